"""Readers, writers and streams on small files."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.operators import amendments, hierarchies
from lawloom.sources import readers, writers
from lawloom.streaming import registers as streams

XML = """<Legislation xmlns="http://www.legislation.gov.uk/namespaces/legislation" xmlns:dc="http://purl.org/dc/elements/1.1/" RestrictExtent="E+W+N.I." RestrictStartDate="2001-02-03">
<ukm:Metadata xmlns:ukm="u"><dc:title>The X Regulations 2001 (revoked)</dc:title><dc:description>About x.</dc:description><dc:modified>2020-01-02</dc:modified>
<dc:subject>Health, England and Wales</dc:subject><dc:subject scheme="SIheading">Health, England and Wales</dc:subject><dc:subject scheme="SIheading">SAFETY</dc:subject><dct:valid>2001-05-06</dct:valid>
<ukm:SecondaryMetadata><ukm:Made Date="2001-01-01"/><ukm:ComingIntoForce><ukm:DateTime Date="2001-04-01"/></ukm:ComingIntoForce></ukm:SecondaryMetadata>
<ukm:Statistics><ukm:TotalParagraphs Value="12"/><ukm:BodyParagraphs Value="7"/></ukm:Statistics></ukm:Metadata>
<Contents><ContentsItem ContentRef="regulation-1" RestrictExtent="E+W"/><ContentsItem ContentRef="regulation-2" RestrictExtent="N.I."/></Contents></Legislation>"""


@pytest.fixture
def xml(spark):
    return spark.createDataFrame([(1, XML)], "id int, xml string")


def test_records_and_articles(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"records": [{"id": "r1", "createdTime": "t", "fields": {"Name": "UK_uksi_2001_1", "More": 1}}, {"id": "r2", "createdTime": "t", "fields": {}}]}))
    rows = readers.records(spark, str(tmp_path), T.StructType([T.StructField("Name", T.StringType())])).orderBy("record_id").collect()
    assert [(r.record_id, r.Name) for r in rows] == [("r1", "UK_uksi_2001_1"), ("r2", None)]
    (tmp_path / "a.json").write_text(json.dumps({"records": [{"ID": "x", "Text": "t"}]}))
    assert readers.articles(spark, str(tmp_path), T.StructType([T.StructField("ID", T.StringType())])).collect()[0].ID == "x"


def test_tables_and_texts(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'say "x",\nnow', ["a", "b"])], "n int, text string, list array<string>")
    writers.table(rows, str(tmp_path / "t"))
    back = readers.table(spark, str(tmp_path / "t"), T.StructType.fromDDL("n int, text string, list string")).collect()
    assert [tuple(r) for r in back] == [(1, 'say "x",\nnow', "a,b")]
    (tmp_path / "x.txt").write_text("one\ntwo")
    assert readers.documents(spark, str(tmp_path / "x.txt")).collect()[0].text == "one\ntwo"
    writers.article_table(spark.createDataFrame([("i", ["F1", "F2"], "t")], "id string, changes array<string>, text string"), str(tmp_path / "a"))
    head = readers.table(spark, str(tmp_path / "a"), T.StructType.fromDDL(", ".join(f"{c} string" for c in writers.ARTICLE_COLUMNS))).collect()[0]
    assert (head.id, head.changes, head.text, head.part) == ("i", "F1,F2", "t", None)


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, "inc"), (2, "x", "exc")], "n int, v string, category string")
    writers.records(rows, str(tmp_path / "r"))
    assert sorted(json.loads(x.value).keys().__len__() for x in spark.read.text(str(tmp_path / "r")).collect()) == [2, 3]
    writers.categorised(rows, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "c" / "category=exc")).collect()[0].v == "x"
    assert rows.select(writers.tab_line(F.col("n"), F.col("v"), F.lit("sub 0")).alias("x")).orderBy("n").collect()[0].x == "1\t\t"
    assert [r.line for r in writers.fixed_width(rows, ["v", "category"], 3).orderBy("line").collect()] == ["  inc", "x exc"]
    lines = spark.createDataFrame([(1, k, f"l{k}") for k in range(5)], "d int, seq int, line string")
    assert [r.text for r in writers.pasted(lines, ["d"], 2).orderBy("chunk").collect()] == ["l0\nl1", "l2\nl3", "l4"]


def test_metadata(xml):
    m = xml.select(readers.law_metadata(F.col("xml")).alias("m")).collect()[0].m
    assert m.title.startswith("The X") and m.md_subjects == ["health"] and m.si_codes == ["HEALTH", "SAFETY"] and (m.md_total_paras, m.md_body_paras, m.md_images) == (12, 7, None)
    assert (m.md_made_date, m.md_coming_into_force_date, m.md_dct_valid_date, m.md_restrict_extent, m.md_restrict_start_date) == ("2001-01-01", "2001-04-01", "2001-05-06", "E+W+NI", "2001-02-03")
    r = xml.select(readers.revoke_state(F.col("xml")).alias("r")).collect()[0].r
    assert r.revoked and r.restrict_extent == "E+W+NI"
    e = xml.select(readers.extents(F.col("xml")).alias("e")).collect()[0].e
    assert [(x.provision, x.extent) for x in e] == [("regulation-1", "E+W"), ("regulation-2", "NI")]


def test_enacting_text(spark):
    text = '<L><IntroductoryText><Text>By powers <FootnoteRef Ref="f00001"/> of <Citation id="c1" URI="http://x/id/ukpga/1974/37">1974</Citation></Text></IntroductoryText><EnactingText>So made.</EnactingText><Footnote id="f00001"><Citation URI="http://x/id/ukpga/1999/1"/><Citation URI="http://x/id/uksi/2000/2"/></Footnote></L>'
    e = spark.createDataFrame([(text,)], "x string").select(readers.enacting_text(F.col("x")).alias("e")).collect()[0].e
    assert e.introductory == "By powers f00001 of [start_ref]c1[end_ref]1974" and e.enacting == "So made."
    assert e.urls == {"f00001": ["http://x/id/ukpga/1999/1", "http://x/id/uksi/2000/2"], "c1": ["http://x/id/ukpga/1974/37"]}


def test_pages(spark):
    row = "".join(f"<td>{c}</td>" for c in ["Old Act", '<a href="/id/ukpga/1974/37">1974 c. 37</a>', "s. 1", "repealed", "New Act", '<a href="/id/ukpga/1999/1">1999 c. 1</a>', "s. 2", "Yes", ""])
    pages = spark.createDataFrame([("q", f"<table><tbody><tr>{row}</tr></tbody></table>")], "k string, html string")
    a = readers.amendment_rows(pages, "k", "html").collect()[0]
    assert (a.path_of_law, a.target, a.affect, a.path, a.applied) == ("/id/ukpga/1974/37", "s. 1", "repealed", "/id/ukpga/1999/1", "Yes")
    news = spark.createDataFrame([("d", '<h6><a href="/id/uksi/2024/12">The X Order 2024</a></h6><p>About <b>x</b>.</p><h6><a href="/id/ssi/2024/3">Y</a></h6>')], "k string, html string")
    got = [tuple(r) for r in readers.new_laws(news, "k", "html").orderBy("path").collect()]
    assert got == [("d", "Y", "/id/ssi/2024/3", "ssi", "2024", "3", ""), ("d", "The X Order 2024", "/id/uksi/2024/12", "uksi", "2024", "12", "About x.")]
    cell = lambda path, title: f'<tr><td><a href="{path}">{title}</a></td><td>1</td><td>Order</td></tr>'
    found = spark.createDataFrame([("fire", cell("/uksi/2001/5/made", "The Fire Order 2001") + cell("/eudr/2001/6/contents", "E") + "<tr><td>Gorchymyn</td></tr>"), ("order", cell("/uksi/2001/5/made", "The Fire Order 2001"))], "term string, html string")
    r = readers.search_results(found, "html", "term").collect()
    assert [(x.name, x.title, x.terms) for x in r] == [("UK_uksi_2001_5", "Fire Order", ["fire", "order"])]
    assert spark.createDataFrame([('<a class="x" href="/y">z</a>',)], "h string").select(readers.links(F.col("h")).alias("l")).collect()[0].l == ["/y"]


def test_joined_and_rendered(spark):
    docs = spark.createDataFrame([(1, "[::part::]1 One\nmore\n[::section::]2 Two")], "d int, text string")
    lines = hierarchies.joined_lines(hierarchies.tagged_lines(docs, "d", "text"), "d").orderBy("seq").collect()
    assert [(r.tag, r.body) for r in lines] == [("part", "1 One more"), ("section", "2 Two")]
    rows = spark.createDataFrame([("l", ["b", "a"], "s10"), ("l", ["a"], "s9"), ("l", ["a"], "s" + "9" * 30)], "law string, tags array<string>, ref string")
    text = hierarchies.rendered(hierarchies.inverted_index(rows, ["law"], "tags", "ref"), ["law"]).collect()[0].text
    assert text == "[a]\ns9\ns10\ns" + "9" * 30 + "\n\n[b]\ns10"


def test_register_kept_by_a_stream(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "register")
    schema, states = "id int, at int, v string", []
    for k, rows in enumerate([[(1, 1, "a"), (2, 1, "b")], [(2, 2, "c"), (2, 3, "d"), (3, 1, "e")], [(1, 9, "z")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(source))
        stream = spark.readStream.schema(schema).json(str(source))
        streams.maintained(stream, path, ["id"], "at", str(tmp_path / "checkpoint"), parts=4).awaitTermination()
        states.append({r.id: r.v for r in streams.version(spark, path, k).collect()})
    assert states == [{1: "a", 2: "b"}, {1: "a", 2: "d", 3: "e"}, {1: "z", 2: "d", 3: "e"}] and streams.version(spark, path, -1) is None


def test_late_rows_lose_and_registers_are_not_begun_anew(spark, tmp_path):
    schema, source, path = "id long, at long, v string", tmp_path / "late", str(tmp_path / "held")

    def batch(rows, checkpoint, **more):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(source))
        streams.maintained(spark.readStream.schema(schema).json(str(source)), path, ["id"], "at", str(tmp_path / checkpoint), parts=2, **more).awaitTermination()
        return {r.id: r.v for r in streams.version(spark, path, streams.newest_version(spark, path)).collect()}

    assert streams.newest_version(spark, path) is None
    assert batch([(1, 5, "new"), (2, 1, "b")], "one") == {1: "new", 2: "b"}
    assert batch([(1, 2, "old"), (2, 1, "same")], "one") == {1: "new", 2: "same"}
    with pytest.raises(ValueError, match="first=2"):
        batch([(3, 1, "c")], "two")
    source = tmp_path / "other"
    assert batch([(3, 1, "c"), (1, 4, "older")], "two", first=2) == {1: "new", 2: "same", 3: "c"}
    assert batch([(1, 6, "newer")], "two", first=2) == {1: "newer", 2: "same", 3: "c"} and streams.newest_version(spark, path) == 3


def test_reach_goes_deep_with_a_plan_that_does_not_grow(spark):
    edges = spark.createDataFrame([(str(k), str(k + 1)) for k in range(9)] + [("3", "x"), ("x", "3")], "a string, b string")
    got = amendments.reach(edges, spark.createDataFrame([("0",)], "node string"), 6)
    assert {r.node: r.level for r in got.collect()} == {**{str(k): k for k in range(7)}, "x": 4}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
    assert amendments.reach(edges, spark.createDataFrame([("z",)], "node string"), 6).count() == 1


def test_windowed_counts(spark, tmp_path):
    spark.sql("SELECT timestamp'2024-01-01 00:00:10' AS at, 'a' AS k UNION ALL SELECT timestamp'2024-01-01 00:00:50', 'a' UNION ALL SELECT timestamp'2024-01-01 00:01:10', 'b'").write.parquet(str(tmp_path / "e"))
    events = spark.readStream.schema("at timestamp, k string").parquet(str(tmp_path / "e"))
    q = streams.windowed_counts(events, "at", ["k"], "1 minute", "10 seconds").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.k, r.n) for r in spark.table("counts").collect()) == [("a", 2), ("b", 1)]

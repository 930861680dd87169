"""Each workflow once from its first rows to its last."""

from pyspark.sql import functions as F

from lawloom.operators import articles
from lawloom.plans import workflows as wf

from .test_acts import PAGE
from .test_sources import XML


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_credentials_and_new_laws_with_metadata(spark):
    laws = spark.createDataFrame([("The Fire Order", None, 2001, "12/5"), ("Water Act", "ukpga", 1999, "3")], "title string, type_code string, year int, number string")
    got = rows(wf.run(laws, wf.WORKFLOWS["credentials"]).withColumn("n", F.size("tags")), "name", "acronym", "old_number", "type_class", "type")
    assert [r[0] for r in got] == ["UK_ukpga_1999_3", "UK_uksi_2001_5"] and [r[2:4] for r in got] == [(None, "Act"), ("12/5", "Order")]
    new = spark.createDataFrame([(XML, "uksi", 2001, "7")], "xml string, type_code string, year int, number string")
    r = wf.run(new, wf.WORKFLOWS["new_with_metadata"]).first()
    assert r.name == "UK_uksi_2001_7" and r.title.startswith("The X") and r.md_date == "2001-04-01"


def test_metadata_and_extent(spark):
    laws = spark.createDataFrame([("a", XML)], "law string, xml string")
    r = wf.run(laws, wf.WORKFLOWS["metadata"]).first()
    assert r.law == "a" and r.si_codes == ["HEALTH", "SAFETY"] and r.md_date is not None
    e = wf.run(laws, wf.WORKFLOWS["extent"]).first()
    assert e.law == "a" and "regulation-1" in str(e) and "regulation-2" in str(e)


def test_enacted_by(spark):
    laws = spark.createDataFrame(
        [("n1", "uksi", None, "The powers conferred by section 2 of the Act of 1974 f00001.", "x f00001", {"f00001": ["http://www.legislation.gov.uk/id/ukpga/1974/37"]}), ("n2", "ukpga", "Act", "any", None, None)],
        "name string, type_code string, type_class string, text string, enacting_text string, urls map<string,array<string>>",
    )
    got = dict(rows(wf.run(laws, wf.WORKFLOWS["enacted_by"]), "name", "enacted_by"))
    assert got["n2"] == [] and got["n1"] == ["UK_ukpga_1974_37"]


def test_amended_by(spark):
    schema = "law string, path_of_law string, title_of_law string, path string, name string, title string, year int, target string, affect string, applied string"
    edges = spark.createDataFrame([("L", "/l", "Old", "/a", "A", "New Act", 2001, "s. 1", "repealed", "Yes"), ("L", "/l", "Old", "/b", "B", "Act B", 2003, "Act", "revoked", "Yes"), ("M", "/m", "M", "/b", "B", "Act B", 2003, "s. 2", "substituted", "Yes")], schema)
    got = {r.law: r for r in wf.run(edges, wf.WORKFLOWS["amended_by"]).collect()}
    assert got["L"].repeals == 2 and got["L"].revoked_by == "A,B" and "New Act" in got["L"].live_description and got["M"].live_description is None
    assert got["L"].live != got["M"].live and got["L"].amendments == 2


def test_taxa_and_law_taxa(spark):
    text = ["The employer shall ensure that every employee is trained.", "The Secretary of State may by regulations make provision.", "In this Part x means y."]
    records = spark.createDataFrame([("L", f"UK_uksi_2001_1_1__1_{k + 1}__", f"u/{k + 1}", "article", t) for k, t in enumerate(text)] + [("M", "UK_uksi_2002_1_1__1_1__", "u", "article", "Nothing.")], "law string, id string, url string, record_type string, text string")
    found = {r.id: r for r in wf.run(records, wf.WORKFLOWS["taxa"]).collect()}
    first = found["UK_uksi_2001_1_1__1_1__"]
    assert "Org: Employer" in first.duty_actor and "Org: Employer" in first.dutyholder and "Duty" in first.duty_type
    laws = {r.law: r for r in wf.run(records, wf.WORKFLOWS["law_taxa"]).collect()}
    assert set(laws) == {"L", "M"} and laws["M"].dutyholder == [] and laws["M"].article_dutyholder is None
    law = laws["L"]
    assert "Org: Employer" in law.dutyholder and "[Org: Employer]\nu/1" in law.dutyholder_article and "UK_uksi_2001_1_1__1_1" in law.article_dutyholder
    assert law.article_dutyholder_clause.startswith("[") and "👤Org: Employer" in law.article_dutyholder_clause and "Duty" in law.duty_type


def test_law_taxa_equals_a_plain_version(spark):
    columns = ["a", "b"]
    given = [("L", f"id{k}", f"u/{k % 4}", [x for x in ("x", "y", "z") if (k + ord(x)) % 3], ["q"] if k % 2 else None, f"C\n👤x\nclause {k}") for k in range(12)]
    records = spark.createDataFrame(given, "law string, id string, url string, a array<string>, b array<string>, a_txt string")
    got = articles.law_taxa(records, "law", columns, {"a": "a_txt"}).first()
    assert got.a == ["x", "y", "z"] and got.b == ["q"]
    own = {}
    for _, i, u, a, _, _ in given:
        for t in a:
            own.setdefault(t, set()).add(u)
    assert got.a_article == "\n\n".join("[" + t + "]\n" + "\n".join(sorted(own[t])) for t in sorted(own))
    assert got.article_b == "\n\n".join(f"id{k}\n[q]" for k in range(1, 12, 2))
    assert articles.law_taxa(records.limit(0), "law", columns, {"a": "a_txt"}).count() == 0


def test_applicability_and_fitness(spark):
    text = "These Regulations shall not apply to vessels which are registered outside the United Kingdom and are on passage through territorial waters."
    provisions = spark.createDataFrame([("L", "3", text), ("L", "4", "Regulation 5 applies to any air monitoring.")], "law string, provision string, text string")
    got = rows(wf.run(provisions, wf.WORKFLOWS["applicability"]), "category", "scope")
    assert ("disapplies-to", "Whole") in got and len(got) == 2
    fits = rows(wf.run(provisions, wf.WORKFLOWS["fitness"]).filter("matched"), "fit_id")
    assert ("disapplies-to|vessels|registered-outside-the-united-kingdom|passage-through-territorial-waters",) in fits


def test_interpretation(spark):
    records = spark.createDataFrame([("L", 1, "heading", "Interpretation"), ("L", 2, "sub-section", "(1) In these Regulations— “employer” means a person who employs;📌“ship” means a vessel.")], "law string, seq int, type string, text string")
    got = rows(wf.run(records, wf.WORKFLOWS["interpretation"]), "term")
    assert {t for (t,) in got} == {"employer", "ship"}


def test_pages_of_acts_to_records(spark):
    got = wf.run(spark.createDataFrame([("L", PAGE)], "law string, html string"), wf.WORKFLOWS["act_records"]).orderBy("line").collect()
    assert [(r.component, r.number) for r in got if r.component in ("part", "section", "sub_section", "paragraph", "sub_paragraph")] == [("part", "2A"), ("section", "1"), ("sub_section", "2"), ("sub_section", "3"), ("paragraph", "2"), ("sub_paragraph", "2")]


def test_every_workflow_is_run_here():
    source = open(__file__).read()
    assert all(f'"{name}"' in source for name in wf.WORKFLOWS)

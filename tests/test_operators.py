"""Operators whose meaning SQL does not tell, on cases of their own."""

import re

import pytest
from pyspark.sql import functions as F

from lawloom.functions import identities, provisions, titles
from lawloom.operators import articles, classifiers, deltas, enactments, fuzzy, hierarchies, interpretations, rules, statutes


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


@pytest.mark.parametrize(
    "text, want",
    [
        ("Regulations 3 to 6 shall apply to a ship but shall not apply to a boat", ["Regulations 3 to 6 shall apply to a ship.", "Regulations 3 to 6 shall not apply to a boat."]),
        ("These Regulations shall not extend to—\n(a) ships; or\n(b) aircraft, unless they are parked", ["These Regulations shall not extend to ships.", "These Regulations shall not extend to aircraft, unless they are parked."]),
        ("Regulation 4 shall not apply to a vehicle used on a road, save that it shall not apply to a lorry", ["Regulation 4 shall not apply to a vehicle used on a road.", "Regulation 4 shall not apply to a lorry."]),
        ("Nothing in these Regulations shall apply to or in relation to ships, except tugs", ["These Regulations shall not apply to or in relation to ships.", "Tugs."]),
        ("As respects any mine worked before 2000, regulation 5 applies to any such mine as before.", ["Regulation 5 applies to a mine worked before 2000 as before."]),
        ("that the duty shall apply", ["The duty shall apply."]),
    ],
)
def test_rules_are_cut(text, want):
    assert rules.separate(text) == want


def test_every_cut_ends():
    for text in ("", "but but but shall apply but", "save that except that such such apply to such a ", "—\n(a) —\n(b) ", "except except except", "shall apply to such a x or y but except that save that"):
        assert rules.separate(text)


def test_rules_of_provisions(spark):
    rows = spark.createDataFrame([(1, "[F1 12 Regulations 7(1) and 2) shall apply to ships but shall not apply to boats]")], "id int, text string")
    got = sorted((r.rule, r.category, r.provision_number, r.scope) for r in rules.single_rules(rows, ["id"]).collect())
    assert [(c, n, s) for _, c, n, s in got] == [("applies-to", ["7(1)", "7(2)"], "Part"), ("disapplies-to", ["7(1)", "7(2)"], "Part")]
    headings = spark.createDataFrame([("l", "7", "[F2 Duties of Owners]")], "law string, number string, text string")
    named = rules.with_headings(rules.single_rules(rows, ["id"]).withColumn("law", F.lit("l")), headings, "law").collect()
    assert {tuple(r.provision) for r in named} == {("duties-of-owners",)}


def test_roles_hold_their_clauses(spark):
    text = " Every employer shall ensure safety.\n The Secretary of State must act.\n No owner may object. He shall comply."
    rows = spark.createDataFrame([(1, text, "article"), (2, text, "heading"), (3, "One line where every employer shall act", "section"), (4, "For “a” there is inserted “b”", "article"), (5, None, "article")], "id int, text string, kind string")
    base = rows.withColumns({"duty_actor": classifiers.governed(F.col("text")), "duty_actor_gvt": classifiers.government(F.col("text"))})
    got = {r.id: r for r in classifiers.without_unbinding(classifiers.with_roles(base, "text", "kind")).collect()}
    assert set(got[1].dutyholder) >= {"Org: Employer", "Org: Owner"} and got[1].responsibility_holder == ["Gvt: Minister"] and got[1].duty_type[:3] == ["Duty", "Right", "Responsibility"]
    assert "DUTY\n👤Org: Employer\n📌" in got[1].dutyholder_txt and got[1].dutyholder_txt.startswith("DUTY\n👤")
    assert got[2].duty_type == [] and got[2].dutyholder == [] and got[3].dutyholder == [] and got[4].duty_type == ["Amendment"] and got[5].duty_type == []


def test_kinds_take_their_text(spark):
    kinds = lambda s: one(spark, classifiers.generic_kinds()(F.lit(s)))
    assert kinds("This Act extends to Wales.") == ["Extent"] and kinds(None) == [] and "Offence" in kinds("An offence, and proceedings")


def test_definitions(spark):
    text = "“alpha”, “beta” and “gamma” mean letters;\n“the thing” means an object .\n“x”"
    found = one(spark, interpretations.definitions()(F.lit(text)))
    assert [(d.term, d.definition) for d in found] == [("alpha", "mean letters"), ("beta", "mean letters"), ("gamma", "mean letters"), ("the thing", "means an object ")] or [d.term for d in found][:3] == ["alpha", "beta", "gamma"]
    welsh = one(spark, interpretations.definitions(True)(F.lit("“dog” (“ci”) means an animal.")))
    assert [(d.term, d.welsh) for d in welsh] == [("dog", "ci")]
    assert one(spark, interpretations.clean_definition(F.lit(" means x ( ) . . ; F12"))) == "means x" and one(spark, interpretations.scope(F.lit("In this Part"))) == "part"


def test_conferred_powers(spark):
    text = "powers conferred by section 1 of the Health and Safety at Work etc. Act 1974 f00002, and powers under the Act f00003"
    assert one(spark, F.size(enactments.conferring(F.lit(text)))) == 2
    assert one(spark, enactments.codes(F.lit("a f00002 and [start_ref]c9[end_ref]"))) == ["f00002", "c9"]
    assert one(spark, enactments.law_of_url(F.lit("http://www.legislation.gov.uk/id/uksi/2001/9"))) == "UK_uksi_2001_9" and one(spark, enactments.law_of_url(F.lit("x"))) is None


def test_best_match_keeps_every_name(spark):
    names = spark.createDataFrame([(1, "b", "martha"), (2, "b", "zzz"), (3, "c", "dwayne"), (4, "b", "exact")], "id int, block string, name string")
    others = spark.createDataFrame([("b", "marhta"), ("b", "exact"), ("b", "exacts")], "block string, other string")
    got = {r.id: (r.match, r.score) for r in fuzzy.best_match(names, others, ["block"], "name", "other", "id", 0.6).collect()}
    assert got == {1: ("marhta", 0.944444), 2: (None, None), 3: (None, None), 4: ("exact", 1.0)}


def test_names_that_a_block_repeats_are_compared_once(spark):
    names = spark.createDataFrame([(k, "b", ["red bolts", "blue gear", None][k % 3]) for k in range(30)], "id long, block string, name string")
    others = spark.createDataFrame([("b", "red bolt"), ("b", "red bolt act"), ("b", "blue gears")], "block string, other string")
    found = fuzzy.best_match(names, others, ["block"], "name", "other", "id", 0.6)
    got = {r.id: r.match for r in found.collect()}
    assert got == {k: ["red bolt", "blue gears", None][k % 3] for k in range(30)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[block#\d+, name#\d+\], \[block#\d+, name#\d+\]", plan)


def test_repetitions_beyond_the_alphabet(spark):
    rows = spark.range(300).selectExpr("id AS n", "1 AS law", "'s' AS id")
    got = {r.n: r.id for r in hierarchies.distinct_ids(rows, ["law"], "id", "n", hierarchies.code_point).collect()}
    assert got == {n: "s" + (chr(64 + n) if n else "") for n in range(300)}


def article_records(spark):
    return spark.createDataFrame(
        [("UK_uksi_2001_1", "UK_uksi_2001_1_1_____", "1", "part", ["b", None], "F1 x F2 ", "u/1"), ("UK_uksi_2001_1", "UK_uksi_2001_1_1_2____", "2", "chapter", ["a", "b"], "F2 y F9 ", "u/2"), ("UK_uksi_2001_2", "UK_uksi_2001_2_1_____", "3", "part", None, None, None)],
        "law string, id string, record_id string, record_type string, tags array<string>, text string, url string",
    )


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


#: Per operator of articles: its rows, the most exchanges of its plan, and what it gives.
ARTICLES = {
    "owned": (lambda r: articles.owned(r, "tags"), 2, {"1": ["a", "b"], "2": ["a", "b"], "3": []}),
    "article_tags": (lambda r: articles.article_tags(r, "law", "tags"), 1, {"UK_uksi_2001_1": "UK_uksi_2001_1_1\n[b]\n\nUK_uksi_2001_1_1_2\n[a; b]"}),
    "with_changes": (lambda r: articles.with_changes(r, r.selectExpr("law", "explode(array('F1', 'F2')) AS code"), "law").select("record_id", "changes"), 2, {"1": ["F2", "F1"], "2": ["F2"], "3": []}),
    "law_taxa": (lambda r: articles.law_taxa(r, "law", ["tags"], {}).select("law", "tags_article"), 4, {"UK_uksi_2001_1": "[a]\nu/2\n\n[b]\nu/1\nu/2", "UK_uksi_2001_2": None}),
}


@pytest.mark.parametrize("name", ARTICLES)
def test_records_of_a_law_move_once(spark, name):
    of, most, want = ARTICLES[name]
    got = of(article_records(spark))
    assert exchanges(got) <= most  # a plan that has run shows them twice
    assert {r[0]: r[1] for r in got.collect()} == want


def test_ranges_with_letters(spark):
    expand = lambda s: one(spark, provisions.expand_range(F.lit(s)))
    assert expand("25B-25D") == ["25B", "25C", "25D", "25"] and expand("25-27") == ["25", "26", "27"] and expand("105ZA-105ZC") == ["105ZA", "105ZB", "105ZC", "105Z"] and expand("x") is None


def test_small_functions(spark):
    assert one(spark, titles.money(F.lit("£1,000"))) == 1000.0 and one(spark, titles.business_type(F.lit("X Limited"))) == "LTD" and one(spark, titles.ordinal_number(F.lit("Third"))) == "3"
    assert identities.type_codes(["uk", "ssi"]) == ["ukpga", "uksi", "ssi"]
    with pytest.raises(ValueError):
        identities.type_codes(["nope"])
    keys = [one(spark, titles.natural_key(F.lit(s))) for s in ("s9", "s10", "s010", "s" + "1" * 20, "s" + "2" * 20)]
    assert keys == sorted(keys) and keys[1] == keys[2] and len(set(keys)) == 4


def test_long_bodies_are_cut(spark):
    docs = spark.createDataFrame([(1, "Anhang I\nListe\n" + "x" * 6000), (2, "Anhang I\nListe\nkurz"), (3, None), (4, "")], "id int, text string")
    got = {r.id: r.text for r in statutes.statute(docs, "id", "text", "AUT").collect()}
    assert got == {1: "Anhang I", 2: "Anhang I📌kurz"}


def test_deltas(spark):
    assert one(spark, deltas.added(F.lit("a, b"), F.lit("b,c ,d"))) == ["c", "d"] and one(spark, deltas.change(F.lit(""), F.lit("x"))) == "nil -> x"


def test_inserted_blocks_are_joined(spark):
    from lawloom.functions import texts

    join = lambda s: one(spark, texts.joined_inserts(F.lit(s)))
    assert join("there is inserted—\n“1 A “b” c\nd.”\nNext\nline") == "there is inserted— 📌“1 A “b” c 📌d.”\nNext\nline"
    long = join("there is substituted—\n“" + "x\n" * 400 + "”\nend")
    assert long.startswith("there is substituted— 📌“x 📌x") and "📌...📌" in long and long.endswith("”\nend") and "\n" not in long[:-4]
    assert join("inserted—\n“never closed\nmore") == "inserted—\n“never closed\nmore" and join(None) is None


def test_clauses_stand_with_their_tags(spark):
    from lawloom.operators import articles

    clauses = "DUTY\n👤Org: Owner\n📌the owner must\nDUTY\n👤Org: Employer\n📌every employer shall"
    rows = spark.createDataFrame([("l", ["Org: Owner", "Org: Employer"], clauses, "u10"), ("l", ["Org: Owner"], "DUTY\n👤Org: Owner\n📌no owner may", "u9")], "law string, tags array<string>, clauses string, url string")
    got = {r.tag: r.text for r in articles.tag_clauses(rows, "law", "tags", "clauses", "url").collect()}
    assert got == {"Org: Owner": "u9\nDUTY\n👤Org: Owner\n📌no owner may\nu10\nDUTY\n👤Org: Owner\n📌the owner must", "Org: Employer": "u10\nDUTY\n👤Org: Employer\n📌every employer shall"}


def test_headings_without_a_number(spark):
    from lawloom.operators import hierarchies

    rows = spark.createDataFrame([("l", 0, "heading", None), ("l", 1, "heading", "1"), ("l", 2, "section", "4"), ("l", 3, "heading", None), ("l", 4, "heading", None), ("l", 5, "heading", "2"), ("l", 6, "heading", None)], "law string, seq int, tag string, number string")
    assert [r.number for r in hierarchies.lettered_headings(rows, ["law"], "seq").orderBy("seq").collect()] == ["A", "1", "4", "1A", "1B", "2", "2A"]


def test_categories_bases_and_kept_tags(spark):
    from lawloom.functions import titles
    from lawloom.operators import categories, registers

    laws = spark.createDataFrame([(1, "The Water Act", None), (2, "Air Order", ["A", "B"]), (3, "Correction Slip to water", ["B"]), (4, None, ["B", "A"]), (5, "Noise", [])], "id int, title string, codes array<string>")
    families = spark.createDataFrame([("B", "Bees")], "code string, family string")
    terms = {"Wet": ["water"], "Dry": ["air"]}
    got = {m: {r.id: (r.category, r.family) for r in categories.categorised(laws, ["id"], "title", "codes", families, terms, m).collect()} for m in categories.MODES}
    assert got["term_si"] == {1: ("inc_wo_si", "Wet"), 2: ("inc_w_si", ""), 4: ("exc", None), 5: ("exc", None)}
    assert got["si_term"] == {1: ("inc_wo_si", "Wet"), 2: ("inc_w_si", ""), 4: ("inc_w_si", "Bees"), 5: ("exc", None)}
    counts = categories.category_counts(categories.categorised(laws, ["id"], "title", "codes", families, terms))
    assert {r.category: r.n for r in counts.collect()} == {"inc_wo_si": 1, "inc_w_si": 1, "exc": 2}
    based = categories.with_base(spark.createDataFrame([("Wet",), (None,)], "family string"), spark.createDataFrame([("Wet", "app1")], "family string, base string"))
    assert {(r.family, r.base) for r in based.collect()} == {("Wet", "app1"), (None, None)}
    with pytest.raises(ValueError, match="mode"):
        categories.categorised(laws, ["id"], "title", "codes", families, terms, "both")
    tags = spark.createDataFrame([(["A", "B"], "The Water Act"), (["A"], "Water Resources Act"), (["A"], None)], "tags array<string>, title string")
    assert [r[0] for r in tags.select(titles.kept_tags(F.col("tags"), F.col("title"))).collect()] == [["A", "B"], ["Water", "Resources", "Act"], ["A"]]
    base = spark.createDataFrame([(1, ["a"], "x"), (2, None, "y")], "id int, links array<string>, v string")
    new = spark.createDataFrame([(1, ["b", "a"], "x"), (2, ["c"], ""), (3, None, "z")], "id int, links array<string>, v string")
    merged = {r.id: (r.links, r.v, r.action) for r in registers.merged(base, new, ["id"], keep_if_empty=["v"], union=["links"]).collect()}
    assert merged == {1: (["a", "b"], "x", "update"), 2: (["c"], "y", "update"), 3: ([], "z", "insert")}

"""Pages of laws to lines with tags, against given cases and a plain fold."""

import random

import pytest

from lawloom.functions.spread import spread
from lawloom.operators import annotations as an
from lawloom.sources import acts

PAGE = """<html><body><p>Menu</p><div class="big DocContainer"><h1 class="LegNo">2003 CHAPTER 4</h1>
<a class="LegAnchorID" id="part-IIA"></a><h2 class="LegPartFirst"><span>Part IIA</span><span class="LegExtentRestriction" title="Applies to x">E+W</span><span>Duties of all</span></h2>
<h3 class="LegP1GroupTitleFirst">General duties</h3>
<a class="LegAnchorID" id="section-1"></a><p class="LegP1ParaText"><span class="LegP1No" id="section-1">1</span><span class="LegExtentRestriction">E+W</span>The employer shall act.</p>
<p class="LegP2ParaText">(2) He shall also report .</p>
<p class="LegClearFix LegP2Container"><span class="LegDS LegLHS LegP2No" id="section-1-3">(3)</span><span class="LegDS LegRHS LegP2Text">Or “ not ” .</span></p>
<h4 class="LegPblock">Cross-heading</h4><div class="LegBlockNotYetInForce"><p>never</p></div>
<p class="LegP1ParaText LegAmend">[::section::]5 quoted</p>
<div class="LegAnnotations"><p class="LegAnnotationsGroupHeading">Textual Amendments</p><div class="LegCommentaryItem" id="commentary-c1"><span>F1</span><p>Words inserted</p></div>
<p class="LegAnnotationsGroupHeading">Marginal Citations</p><div class="LegCommentaryItem" id="commentary-c2"><span>M1</span><p>1974 c. 37.</p></div></div>
<div class="LegClearFix LegTableContainer"><table><thead><tr><th>A</th><th>B</th></tr></thead><tbody><tr><td>1</td><td>2 <b>x</b></td></tr><tr><td>3</td></tr></tbody></table></div>
<div class="LegClearFix LegSignedSection"><div class="LegClearFix LegSignee"><p>A Name</p><p>Minister</p></div></div>
<a class="LegAnchorID" id="schedule-1"></a><h1 class="LegSchedule"><span class="LegScheduleNo">SCHEDULE 1</span><span class="LegExtentRestriction">S</span><span>Lists</span></h1>
<p class="LegClearFix LegSP1Container"><span class="LegDS LegSN1No" id="schedule-1-paragraph-2">2</span><span>First paragraph</span></p>
<p class="LegClearFix LegSP2Container"><span class="LegDS LegSN2No" id="schedule-1-paragraph-2-2">(2)</span><span>Second</span></p>
<a class="LegAnchorID" id="Legislation-ExNote"></a><p>Explanatory note</p></div></body></html>"""
LINES = """2003 CHAPTER 4
[::part::]2A Part IIA [::region::]E+W Duties of ALL
[::heading::]General duties
[::section::]1 1 [::region::]E+W The employer shall act.
[::sub_section::]2 (2) He shall also report.
[::sub_section::]3 (3) Or “not”.
[::heading::]Cross-heading
5 quoted
[::amendment_heading::]Textual Amendments
[::amendment::]F1 F1 Words inserted
[::table::]A\tB
1\t2 x
3
[::signed::]A Name
Minister
[::annex::]1 SCHEDULE 1 [::region::]S Lists
[::paragraph::]2 2 First paragraph
[::sub_paragraph::]2 (2) Second"""


def test_page_to_lines_to_components(spark):
    pages = spark.createDataFrame([(1, PAGE), (1, None), (2, ""), (3, "<p>no container</p>"), (4, PAGE.replace("DocContainer", "x").replace('class="big x"', 'id="viewLegSnippet"'))], "law long, html string")
    got = {}
    for r in acts.law_lines(pages.filter("html IS NOT NULL"), "law").collect():
        got.setdefault(r.law, []).append((r.line, r.text))
    assert {law: [t for _, t in sorted(rows)] for law, rows in got.items()} == {1: LINES.split("\n"), 4: LINES.split("\n")}
    assert acts.law_lines(pages.filter("html IS NULL"), "law").count() == 0 and acts.law_lines(pages.limit(0), "law").count() == 0
    found = an.components(spark.createDataFrame([(1, LINES)], "law long, annotated string"), "law").orderBy("line").collect()
    assert [(r.component, r.number) for r in found[3:6]] == [("section", "1"), ("sub_section", "2"), ("sub_section", "3")] and found[15].region == "S Lists"


@pytest.mark.parametrize("identity, name", [
    ("part-II", "part 2"), ("part-VA", "part 5A"), ("part-Preliminary", "part 1"), ("part-1-chapter-2", "chapter 2"), ("chapter-n3", "chapter 3"), ("part-I-chapter-A", "chapter 1"), ("section-4A", "section 4A"), ("section-4-2", "sub 2"),
    ("section-4A_1", "section 4A"), ("article-7", "article 7"), ("regulation-12n1", "article 12-1"), ("regulation-3n4", "article 3.4"), ("schedule", "annex 1"), ("schedule-n2", "annex 2"), ("schedule-first", "annex 1"), ("schedule-2-part-IIA", "part 2A"),
    ("schedule-part-1-chapter-2", "chapter 2"), ("schedule-1-part-1-chapter-2-paragraph-9", "paragraph 9"), ("schedule-1-paragraph-3-1", "paragraph 3-1"), ("schedule-1-paragraph-3-2", "sub 2"), ("schedule-1-paragraph-wrapper4n2", "paragraph 4.2"),
    ("regulation-abc", None), ("regulation-", None), ("schedule-1-paragraph-", None), ("schedule-1-part-", None), ("schedule-1-paragraph-x", None), ("foo", None), ("", None),
])
def test_anchors(identity, name):
    assert acts.anchor(identity) == (name and "[::{}::]{}".format(*name.split()))


@pytest.mark.parametrize("given, wanted", [
    ("[::region::]E+W\n[::article::]3 3 Text", "[::article::]3 3 Text [::region::]E+W"), ("[::section::]4 4 Title.— (1) Text", "[::section::]4-1 4 Title.—(1) Text"), ("[::section::]4B\n4B Title [::region::]E+W", "[::section::]4B 4B Title [::region::]E+W"),
    ("[::part::]2\n[::sRef::]Regulation 48\nPART II RULES\nMore", "[::part::]2 PART II RULES More\nRegulation 48"), ("[::annex::]3\n[::sRef::]Regulation 8\nSCHEDULE 3\nTests", "[::annex::]3 SCHEDULE 3 Tests Regulation 8"),
    ("[::annex::]1\n[::region::]N.I.\nSchedule 1", "[::annex::]1 Schedule 1 [::region::]N.I."), ("[::heading::][::heading::]A", "[::heading::]A"), ("[::heading::]\nB", "B"), ("[::paragraph::]4.\nText", "[::paragraph::]4. Text"), ("[::paragraph::]4\n[::sub::]1 x", "[::sub::]1 x"),
    ("a\xa0 b ( 3 ) c", "a b (fn3) c"), ("(a)\ntext", "(a) text"), ("[ F1 x ]", "[F1 x]"), ("[::chapter::]2\nCHAPTER 2\nText", "[::chapter::]2 CHAPTER 2\nText"), ("[::marginal_citation::]M1\nText", "Text"),
])
def test_ordered_rewritings(given, wanted):
    assert acts.tidied(given) == wanted


def folded_subs(rows):
    state, out = None, []
    for row in rows:
        for kind in ("article", "section", "paragraph"):
            if row.startswith(f"[::{kind}::]"):
                state = kind
        out.append(row.replace("[::sub::]", f"[::sub_{state}::]", 1) if row.startswith("[::sub::]") and state else row)
    return out


def test_clauses_are_named_as_a_fold_names_them(spark):
    rng = random.Random(4)
    kinds = ["[::article::]1", "[::section::]2", "[::paragraph::]3", "[::sub::]4 (4) [::sub::]", "text", "[::heading::]x", "[::sub_section::]9"]
    laws = {law: [rng.choice(kinds) for _ in range(rng.randrange(1, 60))] for law in range(30)}
    rows = [(law, k, t) for law, texts in laws.items() for k, t in enumerate(texts)]
    rng.shuffle(rows)
    got = acts.with_subs(spark.createDataFrame(rows, "law int, line int, text string"), "law").collect()
    assert {(r.law, r.line): r.text for r in got} == {(law, k): t for law, texts in laws.items() for k, t in enumerate(folded_subs(texts))}


def test_no_page_is_too_deep_or_too_broken():
    deep = '<div class="DocContainer">' + "<div><p class='LegText'>x" * 20_000
    assert acts.page_text(deep).count("x") == 20_000
    assert acts.page_text('<div class="DocContainer"><p class="LegText">a &amp; b<b>c</p></i>d') .split("\n")[0] == "a & b c"


def test_pages_of_a_small_file_are_dealt_to_many_tasks(spark):
    """A file of a few narrow rows is one task, whatever its pages cost."""
    pages = spark.range(64).coalesce(1).selectExpr("id AS law", "'<div class=DocContainer><p>x</p></div>' AS html")
    lines = acts.law_lines(pages, "law")
    assert "REPARTITION_BY_NUM" in lines._jdf.queryExecution().executedPlan().toString()
    assert spread(pages).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert lines.count() == 64


def test_rules_of_an_element_are_looked_up_once():
    acts._rules_of.cache_clear()
    for n in range(20):
        acts.page_text(PAGE.replace("section-1", f"section-{n}"))
    assert acts._rules_of.cache_info().misses < acts._rules_of.cache_info().hits / 10

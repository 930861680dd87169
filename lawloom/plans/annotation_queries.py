"""Annotated acts, the numbering of their parts, and the fields of rules of applicability, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identities as ids
from ..functions import provisions as pv
from ..functions import texts as tx
from ..functions import titles as tt
from ..functions.spread import spread
from ..operators import amendments as am
from ..operators import annotations as an
from ..operators import categories as ca
from ..operators import classifiers as cl
from ..operators import fitness as ft
from ..operators import registers as rg
from ..operators import rewritings as rw
from ..operators import rules as ru
from ..operators import schemes as sc
from ..sources import acts, regulators
from .law_queries import one_of, sql_list, sql_one_of
from .queries import query, read

TITLES = ["Duties", "Powers of inspectors", "Offences"]
REGIONS = ["U.K.", "E+W", "S+N.I."]
_NUMBER = "100 * l_linenumber + l_partkey % 100"


@query(
    f"""WITH rows AS (SELECT l_orderkey, l_linenumber AS n, 'F' || ({_NUMBER}) AS code, {sql_one_of(TITLES, 'l_partkey')} AS title, {sql_one_of(REGIONS, 'l_suppkey')} AS region, 2 * (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, ({_NUMBER}), {sql_one_of(TITLES, 'l_partkey')}, {sql_one_of(REGIONS, 'l_suppkey')}) - 1) AS line FROM lineitem)
SELECT l_orderkey, line::INT AS line, 'amendment' AS component, code AS number, 'S. ' || n || ' substituted (1.1.2000) by an Act' AS text, '' AS region FROM rows
UNION ALL SELECT l_orderkey, (line + 1)::INT, 'section', n::VARCHAR, '[' || code || ' ' || n || ' ' || title || '.', region FROM rows"""
)
def annotated_sections(spark, sf_dir):
    n, code = F.col("l_linenumber"), F.concat(F.lit("F"), F.expr(_NUMBER).cast("string"))
    clause = F.concat(code, F.lit("S. "), n, F.lit(" substituted (1.1.2000) by an Act"))
    section = F.concat(F.lit("["), code, n.cast("string"), F.lit(" "), one_of(TITLES, F.col("l_partkey")), F.lit("."), one_of(REGIONS, F.col("l_suppkey")))
    both = F.struct(n.alias("n"), F.concat_ws("\n", clause, section).alias("rows"))
    acts = spread(read(spark, sf_dir, "lineitem").select("l_orderkey", both.alias("both")), "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("both")).alias("rows"))
    texts = acts.select("l_orderkey", F.array_join(F.transform("rows", lambda x: x["rows"]), "\n").alias("text"))
    return an.components(an.annotated(texts), "l_orderkey")


ROMANS = ["XII", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI"]
FIRST_I = {"I": 1, "II": 2, "III": 3, "IV": 4, "IX": 9}
LETTERS = ["A", "B", "C", "D"]
_LAWS = f"""SELECT p_partkey, p_partkey % 5 AS k, p_size AS n, {sql_one_of(ROMANS, 'p_size')} AS r, 1 + (p_size + 11) % 12 AS v, {sql_one_of(LETTERS, 'p_size')} AS l, 1 + p_size % 4 AS a, {sql_one_of(list(FIRST_I), 'p_size')} AS i, {list(FIRST_I.values())}[1 + p_size % 5] AS j, p_name AS w FROM part"""


@query(
    f"""WITH p AS ({_LAWS})
SELECT p_partkey, 0 AS line, CASE k WHEN 0 THEN 'numeric' WHEN 1 THEN 'roman' WHEN 2 THEN 'alphabetic' WHEN 3 THEN 'roman_numeric' END AS part_scheme, CASE k
  WHEN 0 THEN '[::part::]' || n || ' PART ' || n || ' ' || w || ' [::region::]E+W' WHEN 1 THEN '[::part::]' || v || ' PART ' || r || '  ' || w || ' [::region::]U.K.'
  WHEN 2 THEN '[::part::]1 PART A DUTIES' WHEN 3 THEN '[::part::]' || n || ' Part ' || n || '  Duties [::region::]S' ELSE 'Parts of ' || w END AS text FROM p
UNION ALL SELECT p_partkey, 1, CASE k WHEN 0 THEN 'numeric' WHEN 1 THEN 'roman' WHEN 2 THEN 'alphabetic' WHEN 3 THEN 'roman_numeric' END, CASE k
  WHEN 0 THEN 'PART A DUTIES' WHEN 1 THEN '[::part::]1 PART I I nformation on ' || w || ' [::region::]W' WHEN 2 THEN '[::part::]' || a || ' PART ' || l || ' POWERS'
  WHEN 3 THEN '[::part::]' || j || 'B Part ' || i || 'B  Powers [::region::]E+W' ELSE '[::part::]2A [F5 Part IIA Powers of ' || w || ' [::region::]U.K.' END FROM p"""
)
def numbered_parts(spark, sf_dir):
    k, n, w = F.col("p_partkey") % 5, F.col("p_size").cast("string"), F.col("p_name")
    roman, letter = one_of(ROMANS, F.col("p_size")), one_of(LETTERS, F.col("p_size"))
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    first = F.when(k == 0, text("PART ", n, "E+W", w)).when(k == 1, text("PART ", roman, "U.K. ", w)).when(k == 2, "PART A DUTIES").when(k == 3, text("Part ", n, "S Duties")).otherwise(text("Parts of ", w))
    second = F.when(k == 0, "PART A DUTIES").when(k == 1, text("PART IIWnformation on ", w)).when(k == 2, text("PART ", letter, " POWERS")).when(k == 3, text("Part ", one_of(list(FIRST_I), F.col("p_size")), "BE+W Powers")).otherwise(text("[::part::][F5 Part IIA Powers of ", w, " [::region::]U.K."))
    lines = read(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.array(first, second)).alias("line", "text"))
    return sc.with_headings(lines, "p_partkey").select("p_partkey", "line", "part_scheme", "text")


RULES = [
    "These Regulations shall apply to an employee with vessels of {n} tons",
    "These Regulations shall not apply to vessels which are registered outside the United Kingdom and are on passage through territorial waters.",
    "Regulation {n} shall apply to any air monitoring, health surveillance",
    "Regulations {n} and 7 shall not extend to persons who are not its employees.",
    "Any requirement or prohibition imposed by regulation {n} shall apply to a contractor",
    "These Regulations shall apply to {w}",
    "These Regulations shall apply to and in relation to any activity outside Great Britain",
    "Nothing of {w}",
]
KINDS = ["applies-to", "disapplies-to", "applies-to", "disapplies-to", "applies-to", "applies-to", "extends-to"]
FITS = ["employee|vessels", "vessels|registered-outside-the-united-kingdom|passage-through-territorial-waters", "{b}|air-monitoring", "{b}|x-employee", "{b}|contractor", None, "activity|outside-great-britain"]
PATTERNS = ["<person><plant>", "<plant><property><process>", "<provision><process>", "<provision><person>", "<provision><person>", None, "<process><place>"]
_VALUES = ", ".join(f"({k}, '{kind}', {'NULL' if fit is None else repr(fit)}, {'NULL' if p is None else repr(p)})" for k, (kind, fit, p) in enumerate(zip(KINDS, FITS, PATTERNS)))


@query(
    f"""SELECT p_partkey, kind AS category, replace({sql_list(RULES)}[1 + k], '{{n}}', p_size::VARCHAR).replace('{{w}}', p_name) AS rule, pattern, kind || '|' || replace(fit, '{{b}}', lower(replace(p_brand, ' ', '-'))) AS fit_id,
CASE WHEN k IN (2, 3, 4) THEN 'Part' ELSE 'Whole' END AS scope FROM part JOIN (VALUES {_VALUES}) v(k, kind, fit, pattern) ON p_partkey % {len(RULES)} = k"""
)
def rule_fitness(spark, sf_dir):
    part, k = read(spark, sf_dir, "part"), F.col("p_partkey") % len(RULES)
    rule = F.replace(F.replace(one_of(RULES, F.col("p_partkey")), F.lit("{n}"), F.col("p_size").cast("string")), F.lit("{w}"), F.col("p_name"))
    named = F.when(k.isin(2, 3, 4), F.array(F.lower(F.replace("p_brand", F.lit(" "), F.lit("-"))))).otherwise(F.array().cast("array<string>"))
    rules = part.select("p_partkey", rule.alias("rule"), named.alias("provision"))
    whole = F.when(k == 4, F.array(F.col("p_size").cast("string"))).otherwise(F.array().cast("array<string>"))
    rules = rules.join(part.select("p_partkey", whole.alias("told")), "p_partkey")
    numbers = ru.provision_numbers(F.col("rule"))
    rules = rules.withColumns({"category": ru.category(F.col("rule")), "provision_number": F.when(F.size("told") > 0, F.col("told")).otherwise(numbers)})
    return ft.fitnesses(rules).select("p_partkey", "category", "rule", F.array_join("pattern", "").alias("pattern"), "fit_id", "scope")


#: A law's page with a number {n}, a Roman number {r} and a name {w}, and its lines: component, number, text, region.
PAGE = (
    '<html><body><p>Menu</p><div class="DocContainer"><a class="LegAnchorID" id="part-{r}"></a><h2 class="LegPart"><span class="LegPartNo">PART {r}</span><span class="LegPartTitle">{w}</span></h2>'
    '<h3 class="LegP1GroupTitle">Use of {w}</h3><a class="LegAnchorID" id="section-{n}"></a><p class="LegP1ParaText"><span class="LegP1No" id="section-{n}">{n}</span>  The {w} shall be used .</p>'
    '<p class="LegP2ParaText">(2) Not “ otherwise ”.</p><p class="LegClearFix LegP2Container"><span class="LegDS LegLHS LegP2No" id="section-{n}-3">(3)</span><span class="LegDS LegRHS LegP2Text">Or never.</span></p>'
    '<div class="LegBlockNotYetInForce"><p>Later.</p></div><div class="LegAnnotations"><p class="LegAnnotationsGroupHeading">Textual Amendments</p><div class="LegCommentaryItem" id="commentary-c{n}"><span>F{n}</span><p>Words inserted</p></div></div>'
    '<a class="LegAnchorID" id="schedule-1"></a><h1 class="LegSchedule"><span class="LegScheduleNo">SCHEDULE 1</span><span>Lists of {w}</span></h1><p class="LegClearFix LegSP1Container"><span class="LegDS LegSN1No" id="schedule-1-paragraph-{n}">{n}</span><span>First</span></p>'
    '<p class="LegClearFix LegSP2Container"><span class="LegDS LegSN2No" id="schedule-1-paragraph-{n}-2">(2)</span><span>Second</span></p><a class="LegAnchorID" id="Legislation-ExNote"></a><p>Note</p></div></body></html>'
)
_PAGE_LINES = [
    ("part", "{v}", "PART {r} {wcap}"), ("heading", "Use", "of {w}"), ("section", "{n}", "{n} The {w} shall be used."), ("sub_section", "2", "(2) Not “otherwise”."), ("sub_section", "3", "(3) Or never."),
    ("amendment_heading", "Textual", "Amendments"), ("amendment", "F{n}", "F{n} Words inserted"), ("annex", "1", "SCHEDULE 1 Lists of {w}"), ("paragraph", "{n}", "{n} First"), ("sub_paragraph", "2", "(2) Second"),
]
_LINE_ROWS = ", ".join(f"({k}, '{c}', '{n}', '{t}')" for k, (c, n, t) in enumerate(_PAGE_LINES))
_PUT = lambda c: f"replace(replace(replace(replace(replace({c}, '{{n}}', p_size::VARCHAR), '{{r}}', r), '{{v}}', v::VARCHAR), '{{wcap}}', string_split(p_name, ' ')[1] || ' ' || upper(string_split(p_name, ' ')[2])), '{{w}}', p_name)"


@query(
    f"""WITH p AS (SELECT *, {sql_one_of(ROMANS, 'p_size')} AS r, 1 + (p_size + 11) % 12 AS v FROM part)
SELECT p_partkey, k AS line, component, {_PUT('number')} AS number, {_PUT('text')} AS text, '' AS region FROM p, (VALUES {_LINE_ROWS}) l(k, component, number, text)"""
)
def law_page_lines(spark, sf_dir):
    fill = lambda c, name, value: F.replace(c, F.lit("{" + name + "}"), value)
    html = fill(fill(fill(F.lit(PAGE), "n", F.col("p_size").cast("string")), "r", one_of(ROMANS, F.col("p_size"))), "w", F.col("p_name"))
    lines = acts.law_lines(read(spark, sf_dir, "part").select("p_partkey", html.alias("html")), "p_partkey")
    texts = lines.groupBy("p_partkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n").alias("annotated"))
    return an.components(texts, "p_partkey")


TERMS = {"Metals": ["bolt", "gear"], "Colours": ["red", "blue"], "Sizes": ["small"]}
_CODES = "CASE p_partkey % 5 WHEN 0 THEN [p_type] WHEN 1 THEN ['X', p_type] WHEN 2 THEN ['X'] WHEN 3 THEN []::VARCHAR[] END"
_TERM = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(p_name), '{w}')" for w in ws) + f" THEN '{f}'" for f, ws in TERMS.items()) + " END"


@query(
    f"""WITH p AS (SELECT p_partkey, coalesce({_CODES}, []) AS codes, {_TERM} AS term FROM part),
c AS (SELECT *, list_contains(codes, 'ECONOMY') OR list_contains(codes, 'SMALL') AS member, coalesce(CASE codes[1] WHEN 'ECONOMY' THEN 'E' WHEN 'SMALL' THEN 'S' END, '') AS family FROM p)
SELECT 'term_si' AS mode, p_partkey, CASE WHEN term IS NULL THEN 'exc' WHEN member THEN 'inc_w_si' ELSE 'inc_wo_si' END AS category, CASE WHEN member AND term IS NOT NULL THEN family ELSE term END AS family FROM c
UNION ALL SELECT 'si_term', p_partkey, CASE WHEN member THEN 'inc_w_si' WHEN term IS NULL THEN 'exc' ELSE 'inc_wo_si' END, CASE WHEN member THEN family ELSE term END FROM c"""
)
def new_law_categories(spark, sf_dir):
    k, kind = F.col("p_partkey") % 5, F.col("p_type")
    codes = F.when(k == 0, F.array(kind)).when(k == 1, F.array(F.lit("X"), kind)).when(k == 2, F.array(F.lit("X"))).when(k == 3, F.array().cast("array<string>"))
    laws = read(spark, sf_dir, "part").select("p_partkey", "p_name", codes.alias("codes"))
    families = spark.createDataFrame([("ECONOMY", "E"), ("SMALL", "S")], "code string, family string")
    each = [ca.categorised(laws, ["p_partkey"], "p_name", "codes", families, TERMS, mode).select(F.lit(mode).alias("mode"), "p_partkey", "category", "family") for mode in ca.MODES]
    return each[0].unionByName(each[1])


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus = 'O' AND l_linenumber <= 4 AND l_suppkey % 3 = 1 AS classified, contains(l_returnflag || ',' || l_linestatus, 'R') OR contains(l_returnflag || ',' || l_linestatus, 'F') AS holding,
  CASE WHEN l_linenumber % 2 = 0 THEN l_partkey % 3 = 0 AND l_suppkey % 2 = 0 ELSE l_partkey % 3 = 1 END AS repealed FROM lineitem"""
)
def article_filters(spark, sf_dir):
    line, part, supplier = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    kinds = one_of(["table", *ca.CLASSIFIED[:4], "annex", "figure", "note"], line)
    target, affect = one_of(["", "Act", "s. 2"], part), one_of(["revoked", "repealed"], supplier)
    rows = read(spark, sf_dir, "lineitem").withColumns({"flow": F.when(F.col("l_linestatus") == "O", "main").otherwise("schedule"), "record_type": kinds, "section": (supplier % 3).cast("string"), "marks": F.array("l_returnflag", "l_linestatus")})
    repealed = am.is_full_repeal(target, affect, line % 2 == 0)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ca.classified(section="1").alias("classified"), ca.holding("marks", ["R", "F"]).alias("holding"), repealed.alias("repealed"))


# Pages of a regulator: a list for each nation, details of two customers of three, breaches of every other one.
@query(
    """SELECT c_custkey::VARCHAR AS regulator_id, c_name AS offender_name, '2024-' || lpad((1 + c_custkey % 12)::VARCHAR, 2, '0') || '-' || lpad((1 + c_custkey % 28)::VARCHAR, 2, '0') AS offence_action_date,
  CASE WHEN c_custkey % 3 > 0 THEN 'Field Operations' END AS regulator_function, CASE WHEN c_custkey % 3 > 0 THEN '2025-01-' || lpad((1 + c_custkey % 28)::VARCHAR, 2, '0') END AS offence_compliance_date,
  CASE WHEN c_custkey % 3 > 0 THEN 'Made of ' || lower(c_mktsegment) END AS offence_description, CASE WHEN c_custkey % 2 = 0 THEN 'Act / ' || c_nationkey || '; Rule / ' || c_custkey ELSE '' END AS breaches FROM customer"""
)
def regulator_notices(spark, sf_dir):
    c, k = read(spark, sf_dir, "customer"), F.col("c_custkey")
    row = lambda *cells: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), x if not isinstance(x, str) else F.lit(x), F.lit("</td>")) for x in cells], F.lit("</tr>"))
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    link = F.concat(F.lit("<a title='t' href='x'> "), k, F.lit(" </a>"))
    listed = row(link, F.col("c_name"), "Prohibition", F.concat(two(1 + k % 28), F.lit("/"), two(1 + k % 12), F.lit("/2024")), "LA", "SIC")
    lists = c.groupBy(F.col("c_nationkey").cast("string").alias("page")).agg(F.concat(F.lit("<table>"), F.array_join(F.collect_list(listed), ""), F.lit("</table>")).alias("html"))
    told = F.concat(F.lit("<table>"), row("a", "b", "HSE Directorate", "FIELD OPERATIONS"), row("Compliance Date", F.concat(two(1 + k % 28), F.lit("/01/2025")), "", ""), row("Description", F.concat(F.lit(" Made of "), F.lower("c_mktsegment"), F.lit(" "))), F.lit("</table>"))
    broken = F.concat(F.lit("<table>"), row("", "", "", "Breach", ""), row("1", "", "", F.concat(F.lit("Act / "), "c_nationkey"), ""), row("2", "", "", F.concat(F.lit("Rule / "), k), ""), F.lit("</table>"))
    detail_pages = c.filter(k % 3 > 0).select(k.cast("string").alias("regulator_id"), told.alias("html"))
    breach_pages = c.filter(k % 2 == 0).select(k.cast("string").alias("regulator_id"), broken.alias("html"))
    out = regulators.notices(lists, detail_pages, breach_pages)
    return out.select("regulator_id", "offender_name", "offence_action_date", "regulator_function", "offence_compliance_date", "offence_description", F.array_join("offence_breaches", "; ").alias("breaches"))


@query(
    """SELECT p_partkey, 'Gesetz' || chr(10) || '[::content::]Inhaltsverzeichnis' || chr(10) || repeat('[::content::]§ 1. Zweck' || chr(10) || '[::content::]§ 2. Geltung ' || p_name || chr(10), p_size) || '[::content::]' || p_size || '. Abschnitt: ' || p_name || chr(10) || '§ 3 gilt' || chr(10) || '§ 4. Ende' AS text FROM part"""
)
def contents_lists(spark, sf_dir):
    name, size = F.col("p_name"), F.col("p_size")
    entries = F.repeat(F.concat(F.lit("§ 1. Zweck\n§ 2.\nGeltung "), name, F.lit("\n")), size)
    text = F.concat(F.lit("Gesetz\nInhaltsverzeichnis\n"), entries, size.cast("string"), F.lit(". Abschnitt: "), name, F.lit("\n§ 3 gilt\n§ 4. Ende"))
    return read(spark, sf_dir, "part").select("p_partkey", rw.with_contents(text).alias("text"))


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN 'Law of ' || c_nationkey || ': part ' || c_custkey || '.' ELSE c_name || ' ' || c_mktsegment END AS text FROM customer"""
)
def patched_laws(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    texts = c.select("c_custkey", F.col("c_nationkey").alias("law"), F.concat("c_name", F.lit(" "), "c_mktsegment").alias("text"))
    own = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast(c.schema["c_nationkey"].dataType).alias("law")).filter("law % 5 = 0")
    steps = F.array(F.struct(F.lit(2).alias("ord"), F.lit(r"^L(\d+)$").alias("pattern"), F.concat(F.lit("Law of "), "law", F.lit(": part $1.")).alias("replacement")), F.struct(F.lit(1).alias("ord"), F.lit(r"^\D+0*(\d+) .*$").alias("pattern"), F.lit("L$1").alias("replacement")))
    patches = own.select("law", F.inline(steps))
    return rw.patched(texts, patches, "law").select("c_custkey", "text")


PLANS = [*rg.PLANS, "OTHER"]
WORDS = ["bolter", "gear", "gizmos"]


@query(
    f"""WITH o AS (SELECT o_orderkey, {sql_one_of(PLANS, 'o_orderkey')} AS plan, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderdate::DATE AS d, o_orderpriority AS p, o_custkey AS c FROM orders)
SELECT o_orderkey, CASE plan WHEN 'PUBLIC' THEN 0 WHEN 'STARTER' THEN 1 WHEN 'SUPPORTER' THEN 2 WHEN 'SPONSOR' THEN 3 END AS tier, day[9:10] || '/' || day[6:7] || '/' || day[1:4] AS shown, day AS back,
  upper(p[3:3]) AS letter, c || ' ' || p AS spaced, CASE WHEN c % 17 BETWEEN 1 AND 15 THEN (c % 17)::INT END AS numeral, c % 17 = 0 OR d < DATE '1995-05-25' AS stale,
  plan = 'PUBLIC' AND p IN ('1-URGENT', '2-HIGH') AS wanted, CASE WHEN contains(p, 'URGENT') OR contains(p, 'HIGH') THEN 'first' WHEN contains(p, 'LOW') THEN 'last' END AS label FROM o"""
)
def register_marks(spark, sf_dir):
    k, c, p = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    o = read(spark, sf_dir, "orders").withColumns({"plan": one_of(PLANS, k), "priority": p})
    shown = tt.display_date(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm"))
    numeral = one_of(["", *pv.ROMAN, "XVII"], c % 17)
    return o.select(
        "o_orderkey", rg.tier(F.col("plan"), rg.PLANS).alias("tier"), shown.alias("shown"), tt.iso_date(shown).alias("back"), tt.index_letter(F.substring(p, 3, 10)).alias("letter"),
        ids.single_spaced(F.concat(c, F.lit("   "), p)).alias("spaced"), pv.roman_number(numeral).alias("numeral"), rg.stale(F.when(c % 17 != 0, F.to_date("o_orderdate")), "1995-06-01").alias("stale"),
        rg.predicate(plan="PUBLIC", priority=["1-URGENT", "2-HIGH"], none="").alias("wanted"), cl.first_label(p, {"first": ["URGENT", "HIGH"], "last": ["LOW"]}).alias("label"),
    )


@query(f"SELECT p_partkey, lower(left(string_split(p_name, ' ')[2], 5)) IN {tuple(sorted(w[:5] for w in WORDS))} AS known FROM part")
def known_beginnings(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", tx.prefixed(F.upper(F.split("p_name", " ")[1]), WORDS).alias("known"))

"""Queries over identities, registers, articles, rules, enactments and definitions, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identities as ids
from ..functions import texts as tx
from ..functions import titles as tt
from ..operators import articles as ar
from ..operators import breaches as br
from ..operators import classifiers as cl
from ..operators import deltas as dl
from ..operators import enactments as en
from ..operators import hierarchies as hi
from ..operators import interpretations as ip
from ..operators import registers as rg
from ..operators import rules as ru
from . import workflows as wf
from .queries import _EDGES, edges, query, read


def one_of(values: list[str], n: Column) -> Column:
    """The value at a place of a short list, counted round."""
    return F.get(F.array(*map(F.lit, values)), (n % len(values)).cast("int"))


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_one_of(values: list[str], n: str) -> str:
    return f"{sql_list(values)}[1 + ({n}) % {len(values)}]"


def sql_case(expr: str, table: dict[str, str], other: str = "NULL") -> str:
    return f"CASE {expr} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {other} END"


CODES = [*ids.TYPES, "xxx"]


@query(f"SELECT c_custkey, {sql_case(sql_one_of(CODES, 'c_custkey'), ids.TYPES)} AS type, ({sql_one_of(CODES, 'c_custkey')} IN {tuple(ids.ACT_CODES)} OR c_custkey % 7 = 0) AS act FROM customer")
def type_descriptions(spark, sf_dir):
    code = one_of(CODES, F.col("c_custkey"))
    cls = F.when(F.col("c_custkey") % 7 == 0, "Act")
    return read(spark, sf_dir, "customer").select("c_custkey", ids.type_of(code).alias("type"), ids.is_act(code, cls).alias("act"))


ENDINGS = ["", ", ENGLAND AND WALES", ", ENGLAND", ", WALES", ", SCOTLAND", ", NORTHERN IRELAND", " ENGLAND AND WALES AND SCOTLAND", ", ENGLAND AND WALES AND MORE, SCOTLAND"]
NAMED = ["", "England,Wales", "England", "Wales", "Scotland", "Northern Ireland", "England,Wales,Scotland", "England,Wales,Scotland"]


@query(f"SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'empty' WHEN c_custkey % 13 = 0 THEN 'error' WHEN c_custkey % 8 = 0 THEN 'plain' ELSE 'region' END AS file, CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN 'ERROR 404' ELSE upper(c_mktsegment) END AS si_code, CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN '' ELSE {sql_one_of(NAMED, 'c_custkey')} END AS regions FROM customer")
def code_files(spark, sf_dir):
    k = F.col("c_custkey")
    text = F.when(k % 11 == 0, "").when(k % 13 == 0, "error 404").otherwise(F.concat(F.col("c_mktsegment"), one_of(ENDINGS, k)))
    return rg.code_groups(read(spark, sf_dir, "customer").select("c_custkey", text.alias("code")), "code").select("c_custkey", "file", "si_code", "regions")


FLOWS, REGIONS, KINDS = ["", "pre", "main", "post", "signed", "1"], ["", "U.K.", "E+W+S", "E+W", "N.I."], ["article", "amendment,heading", "amendment,textual", "extent,content", "table"]


@query(
    f"""WITH x AS (SELECT l_orderkey, l_linenumber, 'UK_ukpga_1974_' || l_suppkey AS name, {sql_one_of(FLOWS, 'l_partkey')} AS flow, {sql_one_of(REGIONS, 'l_suppkey')} AS region, {sql_one_of(KINDS, 'l_orderkey')} AS kind,
  l_linenumber || '_' || (l_partkey % 5) || '__' || (l_suppkey % 9) || '__' AS path, 'F' || l_linenumber AS code FROM lineitem),
y AS (SELECT *, {sql_case('region', {'U.K.': '_UK', 'E+W+S': '_GB', 'E+W': '_EW', 'N.I.': '_NI'}, "''")} AS r, CASE kind WHEN 'amendment,heading' THEN '_a' WHEN 'amendment,textual' THEN '_ax_' || code WHEN 'extent,content' THEN '_ex_' || code WHEN 'table' THEN '_tbl' ELSE '' END AS a FROM x)
SELECT l_orderkey, l_linenumber, {sql_case('region', {k: n for k, (_, n) in ids.ARTICLE_REGIONS.items()}, 'region')} AS names,
  CASE flow WHEN 'pre' THEN name || path || r || a WHEN 'post' THEN name || '-' || path || r || a WHEN 'signed' THEN name || r WHEN '1' THEN name || '-1_' || path || r || a ELSE name || '_' || path || r || a END AS id FROM y"""
)
def article_ids(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem")
    path = F.concat("l_linenumber", F.lit("_"), F.col("l_partkey") % 5, F.lit("__"), F.col("l_suppkey") % 9, F.lit("__"))
    region = one_of(REGIONS, F.col("l_suppkey"))
    id_ = ids.article_id(F.concat(F.lit("UK_ukpga_1974_"), "l_suppkey"), one_of(FLOWS, F.col("l_partkey")), path, region, one_of(KINDS, F.col("l_orderkey")), F.concat(F.lit("F"), "l_linenumber"))
    return line.select("l_orderkey", "l_linenumber", ids.region_names(region).alias("names"), id_.alias("id"))


TYPES_OF_RECORD = ["part", "chapter", "heading", "section", "article", "note"]


@query(
    f"""WITH x AS (SELECT p_partkey, {sql_one_of(TYPES_OF_RECORD, 'p_partkey')} AS kind, 'https://legislation.gov.uk/uksi/2001/' || p_size AS law, p_name, p_size FROM part)
SELECT p_partkey, CASE kind WHEN 'part' THEN law || '/part/1' WHEN 'chapter' THEN law || '/chapter/2' WHEN 'heading' THEN law || '/crossheading/' || replace(p_name, ' ', '-') WHEN 'section' THEN law || '/section/7' WHEN 'article' THEN law || '/regulation/7' ELSE '' END AS url,
  'https://legislation.gov.uk/changes/affected/uksi/2001/' || p_size || '?results-count=1000&sort=affecting-year-number' AS changes FROM x"""
)
def article_urls(spark, sf_dir):
    heading = F.concat(F.lit(" [F12 "), F.initcap("p_name"), F.lit("], "))
    args = (F.lit("uksi"), F.lit(2001), F.col("p_size"))
    url = ids.article_url(one_of(TYPES_OF_RECORD, F.col("p_partkey")), ids.law_url(*args), F.lit("1"), F.lit("2"), F.lit("7"), heading)
    return read(spark, sf_dir, "part").select("p_partkey", url.alias("url"), ids.changes_url("affected", *args).alias("changes"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders")
def written_dates(spark, sf_dir):
    day = F.dayofmonth("o_orderdate")
    th = F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th")
    text = one_of(["at 9.00 am on ", "", "coming into force on the "], F.col("o_orderkey"))
    gap = one_of([" ", ""], F.col("o_orderkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", ids.free_date(F.concat(text, day, th, gap, F.date_format("o_orderdate", "MMMM"), gap, F.date_format("o_orderdate", "yyyy"), F.lit(","))).alias("date"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title, upper(p_name[1]) || p_name[2:] AS capital, ascii(lower(p_name[1])) - 96 AS letter, p_name || '💚https://legislation.gov.uk/all?title=' || replace(p_name, ' ', '+') AS link FROM part")
def cased_names(spark, sf_dir):
    c = F.col("p_name")
    return read(spark, sf_dir, "part").select("p_partkey", ids.title_case(c).alias("title"), ids.first_capital(c).alias("capital"), ids.letter_number(F.substring(c, 1, 1)).alias("letter"), ids.search_link(c).alias("link"))


@query("SELECT p_partkey, p_name || ' Regulations and more' AS title, (1970 + p_size)::VARCHAR AS year, CASE WHEN p_partkey % 3 > 0 THEN (p_size % 9)::VARCHAR END AS article, CASE WHEN p_partkey % 3 > 1 THEN '2' END AS sub_article FROM part")
def breaches(spark, sf_dir):
    text = F.concat(F.lit(" "), "p_name", F.lit(" Regs  & more "), F.col("p_size") + 1970, F.when(F.col("p_partkey") % 3 > 0, F.concat(F.lit(" / "), F.col("p_size") % 9)).otherwise(F.lit("")), F.when(F.col("p_partkey") % 3 > 1, F.lit(" / 2")).otherwise(F.lit("")), F.lit(" / "))
    return read(spark, sf_dir, "part").select("p_partkey", br.breach(text).alias("b")).select("p_partkey", "b.*")


@query(
    """WITH laws AS (SELECT p_partkey AS law, p_name || ' Order' AS title, (p_size % 5)::VARCHAR AS year, p_brand FROM part), b AS (SELECT s_suppkey, p.p_name || CASE WHEN s_suppkey % 2 = 0 THEN ' Order' ELSE ' x Order' END AS title, (p.p_size % 5)::VARCHAR AS year FROM supplier s JOIN part p ON p.p_partkey = s.s_suppkey),
exact AS (SELECT s_suppkey, min(law) AS law FROM b JOIN laws ON lower(b.title) = lower(laws.title) AND b.year = laws.year GROUP BY s_suppkey),
near AS (SELECT s_suppkey, law, score FROM (SELECT s_suppkey, l.law, round(jaro_similarity(b.title, l.title), 6) AS score, row_number() OVER (PARTITION BY s_suppkey ORDER BY round(jaro_similarity(b.title, l.title), 6) DESC, l.title) AS k
  FROM b JOIN (SELECT title, year, min(law) AS law FROM laws GROUP BY title, year) l ON b.year = l.year WHERE s_suppkey NOT IN (SELECT s_suppkey FROM exact)) WHERE k = 1)
SELECT s_suppkey AS breach_id, coalesce(exact.law, near.law) AS law, CASE WHEN exact.law IS NULL THEN near.score ELSE 1.0 END AS score FROM b LEFT JOIN exact USING (s_suppkey) LEFT JOIN near USING (s_suppkey)"""
)
def breached_laws(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    year = (F.col("p_size") % 5).cast("string").alias("year")
    laws = part.select(F.col("p_partkey").alias("law"), F.concat("p_name", F.lit(" Order")).alias("title"), year, F.lit("uksi").alias("type_code"))
    named = part.select(F.col("p_partkey").alias("s_suppkey"), "p_name", year)
    rows = read(spark, sf_dir, "supplier").select("s_suppkey").join(named, "s_suppkey")
    title = F.concat("p_name", F.when(F.col("s_suppkey") % 2 == 0, " Order").otherwise(" x Order"))
    return br.breached_laws(rows.select(F.col("s_suppkey").alias("breach_id"), title.alias("title"), "year"), laws)


@query(
    """SELECT l_orderkey AS notice, string_agg('b' || l_partkey, '; ' ORDER BY 'b' || l_partkey) AS breaches, string_agg(DISTINCT 'l' || l_suppkey, ',' ORDER BY 'l' || l_suppkey) AS laws FROM lineitem GROUP BY l_orderkey"""
)
def breach_summaries(spark, sf_dir):
    return br.breach_summary(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("notice"), F.concat(F.lit("b"), "l_partkey").alias("breach"), F.concat(F.lit("l"), "l_suppkey").alias("law")))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN array_to_string(generate_series(p_size::BIGINT, p_size::BIGINT + 3), ',') ELSE p_size || '(1),' || p_size || '(2),' || (p_size + 1) || '(3)(a),' || (p_size + 2) END AS numbers,
  CASE WHEN p_partkey % 3 = 0 THEN 'disapplies-to' ELSE 'applies-to' END AS category, 'Part' AS scope FROM part"""
)
def rule_provisions(spark, sf_dir):
    n = F.col("p_size")
    numbers = F.when(F.col("p_partkey") % 2 == 0, F.concat(n, F.lit(" to "), n + 3)).otherwise(F.concat(n, F.lit("(1) and 2), "), n + 1, F.lit("(3)(a) and "), n + 2))
    rule = F.concat(F.lit("Regulations "), numbers, F.when(F.col("p_partkey") % 3 == 0, " shall not apply to ships").otherwise(" shall apply to ships"))
    found = ru.provision_numbers(rule)
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(found, ",").alias("numbers"), ru.category(rule).alias("category"), ru.rule_scope(found).alias("scope"))


@query(
    """WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
SELECT p_partkey, w[1] || '-' || w[2] || ',' || w[2] || ',' || w[1] || '-on-' || w[2] || ',' || w[1] || '-off-' || w[2] AS processes, CASE WHEN p_partkey % 3 = 0 THEN 'master-of-a-ship,crew-of-a-ship,employer-of-such-persons' WHEN p_partkey % 3 = 1 THEN 'person' ELSE w[1] || '-' || w[2] END AS persons,
  w[1] || ' of ' || w[2] || '|' || w[1] || ' of ' || w[1] AS parts, 'applies-to|' || w[1] || ':' || w[2] || '|x' AS fit FROM w"""
)
def rule_fields(spark, sf_dir):
    w = F.split("p_name", " ")
    a, b = w[0], w[1]
    phrase = F.concat(a, F.lit(" "), b, F.lit(", "), b, F.lit(" and "), a, F.lit(" on or off "), b)
    person = F.when(F.col("p_partkey") % 3 == 0, "master or crew of a ship").when(F.col("p_partkey") % 3 == 1, "persons").otherwise(F.concat(a, F.lit(", "), b))
    both = F.concat(a, F.lit(" of "), b, F.lit(" and "), a)
    fit = ru.fit_id(F.lit("applies-to"), F.array(F.lit("<person>"), F.lit("<place>")), {"person": F.array(a, b), "place": F.array(F.lit("x"))})
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(ru.processes(phrase), ",").alias("processes"), F.array_join(ru.persons(person), ",").alias("persons"), F.array_join(ru.split_and(both), "|").alias("parts"), fit.alias("fit"))


@query(
    """WITH r AS (SELECT DISTINCT p_brand AS law, p_size % 3 AS k FROM part)
SELECT law, CASE k WHEN 0 THEN 'These Regulations shall apply to any work outside Great Britain' ELSE 'Regulation 3 shall apply to things outside Great Britain' END AS rule, CASE k WHEN 0 THEN 'extends-to' END AS category, CASE k WHEN 0 THEN 'work' ELSE 'other' END AS process FROM r WHERE k < 2 AND law <> 'Brand#11' AND (k <> 0 OR law < 'Brand#3')
UNION ALL SELECT DISTINCT law, 'Does not extend outside Great Britain', 'does-not-extend-to', NULL FROM r WHERE law NOT IN (SELECT law FROM r WHERE k = 0 AND law < 'Brand#3' AND law <> 'Brand#11')"""
)
def outside_gb(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select(F.col("p_brand").alias("law"), (F.col("p_size") % 3).alias("k")).distinct()
    extends = (F.col("k") == 0) & (F.col("law") < "Brand#3") & (F.col("law") != "Brand#11")
    other = (F.col("k") == 1) & (F.col("law") != "Brand#11")
    rule = F.when(extends, "These Regulations shall apply to any work outside Great Britain").when(other, "Regulation 3 shall apply to things outside Great Britain").otherwise("Regulation 4 shall apply")
    return ru.outside_gb(rows.select("law", rule.alias("rule")).distinct(), "law")


# Records of articles read out of order lines: an order is a law, a line is an article of one of its parts.
def records(spark, sf_dir) -> DataFrame:
    kind = one_of(["part", "chapter", "heading", "section", "article", "sub-article"], F.col("l_linenumber"))
    n = F.col("l_linenumber")
    numbers = F.concat_ws("_", F.col("l_suppkey") % 2, F.when(n > 1, (F.col("l_partkey") % 2).cast("string")).otherwise(""), F.when(n > 2, "1").otherwise(""), F.when(n > 3, n.cast("string")).otherwise(""), F.lit(""), F.lit(""))
    law = F.concat(F.lit("UK_uksi_2001_"), "l_orderkey")
    return read(spark, sf_dir, "lineitem").select(law.alias("law"), F.concat_ws("_", law, numbers).alias("id"), F.concat_ws("-", "l_orderkey", n, "l_partkey", "l_suppkey").alias("record_id"), kind.alias("record_type"), F.array("l_linestatus", "l_returnflag").alias("tags"), F.array(one_of(["Right", "Duty", "Offence", "None"], F.col("l_partkey"))).alias("duty_type"))


_RECORDS = """WITH records AS (SELECT 'UK_uksi_2001_' || l_orderkey AS law, 'UK_uksi_2001_' || l_orderkey || '_' || (l_suppkey % 2) || '_' || CASE WHEN l_linenumber > 1 THEN (l_partkey % 2)::VARCHAR ELSE '' END || '_' || CASE WHEN l_linenumber > 2 THEN '1' ELSE '' END || '_' || CASE WHEN l_linenumber > 3 THEN l_linenumber::VARCHAR ELSE '' END || '__' AS id,
  l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS record_id, ['part', 'chapter', 'heading', 'section', 'article', 'sub-article'][1 + l_linenumber % 6] AS record_type, [l_linestatus, l_returnflag] AS tags, ['Right', 'Duty', 'Offence', 'None'][1 + l_partkey % 4] AS duty FROM lineitem)
"""
_KEY = "array_to_string(string_split(id, '_')[:CASE record_type WHEN 'part' THEN 5 WHEN 'chapter' THEN 6 WHEN 'heading' THEN 7 WHEN 'section' THEN 8 WHEN 'article' THEN 8 END], '_')"


@query(
    _RECORDS
    + f""", o AS (SELECT law, record_id, {_KEY} AS key FROM records WHERE record_type <> 'sub-article'), t AS (SELECT law, id, unnest(tags) AS tag FROM records)
SELECT record_id, string_agg(DISTINCT tag, ',' ORDER BY tag) AS tags FROM o JOIN t ON o.law = t.law AND (t.id || '_') LIKE replace(o.key, '_', '\\_') || '\\_%' ESCAPE '\\' GROUP BY record_id"""
)
def owned_tags(spark, sf_dir):
    rows = records(spark, sf_dir)
    out = ar.written_back(rows, ar.owned(rows, "tags"), "tags").filter("record_type <> 'sub-article'")
    return out.select("record_id", F.array_join("tags", ",").alias("tags")).distinct()


@query(
    _RECORDS
    + """SELECT law, string_agg(DISTINCT tag, ',' ORDER BY tag) AS tags, concat_ws(',', CASE WHEN bool_or(duty = 'Duty') THEN 'Duty' END, CASE WHEN bool_or(duty = 'Right') THEN 'Right' END, CASE WHEN bool_or(duty = 'Offence') THEN 'Offence' END) AS duty_type
FROM (SELECT law, duty, unnest(tags) AS tag FROM records) GROUP BY law"""
)
def law_tag_lists(spark, sf_dir):
    out = ar.law_tags(records(spark, sf_dir), "law", ["tags", "duty_type"])
    return out.select("law", F.array_join("tags", ",").alias("tags"), F.array_join("duty_type", ",").alias("duty_type"))


@query(
    _RECORDS
    + """, t AS (SELECT law, regexp_replace(id, '_*[A-Z]*$', '') AS article, unnest(tags) AS tag FROM records), a AS (SELECT law, article, string_agg(DISTINCT tag, '; ' ORDER BY tag) AS tags FROM t GROUP BY law, article),
k AS (SELECT *, [coalesce(try_cast(x AS INT), -1) for x in string_split(article, '_')[5:]] AS k FROM a)
SELECT law, count(*) AS articles, list_sort(list(article || chr(10) || '[' || tags || ']')) AS entries FROM k GROUP BY law"""
)
def article_tag_texts(spark, sf_dir):
    out = ar.article_tags(records(spark, sf_dir), "law", "tags")
    entries = F.array_sort(F.split("text", "\n\n"))
    return out.select("law", F.size(entries).cast("long").alias("articles"), entries.alias("entries"))


# Codes of changes: orders are laws, lines are provisions that bear F and C codes.
def coded(spark, sf_dir) -> DataFrame:
    text = F.concat(F.lit("[F"), F.col("l_partkey") % 9 + 1, F.lit(" words F"), F.col("l_suppkey") % 9 + 1, F.lit(" more C"), "l_linenumber", F.lit(" and I900 end"))
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("law"), F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("record_id"), F.concat(F.lit("a"), "l_linenumber").alias("id"), text.alias("text"))


_CODED = "WITH c AS (SELECT l_orderkey AS law, l_linenumber AS n, unnest(list_distinct(['F' || (l_partkey % 9 + 1), 'F' || (l_suppkey % 9 + 1), 'C' || l_linenumber])) AS code FROM lineitem) "


@query(_CODED + "SELECT law, code, string_agg(DISTINCT 'a' || n, ',' ORDER BY 'a' || n) AS articles FROM c GROUP BY law, code")
def change_articles(spark, sf_dir):
    rows = coded(spark, sf_dir)
    codes = rows.select("law", F.explode(F.regexp_extract_all("text", F.lit(r"[FC]\d+"), F.lit(0))).alias("code"))
    out = ar.change_articles(ar.with_changes(rows, codes, "law"), "law")
    return out.select("law", "code", F.array_join("articles", ",").alias("articles"))


@query(_CODED + "SELECT law, coalesce(max(code[2:]::INT) FILTER (code[1] = 'F'), 0) AS amendment, coalesce(max(code[2:]::INT) FILTER (code[1] = 'C'), 0) AS modification, 900 AS commencement, 0 AS extent, 0 AS editorial FROM c GROUP BY law")
def change_counts(spark, sf_dir):
    rows = coded(spark, sf_dir)
    return ar.change_counts(rows.select("law", F.explode(F.regexp_extract_all("text", F.lit(r"[FCIEX]\d+"), F.lit(0))).alias("code")), "law")


@query(_CODED + ", s AS (SELECT law, code[1] AS kind, min(code[2:]::INT) AS a, max(code[2:]::INT) AS b FROM c GROUP BY law, code[1]), e AS (SELECT law, kind, unnest(generate_series(a, b))::INT AS number FROM s) SELECT e.law, e.kind, e.number FROM e ANTI JOIN c ON c.law = e.law AND c.code = e.kind || e.number")
def spare_codes(spark, sf_dir):
    return ar.spare_codes(coded(spark, sf_dir), "law")


@query(
    """WITH c AS (SELECT l_orderkey AS law, 'F' || (l_linenumber + 8) AS code, l_linenumber + 8 AS n, l_partkey % 2 AS range FROM lineitem), m AS (SELECT *, row_number() OVER (PARTITION BY law, range ORDER BY n) AS rank, count(*) OVER (PARTITION BY law, range) AS many FROM c)
SELECT law, code, unnest(CASE WHEN many = 3 THEN [['1', '2', '3'][rank]] ELSE ['1', '2', '3'] END) AS section FROM m"""
)
def optimised_ranges(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("law"), F.concat(F.lit("F"), F.col("l_linenumber") + 8).alias("code"), (F.col("l_partkey") % 2).alias("range"), F.array(*map(F.lit, "123")).alias("sections"))
    return ar.optimised_ranges(rows, "law")


@query(
    _EDGES
    + """, r AS (SELECT law, path, min(name) AS name, min(year) AS year FROM edges WHERE regexp_matches(affect, 'repeal|revoke') GROUP BY law, path)
SELECT law, string_agg(name, ',' ORDER BY year, path) AS revoked_by FROM r GROUP BY law"""
)
def revoked_by(spark, sf_dir):
    return rg.revoked_by(edges(spark, sf_dir))


EXTENTS = ["E+W+S+NI", "E+W", "(E+W)", "S", "EWS"]


@query(
    f"""WITH x AS (SELECT l_orderkey AS law, l_linenumber AS seq, 's.' || l_linenumber AS provision, {sql_case(sql_one_of(EXTENTS, 'l_partkey'), {'(E+W)': 'E+W', 'EWS': 'E+W+S'}, sql_one_of(EXTENTS, 'l_partkey'))} AS e FROM lineitem),
a AS (SELECT law, e, string_agg(provision, ', ' ORDER BY seq) AS p FROM x GROUP BY law, e), n AS (SELECT law, count(*) AS n FROM a GROUP BY law)
SELECT law, string_agg({sql_case('e', {'E+W+S+NI': ids.UK_FLAG, 'E+W': ids.FLAGS['E'] + ' ' + ids.FLAGS['W'], 'S': ids.FLAGS['S'], 'E+W+S': ids.FLAGS['E'] + ' ' + ids.FLAGS['W'] + ' ' + ids.FLAGS['S']})} || ' ' || e || '💚️' || CASE WHEN n = 1 THEN 'All provisions' ELSE p END, '💚️' ORDER BY length(e) DESC, e) AS geo_extent,
  concat_ws(',', CASE WHEN bool_or(contains(e, 'E')) THEN 'England' END, CASE WHEN bool_or(contains(e, 'W')) THEN 'Wales' END, CASE WHEN bool_or(contains(e, 'S')) THEN 'Scotland' END, CASE WHEN bool_or(contains(e, 'NI')) THEN 'Northern Ireland' END) AS geo_region
FROM a JOIN n USING (law) GROUP BY law"""
)
def extent_provisions(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem")
    return rg.extent_provisions(line.select(F.col("l_orderkey").alias("law"), F.col("l_linenumber").alias("seq"), F.concat(F.lit("s."), "l_linenumber").alias("provision"), one_of(EXTENTS, F.col("l_partkey")).alias("extent")))


@query("SELECT l_orderkey, string_agg(DISTINCT x, ',' ORDER BY x) AS codes FROM (SELECT l_orderkey, unnest([l_linestatus, l_returnflag]) AS x FROM lineitem) GROUP BY l_orderkey")
def parent_codes(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", F.concat("l_linestatus", F.lit(", "), "l_returnflag", F.lit(",,"), "l_linestatus").alias("codes"))
    return rg.listed(rows, ["l_orderkey"], "codes")


@query("SELECT DISTINCT unnest([p_brand, p_name, trim(p_type)]) AS name FROM part")
def column_names(spark, sf_dir):
    return rg.names_in(read(spark, sf_dir, "part").select(F.concat("p_brand", F.lit(", "), "p_name").alias("a"), F.concat("p_type", F.lit(",")).alias("b")), ["a", "b"])


WANTED = {"colours": ["Blue", "red", "green"], "finish": ["metal"]}


@query("SELECT p_partkey, list_filter([CASE WHEN contains(p_name, 'blue') THEN 'Blue' END, CASE WHEN contains(p_name, 'red') THEN 'red' END, CASE WHEN contains(p_name, 'green') THEN 'green' END, CASE WHEN contains(p_name, 'metal') THEN 'metal' END], lambda x: x IS NOT NULL) AS terms FROM part WHERE regexp_matches(p_name, 'blue|red|green|metal')")
def found_terms(spark, sf_dir):
    return rg.found_terms(read(spark, sf_dir, "part"), ["p_partkey"], "p_name", WANTED)


@query('SELECT l_orderkey AS "case", count(*) AS offences, arg_max(l_returnflag || l_partkey, (l_linenumber, l_returnflag || l_partkey)) AS result FROM lineitem GROUP BY l_orderkey')
def case_results(spark, sf_dir):
    return rg.case_results(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case"), F.struct("l_linenumber", F.concat("l_returnflag", "l_partkey")).alias("seq"), F.concat("l_returnflag", "l_partkey").alias("result")))


@query("SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicates(spark, sf_dir):
    return rg.duplicates(read(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@query("SELECT c.c_custkey, count(o_orderkey) AS matches, CASE WHEN count(o_orderkey) = 1 THEN max(o_orderkey) END AS o_orderkey FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey")
def found_records(spark, sf_dir):
    store = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return rg.found(read(spark, sf_dir, "customer").select("c_custkey"), store, ["c_custkey"], "o_orderkey")


@query("SELECT c.c_custkey, min(o_orderdate) AS published, arg_min('/new/' || o_orderkey, (o_orderdate, '/new/' || o_orderkey)) AS link FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey")
def first_published(spark, sf_dir):
    days = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("day"), F.concat(F.lit("/new/"), "o_orderkey").alias("link"))
    return rg.first_published(read(spark, sf_dir, "customer").select("c_custkey"), days, ["c_custkey"])


@query("SELECT o_orderkey, o_comment_new AS note, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE o_orderstatus END AS owner FROM (SELECT *, '{' || o_orderstatus || ',x}' AS o_comment_new FROM orders)")
def patched(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    old = o.select("o_orderkey", F.col("o_orderpriority").alias("who"))
    new = o.select("o_orderkey", F.array("o_orderstatus", F.lit("x")).alias("note"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("who"), "o_totalprice", F.lit("gone").alias("row"))
    return rg.post_image(rg.cleaned(old, new, ["o_orderkey"], ["o_totalprice"], ["who"]), ["row"], {"who": "owner"}, [], ["note"])


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS number FROM orders")
def numbered_laws(spark, sf_dir):
    return rg.numbered(read(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_orderkey", "number")


@query(
    """WITH r AS (SELECT o_custkey, min(o_orderdate)::DATE AS first, min(o_orderdate)::DATE + (o_custkey % 4)::INT AS last FROM orders GROUP BY o_custkey)
SELECT o_custkey, strftime(d, '%Y-%m-%d') AS day, '/new/all/' || strftime(d, '%Y-%m-%d') AS path FROM (SELECT o_custkey, unnest(generate_series(first::TIMESTAMP, last::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM r)"""
)
def day_lists(spark, sf_dir):
    first = F.to_date(F.min("o_orderdate"))
    ranges = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(first.alias("first")).withColumn("last", F.date_add("first", (F.col("o_custkey") % 4).cast("int")))
    return rg.days_between(ranges, ["o_custkey"]).withColumn("day", F.col("day").cast("string"))


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'before' WHEN c_custkey % 4 = 1 THEN 'before' || chr(10) || '2/3/2024' || chr(10) || 'md_subjects' || repeat('.', 24) || c_mktsegment || ' -> new' || chr(10) || 'md_images' || repeat('.', 26) || '1 -> 2'
  WHEN c_custkey % 4 = 2 THEN 'before' ELSE 'before' || chr(10) || '2/3/2024' || chr(10) || 'md_images' || repeat('.', 26) || '1 -> 2' END AS md_change_log FROM customer"""
)
def metadata_change_log(spark, sf_dir):
    k = F.col("c_custkey") % 4
    old = read(spark, sf_dir, "customer").select("c_custkey", F.when(k == 2, "").otherwise(F.col("c_mktsegment")).alias("md_subjects"), F.lit("1").alias("md_images"), F.lit("before").alias("md_change_log"))
    new = read(spark, sf_dir, "customer").select("c_custkey", F.when(k == 3, "").when(k == 0, F.col("c_mktsegment")).otherwise(F.lit("new")).alias("md_subjects"), F.when(k.isin(1, 3), "2").otherwise("1").alias("md_images"), F.lit("x").alias("md_change_log"))
    fields = {c: dl.METADATA_FIELDS[c] for c in ("md_subjects", "md_images")}
    return dl.logged(old, new, ["c_custkey"], fields, "2/3/2024", "md_change_log").select("c_custkey", "md_change_log")


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '2/3/2024📌live...New value📌revoked_by..' || CASE WHEN c_custkey % 3 = 0 THEN 'b' ELSE 'b📌c' END || '📌old' ELSE '2/3/2024📌revoked_by..' || CASE WHEN c_custkey % 3 = 0 THEN 'b' ELSE 'b📌c' END || '📌old' END AS log FROM customer"""
)
def repeal_change_log(spark, sf_dir):
    c, k = read(spark, sf_dir, "customer"), F.col("c_custkey")
    old = c.select("c_custkey", F.when(k % 2 == 0, "").otherwise("in force").alias("live"), F.when(k % 3 == 0, "a,c").otherwise("a").alias("revoked_by"), F.lit("old").alias("log"))
    new = c.select("c_custkey", F.lit("in force").alias("live"), F.lit("c, b ,a").alias("revoked_by"), F.lit("").alias("log"))
    return dl.logged(old, new, ["c_custkey"], {"live": 3, "revoked_by": 2}, "2/3/2024", "log", ["revoked_by"], "New value", "📌", True).select("c_custkey", "log")


@query(
    """WITH m AS (SELECT unnest(['UK_uksi_' || (1990 + p_size) || '_' || p_partkey, 'UK_ukpga_' || (1990 + p_size) || '_1']) AS name FROM part), c AS (SELECT 'UK_uksi_' || (1990 + p_size) || '_' || p_partkey AS name FROM part WHERE p_partkey % 2 = 0)
SELECT DISTINCT name, split_part(name, '_', 2) AS type_code, split_part(name, '_', 3) AS year, split_part(name, '_', 4) AS number FROM m WHERE name NOT IN (SELECT name FROM c)"""
)
def missing_laws_by_columns(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    a, b = F.concat(F.lit("UK_uksi_"), F.col("p_size") + 1990, F.lit("_"), "p_partkey"), F.concat(F.lit("UK_ukpga_"), F.col("p_size") + 1990, F.lit("_1"))
    master = part.select(a.alias("amending"), F.concat(b, F.lit(", "), b).alias("revoking"))
    copy = part.filter("p_partkey % 2 = 0").select(a.alias("amending"), F.lit("").alias("revoking"))
    return dl.missing_laws(master, copy, {"amending": "amending", "revoking": "revoking"})


# Introductory texts of laws, read out of parts: a clause of their own, a footnote of a year, a footnote elsewhere, or an Act.
def introductions(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey") % 4
    text = (
        F.when(k == 0, "This is an Order under section 1 of the Planning Act 2008 made today.")
        .when(k == 1, F.concat(F.lit("The powers conferred on the Minister by section 2 of the Act of "), F.col("p_size") + 1950, F.lit(" f00001 now make this.")))
        .when(k == 2, "The Minister makes this.")
        .otherwise("The powers conferred by the Act of 1999 f00001.")
    )
    urls = F.create_map(F.lit("f00001"), F.array(F.concat(F.lit("http://www.legislation.gov.uk/id/ukpga/"), F.col("p_size") + 1950, F.lit("/7")), F.lit("http://www.legislation.gov.uk/id/ukpga/1066/1")), F.lit("c1"), F.array(F.lit("http://www.legislation.gov.uk/european/directive/2003/10")))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("name"), F.when(k == 3, "ukpga").otherwise("uksi").alias("type_code"), F.lit("Order").alias("type_class"), text.alias("text"), F.lit("In the year 2003 [start_ref]c1[end_ref] was").alias("enacting_text"), urls.alias("urls"))


@query(
    """SELECT p_partkey::VARCHAR AS name, CASE p_partkey % 4 WHEN 0 THEN 'UK_ukpga_2008_29' WHEN 1 THEN 'UK_ukpga_' || (p_size + 1950) || '_7' WHEN 2 THEN 'UK_eudr_2003_10' ELSE '' END AS enacted_by,
  CASE p_partkey % 4 WHEN 0 THEN 'UK_ukpga_2008_29' || chr(10) || 'Planning' || chr(10) || 'https://legislation.gov.uk/ukpga/2008/29/introduction' WHEN 1 THEN 'UK_ukpga_' || (p_size + 1950) || '_7' || chr(10) || chr(10) || 'https://legislation.gov.uk/ukpga/' || (p_size + 1950) || '/7/introduction'
  WHEN 2 THEN 'UK_eudr_2003_10' || chr(10) || chr(10) || 'https://legislation.gov.uk/eudr/2003/10/introduction' ELSE '' END AS enacted_by_description FROM part"""
)
def enacting_laws(spark, sf_dir):
    titles = spark.createDataFrame([("UK_ukpga_2008_29", "Planning")], "name string, title string")
    return en.enactment_lines(en.enacting_laws(introductions(spark, sf_dir)), titles)


@query("SELECT 'UK_ukpga_2008_29' AS name UNION SELECT 'UK_eudr_2003_10' UNION SELECT 'UK_ukpga_' || (p_size + 1950) || '_7' FROM part WHERE p_partkey % 4 = 1")
def distinct_enacting_laws(spark, sf_dir):
    return en.distinct_enacting(en.enacting_laws(introductions(spark, sf_dir)))


# Interpretation sections, read out of parts: a heading, and a provision with two definitions.
@query(
    """SELECT p_partkey, lower(t) AS term, CASE WHEN k = 1 THEN 'means ' || p_brand ELSE 'has the same meaning as in the Act of ' || p_size END AS definition, 'law' AS scope, k = 2 AS refers, p_partkey % 2 = 0 AS inter
FROM (SELECT *, string_split(p_name, ' ')[k] AS t FROM part, (SELECT unnest([1, 2]) AS k)) WHERE p_partkey % 5 > 0"""
)
def defined_terms(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    w = F.split(F.initcap("p_name"), " ")
    heading = F.struct(F.lit(0).alias("seq"), F.lit("heading").alias("type"), F.when(F.col("p_partkey") % 2 == 0, "Interpretation").otherwise("General").alias("text"))
    text = F.concat(F.lit("In these Regulations—📌“the "), w[0], F.lit("” means "), "p_brand", F.lit(" ( );📌“"), w[1], F.lit("” has the same meaning as in the Act of "), "p_size", F.lit("."))
    body = F.struct(F.lit(1).alias("seq"), F.lit("article").alias("type"), F.when(F.col("p_partkey") % 5 == 0, F.concat(text, F.lit(" substitute—"))).otherwise(text).alias("text"))
    rows = part.select("p_partkey", F.inline(F.array(heading, body)))
    return ip.defined_terms(rows, ["p_partkey"], "seq").select("p_partkey", "term", "definition", "scope", "refers", "inter")


@query(
    """SELECT p_partkey::VARCHAR AS law, 't' || p_partkey AS term, 'a definition of some length' AS definition, ['none', 'update', 'split', 'link', 'create', 'create'][1 + p_partkey % 6] AS action, CASE WHEN p_partkey % 6 < 4 THEN p_partkey END AS id FROM part"""
)
def terms_taken_up(spark, sf_dir):
    part, k, law = read(spark, sf_dir, "part"), F.col("p_partkey") % 6, F.col("p_partkey").cast("string")
    found = part.select(F.concat(F.lit("t"), "p_partkey").alias("term"), law.alias("law"), F.lit("a definition of some length").alias("definition"))
    same = F.when(k.isin(0, 3), "a definition of some length").otherwise("quite another one")
    laws = F.when(k.isin(0, 1), F.array(law)).when(k == 2, F.array(law, F.lit("x"))).otherwise(F.array(F.lit("x")))
    register = part.filter(k != 5).select(F.col("p_partkey").alias("id"), F.concat(F.lit("t"), "p_partkey").alias("term"), same.alias("definition"), laws.alias("laws"))
    return ip.taken_up(found, register)


SENTENCES = [
    "Every employer shall ensure the health of people. ",
    "The Secretary of State may by regulations make schemes. ",
    "The owner may apply for a permit. ",
    "The local authority must keep a register. ",
    "A person who fails is guilty of an offence. ",
    "In section 2 for “a” substitute “b”. ",
]
HOLDERS = ["dutyholder: Org: Employer", "power_holder: Gvt: Minister", "rights_holder: Org: Owner", "responsibility_holder: Gvt: Authority: Local", "", ""]
KINDS_OF = ["Duty", "Power", "Right", "Responsibility", "Offence", "Amendment"]


@query(f"SELECT p_partkey, {sql_one_of(HOLDERS, 'p_partkey')} AS holder, {sql_one_of(KINDS_OF, 'p_partkey')} AS duty_type FROM part")
def role_holders(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit(" "), one_of(SENTENCES, F.col("p_partkey"))).alias("text"))
    out = cl.provisions(rows)
    names = [h for _, h, _ in cl.ROLE_COLUMNS.values()]
    told = F.concat_ws("; ", *[F.when(F.size(h) > 0, F.concat(F.lit(h + ": "), F.array_join(h, ","))) for h in names])
    return out.select("p_partkey", told.alias("holder"), F.array_join("duty_type", ",").alias("duty_type"))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey IN (1, 2, 3) AND c_acctbal IS NOT NULL")
def formula_rows(spark, sf_dir):
    wanted = ids.formula({"c_mktsegment": "BUILDING", "c_name": ""}, {"c_nationkey": [1, 2, 3], "c_phone": []})
    return read(spark, sf_dir, "customer").filter(wanted & ~ids.all_empty(["c_acctbal"])).select("c_custkey")


@query("SELECT o_orderkey, o_orderdate < DATE '1997-01-01' - 7 AS week, o_orderdate <> DATE '1997-01-01' AS not_today, year(o_orderdate) = 1997 AND month(o_orderdate) = 2 AND day(o_orderdate) BETWEEN 3 AND 9 AS period FROM orders")
def dated_rows(spark, sf_dir):
    c = ids.dated
    return read(spark, sf_dir, "orders").select("o_orderkey", c("o_orderdate", "week", "1997-01-01").alias("week"), c("o_orderdate", "blank_or_not_today", "1997-01-01").alias("not_today"), ids.in_period("o_orderdate", 1997, 2, 3, 9).alias("period"))


@query(
    """SELECT n_nationkey, k, n_name || CASE k WHEN 1 THEN '' ELSE chr(64 + (k - 1)::INT) END AS id FROM nation, (SELECT unnest(generate_series(1, 26)) AS k)"""
)
def lettered_ids(spark, sf_dir):
    rows = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("id"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(26).cast("long"))).alias("k"))
    return hi.distinct_ids(rows, ["n_nationkey"], "id", "k").select("n_nationkey", "k", "id")


@query("SELECT p_partkey, '“' || p_name || '” means (“x y”) and “' || p_brand || '”.' AS curly, '(a) ' || p_name || chr(10) || '7(b) x' AS joined, CASE WHEN length(p_type) > 18 THEN left(p_type, 5) || '📌...📌' || right(p_type, 5) ELSE p_type END AS short FROM part")
def cleaned_texts(spark, sf_dir):
    quoted = F.concat(F.lit('"'), "p_name", F.lit('" means ("x y") and "'), "p_brand", F.lit('".'))
    numbers = F.concat(F.lit("\n\n(a)\n"), "p_name", F.lit("\n\n7\n(b)\nx"))
    return read(spark, sf_dir, "part").select("p_partkey", tx.curly_quotes(quoted).alias("curly"), tx.numbered_text(tx.without_empty_lines(numbers)).alias("joined"), tx.elided(F.col("p_type"), 18, 5).alias("short"))


#: A title for each pattern of excluded titles, and one that none excludes.
EXCLUSIONS = ["Railways (X Station) Order", "Railway Junction Order", "Network Rail (Extension) Order", "Rail Freight (X) Order", "Light Railway Order", "Drought (X) Order", "Restriction of Flying", "Correction Slip", "Trunk Road", "Harbour Empowerment Order", "Harbour Revision Order", "Parking Places", "Parking Prohibition", "Parking and Waiting", "Development Consent Order", "Electrical System Order", "Safety Order"]


@query(f"SELECT p_partkey, CASE WHEN p_partkey % {len(EXCLUSIONS)} < {len(EXCLUSIONS) - 1} THEN 'exc' WHEN p_partkey % 5 = 0 THEN 'inc_w_si' WHEN contains(p_name, 'red') THEN 'inc' ELSE 'inc_wo_si' END AS category FROM part")
def excluded_titles(spark, sf_dir):
    k = F.col("p_partkey")
    rows = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(" "), one_of(EXCLUSIONS, k)).alias("title"), F.when(k % 5 == 0, F.array(F.lit("HEALTH AND SAFETY"))).otherwise(F.array().cast("array<string>")).alias("codes"))
    return cl.categorised(rows, "title", "codes", ["HEALTH AND SAFETY"], {"colours": ["red"]}).select("p_partkey", "category")


@query(
    f"""WITH x AS (SELECT p_partkey, 'UK_uksi_' || (1990 + p_size) || '_' || p_partkey AS name, CASE WHEN p_partkey % {len(EXCLUSIONS)} < {len(EXCLUSIONS) - 1} AND p_partkey % 2 = 0 THEN 'exc' WHEN p_partkey % 5 = 0 THEN 'inc_w_si' WHEN contains(p_name, 'red') THEN 'inc' ELSE 'inc_wo_si' END AS category FROM part)
SELECT p_partkey, name, category, CASE WHEN category <> 'exc' THEN CASE WHEN p_partkey % 3 = 0 THEN 'patch' ELSE 'post' END END AS action, CASE WHEN category = 'exc' THEN row_number() OVER (PARTITION BY category ORDER BY name)::INT END AS number_excluded,
  '2001/' || p_partkey AS old_number, 'UK Statutory Instrument' AS type FROM x"""
)
def new_law_workflow(spark, sf_dir):
    part, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    title = F.concat("p_name", F.when(k % 2 == 0, F.concat(F.lit(" "), one_of(EXCLUSIONS, k))).otherwise(F.lit(" Order")))
    laws = part.select("p_partkey", title.alias("title"), F.lit("uksi").alias("type_code"), (F.col("p_size") + 1990).alias("year"), F.concat(F.lit("2001/"), k).alias("number"), F.when(k % 5 == 0, F.array(F.lit("A"))).otherwise(F.array().cast("array<string>")).alias("codes"))
    base = laws.filter(k % 3 == 0).select(F.concat(F.lit("UK_uksi_"), "year", F.lit("_"), "p_partkey").alias("name"))
    return wf.new_laws(laws, base, ["A"], {"colours": ["red"]}).select("p_partkey", "name", "category", "action", "number_excluded", "old_number", "type")


# Tags of order lines: each order is a law, each line an article with two tags of one column and one of another.
@query(
    """WITH r AS (SELECT l_orderkey AS law, 'id-' || l_linenumber || '-' || l_suppkey AS article, 'u/' || l_linenumber AS url, [l_returnflag, l_linestatus] AS a, CASE WHEN l_suppkey % 2 = 0 THEN ['S' || (l_suppkey % 3)] ELSE [] END AS b, l_linenumber AS n, l_suppkey AS s FROM lineitem),
t AS (SELECT law, article, url, n, s, 'a' AS c, unnest(a) AS tag FROM r UNION ALL SELECT law, article, url, n, s, 'b', unnest(b) FROM r),
u AS (SELECT DISTINCT * FROM t),
tags AS (SELECT law, c, list_sort(list(DISTINCT tag)) AS tags FROM u GROUP BY law, c),
art AS (SELECT law, c, string_agg(article || chr(10) || '[' || tags || ']', chr(10) || chr(10) ORDER BY n, s) AS text FROM (SELECT law, c, article, n, s, string_agg(DISTINCT tag, '; ' ORDER BY tag) AS tags FROM u GROUP BY law, c, article, n, s) GROUP BY law, c),
tag AS (SELECT law, c, string_agg('[' || tag || ']' || chr(10) || urls, chr(10) || chr(10) ORDER BY tag) AS text FROM (SELECT law, c, tag, string_agg(url, chr(10) ORDER BY url) AS urls FROM (SELECT DISTINCT law, c, tag, url FROM u) GROUP BY law, c, tag) GROUP BY law, c)
SELECT l.law, array_to_string(coalesce(a.tags, []), ',') AS a, array_to_string(coalesce(b.tags, []), ',') AS b, x.text AS article_a, y.text AS article_b, v.text AS a_article, w.text AS b_article
FROM (SELECT DISTINCT law FROM r) l LEFT JOIN tags a ON a.law = l.law AND a.c = 'a' LEFT JOIN tags b ON b.law = l.law AND b.c = 'b' LEFT JOIN art x ON x.law = l.law AND x.c = 'a' LEFT JOIN art y ON y.law = l.law AND y.c = 'b'
  LEFT JOIN tag v ON v.law = l.law AND v.c = 'a' LEFT JOIN tag w ON w.law = l.law AND w.c = 'b'"""
)
def law_taxa(spark, sf_dir):
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    own = F.when(s % 2 == 0, F.array(F.concat(F.lit("S"), s % 3))).otherwise(F.array().cast("array<string>"))
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("law"), F.concat_ws("-", F.lit("id"), n, s).alias("id"), F.concat(F.lit("u/"), n).alias("url"), F.array("l_returnflag", "l_linestatus").alias("a"), own.alias("b"))
    out = ar.law_taxa(rows, "law", ["a", "b"], {})
    return out.withColumns({c: F.array_join(c, ",") for c in ("a", "b")})

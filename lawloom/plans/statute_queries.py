"""Statutes of every country as records: texts made of the rows of part, and the records that they must give."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import statutes as st
from .law_queries import one_of, sql_list
from .queries import query, read

#: Texts with a number {n} and a name {w}, and their records: tag, number, heading, text, and the levels they stand in.
TEXTS = {
    "AUT": (
        "x\nLangtitel\n{w}\nI. HAUPTSTÜCK\nAllgemeines\nGeltung\n§ {n}.\n(1) Das gilt.\nUnd {w}.\n(2) So.\nAnhang I\nListe\n{w}",
        [("title", "", "", "{w}", ""), ("chapter", "1", "Allgemeines", "I. HAUPTSTÜCK", "chapter=1"), ("article", "{n}", "Geltung", "§ {n}.", "chapter=1 article={n}"), ("sub_article", "1", "", "(1) Das gilt.📌Und {w}.", "chapter=1 article={n} sub_article=1"), ("sub_article", "2", "", "(2) So.", "chapter=1 article={n} sub_article=2"), ("annex", "1", "Liste", "Anhang I📌{w}", "annex=1")],
    ),
    "DE": ("Gesetz {w}\nErster Teil\n{w}\n§ {n} Zweck\n(1) Text\nAnlage {n} zu x", [("title", "", "", "Gesetz {w}", ""), ("part", "1", "{w}", "Erster Teil", "part=1"), ("article", "{n}", "", "§ {n} Zweck", "part=1 article={n}"), ("para", "1", "", "(1) Text", "part=1 article={n} para=1"), ("annex", "{n}", "", "Anlage {n} zu x", "annex={n}")]),
    "DK": ("y\nYderligere oplysninger\nLov\nKapitel {n}\n{w}\nFormål\n§ {n} Loven\nmere\nBilag II\nTitel\nindhold\nArbejdstilsynet, den 1.\nOm\nz", [("title", "", "", "Lov", ""), ("chapter", "{n}", "{w}", "Kapitel {n}", "chapter={n}"), ("article", "{n}", "Formål", "§ {n} Loven📌mere", "chapter={n} article={n}"), ("annex", "2", "Titel", "Bilag II📌indhold", "annex=2"), ("approval", "", "", "Arbejdstilsynet, den 1.", "annex=2")]),
    "FIN": ("Laki\n{n} luku\n{w}\n{n} §\nTarkoitus\nTeksti\nLiite I\nOtsikko\nSisällysluettelo\nz", [("title", "", "", "Laki", ""), ("chapter", "{n}", "{w}", "{n} luku", "chapter={n}"), ("article", "{n}", "Tarkoitus", "{n} §📌Teksti", "chapter={n} article={n}"), ("annex", "1", "Otsikko", "Liite I", "annex=1")]),
    "NO": ("Lov\nKapittel {n} Generelt\n§ {n}-1. Formål\n(1) {w}\nVedlegg X. Navn\n1 Endret ved lov", [("title", "", "", "Lov", ""), ("chapter", "{n}", "", "Kapittel {n} Generelt", "chapter={n}"), ("article", "{n}-1", "", "§ {n}-1. Formål", "chapter={n} article={n}-1"), ("para", "1", "", "(1) {w}", "chapter={n} article={n}-1 para=1"), ("annex", "10", "", "Vedlegg X. Navn", "annex=10"), ("amendment", "1", "", "1 Endret ved lov", "annex=10")]),
    "RUS": ("Закон\nРАЗДЕЛ IV. {w}\nГлава {n}. Общие\nСтатья {n}. Цель\n1.2. пункт\nПриложение 3", [("title", "", "", "Закон", ""), ("chapter", "4", "", "РАЗДЕЛ IV. {w}", "chapter=4"), ("section", "{n}", "", "Глава {n}. Общие", "chapter=4 section={n}"), ("article", "{n}", "", "Статья {n}. Цель", "chapter=4 section={n} article={n}"), ("para", "2", "", "1.2. пункт", "chapter=4 section={n} article={n} para=2"), ("annex", "3", "", "Приложение 3", "annex=3")]),
    "SWE": ("Lag\n77\nKap. {n} Allmänt\nRubrik\n{n} § {w}\nmer\nIkraftträdande\nBilaga 2", [("title", "", "", "Lag", ""), ("chapter", "{n}", "", "Kap. {n} Allmänt", "chapter={n}"), ("article", "{n}", "Rubrik", "{n} § {w}📌mer", "chapter={n} article={n}"), ("note", "", "", "Ikraftträdande", "chapter={n} article={n}"), ("annex", "2", "", "Bilaga 2", "annex=2")]),
    "TUR": ("{w}\n12\nİKİNCİ KISIM\nGenel\nAmaç\nMadde {n} – (1) Metin\n(2) Daha\nGeçici Madde {n} – x\nEk III\nListe", [("title", "", "", "{w}", ""), ("part", "2", "Genel", "İKİNCİ KISIM", "part=2"), ("article", "{n}", "Amaç", "Madde {n} – (1) Metin", "part=2 article={n}"), ("sub_article", "2", "", "(2) Daha", "part=2 article={n} sub_article=2"), ("amendment", "{n}", "", "Geçici Madde {n} – x", "part=2 article={n} sub_article=2"), ("annex", "3", "Liste", "Ek III", "annex=3")]),
    "UK": (
        "{w} Act\nPART II\nDuties\n{n} The employer shall {w}.\n(2) He shall report.\nF{n} Words inserted\nTextual Amendments\nSCHEDULE 1\nLists\nTable 3\nSigned by x",
        [("title", "", "", "{w} Act", ""), ("part", "2", "", "PART II", "part=2"), ("section", "{n}", "Duties", "{n} The employer shall {w}.", "part=2 section={n}"), ("sub_section", "2", "", "(2) He shall report.", "part=2 section={n} sub_section=2"), ("amendment", "F{n}", "", "F{n} Words inserted", "part=2 section={n} sub_section=2"), ("amendment_heading", "", "", "Textual Amendments", "part=2 section={n} sub_section=2"), ("annex", "1", "Lists", "SCHEDULE 1", "annex=1"), ("table", "3", "", "Table 3", "annex=1"), ("signed", "", "", "Signed by x", "annex=1")],
    ),
}
NAMES = list(TEXTS)
_ROWS = ", ".join(f"({c}, {k}, {', '.join(chr(39) + x + chr(39) for x in r)})" for c, (_, rows) in enumerate(TEXTS.values()) for k, r in enumerate(rows))
_FILLED = lambda c: f"replace(replace({c}, '{{n}}', p_size::VARCHAR), '{{w}}', p_name) AS {c}"


@query(f"SELECT p_partkey, {sql_list(NAMES)}[1 + c] AS country, k, {', '.join(_FILLED(c) for c in ('tag', 'number', 'heading', 'text', 'levels'))} FROM part JOIN (VALUES {_ROWS}) r(c, k, tag, number, heading, text, levels) ON p_partkey % {len(NAMES)} = c")
def statute_records(spark, sf_dir):
    part, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    text = F.replace(F.replace(one_of([t for t, _ in TEXTS.values()], k), F.lit("{n}"), F.col("p_size").cast("string")), F.lit("{w}"), F.col("p_name"))
    docs = part.select("p_partkey", text.alias("text"))
    each = [st.statute(docs.filter(F.col("p_partkey") % len(NAMES) == n), "p_partkey", "text", c).withColumn("country", F.lit(c)) for n, c in enumerate(NAMES)]
    out = reduce(lambda a, b: a.unionByName(b), each)
    levels = F.concat_ws(" ", *[F.concat(F.lit(f"{x}="), F.col(x)) for x in st.LEVELS])
    rank = F.row_number().over(Window.partitionBy("p_partkey").orderBy("seq")) - 1
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return out.select("p_partkey", "country", rank.alias("k"), "tag", blank("number"), blank("heading"), "text", levels.alias("levels"))


@query(
    """WITH r AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS seq, l_partkey FROM lineitem),
  n AS (SELECT l_orderkey, seq, seq::VARCHAR || CASE WHEN l_partkey % 5 = 0 THEN (1 + l_partkey % 9)::VARCHAR WHEN l_partkey % 11 = 0 THEN 'A' ELSE '' END AS number FROM r),
  b AS (SELECT *, lag(try_cast(number AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY seq) AS before FROM n),
  f AS (SELECT *, (before + 1)::VARCHAR AS f, before::VARCHAR AS p, length(number) > length((before + 1)::VARCHAR) AND regexp_full_match(number, '[0-9]+') AS long FROM b)
SELECT l_orderkey, seq::INT AS seq, CASE WHEN long AND starts_with(number, f) THEN f || '-' || number[length(f) + 1:] WHEN long AND starts_with(number, p) THEN p || '-' || number[length(p) + 1:] ELSE number END AS number FROM f"""
)
def repaired_numbers(spark, sf_dir):
    k = F.col("l_partkey")
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    glued = F.when(k % 5 == 0, (1 + k % 9).cast("string")).when(k % 11 == 0, "A").otherwise("")
    rows = read(spark, sf_dir, "lineitem").withColumn("seq", seq).select("l_orderkey", "seq", F.concat(F.col("seq").cast("string"), glued).alias("number"))
    return st.repaired_numbers(rows, "l_orderkey", "seq", "number")

"""Quality rules: repetition inside a document, and line frequency across the documents of a host.

DataFrame functions only. The base measures count words, symbols, repeated lines
and words in repeated 8-word windows. The cross-document step hashes each
normalised line, counts the distinct documents of a host that hold it, removes lines
over the limit as boilerplate from the text, and rejects a document that keeps too
few of its words. A line that very many documents share is one key of an aggregate
that combines before the shuffle; in the join back such keys are salted.

A line is common if LINE_DOCS documents of the host hold it and LINE_SHARE per cent of
them do, or if LINE_MANY documents do, however large the host is. Copies of a text are
documents; with copies=False equal texts of a host count once, so that being copied
alone depletes nothing.

Defined results: a null or empty text has no words, fails the base rules and is not
kept; a null source is a host of its own; repeated rows count as one document and
each gets its own result; rows of one doc_id with different texts are told apart; an empty table gives an empty result.
Columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, WORD, materialised

LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
WINDOW = 8
#: Limits of common lines: documents, per cent of the documents of the host, and documents of a host of any size.
LINE_DOCS = 20
LINE_SHARE = 1
LINE_MANY = 1000
#: A document keeps at least this per cent of its words, or is depleted.
LEAST_LEFT = 50
SALTS = 16


def normalised(line: Column) -> Column:
    """Lower-case ASCII, digits as 0, runs of white space as one blank, trimmed."""
    low = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    return F.trim(F.regexp_replace(low, SPACE + "+", " "))


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def repeated_words(words: Column) -> Column:
    """Words inside 8-word windows that occur twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash of the hashes of their words. Without an equal pair the
    answer is 0 at once; otherwise (hash, position) pairs are sorted, equal neighbours
    give the positions of repeated windows, and the union of these windows is summed.
    """
    n = F.size(words)
    own = F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), lambda h: F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))[0]
    return F.transform(F.array(F.when(n >= WINDOW, own).otherwise(F.array().cast("array<bigint>"))), _covered)[0]


def _covered(hashes: Column) -> Column:
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    again = F.transform(F.array(pairs), lambda p: F.filter(p, lambda x, k: (F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False))) | (F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)))))[0]
    at = F.sort_array(F.transform(again, lambda x: x["i"]))
    covered = F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)


def _keys() -> list[Column]:
    """Hashes of the id, of the text and of the source, which tell rows apart in joins."""
    return [F.xxhash64("doc_id").alias("row"), F.xxhash64("text").alias("content"), F.xxhash64("source").alias("host")]


KEYS = ["row", "content", "host"]


def measures(docs: DataFrame) -> DataFrame:
    """The keys, the base measures, and the hash and words of each line (null for a line without a word) of every row."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(*_keys(), text.alias("text"), word_array(F.col("text")).alias("words"), F.split(text, "\n").alias("every"))
    base = base.withColumn("lines", F.filter("every", lambda x: x.rlike(WORD)))
    return base.select(
        *KEYS,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE + "+", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.transform("every", lambda x: F.when(x.rlike(WORD), F.xxhash64(normalised(x)))).alias("hashes"),
        F.transform("every", lambda x: F.size(word_array(x))).alias("counts"),
    )


def line_rows(measured: DataFrame) -> DataFrame:
    """The keys, line hash, number and words of each line with a word, repeats included."""
    every = measured.select(*KEYS, "counts", F.posexplode("hashes").alias("at", "line")).filter("line IS NOT NULL")
    return every.select(*KEYS, "at", "line", F.get("counts", F.col("at")).alias("words"))


def common_lines(measured: DataFrame, copies: bool = True, least_docs: int = LINE_DOCS, least_share: int = LINE_SHARE, many: int = LINE_MANY) -> DataFrame:
    """(host, line, docs) of the lines over the limits; measured: one row for each document. copies: whether equal texts of a host count each."""
    held = measured.filter(F.exists("hashes", lambda x: x.isNotNull()))
    if not copies:
        held = held.dropDuplicates(["host", "content"])
    pairs = held.select("host", F.explode(F.array_distinct("hashes")).alias("line")).filter("line IS NOT NULL")
    counted = pairs.groupBy("host", "line").agg(F.count("*").alias("docs")).filter(F.col("docs") >= least_docs)
    hosts = held.groupBy("host").agg(F.count("*").alias("host_docs"))
    over = (F.col("docs") * 100 >= F.col("host_docs") * least_share) | (F.col("docs") >= many)
    return counted.join(hosts, "host").filter(over).select("host", "line", "docs")


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines of these numbers; the lines and numbers are worked out once a row."""
    lines = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.transform(F.array(F.struct(lines.alias("lines"), left.alias("left"))), lambda s: F.array_join(F.transform(s["left"], lambda i: F.get(s["lines"], i)), "\n"))[0]


def rules(docs: DataFrame, copies: bool = True) -> DataFrame:
    """Measures, base verdict, the text without common lines, the words lost with them, and the final verdict of every row.

    The words that are left follow from the words of each line, so texts move only where `cleaned` is asked for.
    """
    docs = docs.select("doc_id", "text", "source")
    measured = materialised(measures(docs).dropDuplicates(KEYS))  # a line is a hash and a number in all steps but the last
    base = measured.drop("hashes", "counts").withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    salted = line_rows(measured).withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS)))
    spread = common_lines(measured, copies).select("host", "line", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    gone = salted.join(spread, ["host", "line", "salt"]).groupBy(KEYS).agg(F.collect_set("at").alias("gone"), F.sum("words").cast("long").alias("lost"))
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *_keys()).join(base, KEYS).join(gone, KEYS, "left")
    joined = joined.withColumn("cleaned", F.when(F.col("gone").isNull(), F.col("text")).otherwise(without_lines(F.col("text"), F.col("gone"))))
    lost = F.coalesce("lost", F.lit(0).cast("long"))
    joined = joined.withColumn("n_common_words", lost).withColumn("n_left", F.col("n_words") - F.col("n_common_words")).drop("text", "gone", "lost")
    left = F.col("n_left")
    return joined.withColumn("kept", ~F.col("base_failed") & (left >= LEAST_WORDS) & (100 * left >= LEAST_LEFT * F.col("n_words")))


def cleaned(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the kept rows, without the common lines of their hosts."""
    return rules(docs).filter("kept").select("doc_id", F.col("cleaned").alias("text"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: The same in DuckDB SQL, comparing windows and lines themselves instead of their hashes.
OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]+')) AS lines
  FROM documents),
w AS (
  SELECT doc_id, i, array_to_string(words[i:i+7], ' ') AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM d WHERE len(words) >= 8)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1),
c AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM r) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN c USING (doc_id)),
l AS (
  SELECT doc_id, text, source,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm,
         len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS lw
  FROM (SELECT doc_id, text, source, unnest(lines) AS line FROM d)),
h AS (SELECT source, count(DISTINCT doc_id) AS host_docs FROM l GROUP BY source),
f AS (
  SELECT l.source, norm FROM l JOIN h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, norm, host_docs
  HAVING count(DISTINCT doc_id) >= 20 AND (count(DISTINCT doc_id) * 100 >= host_docs * 1 OR count(DISTINCT doc_id) >= 1000)),
x AS (SELECT doc_id, sum(lw) AS lost FROM l JOIN f ON l.source IS NOT DISTINCT FROM f.source AND l.norm = f.norm GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
        AND n_words - coalesce(lost, 0) >= 20 AND 100 * (n_words - coalesce(lost, 0)) >= 50 * n_words) AS kept
FROM m LEFT JOIN x USING (doc_id)
"""

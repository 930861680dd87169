"""Phrases whose words stand together more often than chance, by suffix arrays over word ids.

A text is lower-cased (A-Z), cut into pieces at punctuation and line ends and these into
words. All counts are per language. Each shard (a slice of texts, some MB) numbers its
words and sorts its positions by prefix doubling: by one word, two, four and so on until
the longest phrase is covered. Neighbours in that order share their longest common prefix
(LCP); an interval of the order in which it stays at m words or more is one phrase of m
words, and the size of the interval its count. Shards' counts are merged by key.

Only phrases of `least` occurrences or more are asked for, and all pairs in such a phrase
are as frequent themselves, so there are two passes:

1. shards emit hashes and counts of their word pairs; hashes that reach `least` are marked
   in a bitmap of FILTER_BITS bits, whatever the size of the input;
2. shards emit their words, cut their pieces where a pair is not marked, and emit the
   phrases of what is left.

A mark can be wrong only by letting a phrase through, whose merged count then drops it, so
counts are exact; with very many frequent pairs the bitmap fills and spares less.

Defined results: a null text is empty; a null language is `und`; repeated rows count one by
one; an empty table gives an empty result. Columns other than text and lang are not read.
Scores are exact for up to 10**15 words of a language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, materialised, mixed, raw, runs, slices, span_hashes

LEAST, LONGEST, TOP = 100, 5, 2000
FILTER_BITS = 1 << 26
SHARD_BYTES = 4 << 20

_CUTS, _BLANKS = np.zeros(256, bool), np.zeros(256, bool)
_CUTS[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANKS[list(b" \t")] = True
_INSIDE = ~(_CUTS | _BLANKS)


class Shard:
    """The words of some texts: ids (one for each word of a language) by position, and how many words follow in the piece.

    names and langs hold the word and the language of each id; hashes a 64-bit number that names both everywhere.
    """

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, offsets = raw(texts)
        data = LOWER[data]
        inside = _INSIDE[data]
        starts, ends = runs(inside, offsets)
        n = len(starts)
        kept, sizes = data[inside], ends - starts
        at = np.concatenate([[0], np.cumsum(sizes)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(at), pa.py_buffer(kept)]).dictionary_encode()
        spoken = langs.fill_null("und").dictionary_encode()
        text = np.searchsorted(offsets, starts, side="right") - 1
        lang = spoken.indices.to_numpy()[text].astype(np.int64)
        both, self.ids = np.unique(words.indices.to_numpy() * np.int64(max(1, len(spoken.dictionary))) + lang, return_inverse=True)
        word, own = np.divmod(both, max(1, len(spoken.dictionary)))
        self.names = words.dictionary.take(pa.array(word)).cast(pa.binary()).cast(pa.string())
        self.langs = spoken.dictionary.take(pa.array(own)).cast(pa.string())
        tongue, name = _hashes(spoken.dictionary), _hashes(words.dictionary)
        with np.errstate(over="ignore"):
            self.hashes = mixed(name[word] + tongue[own] * np.uint64(3))
        cuts = np.cumsum(_CUTS[data], dtype=np.int64)[starts] if n else starts
        first = np.ones(n, bool)
        first[1:] = (text[1:] != text[:-1]) | (cuts[1:] != cuts[:-1])
        self._runs(first)

    def _runs(self, first: np.ndarray) -> None:
        """Words left from each position on to the end of its piece, itself included."""
        n = len(first)
        self.first = first
        begins = np.flatnonzero(first)
        ends = np.append(begins[1:], n) if len(begins) else begins
        self.left = np.repeat(ends, ends - begins) - np.arange(n)

    def pairs(self) -> np.ndarray:
        """Hash of the pair that begins at each position; meaningless where no word follows."""
        h = self.hashes[self.ids]
        return pair_hashes(h, np.append(h[1:], h[:1]))

    def cut(self, joined: np.ndarray) -> None:
        """Cut pieces after each position that is not joined to the next, and leave out what is then a single word."""
        first = self.first.copy()
        first[1:] |= ~joined[:-1]
        self._runs(first)
        keep = ~first | (self.left > 1)
        self.ids, first = self.ids[keep], first[keep]
        self._runs(first)

    def phrases(self, longest: int):
        """(m, where the phrase begins for the first time in the order, count) of all phrases of m words, m from 1 to longest."""
        order = suffix_array(self.ids, self.left, longest)
        common = common_prefixes(order, self.ids, self.left, longest)
        for m in range(1, longest + 1):
            begins = np.flatnonzero(common < m)
            counts = np.diff(np.append(begins, len(order)))
            enough = self.left[order[begins]] >= m
            yield m, order[begins[enough]], counts[enough]


def _hashes(values: pa.Array) -> np.ndarray:
    data, at = raw(values)
    return span_hashes(data, at[:-1], at[1:])


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def suffix_array(ids: np.ndarray, left: np.ndarray, longest: int) -> np.ndarray:
    """Positions in the order of what begins there within its piece, compared by `longest` words or more.

    Prefix doubling: the ranks of k words at a position and at k words further make the rank of 2k words.
    """
    n = len(ids)
    rank, depth, order = ids.astype(np.int64) + 1, 1, np.argsort(ids, kind="stable")
    while depth < longest and n:
        beyond = np.zeros(n, np.int64)
        more = np.flatnonzero(left > depth)
        beyond[more] = rank[more + depth]
        key = rank * (beyond.max() + 1) + beyond
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.cumsum(np.concatenate([[1], key[1:] != key[:-1]]))
        depth *= 2
    return order


def common_prefixes(order: np.ndarray, ids: np.ndarray, left: np.ndarray, longest: int) -> np.ndarray:
    """Words, at most `longest`, that each position of the order has in common with the one before it."""
    out = np.zeros(len(order), np.int8)
    a, b = order[:-1], order[1:]
    same = np.ones(len(b), bool)
    least = np.minimum(left[a], left[b]) if len(b) else np.zeros(0, np.int64)
    for k in range(longest):
        same &= least > k
        at = np.flatnonzero(same)
        same[at] = ids[a[at] + k] == ids[b[at] + k]
        out[1:] += same
    return out


def _shards(batches):
    for batch in slices(batches, most=SHARD_BYTES):
        yield Shard(batch.column(0), batch.column(1))


def pair_counts(docs: DataFrame) -> DataFrame:
    """(hash, f) of all word pairs, merged; two that share a hash count as one."""

    def work(batches):
        for s in _shards(batches):
            for m, at, n in s.phrases(2):
                if m == 2:
                    yield pa.RecordBatch.from_arrays([pa.array(s.pairs()[at].view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "f"])

    return docs.select("text", "lang").mapInArrow(work, "hash long, f long").groupBy("hash").agg(F.sum("f").alias("f"))


def marks(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap (bytes, bits / 8 of them) in which the bits of all hashes are set.

    Bits are gathered by words of 64, of which there are at most bits / 64, however many hashes there are.
    """
    bit = F.pmod("hash", F.lit(bits))
    words = hashes.groupBy(F.shiftright(bit, 6).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(hash, {bits}) AS INT) & 63)")).alias("word"))
    table, out = words.toArrow(), np.zeros(bits // 64, np.int64)
    out[table["at"].to_numpy()] = table["word"].to_numpy()
    return out.view(np.uint8)


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, f): phrases of 1 to `longest` words with f >= least, and the count of all words of each language under a null phrase."""
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(marks(pair_counts(docs).filter(F.col("f") >= least)))

    def work(batches):
        def rows(langs, phrases, counts):
            return pa.RecordBatch.from_arrays([langs, phrases, pa.array(counts, pa.int64())], ["lang", "phrase", "f"])

        for s in _shards(batches):
            n = np.bincount(s.ids, minlength=len(s.names))
            of = s.langs.dictionary_encode()
            total = np.bincount(of.indices.to_numpy(), n, len(of.dictionary)).astype(np.int64)
            yield rows(of.dictionary, pa.nulls(len(total), pa.string()), total)
            yield rows(s.langs, s.names, n)
            s.cut(marked(bitmap.value, s.pairs()) & (s.left > 1))
            for m, at, counts in s.phrases(longest):
                if m > 1 and len(at):
                    words = [s.names.take(pa.array(s.ids[at + k])) for k in range(m)]
                    yield rows(s.langs.take(pa.array(s.ids[at])), pc.binary_join_element_wise(*words, " "), counts)

    found = docs.select("text", "lang").mapInArrow(work, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("phrase").isNull() | (F.col("f") >= least))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """Every candidate (lang, phrase, a, l, r, n, score, dropped): a phrase of 2 to `longest` words with a >= least.

    l and r are the counts of the two parts of the cut with the least score; dropped tells whether a longer
    candidate holds the phrase as often as it occurs at all.
    """
    counts = materialised(phrase_counts(docs, least, longest))
    totals = counts.filter("phrase IS NULL").select("lang", F.col("f").alias("n"))
    known = counts.filter("phrase IS NOT NULL")
    words = F.split("phrase", " ")
    found = known.filter(F.size(words) > 1).select("lang", "phrase", F.col("f").alias("a"), words.alias("words"))
    parts = found.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.expr("slice(words, 1, k)"), " ").alias("head"),
        F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ").alias("tail"),
    )
    head = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tail = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cut = parts.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).join(totals, "lang")
    score = F.expr("1000BD * CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(15, 0)) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))").cast("long")
    best = cut.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    inner = F.explode(F.array(F.array_join(F.expr("slice(words, 1, size(words) - 1)"), " "), F.array_join(F.expr("slice(words, 2, size(words) - 1)"), " ")))
    # a phrase that some longer one holds as often as it occurs is held as often by one of a word more
    held = found.filter(F.size("words") > 2).select("lang", "a", inner.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    return best.join(held, ["lang", "phrase"], "left").select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"), F.coalesce(F.col("most") >= F.col("a"), F.lit(False)).alias("dropped")
    )


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first candidates of each language that are not dropped: score and a descending, then the phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.filter(~F.col("dropped")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long")).drop("dropped")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best(collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), lists AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), starts AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM lists
), spans AS (
    SELECT lang, words, i, unnest([1, 2, 3, 4, 5]) AS m FROM starts
), counts AS (
    SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase, count(*) AS f
    FROM spans WHERE i + m - 1 <= len(words) GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang
), often AS (
    SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE f >= 100
), cuts AS (
    SELECT lang, m, phrase, words, f, unnest(range(1, m)) AS k FROM often WHERE m > 1
), scored AS (
    SELECT c.lang, c.m, c.phrase, c.f AS a, c.k, l.f AS l, r.f AS r, t.n, ((1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang
    JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:c.k], ' ')
    JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.k + 1:c.m], ' ')
), least AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
    SELECT lang, f, words, m, unnest(range(2, m)) AS size FROM often WHERE m > 2
), inner_starts AS (
    SELECT lang, f, words, size, unnest(range(1, m - size + 2)) AS i FROM inner_parts
), held AS (
    SELECT lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, max(f) AS most FROM inner_starts GROUP BY ALL
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase)::BIGINT AS rank, s.phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM least s LEFT JOIN held h ON h.lang = s.lang AND h.phrase = s.phrase
WHERE coalesce(h.most, 0) < a QUALIFY rank <= 2000
"""

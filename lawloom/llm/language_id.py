"""Language identification by a mixture over the languages of one text.

Training counts hashed character trigrams (word edges included) by language. The
likelihood of a word under a language is the product over its trigrams. For each
text, expectation-maximisation estimates the share of each language among its
words, and the set of languages of the best penalised likelihood (the Bayesian
information criterion) is chosen: one language, the likeliest two, three, ..., or all.
A bound on the likelihood of all mixtures tells where one language must win. The prediction is the language of the largest
share, the score its share.

Defined results: a null text or one without a letter gives 'und' with score 0;
repeated rows repeat their result; an empty table gives an empty result; without
training rows every text is 'und'. Columns other than doc_id and text are not
read when predicting.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, mixed, slices

GRAMS = 1 << 18
#: Bound of what fitting reads: about so many rows of each language, those of the least hashes.
ROWS_OF_A_LANGUAGE = 2000
ROUNDS = 12
#: Times log(words) that one more language must win in twice the log-likelihood.
PENALTY = 2.0


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the words of lower-cased text, and the first gram of each word (one more entry at the end).

    A word is a run of letters; it is taken between two blanks, so that a word of n letters has n trigrams.
    """
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters(code)
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    padded = np.zeros(len(code) + 2, np.uint64)
    padded[1:-1] = np.where(letter, code, 0)
    with np.errstate(over="ignore"):
        h = mixed(padded[:-2] * np.uint64(0x100000001B3) ^ padded[1:-1] << np.uint64(21) ^ padded[2:] << np.uint64(42))
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    grams = (h[letter] & np.uint64(GRAMS - 1)).astype(np.int64)
    return grams, np.append(np.flatnonzero(first[letter]), len(grams))


_BMP = None


def _letters(code: np.ndarray) -> np.ndarray:
    global _BMP
    if _BMP is None:
        _BMP = np.array([chr(k).isalpha() for k in range(0x30000)])
    return _BMP[np.minimum(code, len(_BMP) - 1)] | (code >= 0x30000)


@dataclass
class Model:
    names: list[str]
    table: np.ndarray  # (GRAMS, languages) log-likelihoods

    def mixtures(self, likelihood: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Shares (n, languages) of the chosen languages of each text, from the log-likelihoods of its words."""
        k = likelihood.shape[1]
        edges = np.searchsorted(doc, np.arange(n + 1))
        count = np.diff(edges)
        rows = np.flatnonzero(count)
        top = likelihood.max(1, keepdims=True)
        p = np.exp(likelihood - top)

        def sums(x: np.ndarray) -> np.ndarray:
            out = np.zeros((n, *x.shape[1:]))
            if len(rows):
                out[rows] = np.add.reduceat(x, edges[rows], 0)
            return out

        base = sums(top[:, 0])
        logs = np.log(np.maximum(count, 2))
        alone = sums(likelihood)
        single = alone.argmax(1)
        # The log-likelihood is concave in the shares: no mixture exceeds its value near one language by more than the largest slope less the words.
        near = np.full((n, k), 1.0) / np.maximum(count, 1)[:, None] / k
        near[np.arange(n), single] += 1 - 1 / np.maximum(count, 1)
        at_near = np.maximum((near[doc] * p).sum(1), 1e-300)
        most = base + sums(np.log(at_near)) + sums(p / at_near[:, None]).max(1) - count
        out = np.eye(k)[single]
        one = -2 * alone[np.arange(n), single]
        open_ = np.flatnonzero((one > -2 * most + PENALTY * logs) & (count > 0))  # elsewhere no larger set can win
        if len(open_):
            keep = np.isin(doc, open_)
            out[open_] = self._chosen(p[keep], base[open_], np.searchsorted(open_, doc[keep]), out[open_], one[open_], logs[open_])
        return out, count

    def _chosen(self, p, base, doc, out, cost, logs) -> np.ndarray:
        """Shares by expectation-maximisation over all languages, then over the likeliest two, three, ...; `out` at `cost` is one language alone."""
        n, k = out.shape
        edges = np.searchsorted(doc, np.arange(n))
        count = np.diff(np.append(edges, len(doc)))

        def run(allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pi = allowed / allowed.sum(1, keepdims=True)
            for _ in range(ROUNDS):
                w = pi[doc] * p
                w /= np.maximum(w.sum(1, keepdims=True), 1e-300)
                pi = np.add.reduceat(w, edges, 0) / count[:, None]
            return pi, base + np.add.reduceat(np.log(np.maximum((pi[doc] * p).sum(1), 1e-300)), edges)

        best, fit = run(np.ones((n, k)))
        now = -2 * fit + PENALTY * (k - 1) * logs
        out = np.where((cost < now)[:, None], out, best)
        cost = np.minimum(cost, now)
        order = np.argsort(-best, 1, kind="stable")
        for size in range(2, k):
            allowed = np.zeros((n, k))
            allowed[np.arange(n)[:, None], order[:, :size]] = 1
            pi, fit = run(allowed)
            now = -2 * fit + PENALTY * (size - 1) * logs
            out = np.where((now < cost)[:, None], pi, out)
            cost = np.minimum(cost, now)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[list]]:
        words, docs = [], []
        for i, text in enumerate(texts):
            grams, first = trigrams(text)
            if len(grams) and self.names:
                words.append(np.add.reduceat(self.table[grams], first[:-1], 0))
                docs.append(np.full(len(first) - 1, i))
        if not words:
            return ["und"] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
        share, count = self.mixtures(np.concatenate(words).astype(np.float64), np.concatenate(docs), len(texts))
        best = share.argmax(1)
        sets = [[(self.names[k], float(row[k])) for k in np.flatnonzero(row > 0)] if c else [] for row, c in zip(share, count)]
        return [self.names[b] if c else "und" for b, c in zip(best, count)], np.where(count > 0, share[np.arange(len(texts)), best], 0.0), sets


def fit(docs: DataFrame, rows_of_a_language: int = ROWS_OF_A_LANGUAGE) -> Model:
    """Learn from the text and non-null lang of docs, about rows_of_a_language rows of each language, chosen by a hash of doc_id and text."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Model([], np.zeros((GRAMS, 0), np.float32))
    below = docs.sparkSession.createDataFrame([(name, int(min(1.0, rows_of_a_language / n) * (1 << 32))) for name, n in sizes.items()], "lang string, below long")
    drawn = F.pmod(F.xxhash64(F.lit(31), "doc_id", "text"), F.lit(1 << 32)) < F.col("below")

    def count(batches):
        total = {name: np.zeros(GRAMS, np.int64) for name in names}
        for batch in slices(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[lang] += np.bincount(trigrams(text)[0], minlength=GRAMS)
        for name, c in total.items():
            at = np.flatnonzero(c)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(c[at])], ["lang", "gram", "n"])

    found = known.join(F.broadcast(below), "lang").filter(drawn).select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    found = found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # at most GRAMS rows a language
    counts = np.full((GRAMS, len(names)), 0.5)
    for k, name in enumerate(names):
        own = found[found.lang == name]
        counts[own.gram.to_numpy(), k] += own.n.to_numpy()
    return Model(names, np.log(counts / counts.sum(0)).astype(np.float32))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row; languages: the share of each chosen language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: GRAMS rows by languages

    def work(batches):
        for batch in slices(batches, most=512 << 10):
            lang, score, sets = shared.value.predict([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.map_(pa.string(), pa.float64()))], ["doc_id", "lang_pred", "score", "languages"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, lang_pred string, score double, languages map<string,double>")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = held_out(F.col("doc_id"), 4, 2)
    return predict(docs, fit(docs.filter(~out))).select("doc_id", out.alias("held_out"), "lang_pred", "score")

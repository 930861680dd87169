"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word is a run of letters, lower-cased; hashes of the word and of its first four
and first six bytes pick one row in each of three embedding tables, and the rows
are added, so that unseen forms of a stem share what the stem has learned. Filters of width 1, 2 and 3 slide
over the words, each keeps its largest value in the whole text, and a logistic
layer weighs these maxima. Training is plain numpy (Adagrad; the gradient of a
maximum touches one window, so updates are sparse). One embedding coordinate
starts at the smoothed log-odds of its bucket between toxic and clean rows.
The decision threshold is calibrated by language on rows that training left out; each
language's own is drawn towards that of all, the more the fewer toxic rows it has.
Languages are learned from the words of the training texts alone, as LANGUAGES groups
of a mixture of word distributions; the column lang is not read, in training or later.

Defined results: null, empty or letterless texts have no window, so all maxima are
0 and the score is that of no evidence; repeated rows repeat their score; an empty
table gives an empty result. Without labelled rows of both classes every score is
the share of toxic labels (0 without labels). If labels of one doc_id differ, the
largest counts. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, bounded_sample, held_out, raw, runs, slices, span_hashes
from .quality_classifier import logistic

BUCKETS = 1 << 16
DIM = 8
FILTERS = 8
#: Bytes of each of the three views of a word; None: all.
STEMS = (None, 4, 6)
WIDTHS = (1, 2, 3)
EPOCHS = 8
#: Bound of what fitting gathers: labelled rows of each class.
ROWS_OF_A_CLASS = 3000
#: Groups of texts by their words, which stand for languages.
LANGUAGES = 6
#: The threshold of all languages counts like so many toxic rows of each language, so that few rows of its own move it little.
SHRINK = 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of each word (words, 3), and the first word of each text (one more entry at the end)."""
    low = LOWER[data]
    starts, ends = runs(_LETTER[low], offsets)
    m = np.uint64(BUCKETS - 1)
    ids = np.empty((len(starts), len(STEMS)), np.uint16)
    for k, stem in enumerate(STEMS):
        ids[:, k] = (span_hashes(low, starts, ends if stem is None else np.minimum(ends, starts + stem)) >> np.uint64(16 * k)) & m
    return ids, np.searchsorted(starts, offsets)


@dataclass
class Model:
    tables: list = field(default_factory=list)  # by view: (BUCKETS, DIM)
    filters: list = field(default_factory=list)  # by width: (width, DIM, FILTERS)
    bias: np.ndarray | None = None
    weights: np.ndarray | None = None
    constant: float = 0.0
    languages: np.ndarray | None = None  # (BUCKETS, languages) log-likelihoods
    thresholds: np.ndarray | None = None
    slope: float = 1.0

    def projected(self) -> list:
        """Each table times every filter column: (BUCKETS, sum of widths * FILTERS)."""
        columns = np.concatenate([w[j] for w in self.filters for j in range(len(w))], 1)
        return [(t @ columns).astype(np.float32) for t in self.tables]

    def logits(self, ids, first, projected) -> np.ndarray:
        x = projected[0][ids[:, 0]]
        for k in range(1, len(STEMS)):
            x += projected[k][ids[:, k]]
        pooled = np.zeros((len(first) - 1, len(WIDTHS) * FILTERS), np.float32)
        at = 0
        for k, width in enumerate(WIDTHS):
            z = x[: max(0, len(x) - width + 1), at : at + FILTERS]
            for j in range(1, width):
                z = z + x[j : len(x) - width + 1 + j, at + j * FILTERS : at + (j + 1) * FILTERS]
            at += width * FILTERS
            size = np.diff(first) - width + 1
            rows = np.flatnonzero(size > 0)
            if len(rows):
                edges = np.stack([first[rows], first[rows] + size[rows]], 1).ravel()
                # every second piece holds the windows that run over the end of a text
                z = np.concatenate([z, np.zeros((1, FILTERS), np.float32)])
                pooled[rows, k * FILTERS : (k + 1) * FILTERS] = np.maximum.reduceat(z, np.minimum(edges, len(z) - 1), 0)[::2]
                pooled[rows, k * FILTERS : (k + 1) * FILTERS] += self.bias[k * FILTERS : (k + 1) * FILTERS]
        return np.maximum(pooled, 0) @ self.weights + self.constant

    def language(self, ids, first) -> np.ndarray:
        total = np.concatenate([np.zeros((1, self.languages.shape[1])), np.cumsum(self.languages[ids[:, 0]], 0, dtype=np.float64)])
        return (total[first[1:]] - total[first[:-1]]).argmax(1)

    def scores(self, ids, first, projected) -> np.ndarray:
        if self.weights is None:
            return np.full(len(first) - 1, self.constant)
        z = self.logits(ids, first, projected)
        return 1 / (1 + np.exp(-np.clip(self.slope * (z - self.thresholds[self.language(ids, first)]), -35, 35)))


def _collected(batches):
    for batch in slices(batches, most=512 << 10):
        ids, first = word_ids(*raw(batch.column(batch.schema.get_field_index("text"))))
        ids = [ids[i:j].tobytes() for i, j in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("label")), pa.array(ids, pa.binary())], ["label", "ids"])


def word_groups(ids: list, groups: int = LANGUAGES, rounds: int = 12, tries: int = 4) -> np.ndarray:
    """(BUCKETS, groups) log-likelihoods of words in the best of some mixtures of word distributions, fitted to the texts."""
    ids = [doc[:, 0] for doc in ids if len(doc)]
    if not ids:
        return np.zeros((BUCKETS, 1), np.float32)
    size = np.array([len(x) for x in ids])
    word, first = np.concatenate(ids).astype(np.int64), np.cumsum(size) - size
    doc = np.repeat(np.arange(len(ids)), size)
    background = np.bincount(word, minlength=BUCKETS) + 0.1
    rng = np.random.default_rng(5)
    best, table = -np.inf, None
    for _ in range(tries):
        group = np.full(len(ids), -1)
        group[rng.permutation(len(ids))[: 8 * groups]] = np.arange(min(8 * groups, len(ids))) % groups
        for _ in range(rounds):
            counts = np.stack([np.bincount(word[group[doc] == g], minlength=BUCKETS) for g in range(groups)], 1) + background[:, None] * 1e-3
            now = np.log(counts / counts.sum(0)).astype(np.float32)
            score = np.add.reduceat(now[word], first, 0)
            changed, group = group, score.argmax(1)
            if (changed == group).all():
                break
        total = score.max(1).sum(dtype=np.float64)
        if total > best:
            best, table = total, now
    return table


def _log_odds(ids: list, y: np.ndarray, column: int) -> np.ndarray:
    n = np.zeros((2, BUCKETS))
    for doc, label in zip(ids, y):
        n[int(label), np.unique(doc[:, column])] += 1
    share = (n + 0.5) / (np.array([(y == 0).sum(), (y == 1).sum()])[:, None] + 1)
    return np.clip(np.log(share[1] / share[0]), -3, 3) * (n.sum(0) > 1)


def train(ids: list, y: np.ndarray, seed: int = 3, epochs: int = EPOCHS) -> Model:
    """Fit the network on texts given as (words, 3) bucket numbers."""
    rng = np.random.default_rng(seed)
    m = Model()
    m.tables = [rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32) for _ in STEMS]
    for k in range(len(STEMS)):
        m.tables[k][:, 0] = 0.4 * _log_odds(ids, y, k)
    m.filters = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w in m.filters:
        w[:, 0, : FILTERS // 2] = 1.0 / len(w)
    n = len(WIDTHS) * FILTERS
    m.bias, m.weights, m.constant = np.full(n, -0.5, np.float32), np.full(n, 0.2, np.float32), -2.0
    g2 = {"t": [np.full(BUCKETS, 1e-2, np.float32) for _ in STEMS], "f": [np.full_like(w, 1e-2) for w in m.filters], "b": np.full(n, 1e-2, np.float32), "w": np.full(n, 1e-2, np.float32), "c": 1e-2}
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for epoch in range(epochs):
        rate = 0.08 / (1 + 0.5 * epoch)
        order = rng.permutation(len(ids))
        for at in range(0, len(order), 32):
            batch = order[at : at + 32]
            docs = [ids[i] for i in batch]
            size = np.array([len(doc) for doc in docs])
            some = np.flatnonzero(size)
            first, words = (np.cumsum(size) - size)[some], np.concatenate(docs)
            left = np.repeat(np.cumsum(size), size) - np.arange(len(words))  # words up to the end of the text
            e = sum(t[words[:, k]] for k, t in enumerate(m.tables))
            pooled, where = np.full((len(batch), n), -np.inf, np.float32), np.zeros((len(batch), n), np.int64)
            for k, w in enumerate(m.filters):
                z = np.full((len(words), FILTERS), -np.inf, np.float32)
                if len(words) >= len(w):
                    z[: len(words) - len(w) + 1] = sum(e[j : len(words) - len(w) + 1 + j] @ w[j] for j in range(len(w)))
                z[left < len(w)] = -np.inf
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                if len(some):
                    pooled[some, own] = np.maximum.reduceat(z, first, 0)
                    top = z == np.repeat(pooled[some, own], size[some], 0)
                    where[some, own] = np.minimum.reduceat(np.where(top, np.arange(len(words))[:, None], len(words) - 1), first, 0)
            pooled = np.where(np.isinf(pooled), 0, pooled + m.bias)
            keep = (rng.random((len(batch), n)) > 0.2) / 0.8
            active = np.maximum(pooled, 0) * keep
            p = 1 / (1 + np.exp(-np.clip(active @ m.weights + m.constant, -30, 30)))
            d = (p - y[batch]) * weight[batch] / len(batch)
            gw, gc, back = d @ active, float(d.sum()), d[:, None] * m.weights * (pooled > 0) * keep
            gb = back.sum(0)
            rows, grads_e = [], []
            for k, w in enumerate(m.filters):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                text, f = np.nonzero(back[:, own])
                if len(text):
                    by, place = back[:, own][text, f][:, None], where[:, own][text, f]
                    g = np.zeros_like(w)
                    for j in range(len(w)):
                        np.add.at(g[j].T, f, by * e[place + j])
                        rows.append(words[place + j])
                        grads_e.append(by * w[j].T[f])
                else:
                    g = np.zeros_like(w)
                g += 1e-4 * w
                g2["f"][k] += g * g
                m.filters[k] = w - rate * g / np.sqrt(g2["f"][k])
            g2["b"] += gb * gb
            m.bias -= rate * gb / np.sqrt(g2["b"])
            gw = gw + 1e-4 * m.weights
            g2["w"] += gw * gw
            m.weights -= rate * gw / np.sqrt(g2["w"])
            g2["c"] += gc * gc
            m.constant -= rate * gc / np.sqrt(g2["c"])
            if rows:
                at_rows, g = np.concatenate(rows).astype(np.int64), np.concatenate(grads_e)
                for k in range(len(STEMS)):
                    u, inverse = np.unique(at_rows[:, k], return_inverse=True)
                    total = np.zeros((len(u), DIM), np.float32)
                    np.add.at(total, inverse, g)
                    g2["t"][k][u] += (total * total).mean(1)
                    m.tables[k][u] -= rate * total / np.sqrt(g2["t"][k][u])[:, None]
    return m


def calibrate(m: Model, ids: list, y: np.ndarray, toxic_share: float) -> None:
    """Set the slope and, by guessed language, the threshold of the best F1 at the given share of toxic rows, shrunk towards that of all."""
    first = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    together = np.concatenate(ids) if len(ids) else np.zeros((0, len(STEMS)), np.uint16)
    z = m.logits(together, first, m.projected())
    w = np.where(y == 1, toxic_share / max(1, (y == 1).sum()), (1 - toxic_share) / max(1, (y == 0).sum()))

    def best(rows: np.ndarray) -> float:
        zs, ys, ws = z[rows], y[rows], w[rows]
        order = np.argsort(-zs)
        zs, tp, fp = zs[order], np.cumsum((ws * (ys == 1))[order]), np.cumsum((ws * (ys == 0))[order])
        f1 = 2 * tp / (tp + fp + ws[ys == 1].sum())
        k = int(f1.argmax())
        return float((zs[k] + zs[min(k + 1, len(zs) - 1)]) / 2)

    guessed = m.language(together, first)
    everywhere = best(np.arange(len(z)))
    m.thresholds = np.full(m.languages.shape[1], everywhere)
    for k in range(len(m.thresholds)):
        rows = np.flatnonzero(guessed == k)
        toxic = int((y[rows] == 1).sum())
        if 0 < toxic < len(rows):
            m.thresholds[k] = (toxic * best(rows) + SHRINK * everywhere) / (toxic + SHRINK)
    m.slope = max(0.5, logistic(z.astype(float), y.astype(float))[0])


def fit(docs: DataFrame, labelled: DataFrame, rows_of_a_class: int = ROWS_OF_A_CLASS) -> Model:
    """Learn from labelled (doc_id, label); a quarter of the sampled rows calibrates."""
    rows = labelled.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    share = rows.agg(F.avg("label")).first()[0]
    picked = bounded_sample(rows, "label", rows_of_a_class, 21)
    got = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("label", "text").mapInArrow(_collected, "label int, ids binary").toPandas()
    got = got.sort_values(["ids", "label"], kind="stable").reset_index(drop=True)
    if got.label.nunique() < 2:
        return Model(constant=float(share or 0.0))
    ids = [np.frombuffer(bytes(x), np.uint16).reshape(-1, len(STEMS)) for x in got.ids]
    y = got.label.to_numpy()
    part = np.random.default_rng(4).permutation(len(ids)) % 4
    fitted = np.flatnonzero(part != 0)
    m = train([ids[i] for i in fitted], y[fitted])
    m.languages = word_groups([ids[i] for i in fitted])
    rest = np.flatnonzero(part == 0)
    calibrate(m, [ids[i] for i in rest], y[rest], float(share))
    return m


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; the whole text counts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: tables of BUCKETS rows

    def work(batches):
        m = shared.value
        projected = m.projected() if m.weights is not None else None
        for batch in slices(batches, most=256 << 10):
            s = m.scores(*word_ids(*raw(batch.column(batch.schema.get_field_index("text")))), projected)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(s.astype(float), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, score double")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", F.col("toxic").alias("label")))
    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

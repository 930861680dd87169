"""Quality by compression: dictionaries of good and bad text, the size difference as a calibrated score.

Each text is cut into blocks of BLOCK bytes; a block is compressed once with a
zstandard dictionary trained on good text and once with one trained on bad text.
The difference of the two sizes over the length is the evidence; a logistic
curve over its inverse hyperbolic sine turns it into a probability.

Defined results: a null or empty text has no evidence and scores what the curve
gives for none; rows are scored one by one, so repeated rows repeat their score;
an empty table gives an empty result. If one of the classes has no labelled row,
every score is the share of good labels (0.5 without labels). If labels of one
doc_id differ, the largest counts. Where the blocks of the labelled rows are too few or
too short to train dictionaries on, the dictionaries are the blocks themselves. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import bounded_sample, held_out, raw, slices

BLOCK = 1024
DICTIONARY_BYTES = 64 << 10
#: Bound of what fitting gathers: labelled rows of each class. Their texts count whole.
ROWS_OF_A_CLASS = 3000


@dataclass
class Model:
    good: bytes
    bad: bytes
    raw_content: bool
    slope: float
    bias: float

    def evidence(self, text: bytes, tools: list | None = None) -> float:
        good, bad = tools or compressors(self)
        diff = 0
        for at in range(0, len(text), BLOCK):
            block = text[at : at + BLOCK]
            diff += len(bad.compress(block)) - len(good.compress(block))
        return float(np.arcsinh(200.0 * (diff + 1) / (len(text) + 32)))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.bias, -35, 35)))


def compressors(model: Model) -> list:
    made = []
    for data in (model.good, model.bad):
        kind = zstandard.DICT_TYPE_RAWCONTENT if model.raw_content else zstandard.DICT_TYPE_AUTO
        d = zstandard.ZstdCompressionDict(data, dict_type=kind)
        d.precompute_compress(level=3)
        made.append(zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0, rounds: int = 50) -> tuple[float, float]:
    """Slope and bias of a slightly ridged logistic curve by Newton's method; weight: of each row."""
    a = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + np.eye(2) * 1e-2
        step = np.linalg.solve(h, a.T @ (weight * (y - p)) - 1e-2 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _trained(groups: list[list[bytes]]) -> tuple[list[bytes], bool]:
    """A dictionary of each group's blocks, and whether they are plain: the last bytes of the blocks, where zstandard finds too little to train on (less than about ten times the dictionary)."""
    try:
        return [zstandard.train_dictionary(DICTIONARY_BYTES, g).as_bytes() for g in groups], False
    except zstandard.ZstdError:
        return [b"".join(g)[-DICTIONARY_BYTES:] or b"\0" * 8 for g in groups], True


def _blocks(batches):
    for batch in slices(batches):
        rows = batch.to_pydict()
        for label, text in zip(rows["label"], rows["text"]):
            data = (text or "").encode()
            blocks = [data[k : k + BLOCK] for k in range(0, max(1, len(data)), BLOCK)]
            yield pa.RecordBatch.from_pydict({"label": [label] * len(blocks), "block": blocks}, pa.schema([("label", pa.int32()), ("block", pa.binary())]))


def _evidences(model: Model):
    def work(batches):
        tools = compressors(model)
        for batch in slices(batches):
            data, at = raw(batch.column(batch.schema.get_field_index("text")))
            data = data.tobytes()
            x = [model.evidence(data[a:b], tools) for a, b in zip(at[:-1], at[1:])]
            rest = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in rest), pa.array(x, pa.float64())], [*rest, "evidence"])

    return work


def fit(docs: DataFrame, labelled: DataFrame, rows_of_a_class: int = ROWS_OF_A_CLASS) -> Model:
    """Learn from labelled (doc_id, label); at most rows_of_a_class rows of each class, half for each of the two steps.

    The curve weighs the sampled rows by the shares of the classes among all labels, so its odds do not depend on the bound.
    """
    rows = labelled.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    picked = bounded_sample(rows, "label", rows_of_a_class, 11)
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    half = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(2))
    got = texts.filter(half == 0).select("label", "text").mapInArrow(_blocks, "label int, block binary").toPandas()
    groups = [sorted(map(bytes, got.block[got.label == v])) for v in (1, 0)]
    if not all(groups):
        n = labelled.agg(F.avg(F.col("label").cast("double"))).first()[0]
        share = min(max(0.5 if n is None else n, 1e-3), 1 - 1e-3)
        return Model(b"\0" * 8, b"\0" * 8, True, 0.0, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(6)
    for g in groups:
        rng.shuffle(g)
    dictionaries, plain = _trained(groups)
    model = Model(*dictionaries, plain, 1.0, 0.0)
    seen: pd.DataFrame = texts.filter(half == 1).select("label", "text").mapInArrow(_evidences(model), "label int, evidence double").toPandas()
    seen = seen.sort_values(["evidence", "label"])
    if seen.label.nunique() == 2:
        good = rows.agg(F.avg("label")).first()[0]
        y = seen.label.to_numpy()
        weight = np.where(y == 1, good / (y == 1).sum(), (1 - good) / (y == 0).sum()) * len(y)
        model.slope, model.bias = logistic(seen.evidence.to_numpy(), y.astype(float), weight)
    return model


def scored(docs: DataFrame, model: Model, to: str = "score") -> DataFrame:
    """The rows of docs with their score in one more column, whose name must be free; the whole text counts."""
    tools: list = []

    def work(batches):
        if not tools:
            tools.extend(compressors(model))
        for batch in slices(batches):
            data, at = raw(batch.column(batch.schema.get_field_index("text")))
            data = data.tobytes()
            x = np.array([model.evidence(data[a:b], tools) for a, b in zip(at[:-1], at[1:])])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x), pa.float64())], [*batch.schema.names, to])

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(to, DoubleType())]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    return scored(docs.select("doc_id", "text"), model).select("doc_id", "score")


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return fit(docs, labels.filter(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", F.col("quality").alias("label")))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, fitted(spark, docs, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

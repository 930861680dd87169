"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Equal vectors of one label are one class. A class is scaled to unit length once and
rounded to int8 steps of its own size; what that leaves is rounded to int8 steps again.
The classes of a label are dealt into blocks of about BLOCK by a hash; each pair of
blocks is one task that holds two blocks of int8 numbers, however large a label is.
With x = q + e, the product of two unit vectors differs from that of their rounded
forms by at most |q| |e'| + |e|. So in a task

1. pairs that even this cannot lift to the threshold by the first steps are done, pairs
   that it cannot pull below are links;
2. the rest is computed with both steps, whose errors are 100 times smaller, and judged
   by the same bound;
3. pairs that still may lie on either side leave the task, and are recomputed from the
   vectors themselves in double precision.

A task returns the number of links of each class and a spanning forest, not pairs, but
for those of step 3.

All classes of a label meet, so the work grows with the square of the largest label;
vectors have no key that would rule out pairs without a risk of losing links.

Defined results: a null label, and vectors that are null, empty, zero or hold null
or non-finite components, link with nothing; only vectors of equal length are
compared; every row is a vector, so repeated rows link with each other; an empty
table gives an empty result. Columns other than vec_id, embedding and label are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, materialised, with_keys

BLOCK = 1024
STRIP = 256
THRESHOLD = 0.93
#: Room for rounding in double precision.
ROOM = 1e-9


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 steps, the size of a step, and what they leave of each value."""
    step = np.abs(values).max(1) / 127
    q = np.rint(values / np.where(step > 0, step, 1)[:, None]).astype(np.int8)
    return q, step, values - q * step[:, None]


def _length(values: np.ndarray) -> np.ndarray:
    return np.sqrt((values**2).sum(1))


#: Of a rounded vector: its steps, their sizes, and the lengths of the rounded forms and of the errors, by step.
ROUNDED = "q1 binary, q2 binary, s1 double, s2 double, l1 double, l2 double, e1 double, e2 double"


def rounded(values: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of ROUNDED for vectors other than zero."""
    unit = values / np.abs(values).max(1, keepdims=True)
    unit = unit / _length(unit)[:, None]
    q1, s1, rest = quantised(unit)
    q2, s2, left = quantised(rest)
    return {"q1": q1, "q2": q2, "s1": s1, "s2": s2, "l1": _length(unit - rest), "l2": _length(unit - left), "e1": _length(rest), "e2": _length(left)}


def linked_pairs(v: dict[str, np.ndarray], rows: np.ndarray, columns: np.ndarray, threshold: float):
    """(i, j, sure): pairs of rows and columns whose product may reach the threshold, strip by strip, and whether it must."""
    dim = v["q1"].shape[1]
    wide = v["q1"].astype(np.float32 if dim * 127 * 127 < 1 << 24 else np.float64)  # sums of int8 products below 2**24 are exact
    right = wide[columns]
    for at in range(0, len(rows), STRIP):
        r = rows[at : at + STRIP]
        near = (wide[r] @ right.T).astype(np.float64) * v["s1"][r][:, None] * v["s1"][columns][None, :]
        bound = v["l1"][r][:, None] * v["e1"][columns][None, :] + v["e1"][r][:, None] + ROOM
        i, j = np.nonzero(near + bound >= threshold)
        sure = near[i, j] - bound[i, j] >= threshold
        i, j = r[i], columns[j]
        keep = np.ones(len(i), bool)
        open_ = np.flatnonzero(~sure)
        for k in range(0, len(open_), 1 << 14):
            part = open_[k : k + (1 << 14)]
            x, y = ((v["q1"][at] * v["s1"][at][:, None] + v["q2"][at] * v["s2"][at][:, None]) for at in (i[part], j[part]))
            near = np.einsum("ij,ij->i", x, y)
            bound = v["l2"][i[part]] * v["e2"][j[part]] + v["e2"][i[part]] + ROOM
            keep[part], sure[part] = near + bound >= threshold, near - bound >= threshold
        yield i[keep], j[keep], sure[keep]


def task(ids: np.ndarray, copies: np.ndarray, block: np.ndarray, v: dict[str, np.ndarray], diagonal: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids with links: the number of linked rows, and the smallest id that the links of this task lead to; and pairs (ids) that are open."""
    first = block == block.min()
    rows, columns = (np.arange(len(ids)),) * 2 if diagonal else (np.flatnonzero(first), np.flatnonzero(~first))
    count = np.zeros(len(ids), np.int64)
    a, b, open_ = [], [], []
    for i, j, sure in linked_pairs(v, rows, columns, threshold):
        if diagonal:
            once = i < j  # the bound of a pair depends on its order
            i, j, sure = i[once], j[once], sure[once]
        open_.append(np.stack([ids[i[~sure]], ids[j[~sure]]], 1))
        i, j = i[sure], j[sure]
        np.add.at(count, i, copies[j])
        np.add.at(count, j, copies[i])
        a.append(i)
        b.append(j)
    a, b = np.concatenate([*a, np.zeros(0, np.int64)]), np.concatenate([*b, np.zeros(0, np.int64)])
    order = np.argsort(ids)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    least, a, b = np.arange(len(ids)), rank[a.astype(np.int64)], rank[b.astype(np.int64)]
    while True:
        now = least.copy()
        np.minimum.at(now, a, least[b])
        np.minimum.at(now, b, least[a])
        now = now[now]
        if (now == least).all():
            break
        least = now
    at = np.flatnonzero(count)
    return ids[at], count[at], ids[order][least[rank[at]]], np.concatenate(open_)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    value = F.col("embedding")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size(value) > 0) & finite & F.exists(value, lambda x: x != 0), F.lit(False))
    usable = usable & F.col("vec_id").isNotNull()
    keys = [F.when(usable, F.xxhash64(F.lit(s), F.size(value), value)).alias(k) for s, k in ((1, "a"), (2, "b"))]
    every = materialised(vectors.select("vec_id", "label", *keys))
    full = vectors.filter(usable).select("vec_id", "label", *keys, F.size(value).alias("dim"), value.cast("array<double>").alias("value"))
    # a class is named by its row in this table: one vec_id may stand for several vectors
    classes = materialised(full.groupBy("label", "a", "b", "dim").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"), F.any_value("value").alias("value")).withColumn("rep", F.monotonically_increasing_id()))
    counted = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))

    def narrow(batches):
        for batch in batches:
            column = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            value, dim = column.pop("value"), column["dim"].to_numpy()
            flat, at = value.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(dim)])
            for d in np.unique(dim):
                rows = np.flatnonzero(dim == d)
                v = rounded(np.stack([flat[at[k] : at[k + 1]] for k in rows]))
                pick = pa.array(rows)
                kept = [pa.array([x.tobytes() for x in c], pa.binary()) if c.ndim == 2 else pa.array(c) for c in v.values()]
                yield pa.RecordBatch.from_arrays([*(c.take(pick) for c in column.values()), *kept], [*column, *v])

    kind = vectors.schema["label"].dataType.simpleString()
    dealt = classes.select("label", "dim", "rep", "copies", "value").mapInArrow(narrow, f"label {kind}, dim int, rep long, copies long, {ROUNDED}")
    dealt = with_keys(dealt, counted, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    tiles = dealt.select("*", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks")
    schema = pa.schema([(n, pa.int64()) for n in ("rep", "n", "least", "other")])

    def work(table: pa.Table) -> pa.Table:
        v = {n: table.column(n).to_numpy() for n in ("s1", "s2", "l1", "l2", "e1", "e2")}
        for n in ("q1", "q2"):
            v[n] = np.frombuffer(b"".join(table.column(n).to_pylist()), np.int8).reshape(len(table), -1)
        *linked, open_ = task(*(table.column(n).to_numpy() for n in ("rep", "copies", "block")), v, table.column("i")[0].as_py() == table.column("j")[0].as_py(), threshold)
        sure = pa.table([pa.array(x, pa.int64()) for x in linked] + [pa.nulls(len(linked[0]), pa.int64())], schema=schema)
        rest = pa.nulls(len(open_), pa.int64())
        return pa.concat_tables([sure, pa.table([pa.array(open_[:, 0]), rest, rest, pa.array(open_[:, 1])], schema=schema)])

    answers = materialised(tiles.groupBy("label", "dim", "i", "j").applyInArrow(work, "rep long, n long, least long, other long"))
    sides = [classes.select(F.col("rep").alias(k), F.col("copies").alias(f"n_{k}"), F.col("value").alias(f"v_{k}")) for k in ("rep", "other")]
    open_ = answers.filter("other IS NOT NULL").select("rep", "other").join(sides[0], "rep").join(sides[1], "other")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    cosine = dot("v_rep", "v_other") / F.sqrt(dot("v_rep", "v_rep")) / F.sqrt(dot("v_other", "v_other"))
    pairs = materialised(open_.filter(cosine >= threshold).select("rep", "other", "n_rep", "n_other"))
    found = answers.filter("other IS NULL").select("rep", "n", "least")
    found = found.unionByName(pairs.select("rep", F.col("n_other").alias("n"), F.col("other").alias("least")))
    found = found.unionByName(pairs.select(F.col("other").alias("rep"), F.col("n_rep").alias("n"), F.col("other").alias("least")))
    parts = materialised(components(found.select(F.col("rep").alias("a"), F.col("least").alias("b"))).withColumnRenamed("node", "rep").join(classes.select("rep", "least_id"), "rep"))
    least = parts.groupBy("component").agg(F.min("least_id").alias("least_id"))
    parts = with_keys(parts.select("rep", "component"), least, ["component"]).select("rep", F.col("least_id").alias("component_id"))
    linked = found.groupBy("rep").agg(F.sum("n").alias("n"))
    known = classes.select("label", "a", "b", "rep", "copies", "least_id").join(linked, "rep", "left").join(parts, "rep", "left")
    known = known.select("label", "a", "b", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component_id", "least_id").alias("component"))
    out = every.join(known, ["label", "a", "b"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

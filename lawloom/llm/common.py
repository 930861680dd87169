"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_C = ctypes.CDLL(None)
#: White space of the contracts: blank and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def held_out(doc_id: Column, parts: int, value: int) -> Column:
    """True where the remainder is value; a null id is never held out."""
    return F.coalesce(remainder(doc_id, parts) == value, F.lit(False))


def bounded_sample(rows: DataFrame, label: str, bound: int, seed: int) -> DataFrame:
    """At most `bound` rows of each of the labels 0 and 1, by the order of a hash of doc_id."""
    one = [rows.filter(F.col(label) == v).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(bound) for v in (0, 1)]
    return one[0].unionByName(one[1])


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the session's own where it names one. Only a local session may go without."""
    ctx = spark.sparkContext
    if ctx.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not ctx.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        ctx.setCheckpointDir(named or "/tmp/lawloom-checkpoints")
    return ctx.getCheckpointDir()


def materialised(df: DataFrame) -> DataFrame:
    """The same rows as a table in the shared folder, so that no later step repeats the work or carries its plan."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def give_back() -> None:
    """Return memory that a task no longer uses: workers live on, and what they hold counts for the next task as well."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


def slices(batches, column: str = "text", most: int = 2 << 20):
    """Cut record batches so that a column of texts holds about `most` bytes a slice; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = raw(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
    give_back()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    kind = np.int64 if texts.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    bytes_ = bytes_[offsets[0] : offsets[-1]]
    return bytes_, offsets - offsets[0]


def valid(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """raw(), and the code points of all texts; bytes that are no UTF-8 become U+FFFD."""
    data, offsets = raw(texts)
    try:
        points = data.tobytes().decode()
    except UnicodeDecodeError:
        data = data.tobytes()
        whole = [data[i:j].decode("utf-8", "replace") for i, j in zip(offsets[:-1], offsets[1:])]
        data, offsets = raw(pa.array(whole, pa.large_string()))
        points = "".join(whole)
    return data, offsets, np.frombuffer(points.encode("utf-32-le"), "<u4")


def contractions(begins: np.ndarray, points: np.ndarray, edge: np.ndarray) -> None:
    """Let 's, 't, 'm, 'd, 're, 've and 'll be tokens of their own wherever an apostrophe begins one; edge: a text begins or ends here."""
    n = len(points)
    mark = np.flatnonzero(begins & (points == 39))
    text = np.append(np.cumsum(edge[:n]), -1)  # number of the text of each character

    def after(k: int) -> np.ndarray:
        """The k-th character after the mark in the same text, or 0."""
        at = np.minimum(mark + k, n)
        return np.where(text[at] == text[mark], points[np.minimum(at, n - 1)], 0)

    one, two = after(1), after(2)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = (two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | (one == ord("l")) & (two == ord("l"))
    for which, length in ((mark[short], 2), (mark[long], 3)):
        begins[which + 1] = False
        to = which + length
        begins[to[to < n]] = True


_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        with np.errstate(over="ignore"):
            p = np.full(size, _BASE, np.uint64)
            q = np.full(size, _INVERSE, np.uint64)
            p[0] = q[0] = 1
            _POWERS[size] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _POWERS[size]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, from one running polynomial sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, q = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * p[: len(data)], out=total[1:])
        h = (total[ends] - total[starts]) * q[starts]
        return mixed(h + (ends - starts).astype(np.uint64))


def runs(flags: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags; no run crosses a position of `cuts`."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = flags.copy()
    first[1:] &= ~flags[:-1]
    inner = cuts[(cuts > 0) & (cuts < len(flags))]
    first[inner] = flags[inner]
    last = flags.copy()
    last[:-1] &= ~flags[1:]
    last[inner - 1] = flags[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and the first word of each text (one more entry at the end)."""
    starts, ends = runs(~_SPACES[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def with_keys(rows: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """rows joined to keyed, which has one row for each key.

    keyed is kept in the shared folder first: an aggregate that goes straight into a join ties all rows of a key to one
    task, while adaptive execution splits the rows of a hot key where both sides are plain tables.
    """
    return rows.join(materialised(keyed), keys)


#: Edges that one task joins in the end; more go through another round.
FEW_EDGES = 1 << 16


def joined(edges: DataFrame) -> DataFrame:
    """(u, to): the smallest node of the component of every node of at most FEW_EDGES edges (u, v)."""

    def work(batches):
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u, v = find(u), find(v)
                root[max(u, v)] = min(u, v)
        yield pa.RecordBatch.from_arrays([pa.array(root, pa.int64()), pa.array([find(x) for x in root], pa.int64())], ["u", "to"])

    return edges.select("u", "v").coalesce(1).mapInArrow(work, "u long, to long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b): (node, component) of every node that has an edge; component is its smallest node.

    In each round every node is merged into the first of itself and its neighbours, and the edges between merged nodes are
    those of the next round, so finished components leave at once. The first round goes by the numbers themselves, which
    ends all stars around their smallest node; later ones by a hash of the round, so that long chains shrink by a share as
    well. At most FEW_EDGES of them are joined by one task. Then the merges are followed from the last to the first.
    A round is two exchanges and two tables in the shared folder; a hub with very many neighbours is a hot key of joins
    between plain tables. Nulls and loops are left out; repeated edges count once; no edge gives no row. The edges are
    read twice.
    """
    e, merges = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v"), []
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if merges:
            first = [F.struct(F.xxhash64(F.lit(len(merges)), c).alias("h"), F.col(c).alias("to")) for c in ("u", "v")]
            into = F.least(F.min(first[1]), first[0])["to"]
        else:
            into = F.least(F.min("v"), "u")
        merges.append(materialised(both.groupBy("u").agg(into.alias("to"))))
        ends = [merges[-1].select(F.col("u").alias(c), F.col("to").alias(f"{c}_to")) for c in ("u", "v")]
        e = e.join(ends[0], "u").join(ends[1], "v").filter("u_to <> v_to")
        e = materialised(e.select(F.greatest("u_to", "v_to").alias("u"), F.least("u_to", "v_to").alias("v")).distinct())
        n = e.count()
        if n <= FEW_EDGES:
            break
    rounds = len(merges)
    root = materialised(joined(e)) if n else merges.pop()
    while merges:
        root = merges.pop().join(root.select(F.col("u").alias("to"), F.col("to").alias("root")), "to", "left").select("u", F.coalesce("root", "to").alias("to"))
    root = materialised(root)
    if rounds > 1:  # the first by a hash is not the smallest
        root = with_keys(root, root.groupBy("to").agg(F.min("u").alias("least")), ["to"]).select("u", F.col("least").alias("to"))
    return root.select(F.col("u").alias("node"), F.col("to").alias("component"))

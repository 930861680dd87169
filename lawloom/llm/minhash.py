"""Near-duplicate documents by MinHash bands with sequential Bayesian verification.

1. Every text becomes its set of word shingles (64-bit hashes), HASHES minimum hashes,
   band keys, and a 128-bit fingerprint of the set. Texts with equal sets are one class.
2. Classes that share a band key are joined to the smallest of the key (a star, not
   all pairs); connected components of these stars are the candidate clusters. Most
   of them fit into one block of about BLOCK classes, which is one task.
3. Larger clusters are crowds, and there a band key that several classes share decides
   who meets: first every class meets one hub of one of its keys, then in ROUNDS rounds
   one hub of each key, block by block, and what that connects needs no comparison any
   more. Then only classes outside the largest component of a key meet the others of the
   key, pairs of blocks being the tasks.
4. In a task, pairs that share a band are compared STEP hashes at a time and
   dropped once the posterior probability of a similarity at the threshold falls
   below MISS; the survivors are confirmed on their full sets, best first, unless
   confirmed links have connected them already. So a task sends out a spanning
   forest of its confirmed links and no group of copies is expanded into pairs.
5. Connected components of the confirmed links are the result.

The number of rows in a band is the largest that misses a pair at the threshold with
probability LSH_MISS at most.

Defined results: a text without words, or null, has the empty set and no link; rows
of one doc_id are one document, linked by any of its texts; a null doc_id links with
nothing, has a null component and is kept; an empty table gives an empty result.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, components, give_back, materialised, mixed, raw, slices, span_hashes, with_keys, words

HASHES = 256
LSH_MISS = 1e-4
STEP = 32
MISS = 1e-6
#: Most classes, and about the most shingles, of a block.
BLOCK = 256
SHINGLES = 1 << 20
#: Rounds in which the classes of a crowd meet a hub of each key, after one in which they meet one hub alone.
ROUNDS = 1

_RNG = np.random.default_rng(55)
_A = _RNG.integers(1, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
_M = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def band_rows(percent: int) -> int:
    return max(r for r in range(1, 33) if r == 1 or (1 - (percent / 100) ** r) ** (HASHES // r) <= LSH_MISS)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    low = LOWER[data]
    starts, ends, first = words(low, offsets)
    h = span_hashes(low, starts, ends)
    n = np.diff(first)
    with np.errstate(over="ignore"):
        s = np.zeros(max(0, len(h) - size + 1), np.uint64)
        for k in range(size):
            s += mixed(h[k : len(h) - size + 1 + k] ^ _M[k]) * _M[32 + k % 32] if len(s) else 0
        s = mixed(s)
    out = []
    for i, count in enumerate(n):
        if count >= size:
            out.append(np.unique(s[first[i] : first[i + 1] - size + 1]))
        elif count:
            v = np.uint64(count)
            for x in h[first[i] : first[i + 1]]:
                v = mixed(np.array([v ^ x]))[0]
            out.append(np.array([v], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minimum hashes of each set; zeros for an empty set."""
    sig = np.zeros((len(sets), HASHES), np.uint32)
    rows = [i for i, s in enumerate(sets) if len(s)]
    if rows:
        x = (np.concatenate([sets[i] for i in rows]) >> np.uint64(32)).astype(np.uint32)
        at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in rows])[:-1]])
        v = np.empty_like(x)
        for k in range(HASHES):
            np.multiply(x, _A[k], out=v)
            np.add(v, _B[k], out=v)
            v ^= v >> np.uint32(15)
            sig[rows, k] = np.minimum.reduceat(v, at)
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    bands = HASHES // rows
    part = sig[:, : bands * rows].reshape(len(sig), bands, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.arange(bands, dtype=np.uint64) * _M[0]
        for k in range(rows):
            key = mixed(key ^ part[:, :, k] * _M[1 + k % 31])
    return key


def described(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, the fingerprint a, b of the set, and its band keys."""
    rows = band_rows(percent)

    def work(batches):
        for batch in slices(batches, most=512 << 10):
            sets = shingle_sets(*raw(batch.column(1)), size)
            keys = band_keys(signatures(sets), rows).view(np.int64)
            with np.errstate(over="ignore"):
                prints = [np.array([mixed(s ^ _M[40 + k]).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for k in (0, 1)]
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[0]), pa.array(prints[1]), bands], ["doc_id", "n_shingles", "a", "b", "bands"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_shingles long, a long, b long, bands array<long>")


def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For each number of compared hashes, a multiple of STEP, the fewest matches that leave the pair possible.

    With a uniform prior, the posterior probability of a similarity of at least t after m matches of n
    is the chance of at most m successes in n + 1 draws of chance t.
    """
    t, out = percent / 100, []
    for n in range(STEP, HASHES + 1, STEP):
        chance = 0.0
        for m in range(n + 1):
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                break
        out.append(m)
    return out


def verified(ids: np.ndarray, known: np.ndarray, side: np.ndarray, sets: list[np.ndarray], sig: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the documents of one task, each link confirmed on the full sets.

    known: documents of equal value are connected already; side: if there are two, only documents of different sides are compared.
    """
    keys = band_keys(sig, band_rows(percent))
    size = np.array([len(s) for s in sets])
    a, b = [], []
    fewer, more = sorted((np.flatnonzero(side == x) for x in np.unique(side)), key=len) if len(np.unique(side)) > 1 else (range(len(ids) - 1), None)
    for i in fewer:
        to = slice(i + 1, None) if more is None else more
        hit = (keys[to] == keys[i]).any(1)
        hit &= (ids[to] != ids[i]) & (known[to] != known[i])
        low, high = np.minimum(size[to], size[i]), np.maximum(size[to], size[i])
        hit &= 100 * low >= percent * high
        at = np.flatnonzero(hit) + i + 1 if more is None else more[hit]
        a.append(np.full(len(at), i))
        b.append(at)
    if not a:
        return []
    a, b = np.concatenate(a), np.concatenate(b)
    same = np.zeros(len(a), int)
    for k, least in enumerate(least_matches(percent)):
        part = slice(k * STEP, (k + 1) * STEP)
        for at in range(0, len(a), 1 << 16):
            same[at : at + (1 << 16)] += (sig[a[at : at + (1 << 16)], part] == sig[b[at : at + (1 << 16)], part]).sum(1)
        keep = same >= least
        a, b, same = a[keep], b[keep], same[keep]
    _, group = np.unique(known, return_inverse=True)
    root = list(range(group.max() + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for k in np.argsort(-same, kind="stable"):
        i, j = int(a[k]), int(b[k])
        ri, rj = find(int(group[i])), find(int(group[j]))
        if ri == rj:
            continue
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= percent * (size[i] + size[j] - both):
            root[ri] = rj
            links.append((int(ids[i]), int(ids[j])))
    return links


def sketched(texts: DataFrame, size: int) -> DataFrame:
    """(rep, set, sig) of (rep, text): the shingle set and its minimum hashes, as bytes."""

    def sketch(batches):
        for batch in slices(batches, most=512 << 10):
            sets = shingle_sets(*raw(batch.column(1)), size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in signatures(sets)], pa.binary())], ["rep", "set", "sig"])

    return texts.select("rep", "text").mapInArrow(sketch, "rep long, set binary, sig binary")


def confirmed(tasks: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b): the links of every task; sketches: rep, set and sig of all members."""

    def work(table: pa.Table) -> pa.Table:
        column = {n: table.column(n).to_pylist() for n in table.schema.names}
        sets = [np.frombuffer(x, np.uint64) for x in column["set"]]
        sig = np.frombuffer(b"".join(column["sig"]), np.uint32).reshape(-1, HASHES)
        found = verified(*(np.array(column[n]) for n in ("rep", "known", "side")), sets, sig, percent)
        if len(sets) >= BLOCK // 8:
            del column, sets, sig
            give_back()
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    rows = tasks.join(sketches, "rep").select("of", "i", "j", "rep", "known", "side", "set", "sig")
    return rows.groupBy("of", "i", "j").applyInArrow(work, "a long, b long")


def blocks_of(rows: Column, shingles: Column) -> Column:
    """Into how many blocks so many rows with so many shingles are cut."""
    return F.greatest(F.ceil(rows / BLOCK), F.ceil(shingles / SHINGLES)).cast("long")


def _task(of: Column, i: Column, j: Column, side: Column) -> list[Column]:
    """Columns of a task besides rep and known."""
    zero = F.lit(0).cast("long")
    return [of.alias("of"), (i + zero).alias("i"), (j + zero).alias("j"), "rep", "known", side.cast("int").alias("side")]


def _numbers(n: Column) -> Column:
    """0 to n - 1, one a row; no row for 0."""
    return F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)))


def crowded_links(keys: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of crowds, from (key, rep, weight): the band keys and shingles of their classes.

    In the first round every class meets one hub, the least of the hubs of its keys by a hash, so classes that share many
    keys meet the same one; in each of ROUNDS more it meets the hubs of all its keys, in blocks. What the links connect is
    known from then on, so a group of near copies is one component after a round or two. In the end the classes of a key
    outside its largest component meet all classes of the key that they are not connected with, block by block.
    """
    found = None
    members = keys.withColumn("known", F.col("rep"))
    for turn in range(ROUNDS + 2):
        if found is not None:
            parts = components(found)
            members = keys.join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("known", F.coalesce("component", "rep")).drop("component")
            members = materialised(members)
        if turn <= ROUNDS:
            order = F.xxhash64(F.lit(turn), "rep")
            hubs = members.groupBy("key").agg(F.min_by("rep", order).alias("hub"), F.min_by("known", order).alias("of_hub"))
            pairs = with_keys(members, hubs, ["key"]).filter("known <> of_hub").select("rep", "known", "weight", "hub", "of_hub")
            if turn:
                pairs = pairs.distinct()
            else:
                least = F.min_by(F.struct("hub", "of_hub"), F.struct(F.xxhash64(F.lit(turn), "hub"), "hub"))
                pairs = pairs.groupBy("rep", "known", "weight").agg(least.alias("least")).select("rep", "known", "weight", "least.*")
            pairs = materialised(pairs)
            counted = pairs.groupBy("hub", "of_hub").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
            cut = materialised(counted.select("hub", "of_hub", blocks_of(F.col("n"), F.col("w")).alias("blocks")))
            with_blocks = pairs.drop("of_hub").join(cut.drop("of_hub"), "hub")
            tasks = with_blocks.select(*_task(F.col("hub"), F.pmod(F.xxhash64("rep"), "blocks"), F.lit(0), F.lit(0)))
            centres = cut.select(F.col("hub").alias("rep"), F.col("of_hub").alias("known"), _numbers(F.col("blocks")).alias("block"))
            tasks = tasks.unionByName(centres.select(*_task(F.col("rep"), F.col("block"), F.lit(0), F.lit(0))))
        else:
            by = members.groupBy("key", "known").agg(F.count("*").alias("c"), F.sum("weight").alias("w"))
            main = F.max_by(F.struct("known", "c", "w"), F.struct("c", "known")).alias("main")
            by = by.groupBy("key").agg(main, F.sum("c").alias("n"), F.sum("w").alias("w"), F.count("*").alias("parts")).filter("parts > 1")
            few = blocks_of(F.col("n") - F.col("main.c"), F.col("w") - F.col("main.w"))
            cut = by.select("key", F.col("main.known").alias("main"), few.alias("few"), blocks_of(F.col("main.c"), F.col("main.w")).alias("many"))
            rows = with_keys(members, cut, ["key"])
            own = F.pmod(F.xxhash64("rep"), F.when(F.col("known") == F.col("main"), F.col("many")).otherwise(F.col("few")))
            rows = materialised(rows.withColumn("block", own))
            outside = rows.filter("known <> main")
            other = _numbers(F.col("few")).alias("other")
            among = outside.select("*", other).select(*_task(F.col("key"), F.least("block", "other"), F.greatest("block", "other"), F.col("block") != F.least("block", "other")))
            # block -1 - m is block m of the main component
            left = outside.select("*", _numbers(F.col("many")).alias("m")).select(*_task(F.col("key"), F.col("block"), -1 - F.col("m"), F.lit(0)))
            right = rows.filter("known = main").select("*", other).select(*_task(F.col("key"), F.col("other"), -1 - F.col("block"), F.lit(1)))
            tasks = among.unionByName(left).unionByName(right)
        links = materialised(confirmed(tasks, sketches, percent))
        found = links if found is None else found.unionByName(links)
    return found


def links(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): confirmed links that connect all linked classes; classes: rep, bands and weight (shingles)."""
    keys = classes.select("rep", "weight", F.explode("bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    keys = materialised(with_keys(keys, hubs.drop("n"), ["key"]))  # keys that several classes share
    stars = keys.filter("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    sized = materialised(components(stars).withColumnRenamed("node", "rep").join(classes.groupBy("rep").agg(F.sum("weight").alias("weight")), "rep"))
    crowds = sized.groupBy("component").agg(blocks_of(F.count("*"), F.sum("weight")).alias("blocks")).filter("blocks > 1")
    crowds = materialised(crowds.select("component"))  # few rows
    sketches = materialised(sketched(docs.select(F.col("doc_id").alias("rep"), "text").join(sized.select("rep"), "rep"), size))
    small = sized.join(crowds, "component", "left_anti").withColumn("known", F.col("rep"))
    found = materialised(confirmed(small.select(*_task(F.col("component"), F.lit(0), F.lit(0), F.lit(0))), sketches, percent))
    if not crowds.isEmpty():
        crowd = sized.join(crowds, "component", "left_semi").select("rep")
        found = found.unionByName(crowded_links(materialised(keys.drop("hub").join(crowd, "rep").distinct()), sketches, percent))
    return found


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row: links have 100 * intersection >= percent * union."""
    every = materialised(described(docs, size, percent))
    full = every.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = full.groupBy("a", "b").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"), F.max("n_shingles").alias("weight"))
    classes = materialised(classes)
    copies = full.select("doc_id", "a", "b").join(classes.select("a", "b", "rep"), ["a", "b"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    copies = materialised(copies.filter("a <> b"))
    # one doc_id with several texts is a node of several classes, so copies are edges as well
    parts = components(links(docs, classes, size, percent).unionByName(copies))
    joined = every.join(parts, every["doc_id"] == parts["node"], "left")
    component = F.coalesce("component", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, percent=85)

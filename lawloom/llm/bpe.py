"""Byte-level BPE: texts to ids, as the tiktoken library encodes them, and ids back to bytes.

A text is cut into pre-tokens by one pattern. Two tiers give the ids of a pre-token:

1. a minimal perfect hash over the vocabulary: the pre-token's hash names a bucket,
   the bucket's displacement names the only slot where it can lie, and its bytes there
   decide. Most pre-tokens end here;
2. the others are merged from their bytes: a linked list of parts, and a heap of the
   neighbours that the vocabulary joins, lowest rank first and leftmost among equals.
   A part that changed leaves its old entries behind; they are known by their end.

Work is done by slices of texts; each distinct pre-token of a slice is looked up once.

Defined results: a null text is empty, an empty text has no ids; repeated rows are
encoded one by one; an empty table gives an empty result; bytes that are no UTF-8 become
U+FFFD first. Columns other than doc_id and text are not read, or are carried as they are.
The vocabulary file is a parameter, read by each worker.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import contractions, mixed, raw, slices, span_hashes, valid

#: Fixed value: the pattern of pre-tokens that this module cuts by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Bytes of pre-tokens whose ids a worker remembers; beyond it, it starts anew. Longer ones than LONG are not remembered.
REMEMBERED, LONG = 48 << 20, 256


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def vocabulary(path: str) -> dict[bytes, int]:
    """Bytes and rank of every token of the file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, f)))}


class PerfectHash:
    """A minimal perfect hash: n keys (distinct 64-bit numbers) to the slots 0 to n - 1, one each.

    Buckets of about four keys, largest first, look for a displacement that sends all their keys to free slots;
    what is alone in its bucket takes a free slot, which its displacement names as -1 - slot.
    """

    def __init__(self, keys: np.ndarray):
        n = self.size = len(keys)
        self.buckets = max(1, n // 4)
        self.displacement = np.zeros(self.buckets, np.int64)
        if not n:
            return
        bucket = (keys % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        first = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        free = np.ones(n, bool)
        sizes = np.diff(first)
        for size in range(int(sizes.max()), 1, -1):
            left, d = np.flatnonzero(sizes == size), 0
            own = keys[order[first[left][:, None] + np.arange(size)]]
            while len(left) > 32:
                to = self._slots(own, np.int64(d))
                apart = np.sort(to, 1)
                fits = np.flatnonzero(free[to].all(1) & (apart[:, 1:] != apart[:, :-1]).all(1))
                _, claim, asked = np.unique(to[fits], return_index=True, return_inverse=True)
                won = fits[(claim[asked.reshape(-1, size)] // size == np.arange(len(fits))[:, None]).all(1)]  # the first bucket that asks for a slot has it
                self.displacement[left[won]] = d
                free[to[won]] = False
                left, own, d = np.delete(left, won), np.delete(own, won, 0), d + 1
            for b, group in zip(left, own):  # the last few look on alone
                at, good = 0, ()
                while not len(good):
                    tried = np.arange(at, at + 1024)
                    to = self._slots(group[None, :], tried[:, None])
                    apart = np.sort(to, 1)
                    good = np.flatnonzero(free[to].all(1) & (apart[:, 1:] != apart[:, :-1]).all(1))
                    at += 1024
                self.displacement[b] = tried[good[0]]
                free[to[good[0]]] = False
        alone = np.flatnonzero(sizes == 1)
        self.displacement[alone] = -1 - np.flatnonzero(free)

    def _slots(self, keys: np.ndarray, displacement) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mixed(keys + np.asarray(displacement).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(max(1, self.size))).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot where each key lies, if it is one of the keys at all."""
        d = self.displacement[(keys % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._slots(keys, np.maximum(d, 0)))


@lru_cache(1)
def kinds() -> np.ndarray:
    """SPACE, LETTER, NUMBER or OTHER of every code point, as tiktoken's own splitter has it.

    Letters and numbers that are younger than the interpreter's tables are asked of that splitter.
    """
    import tiktoken

    chars = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    at = np.array([*range(0xD800), *range(0xE000, 0x110000)])
    out = np.full(0x110000, OTHER, np.uint8)
    ranks = {bytes([b]): b for b in range(256)}
    for a in b"a1":
        for b in range(256):
            ranks[bytes([a, b])] = len(ranks)
    probe = tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for kind, pattern, like in ((SPACE, r"\s+", None), (LETTER, r"\p{L}+", "a"), (NUMBER, r"\p{N}+", "1")):
        for m in regex.finditer(pattern, chars):
            run = at[m.start() : m.end()]
            if like:
                run = [c for c in run if unicodedata.category(chr(c)) != "Cn" or len(probe.encode_ordinary(like + chr(c))) == len(chr(c).encode())]
            out[run] = kind
    return out


def pre_tokens(data: np.ndarray, offsets: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Byte positions at which the pre-tokens of all texts (UTF-8, one after the other; points: their characters) begin, and the end."""
    n = len(points)
    if not n:
        return np.zeros(1, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    kind = kinds()[points]
    edge = np.zeros(n + 1, bool)  # a text begins here, or ends before
    edge[np.searchsorted(lead, offsets)] = True
    edge[[0, n]] = True
    begins = edge[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(begins)
    ends = np.append(runs[1:], n)
    spaces = kind[runs] == SPACE
    end = ends[spaces]
    end = end[~edge[end]]  # white space before something in the same text: its last character stands apart,
    begins[end - 1] = True
    begins[end[points[end - 1] == 32]] = False  # or goes with what follows, if it is a blank
    contractions(begins, points, edge)
    return np.append(lead[begins], len(data))


def merged(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging: lowest rank first, leftmost among equals."""
    n = len(token)
    after, before = list(range(1, n + 1)), list(range(-1, n))  # parts by their first byte; a part that is gone ends nowhere
    get, pop, push = ranks.get, heapq.heappop, heapq.heappush
    heap = [r << 64 | i << 32 | i + 2 for i in range(n - 1) if (r := get(token[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        x = pop(heap)
        i, end = x >> 32 & 0xFFFFFFFF, x & 0xFFFFFFFF
        j = after[i]
        if j <= 0 or j >= n or after[j] != end:
            continue
        after[i], after[j] = end, -1
        before[end] = i
        if end < n and (r := get(token[i : after[end]])) is not None:
            push(heap, r << 64 | i << 32 | after[end])
        j = before[i]
        if j >= 0 and (r := get(token[j:end])) is not None:
            push(heap, r << 64 | j << 32 | end)
    out, i = [], 0
    while i < n:
        out.append(ranks[token[i : after[i]]])
        i = after[i]
    return out


class Encoder:
    """Ids of texts, and bytes of ids, by one vocabulary file."""

    def __init__(self, path: str):
        self.ranks = vocabulary(path)
        tokens = list(self.ranks)
        sizes = np.array([len(t) for t in tokens], np.int64)
        ends = np.cumsum(sizes)
        keys = span_hashes(np.frombuffer(b"".join(tokens), np.uint8), ends - sizes, ends)
        self.hash = PerfectHash(keys)
        self.lies = [b""] * len(tokens)  # by slot
        self.id = np.zeros(len(tokens), np.int64)
        for slot, token in zip(self.hash.slots(keys), tokens):
            self.lies[slot], self.id[slot] = token, self.ranks[token]
        most = max(self.ranks.values(), default=-1) + 1
        by_id = [b""] * most
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self.size = np.array([len(t) for t in by_id], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.known: dict[bytes, list[int]] = {}
        self.held = 0

    def _missed(self, token: bytes) -> list[int]:
        ids = self.known.get(token)
        if ids is None:
            ids = merged(token, self.ranks)
            if len(token) <= LONG:
                if self.held > REMEMBERED:
                    self.known.clear()
                    self.held = 0
                self.known[token] = ids
                self.held += len(token) + 64
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (32 bits each), and where each text begins, with the end."""
        data, offsets, points = valid(texts)
        bounds = pre_tokens(data, offsets, points)
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        distinct = cut.dictionary_encode()
        values, token = distinct.dictionary.to_pylist(), distinct.indices.to_numpy()
        edges = np.searchsorted(bounds, offsets)
        if not len(values):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        slot = self.hash.slots(span_hashes(*_spans(distinct.dictionary)))
        lies, size = self.lies, np.ones(len(values), np.int64)
        missed = [k for k, (s, v) in enumerate(zip(slot.tolist(), values)) if lies[s] != v]
        of = [self._missed(values[k]) for k in missed]
        size[missed] = [len(x) for x in of]
        start = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.int64)
        flat[start] = self.id[slot]
        merge = np.zeros(len(values), bool)
        merge[missed] = True
        flat[np.repeat(merge, size)] = np.fromiter(chain.from_iterable(of), np.int64)
        n = size[token]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(start[token] - ends[:-1], n) + np.arange(ends[-1])].astype(np.int32)
        return ids, ends[edges]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Bytes of each list of ids."""
        n = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(n)])
        data = self.bytes[np.repeat(self.at[ids] - ends[:-1], n) + np.arange(ends[-1])]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(ends[offsets]), pa.py_buffer(data)]).cast(pa.binary())


def _spans(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, at = raw(values)
    return data, at[:-1], at[1:]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """The Encoder of this worker, which later tasks use again."""
    return Encoder(path)


def encode(docs: DataFrame, path: str | None = None, text: str = "text", to: str = "ids") -> DataFrame:
    """The rows with the column `text` replaced by `to`, its ids (array of int)."""

    def work(batches):
        own = encoder(path or default_vocabulary())
        for batch in slices(batches, text, 1 << 20):
            at = batch.schema.get_field_index(text)
            ids, offsets = own.encode(batch.column(at))
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([column if k == at else c for k, c in enumerate(batch.columns)], [to if n == text else n for n in batch.schema.names])

    schema = StructType([StructField(to, ArrayType(IntegerType())) if f.name == text else f for f in docs.schema.fields])
    return docs.mapInArrow(work, schema)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with one more column, the bytes of the column `ids`."""

    def work(batches):
        own = encoder(path or default_vocabulary())
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            sizes = np.diff(lists.offsets.to_numpy().astype(np.int64))
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            while at < batch.num_rows:  # slices of about a million ids
                end = min(max(int(np.searchsorted(offsets, offsets[at] + (1 << 20), side="right")) - 1, at + 1), batch.num_rows)
                part = batch.slice(at, end - at)
                own_ids = part.column(batch.schema.get_field_index(ids)).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*part.columns, own.decode(own_ids, offsets[at : end + 1] - offsets[at])], [*part.schema.names, to])
                at = end

    return encoded.mapInArrow(work, StructType([*encoded.schema.fields, StructField(to, BinaryType())]))


def written(ids: Column) -> Column:
    """The decimal numbers of the ids, joined by one blank."""
    return F.array_join(ids.cast("array<string>"), " ")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return decode(encode(docs)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )

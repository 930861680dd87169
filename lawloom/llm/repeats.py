"""Removal of repeated byte strings by run-length indexes over the repetitive part of a corpus.

A string of LENGTH bytes that two documents share contains the same anchors in both:
an anchor is a K-byte string whose hash is the least of the LENGTH - K + 1 strings of
that size in some LENGTH-byte window. So

1. every group of documents sends the hashes of its anchors, once each, packed by hash
   bucket, and whether several of its documents hold them; a bucket answers each group
   which of them occur in several documents of all;
2. around each such anchor the document sends the LENGTH - K bytes on either side to
   the anchor's bucket. Equal contexts are one. The bucket builds the run-compressed
   Burrows-Wheeler transform of its contexts, with a sample at the ends of its runs:
   the smallest document of the run;
3. each context streams through the transform from right to left. Its matching
   statistics follow from backward steps over the runs; where a match reaches LENGTH
   bytes, the samples of its runs give the smallest document that holds them, and if
   that is smaller than the document of the context, the bytes are marked.

Whole copies of a text (equal 128-bit hash) are answered by their first document and
send nothing. A bucket works through SLICES of its anchors one at a time.

Defined results: a null text is empty; a text of fewer than LENGTH bytes loses
nothing; rows of one doc_id are never sources for one another; a null doc_id loses
nothing and is no source; an empty table gives an empty result. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import _BASE, _BYTE, give_back, materialised, mixed, raw, slices, span_hashes, with_keys

LENGTH = 50
K = 24
WINDOW = LENGTH - K + 1
#: Parts of the anchors of a bucket, which are matched one after the other.
SLICES = 64
#: Bytes of text for each group of documents, and for each bucket.
GROUP_BYTES = 8 << 20
_LOW = np.uint64((1 << 40) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all texts."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h1 = _BYTE[data]
        b1 = _BASE
        h2 = h1[:-1] * b1 + h1[1:]
        b2 = b1 * b1
        h4 = h2[:-2] * b2 + h2[2:]
        b4 = b2 * b2
        h8 = h4[:-4] * b4 + h4[4:]
        b8 = b4 * b4
        h16 = h8[:-8] * b8 + h8[8:]
        h = mixed(h16[:-8] * b8 + h8[16:])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    valid = np.arange(n) + LENGTH <= ends  # a window starts here and stays in its text
    least = h
    size = 1
    while size < WINDOW:
        step = min(size, WINDOW - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    least = np.where(valid[: len(least)], least, np.uint64(0))
    most = np.concatenate([np.zeros(WINDOW - 1, np.uint64), least, np.zeros(WINDOW - 1, np.uint64)])
    size = 1
    while size < WINDOW:
        step = min(size, WINDOW - size)
        most = np.maximum(most[:-step], most[step:])
        size += step
    at = np.flatnonzero(most == h)
    return at, h[at]


def code(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 40 more bits of a hash in one number."""
    b = np.uint64(buckets)
    return ((h // b) & _LOW) * b + h % b


class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of many short texts, sorted by LENGTH bytes, with a sample for each run.

    A text ends with a symbol 0 below all bytes. A run is a maximal range of rows with one preceding symbol; it also ends
    where the LENGTH bytes of the rows change, and its sample is the smallest document of its rows, so the samples of the
    runs of one string add up to the smallest document that holds it. Ties of LENGTH bytes stand in any order: a step
    back from the first row of a string of at most LENGTH bytes counts rows that differ within LENGTH bytes only.
    """

    def __init__(self, texts: np.ndarray, starts: np.ndarray, sizes: np.ndarray, docs: np.ndarray):
        n = len(starts)
        self.sizes, self.ends = sizes, np.cumsum(sizes + 1) - 1  # each text has one more place, for its end
        self.symbols = np.zeros(len(texts) + n, np.int64)
        inside = np.ones(len(self.symbols), bool)
        inside[self.ends] = False
        self.symbols[inside] = texts.astype(np.int64) + 1
        self.rows = len(self.symbols)
        left = np.repeat(self.ends, sizes + 1) - np.arange(self.rows)  # bytes up to the end of the text
        order, new = self._sorted(left)
        before = np.where(order > 0, self.symbols[order - 1], 0)
        run = new.copy()
        run[1:] |= before[1:] != before[:-1]
        at = np.flatnonzero(run)
        sample = np.minimum.reduceat(np.repeat(docs, sizes + 1)[order], at)
        self.strings = np.flatnonzero(new)  # first row of each string
        self.smallest = np.minimum.reduceat(sample, np.flatnonzero(new[at]))
        # runs by symbol and row; every symbol begins with an empty run before all rows
        symbol = np.concatenate([np.arange(257), before[at]])
        first = np.concatenate([np.full(257, -1), at])
        length = np.concatenate([np.zeros(257, np.int64), np.diff(np.append(at, self.rows))])
        key = symbol * (self.rows + 2) + first + 1
        by = np.argsort(key)
        self.keys, self.first, self.length = key[by], first[by], length[by]
        self.total = np.cumsum(self.length) - self.length

    def _sorted(self, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the order of their first LENGTH symbols, and whether these differ from the row before."""
        padded = np.concatenate([self.symbols, np.zeros(7, np.int64)])
        word, size = np.zeros(self.rows, np.int64), 7
        for k in range(size):
            word = word << 9 | np.where(left >= k, padded[k : k + self.rows], 0)
        for step in (7, 14, 22):  # of 7, 14 and 28 symbols known, so 14, 28 and LENGTH follow
            values, rank = np.unique(word, return_inverse=True)
            then = np.zeros(self.rows, np.int64)
            on = np.flatnonzero(left >= step)
            then[on] = rank[on + step] + 1
            word = rank * (len(values) + 1) + then
        order = np.argsort(word)
        new = np.ones(self.rows, bool)
        new[1:] = word[order][1:] != word[order][:-1]
        return order, new

    def back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """First row of symbol + string, from the first row of string."""
        run = np.searchsorted(self.keys, symbol * (self.rows + 2) + row + 1, side="right") - 1
        return self.total[run] + np.minimum(row - self.first[run], self.length[run])

    def statistics(self) -> np.ndarray:
        """Smallest document that matches LENGTH bytes at each place of each text: (texts, WINDOW); the least integer beyond the end.

        All texts stream from right to left. A match of LENGTH bytes that is extended gives up its last byte.
        """
        out = np.full((len(self.ends), WINDOW), np.iinfo(np.int64).min)
        row = np.zeros(len(self.ends), np.int64)
        for done in range(1, int(self.sizes.max(initial=0)) + 1):
            on = np.flatnonzero(self.sizes >= done)
            row[on] = self.back(self.symbols[self.ends[on] - done], row[on])
            if done >= LENGTH:
                string = np.searchsorted(self.strings, row[on], side="right") - 1
                row[on] = self.strings[string]
                out[on, self.sizes[on] - done] = self.smallest[string]
        return out


def suffix_index(windows: np.ndarray, starts: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Smallest document that holds the LENGTH bytes at each possible start of each window: (windows, WINDOW).

    windows: the bytes of all windows, one after the other; docs: the smallest document of each window.
    """
    return RunLengthIndex(windows, starts, sizes, docs).statistics()


def _packed(bucket: np.ndarray, doc: np.ndarray, buckets: int):
    """For each bucket that occurs: its number, the rows in it by document, the documents and the rows of each."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        rows = order[edges[b] : edges[b + 1]]
        d = doc[rows]
        first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        yield int(b), rows, d[first], np.diff(np.append(first, len(d))).astype(np.uint32)


def _numbers(keys: np.ndarray) -> np.ndarray:
    """The number of each document in its group: the place of its key among those of the group, whatever the order of the rows."""
    return np.unique(keys, return_inverse=True)[1].astype(np.uint32)


def _sent_hashes(buckets: int):
    """The hashes of the anchors of a group for each bucket, once each, and a bit for those that several documents of the group hold."""
    schema = pa.schema([("group", pa.int64()), ("bucket", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("several", pa.binary())])

    def work(texts: pa.Table, asked: pa.Table) -> pa.Table:
        copies = asked.column("copy").to_numpy()
        held = [np.zeros(0, np.uint64)]
        for batch in slices(texts.select(["doc_id", "text", "key"]).to_batches(), most=512 << 10):
            data, offsets = raw(batch.column(1))
            at, h = anchors(data, offsets)
            doc = np.searchsorted(offsets, at, side="right") - 1
            wanted = ~np.isin(batch.column(2).to_numpy(), copies) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            doc, h = doc[wanted[doc]], h[wanted[doc]]
            order = np.lexsort((h, doc))
            held.append(h[order][_runs_of(doc[order], h[order])[:-1]])
        h, n = np.unique(np.concatenate(held), return_counts=True)
        bucket, v, several = (h % np.uint64(buckets)).astype(np.int64), (h // np.uint64(buckets)) & _LOW, n > 1
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        group, rows = texts.column("group")[0].as_py(), []
        for b in np.flatnonzero(np.diff(edges)):
            at = order[edges[b] : edges[b + 1]]
            rows.append((group, int(b), v[at].astype(np.uint32).tobytes(), (v[at] >> np.uint64(32)).astype(np.uint8).tobytes(), np.packbits(several[at]).tobytes()))
        out = pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, schema)], schema=schema)
        del held, h, n, v, bucket, several, order, rows
        give_back()
        return out

    return work


def _runs_of(*of: np.ndarray) -> np.ndarray:
    """Edges of the runs of equal rows of sorted arrays, both ends included."""
    n = len(of[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n + 1, bool)
    new[[0, n]] = True
    for x in of:
        new[1:n] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _shared(table: pa.Table) -> pa.Table:
    """The anchors of a bucket that several documents hold: their codes, one row for each group that holds any."""
    schema = pa.schema([("group", pa.int64()), ("bucket", pa.int32()), ("low", pa.binary()), ("high", pa.binary())])
    t = {n: table.column(n).to_pylist() for n in ("low", "high", "several")}
    bucket = table.column("bucket")[0].as_py()
    size = [len(x) for x in t["high"]]
    group = np.repeat(table.column("group").to_numpy(), size)
    v = np.frombuffer(b"".join(t["low"]), np.uint32).astype(np.uint64) | np.frombuffer(b"".join(t["high"]), np.uint8).astype(np.uint64) << np.uint64(32)
    several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(t["several"], size)])
    order = np.argsort(v, kind="stable")
    s = v[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    hit = order[same[:-1] | same[1:] | (several[order] == 1)]
    hit = hit[np.argsort(group[hit], kind="stable")]
    group, v, rows = group[hit], v[hit], []
    edges = _runs_of(group)
    for a, b in zip(edges[:-1], edges[1:]):
        rows.append((int(group[a]), bucket, v[a:b].astype(np.uint32).tobytes(), (v[a:b] >> np.uint64(32)).astype(np.uint8).tobytes()))
    out = pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, schema)], schema=schema)
    del t, several, order, s, same, hit, group, v, rows
    give_back()
    return out


def _asked(table: pa.Table) -> tuple[np.ndarray, pa.Table]:
    """Keys of the copies of a group, and its packed rows."""
    return table.column("copy").drop_null().to_numpy(), table.filter(table.column("copy").is_null())


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _sent_contexts(buckets: int):
    schema = pa.schema([("group", pa.int64()), ("bucket", pa.int32()), ("numbers", pa.binary()), ("docs", pa.binary()), ("counts", pa.binary()), ("pos", pa.binary()), ("size", pa.binary()), ("slice", pa.binary()), ("bytes", pa.binary())])

    def packed(group: int, held: list):
        press = zstandard.ZstdCompressor(level=3)
        numbers, ids = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
        base = np.cumsum([0] + [len(x[0]) for x in held])
        doc = np.concatenate([x[2] + b for x, b in zip(held, base)])
        c = np.concatenate([x[3] for x in held])
        pos, size = np.concatenate([x[4] for x in held]), np.concatenate([x[5] for x in held])
        bytes_ = np.concatenate([x[6] for x in held])
        starts = np.cumsum(size) - size
        for b, at, d, n in _packed((c % np.uint64(buckets)).astype(np.int64), doc, buckets):
            own = np.repeat(starts[at] - (np.cumsum(size[at]) - size[at]), size[at]) + np.arange(size[at].sum())
            part = ((c[at] // np.uint64(buckets)) % np.uint64(SLICES)).astype(np.uint8)
            yield group, b, numbers[d].tobytes(), ids[d].tobytes(), n.tobytes(), pos[at].astype(np.uint32).tobytes(), size[at].astype(np.uint8).tobytes(), part.tobytes(), press.compress(bytes_[own].tobytes())

    def work(texts: pa.Table, asked: pa.Table) -> pa.Table:
        copies, told = _asked(asked)
        bucket = np.repeat(told.column("bucket").to_numpy().astype(np.uint64), [len(x) for x in told.column("high").to_pylist()])
        codes = np.sort((_joined(told, "low", np.uint32).astype(np.uint64) | _joined(told, "high", np.uint8).astype(np.uint64) << np.uint64(32)) * np.uint64(buckets) + bucket)
        numbers, at_row = _numbers(texts.column("key").to_numpy()), 0
        held = []
        for batch in slices(texts.select(["doc_id", "text", "key"]).to_batches(), most=512 << 10):
            own, at_row = numbers[at_row : at_row + batch.num_rows], at_row + batch.num_rows
            if not len(codes):
                continue
            wanted = ~np.isin(batch.column(2).to_numpy(), copies) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            data, offsets = raw(batch.column(1))
            at, h = anchors(data, offsets)
            doc = np.searchsorted(offsets, at, side="right") - 1
            c = code(h, buckets)
            keep = wanted[doc] & (codes[np.minimum(np.searchsorted(codes, c), len(codes) - 1)] == c)
            at, doc, c = at[keep], doc[keep], c[keep]
            start = np.maximum(at - (LENGTH - K), offsets[doc])
            end = np.minimum(at + LENGTH, offsets[doc + 1])
            size = end - start
            where = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
            held.append((own, batch.column(0).fill_null(0).to_numpy(), doc, c, start - offsets[doc], size, data[where]))
        rows = list(packed(texts.column("group")[0].as_py(), held)) if held else []
        out = pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 9, schema)], schema=schema)
        del held, rows, codes, numbers, bucket, told
        give_back()
        return out

    return work


def _marks(table: pa.Table) -> pa.Table:
    """Numbers and packed (position, bits of the matched starts from there) of the documents of a bucket, one row for each group."""
    t = {n: table.column(n).to_pylist() for n in table.schema.names if n not in ("bytes", "group", "bucket")}
    packed = table.column("bytes")
    join = lambda name, kind: np.frombuffer(b"".join(t[name]), kind)
    counts = join("counts", np.uint32)
    own_number, doc = np.repeat(join("numbers", np.uint32), counts), np.repeat(join("docs", np.int64), counts)
    pos, size, part = join("pos", np.uint32), join("size", np.uint8).astype(np.int64), join("slice", np.uint8)
    base = np.cumsum([0] + [len(x) for x in t["size"]])
    unpress = zstandard.ZstdDecompressor()

    def contexts(k: int):
        """Bytes of the contexts of a packed row, and where each begins."""
        n = size[base[k] : base[k + 1]]
        return np.frombuffer(unpress.decompress(packed[k].as_py()), np.uint8), np.cumsum(n) - n, n

    h = np.zeros(len(size), np.uint64)
    for k in range(len(packed)):
        bytes_, begin, n = contexts(k)
        for a in range(0, len(n), 8192):
            b, c = begin[a : a + 8192], n[a : a + 8192]
            h[base[k] + a : base[k] + a + len(b)] = span_hashes(bytes_[b[0] : b[-1] + c[-1]], b - b[0], b - b[0] + c)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, doc)
    chosen = np.sort(first)  # equal contexts are one, and only one of them is held as bytes
    held = []
    for k in range(len(packed)):
        own = chosen[np.searchsorted(chosen, base[k]) : np.searchsorted(chosen, base[k + 1])] - base[k]
        if len(own):
            bytes_, begin, n = contexts(k)
            held.append(bytes_[np.repeat(begin[own] - (np.cumsum(n[own]) - n[own]), n[own]) + np.arange(n[own].sum())])
    text = np.concatenate(held) if held else np.zeros(0, np.uint8)
    begin = np.zeros(len(size), np.int64)
    begin[chosen] = np.cumsum(size[chosen]) - size[chosen]
    found = []
    for s in range(SLICES):
        distinct = np.flatnonzero(part[first] == s)
        if not len(distinct):
            continue
        n, at = size[first[distinct]], begin[first[distinct]]
        own = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
        smallest = suffix_index(text[own], np.cumsum(n) - n, n, least[distinct])
        number = np.full(len(first), -1)
        number[distinct] = np.arange(len(distinct))
        mine = np.flatnonzero(part == s)
        for a in range(0, len(mine), 1 << 16):
            rows = mine[a : a + (1 << 16)]
            i = number[inverse[rows]]
            known = np.arange(WINDOW)[None, :] <= (n[i] - LENGTH)[:, None]
            hit = known & (smallest[i] < doc[rows][:, None])
            bits = (hit.astype(np.uint32) << np.arange(WINDOW, dtype=np.uint32)[None, :]).sum(1, dtype=np.uint32)
            on = np.flatnonzero(bits)
            found.append((rows[on], bits[on]))
    rows = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    bits = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.uint32)
    group = table.column("group").to_numpy()[np.searchsorted(base, rows, side="right") - 1]
    order = np.lexsort((own_number[rows], group))
    group, own_number, marks = group[order], own_number[rows][order], np.stack([pos[rows], bits], 1)[order]
    schema = pa.schema([("group", pa.int64()), ("numbers", pa.binary()), ("counts", pa.binary()), ("marks", pa.binary())])
    out, edges = [], _runs_of(group)
    for a, b in zip(edges[:-1], edges[1:]):
        runs = _runs_of(own_number[a:b])
        out.append((int(group[a]), own_number[a:b][runs[:-1]].tobytes(), np.diff(runs).astype(np.uint32).tobytes(), marks[a:b].tobytes()))
    give_back()
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, schema)], schema=schema)


def spans(size: int, marks: np.ndarray, copy: bool) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes."""
    if size < LENGTH:
        return []
    if copy:
        return [(0, size)]
    if not len(marks):
        return []
    m = marks
    bit = (m[:, 1:] >> np.arange(WINDOW, dtype=np.uint32)[None, :]) & 1
    row, shift = np.nonzero(bit)
    at = np.unique(m[row, 0].astype(np.int64) + shift)
    new = np.flatnonzero(np.concatenate([[True], at[1:] > at[:-1] + LENGTH]))
    return list(zip(at[new].tolist(), (at[np.append(new[1:], len(at)) - 1] + LENGTH).tolist()))


def _piece(piece: bytes, after_cut: bool, before_cut: bool) -> bytes:
    """The piece without the bytes of characters that a cut at its ends has broken."""
    if after_cut:
        first = 0
        while first < min(3, len(piece)) and piece[first] & 0xC0 == 0x80:
            first += 1
        piece = piece[first:]
    if before_cut:
        for back in range(1, min(3, len(piece)) + 1):
            lead = piece[-back]
            if lead & 0xC0 != 0x80:
                if lead >= 0xC0 and back < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                    piece = piece[:-back]
                break
    return piece


def _cut(whole: bool):
    def work(texts: pa.Table, marked: pa.Table) -> pa.Table:
        """doc_id, n_bytes, removed, kept and __carried of the documents of a group."""
        copies, told = _asked(marked)
        key = np.repeat(_joined(told, "numbers", np.uint32), _joined(told, "counts", np.uint32))
        order = np.argsort(key, kind="stable")
        key, marks = key[order], _joined(told, "marks", np.uint32).reshape(-1, 2)[order]
        numbers, at_row = _numbers(texts.column("key").to_numpy()), 0
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", kind), ("kept", pa.binary()), ("__carried", texts.schema.field("__carried").type)])
        out = []
        for batch in slices(texts.select(["doc_id", "text", "key", "__carried"]).to_batches(), most=4 << 20):
            data, offsets = raw(batch.column(1))
            own, at_row = numbers[at_row : at_row + batch.num_rows], at_row + batch.num_rows
            data, copy = data.tobytes(), np.isin(batch.column(2).to_numpy(), copies)
            first, last = np.searchsorted(key, own, side="left"), np.searchsorted(key, own, side="right")
            kept, removed = [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]]
                cut = spans(len(text), marks[first[i] : last[i]], bool(copy[i]))
                ends = [0, *(b for _, b in cut)]
                pieces = [text[a:b] for a, b in zip(ends, [*(a for a, _ in cut), len(text)])]
                if whole and cut:
                    pieces = [_piece(x, k > 0, k < len(cut)) for k, x in enumerate(pieces)]
                kept.append(b"".join(pieces))
                removed.append([{"start": a, "end": b} for a, b in cut])
            out.append(pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, kind), pa.array(kept, pa.binary()), batch.column(3)], schema=schema))
        return pa.Table.from_batches(out, schema)

    return work


def without_repeats(docs: DataFrame, carry: list[str] | None = None, whole: bool = False) -> DataFrame:
    """doc_id, n_bytes, removed (start, end) and kept bytes of every row, and the columns named in carry.

    Documents are dealt into groups by a hash, and anchors into buckets, as many as GROUP_BYTES of text each ask for;
    what a bucket answers is one packed row for each group, so answers grow with the shared anchors and never with
    their pairs. A task holds one group or bucket at a time.

    whole: kept loses the bytes of characters that a cut has broken as well; removed stays. It is done where the cuts are
    made, since a step of its own asks for a second Python worker beside that of each task.
    """
    carry = carry or []
    text_keys = [F.xxhash64("doc_id", "text").alias("key"), F.xxhash64(F.lit(7), "doc_id", "text").alias("deal"), *(F.xxhash64(F.lit(k), "text").alias(f"c{k}") for k in (1, 2))]
    prints = materialised(docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", *text_keys, F.octet_length("text").alias("bytes")))
    held = prints.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    buckets = groups = held // GROUP_BYTES + 1
    group = F.pmod("deal", F.lit(groups).cast("long")).alias("group")
    unused = "_" * (1 + max((len(c) for c in carry), default=0))  # longer than any name that is carried
    carried = F.struct(F.lit(0).alias(unused), *carry).alias("__carried")  # names of their own cannot clash
    rows = docs.select("doc_id", "text", carried, *text_keys[:2]).withColumn("group", group)
    firsts = prints.groupBy("c1", "c2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    copies = with_keys(prints.select("doc_id", "key", group, "c1", "c2"), firsts, ["c1", "c2"])
    copies = materialised(copies.filter("doc_id > first").select("group", F.col("key").alias("copy")).distinct())
    dealt = rows.repartition(groups, "group").groupBy("group")

    def by_group(packed: DataFrame) -> DataFrame:
        return packed.repartition(groups, "group").groupBy("group")

    def with_copies(packed: DataFrame) -> DataFrame:
        return by_group(packed.unionByName(copies, allowMissingColumns=True))

    sent = dealt.cogroup(by_group(copies)).applyInArrow(_sent_hashes(buckets), "group long, bucket int, low binary, high binary, several binary")
    shared = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_shared, "group long, bucket int, low binary, high binary")
    contexts = dealt.cogroup(with_copies(shared)).applyInArrow(_sent_contexts(buckets), "group long, bucket int, numbers binary, docs binary, counts binary, pos binary, size binary, slice binary, bytes binary")
    matched = contexts.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_marks, "group long, numbers binary, counts binary, marks binary")
    kind = StructType.fromDDL("doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
    out = dealt.cogroup(with_copies(matched)).applyInArrow(_cut(whole), StructType([*kind.fields, rows.schema["__carried"]]))
    return out.select("doc_id", "n_bytes", "removed", "kept", *(F.col("__carried")[c].alias(c) for c in carry))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

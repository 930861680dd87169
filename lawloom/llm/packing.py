"""Packing token sequences along a space-filling curve.

Each document becomes token ids and an end id. Its hashed term-frequency vector
(unit length, AXES fixed random projections) is quantised and mapped to its place
on a Hilbert curve. Documents are range-partitioned and sorted by that place, and
each partition writes its documents one after the other into sequences of LENGTH
ids, cutting where a sequence is full. What is left at the end of a partition goes
into sequences of a power of two each, so nothing is padded at all.

Documents with equal places (copies) are told apart by doc_id and a hash of the
text, so no group of copies has to stay in one partition.

Defined results: a null or empty text is the end id alone; repeated rows are packed
one by one; an empty table gives an empty result. Columns other than doc_id and
text are not read. The tokenizer file is a parameter and is read by each task.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import contractions, give_back, scratch, slices, valid

LENGTH = 4096
END = 2
AXES = 4
BITS = 10
DIMENSIONS = 1024
#: Pieces whose ids a worker remembers; beyond it, it starts anew.
REMEMBERED = 400_000


#: Words of these characters only are composed already and lower-cased one by one, so their pieces are those of the tokenizer.
_PLAIN = regex.compile(r"[\x21-\x7e\u00a1-\u012f\u0131-\u017e]")
#: The rules of the tokenizer file for which words and pieces stand for themselves.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": PIECES}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
SPACE, LETTER, NUMBER, OTHER, ODD = range(5)


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """What each plain character is, and its lower-case form; all others are ODD, but for the blanks that end a word."""
    kind, lower = np.full(0x181, ODD, np.uint8), np.arange(0x181, dtype=np.uint32)
    for c in range(0x180):
        if _PLAIN.match(chr(c)):
            kind[c] = LETTER if regex.match(r"\p{L}", chr(c)) else NUMBER if regex.match(r"\p{N}", chr(c)) else OTHER
            lower[c] = ord(chr(c).lower())
    kind[[32, 9, 10, 13]] = SPACE  # the tokenizer sees any other white space itself
    return kind, lower


_KIND, _LOWER = _kinds()


def _byte_letters() -> dict[int, int]:
    """The character by which byte-level vocabularies write each byte: printable ones stand for themselves, others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class Words:
    """Ids of texts as little-endian unsigned numbers of 16 bits, or 32 where the vocabulary asks for it, by way of their distinct pieces.

    A tokenizer whose file has other rules than those of NORMALIZER and PIECES encodes whole texts itself. The tokenizer
    never joins ids over white space, nor over the pieces into which it cuts a word, so these stand for themselves and
    their ids can be remembered. A piece goes to the tokenizer's model at once; words with characters that are not plain,
    or with what may be a special token, are not cut but go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # only what is compared: the whole file as objects is many times its vocabulary
        rules = [None if part is None else json.loads(part.__getstate__()) for part in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.by_words = rules == [NORMALIZER, PRE_TOKENIZER]
        self.known: dict[bytes, bytes] = {}

    def _ids(self, piece: bytes, whole: bool) -> bytes:
        if whole:
            ids = np.array(self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids, self.kind).tobytes()
        else:
            letters = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(_BYTE_LETTERS)
            ids = b"".join([t.id.to_bytes(self.width, "little") for t in self.tokenizer.model.tokenize(letters)])
        if len(piece) <= 64:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; nulls are empty."""
        if not self.by_words:
            whole = self.tokenizer.encode_batch([x or "" for x in texts.to_pylist()], add_special_tokens=False)
            return [np.array(x.ids, self.kind).tobytes() for x in whole]
        data, offsets, points = valid(texts)
        n = len(points)
        if not n:
            return [b""] * len(texts)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        small = np.minimum(points, 0x180)
        kind = _KIND[small]
        edge = np.zeros(n + 1, bool)  # a text begins here, or ends before
        edge[np.searchsorted(lead, offsets)] = True
        begins = edge[:n].copy()
        begins[1:] |= kind[1:] != kind[:-1]
        begins |= kind == NUMBER
        new_word = (kind == SPACE) != np.concatenate([[True], kind[:-1] == SPACE])
        new_word |= edge[:n]
        odd = kind == ODD
        odd[:-1] |= (points[:-1] == ord("<")) & (points[1:] == ord("|"))
        word = np.cumsum(new_word) - 1
        odd = (np.bincount(word[odd], minlength=word[-1] + 1) > 0)[word] & (kind != SPACE)
        lowered = np.where(odd, points, np.where(points < 0x180, _LOWER[small], points)).astype("<u4")
        contractions(begins, lowered, edge)
        begins = np.where(odd, new_word, begins)
        begins |= new_word
        cut = np.flatnonzero(begins)
        bounds = np.append(lead[cut], len(data))
        text = lowered.tobytes().decode("utf-32-le").encode()
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(bounds), pa.py_buffer(text)]).dictionary_encode()
        values, piece = pieces.dictionary.to_pylist(), pieces.indices.to_numpy()
        what = np.zeros(len(values), np.uint8)
        what[piece] = np.where(kind[cut] == SPACE, 2, odd[cut])
        known = self.known.get
        of = [b"" if w == 2 else ids if (ids := known(v)) is not None else self._ids(v, w == 1) for v, w in zip(values, what.tolist())]
        size = np.fromiter(map(len, of), np.int64, len(of)) // self.width
        start = np.cumsum(size) - size
        many = size[piece]
        ends = np.concatenate([[0], np.cumsum(many)])
        out = np.frombuffer(b"".join(of), self.kind)[np.repeat(start[piece] - ends[:-1], many) + np.arange(ends[-1])]
        edges = ends[np.searchsorted(bounds, offsets)]
        return [out[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:])]


@lru_cache(1)
def remembering(path: str) -> Words:
    """The Words of this worker, which later tasks use again."""
    return Words(path)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (rows of unsigned coordinates below 2**bits) on the Hilbert curve, by Skilling's transform."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def places(ids: list[bytes], kind: str = "<u2") -> np.ndarray:
    """Hilbert place of each document from its ids, numbers of that kind."""
    axes = np.random.default_rng(44).normal(size=(DIMENSIONS, AXES))
    unit = np.zeros((len(ids), AXES))
    for at in range(0, len(ids), 256):  # so many documents have their vectors at a time
        tf = np.zeros((len(ids[at : at + 256]), DIMENSIONS))
        for row, data in zip(tf, ids[at : at + 256]):
            row += np.bincount(np.frombuffer(data, kind) % DIMENSIONS, minlength=DIMENSIONS)
        tf /= np.maximum(np.sqrt((tf * tf).sum(1, keepdims=True)), 1e-12)
        unit[at : at + 256] = (np.clip(tf @ axes, -4, 4) + 4) / 8
    return hilbert(np.minimum(unit * (1 << BITS), (1 << BITS) - 1), BITS)


def tokenised(docs: DataFrame, tokenizer: str | None, end: int = END) -> DataFrame:
    """doc_id, content, place, tokens and compressed ids of every row."""

    def work(batches):
        words, press = remembering(tokenizer or default_tokenizer()), zstandard.ZstdCompressor(level=1)
        last = np.array([end], words.kind).tobytes()
        for batch in slices(batches, most=512 << 10):  # pieces take about 100 times the bytes of their text
            ids = [x + last for x in words.ids(batch.column(1))]
            out = [batch.column(0), batch.column(2), pa.array(places(ids, words.kind)), pa.array([len(x) // words.width for x in ids], pa.int64()), pa.array([press.compress(x) for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "content", "place", "doc_tokens", "packed"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("content")).mapInArrow(work, "doc_id long, content long, place long, doc_tokens long, packed binary")


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian, 32 bits each), doc_tokens, sequence_id, offset.

    tokenizer: a file that every task can read; None: default_tokenizer(), which each task looks up where it runs.
    """
    spark = docs.sparkSession
    path = scratch(spark, "packing")
    tokenised(docs, tokenizer, end).write.option("compression", "none").parquet(path)
    order = ["place", "doc_id", "content"]
    dealt = spark.read.parquet(path).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches):
        unpress = zstandard.ZstdDecompressor()
        sequence, rows, size = TaskContext.get().partitionId() << 36, [], 0
        held: list = []  # pieces of the sequence that is being filled
        filled = 0

        def batch(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64()) for c, n in zip(columns, names)], names)

        def whole(pieces: list, room: list[int]):
            """Deal pieces into sequences of the sizes in room, which add up to their length."""
            nonlocal sequence
            room, at = iter(room), 0
            left = next(room)
            for doc_id, start, ids, total in pieces:
                while len(ids):
                    part = ids[:left]
                    yield doc_id, start, len(part), part.tobytes(), total, sequence, at
                    start, ids, at, left = start + len(part), ids[len(part) :], at + len(part), left - len(part)
                    if not left:
                        sequence, at, left = sequence + 1, 0, next(room, 0)

        for record in (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256)):
            for doc_id, total, packed in zip(*(record.column(record.schema.get_field_index(n)).to_pylist() for n in ("doc_id", "doc_tokens", "packed"))):
                data = unpress.decompress(packed)
                ids = np.frombuffer(data, f"<u{len(data) // total}").astype("<u4")
                held.append((doc_id, 0, ids, total))
                filled += len(ids)
                if filled >= length:
                    full, over = divmod(filled, length)
                    if over:
                        last = held[-1]
                        cut = len(last[2]) - over
                        held[-1] = (last[0], last[1], last[2][:cut], last[3])
                        rest = [(last[0], last[1] + cut, last[2][cut:], last[3])]
                    else:
                        rest = []
                    rows += whole(held, [length] * full)
                    size += 4 * full * length
                    held, filled = rest, over
                    if size >= 1 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        if filled:
            rows += whole(held, [1 << b for b in range(filled.bit_length() - 1, -1, -1) if filled >> b & 1])
        if rows:
            yield batch(rows)
        give_back()

    return dealt.select("doc_id", "doc_tokens", "packed").mapInArrow(work, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))

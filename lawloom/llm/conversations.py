"""Repair of conversations whose turns are blank, repeated, cut off or out of order.

Each turn of a conversation, in its order, is a symbol: what its role begins with and what
is wrong with it. The symbols make the conversation's signature. The cheapest edits that
give a good order of roles, `(s?(ua)+)?`, depend on the signature alone, so

1. rows are dealt by ranges of (conversation, turn) and each task writes the signature of
   what it holds of each conversation; the pieces, one byte a row, meet by conversation;
2. signatures are range-sorted and walked as a prefix trie: the walk keeps the layers of the
   dynamic programme on the path from the root, goes back to what a signature shares with
   the one before, and computes layers for the rest alone; at a terminal node the edits
   are read back. Conversations of one signature lie side by side and share the answer;
3. the edits meet the rows again and give the repaired turns.

A layer holds, for each state of the roles written so far (none, s, u, a), the least cost and
the place of its edits in the order of all four. All of them have read the same rows and end
with a row's edit, so none is the beginning of another and their order is that of what
follows as well: the least cost with the ASCII-least edits needs no more than that.

Defined results: nulls of role and text are one blank; rows of one turn come in the order of
role and text (bytes); null turns come first; a null conv_id is a conversation of its own;
repeated rows are duplicates; an empty table gives an empty result; gaps beyond 64 bits stay
at 2**63 - 1. Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialised

WORD = r"[^\x20\x09-\x0D]"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States of the roles written so far, and the roles that may follow each.
NONE, SYSTEM, USER, ASSISTANT = range(4)
FOLLOW = {NONE: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
GOOD = (NONE, ASSISTANT)
#: Symbols: a row that has to go; else the role's initial (x: any other), in capitals where the text is truncated.
GONE = "-"
#: So many characters of a string deal rows to tasks; what agrees in them stays together.
KEY = 64


def _inserts() -> dict[int, list[tuple[int, int]]]:
    """From each state: (inserted turns, state after them), for as many as can be of use."""
    out = {}
    for state in range(4):
        seen, at, n = {state: 0}, state, 0
        while len(nxt := [to for role, to in FOLLOW[at].items() if role != "s"]) and nxt[0] not in seen:
            at, n = nxt[0], n + 1
            seen[at] = n
        out[state] = [(n, to) for to, n in seen.items()]
    return out


INSERTS = _inserts()
#: A layer: (cost, place) of each state; None where no edits lead to it.
Layer = tuple
ROOT: Layer = ((0, 0), None, None, None)


def _row_edits(symbol: str, state: int):
    """(edit, cost, state after it) of a row in a state."""
    yield "D", DELETE, state
    if symbol != GONE:
        more = TRUNCATED if symbol.isupper() else 0
        for role, to in FOLLOW[state].items():
            if role == symbol.lower():
                yield "K", more, to
            elif role != "s":
                yield "R", REROLE + more, to


@lru_cache(1 << 14)
def _step(layer: Layer, symbol: str) -> tuple[int, Layer, tuple]:
    """Least cost of the next layer, the layer relative to it, and (state before, edits) of each of its states."""
    found: list = [None] * 4
    for state, known in enumerate(layer):
        if known:
            for n, ready in INSERTS[state]:
                for edit, cost, to in _row_edits(symbol, ready):
                    way = (known[0] + n * INSERT + cost, known[1], "I" * n + edit, state)
                    if found[to] is None or way < found[to]:
                        found[to] = way
    least = min(w[0] for w in found if w)
    places = {w[1:3]: k for k, w in enumerate(sorted((w for w in found if w), key=lambda w: w[1:3]))}
    return least, tuple(w and (w[0] - least, places[w[1:3]]) for w in found), tuple(w and (w[3], w[2]) for w in found)


class Trie:
    """The path from the root to the last signature: a layer for each of its symbols."""

    def __init__(self):
        self.signature, self.computed = "", 0
        self.costs, self.layers, self.ways = [0], [ROOT], [()]
        self.answer = self._read()

    def visit(self, signature: str) -> tuple[int, str]:
        """Least cost and edits of a signature; layers of what it shares with the last one stay."""
        if signature != self.signature:
            shared = _shared(signature, self.signature)
            for kept in (self.costs, self.layers, self.ways):
                del kept[shared + 1 :]
            for symbol in signature[shared:]:
                more, layer, ways = _step(self.layers[-1], symbol)
                self.costs.append(self.costs[-1] + more)
                self.layers.append(layer)
                self.ways.append(ways)
            self.computed += len(signature) - shared
            self.signature = signature
            self.answer = self._read()
        return self.answer

    def _read(self) -> tuple[int, str]:
        ends = [(known[0] + n * INSERT, known[1], "I" * n, state) for state, known in enumerate(self.layers[-1]) if known for n, to in INSERTS[state] if to in GOOD]
        cost, _, last, state = min(ends)
        edits = [last]
        for ways in reversed(self.ways[1:]):
            state, edit = ways[state]
            edits.append(edit)
        return self.costs[-1] + cost, "".join(reversed(edits))


def _shared(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) after the damage that crc32 of `conv_id:turn` names; n equal rows side by side."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"))


def _symbol(again: Column) -> Column:
    """The symbol of the first of equal rows; again: role and text were seen in an earlier turn."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    cut = F.col("text").rlike(r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z")
    return F.when(~F.col("text").rlike(WORD) | again, GONE).when(cut, F.upper(role)).otherwise(role)


def turns(rows: DataFrame) -> DataFrame:
    """The distinct rows of damaged conversations with their number n, symbol and whether they are blank, kept as a table."""
    same = ["conv_id", "turn", "role", "text"]
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = materialised(rows.groupBy(same).agg(F.sum("n").alias("n")).withColumn("digest", digest))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = materialised(rows.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(at).alias("first")))
    met = rows.join(first, rows.conv_id.eqNullSafe(first.c) & (rows.digest == first.d))
    return materialised(met.select(*same, "n", _symbol(~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("symbol"), (~F.col("text").rlike(WORD)).alias("blank")))


_ORDER = ["conv_id", "turn", "role", "text"]
_PIECE = "conv_id long, at long, signature string, first string, last string, illegal long, blank long, duplicate long, truncated long, turns long, low long, high long"


def _pieces(batches):
    """What a task holds of each conversation, from sorted rows: its symbols, the initials of its first and last role, counts."""
    names = [x.split()[0] for x in _PIECE.split(", ")]
    part, held = TaskContext.get().partitionId(), None

    def told(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("signature", "first", "last") else pa.int64()) for n, c in zip(names, zip(*rows))], names)

    def done(h):
        return (h["conv"], part, "".join(h["signature"]), *(h[n] for n in names[3:]))

    out = []
    for batch in batches:
        for conv, turn, initial, n, symbol, blank in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held["conv"] != conv:
                if held:
                    out.append(done(held))
                held = dict(conv=conv, signature=[], first=initial, last=None, illegal=0, blank=0, duplicate=0, truncated=0, turns=0, low=None, high=None)
            h = held
            h["illegal"] += n - 1 + (h["last"] is not None and h["last"] + initial not in ("su", "ua", "au"))
            h["last"] = initial
            h["signature"].append(symbol + GONE * (n - 1))
            h["blank"] += n if blank else 0
            h["duplicate"] += 0 if blank else n - (symbol != GONE)
            h["truncated"] += symbol.isupper()
            if turn is not None and turn != h["high"]:
                h["turns"] += 1
                h["low"] = turn if h["low"] is None else h["low"]
                h["high"] = turn
        if len(out) > 10_000:
            yield told(out)
            out = []
    if held:
        out.append(done(held))
    if out:
        yield told(out)


def signatures(rows: DataFrame) -> DataFrame:
    """One row for each conversation of turns(): its signature and counts."""
    beginnings = [F.substring(c, 1, KEY) for c in ("role", "text")]
    dealt = rows.repartitionByRange("conv_id", "turn", *beginnings).sortWithinPartitions(*_ORDER)
    pieces = dealt.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "n", "symbol", "blank").mapInArrow(_pieces, _PIECE)
    piece = F.struct("at", "signature", "first", "last", "turns", "low", "high")
    sums = [F.sum(c).alias(c) for c in ("illegal", "blank", "duplicate", "truncated")]
    met = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), *sums)

    def joined(batches):
        names = ["conv_id", "signature", "illegal", "blank", "duplicate", "truncated", "gaps"]
        for batch in batches:
            out = []
            for conv, parts, illegal, *counts in zip(*(c.to_pylist() for c in batch.columns)):
                illegal += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(parts, parts[1:]))
                known = [p for p in parts if p["low"] is not None]
                distinct = sum(p["turns"] for p in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
                gaps = min(known[-1]["high"] - known[0]["low"] + 1 - distinct, 2**63 - 1) if known else 0
                out.append((conv, "".join(p["signature"] for p in parts), illegal, *counts, gaps))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "signature" else pa.int64()) for n, c in zip(names, zip(*out))], names)

    return met.select("conv_id", "pieces", "illegal", "blank", "duplicate", "truncated").mapInArrow(joined, "conv_id long, signature string, illegal long, blank long, duplicate long, truncated long, gaps long")


def edits(signed: DataFrame) -> DataFrame:
    """The rows of signatures() with cost and audit, the initials of the cheapest edits in their order."""

    def work(batches):
        trie = Trie()
        for batch in batches:
            cost, audit = zip(*map(trie.visit, batch.column(batch.schema.get_field_index("signature")).to_pylist())) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cost, pa.int64()), pa.array(audit, pa.string())], [*batch.schema.names, "cost", "audit"])

    dealt = signed.repartitionByRange(F.substring("signature", 1, KEY), "conv_id").sortWithinPartitions("signature", "conv_id")
    return dealt.mapInArrow(work, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in signed.schema.fields)}, cost long, audit string")


def _mend(batches):
    """Repaired turns from rows sorted by conversation, each conversation's edits before its rows."""
    names = ["conv_id", "position", "edit", "role", "text"]

    def told(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n in ("conv_id", "position") else pa.string()) for n, c in zip(names, zip(*rows))], names)

    audit, at, rest, written, last, out, size = "", 0, 0, 0, "", [], 0

    def put(edit, role, text):
        nonlocal written, last, size
        out.append((conv, written, edit, role, text))
        written, last, size = written + 1, role[:1], size + len(text)

    for batch in batches:
        for conv, plan, role, text, n in zip(*(c.to_pylist() for c in batch.columns)):
            if plan is not None:
                audit, at, rest, written, last = plan, 0, len(plan.rstrip("I")), 0, ""
            for _ in range(n):
                while audit[at] == "I":
                    put("I", "assistant" if last == "u" else "user", "")
                    at += 1
                if audit[at] != "D":
                    put(audit[at], role if audit[at] == "K" else "assistant" if last == "u" else "user", text)
                at += 1
                if at == rest:  # no row follows
                    for _ in audit[rest:]:
                        put("I", "assistant" if last == "u" else "user", "")
                if len(out) >= 10_000 or size >= 1 << 20:
                    yield told(out)
                    out, size = [], 0
    if out:
        yield told(out)


def repaired(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns after the edits, in order within each partition.

    rows: turns(); edited: edits(). A conversation streams through one task, row by row.
    """
    plan = edited.select("conv_id", "audit", F.lit(False).alias("row"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"))], F.lit(0).cast("long").alias("n"))
    own = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), F.lit(True).alias("row"), "turn", "role", "text", "n")
    dealt = plan.unionByName(own).repartition("conv_id").sortWithinPartitions("conv_id", "row", "turn", "role", "text")
    return dealt.select("conv_id", "audit", "role", "text", "n").mapInArrow(_mend, "conv_id long, position long, edit string, role string, text string")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of conversations as they are: (one row for each with counts, cost and audit; the repaired turns)."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return repair_rows(conversations.select("conv_id", "turn", told("role"), told("text"), F.lit(1).cast("long").alias("n")))


def repair_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """repair() of rows with their number n, as damaged() gives them."""
    own = turns(rows)
    edited = materialised(edits(signatures(own)))
    return edited, repaired(own, edited)


def _hashed(batches):
    """sha256 of the turns of each conversation, written as `role:text` and joined by line feeds."""
    held, hashed, out = None, None, []

    def told(rows):
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()), pa.array([h for _, h in rows], pa.string())], ["conv_id", "repaired_sha256"])

    for batch in batches:
        for conv, position, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if position == 0:
                if hashed:
                    out.append((held, hashed.hexdigest()))
                held, hashed = conv, hashlib.sha256()
            hashed.update(f"{chr(10) if position else ''}{role}:{text}".encode())
        if len(out) > 10_000:
            yield told(out)
            out = []
    if hashed:
        out.append((held, hashed.hexdigest()))
    if out:
        yield told(out)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    edited, turns_ = repair_rows(damaged(conversations))
    hashes = turns_.select("conv_id", "position", "role", "text").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = conversations.select("conv_id", *[F.lit(None).cast("long").alias(c) for c in columns], *[F.lit(None).cast("string").alias(c) for c in ("audit", "repaired_sha256")]).distinct()
    parts = every.unionByName(edited.select("conv_id", *columns, "audit"), allowMissingColumns=True).unionByName(hashes, allowMissingColumns=True)
    empty = hashlib.sha256(b"").hexdigest()
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in columns],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(empty)).alias("repaired_sha256"),
    )

"""Conversation repair, byte-level BPE and phrases against brute force, the tiktoken library and counting by hand."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import tiktoken

from lawloom.llm import bpe, conversations, phrases

from .test_operators import LONG, SF, SPACE, odd

BLANKS = SPACE.decode()
ROLES = {"u": "user", "a": "assistant"}
AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows, faults):
    """(cost, audit, lines) of the cheapest edits, with whole strings for each state."""

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for to in AFTER[state].replace("s", ""):
                    way = (cost + 3, audit + "I", [*lines, ROLES[to] + ":"])
                    if to not in best or way < best[to]:
                        best[to] = way
        return best

    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        ways = []
        for state, (cost, audit, lines) in inserted(best).items():
            ways.append((state, (cost + 4, audit + "D", lines)))
            more = 3 if fault == "truncated" else 0
            for to in AFTER[state] if fault not in ("blank", "duplicate") else "":
                if role[:1] == to:
                    ways.append((to, (cost + more, audit + "K", [*lines, f"{role}:{text}"])))
                elif to != "s":
                    ways.append((to, (cost + more + 3, audit + "R", [*lines, f"{ROLES[to]}:{text}"])))
        best = {}
        for to, way in ways:
            best[to] = min(best.get(to, way), way)
    return min(way for state, way in inserted(best).items() if state in ("", "a"))


def repaired_by_hand(table):
    kept = {c: [] for c, *_ in table}
    for conv, turn, role, text in table:
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, rows in kept.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.rstrip(BLANKS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, *_ in rows if t is not None}
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(rows, faults)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rough(n):
    """Conversations with odd roles, nulls, ties and one very long conversation."""
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(200)]), rng.choice([None, 0, 1, 2, 3, 4, 9]), rng.choice(["user", "assistant", "system", "tool", "", None, "use", "Ü"]), rng.choice(["Hi.", "no", "", None, " \n", "Yes!  ", "what? x", "é."])) for _ in range(n)]
    return rows + [(7, k // 3, rng.choice(["user", "assistant"]), f"row {k % 50}.") for k in range(n // 2)]


@pytest.mark.parametrize("table", ["given", "rough", "empty"])
def test_conversations_equal_brute_force(spark, tmp_path, table):
    given = pd.read_parquet(f"{SF}/conversations.parquet")[["conv_id", "turn", "role", "text"]]
    rows = {"given": list(given.itertuples(index=False, name=None)), "rough": rough(2000), "empty": []}[table]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    docs.selectExpr("*", "'x' AS n", "'x' AS symbol", "'x' AS audit", "'x' AS signature").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = conversations.op11(spark, str(tmp_path)).collect()
    assert len({r.conv_id for r in got}) == len(got)
    assert {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got} == repaired_by_hand(rows)


def test_gaps_beyond_64_bits_stay_in_them(spark):
    docs = spark.createDataFrame([(1, 2**63 - 1, "user", "x."), (1, -(2**63), "assistant", "y.")], "conv_id long, turn long, role string, text string")
    edited, turns = conversations.repair(docs)
    assert edited.first().gaps == 2**63 - 1 and [r.role for r in turns.collect()] in (["user", "assistant", "user", "assistant"], ["user", "assistant"])


def test_layers_of_a_shared_beginning_are_computed_once():
    rng = random.Random(2)
    signatures = sorted({"".join(rng.choice("-suaxSUAX") for _ in range(rng.randrange(9))) for _ in range(3000)})
    trie = conversations.Trie()
    for s in signatures:
        rows = [(0, {"x": "tool"}.get(c.lower(), c.lower()), "t") for c in s]
        faults = ["blank" if c == "-" else "truncated" if c.isupper() else "" for c in s]
        assert trie.visit(s) == cheapest(rows, faults)[:2]
    assert trie.computed == len({s[:k] for s in signatures for k in range(1, len(s) + 1)})


def test_repaired_turns_stand_in_order(spark):
    docs = spark.createDataFrame([(1, 0, "assistant", "A."), (1, 1, "user", "B."), (1, 2, "user", "B."), (2, 0, "tool", "")], "conv_id long, turn long, role string, text string")
    edited, turns = conversations.repair(docs)
    assert {r.conv_id: (r.cost, r.audit) for r in edited.collect()} == {1: (10, "IKKDI"), 2: (4, "D")}
    assert [(r.position, r.edit, r.role, r.text) for r in turns.collect()] == [(0, "I", "user", ""), (1, "K", "assistant", "A."), (2, "K", "user", "B."), (3, "I", "assistant", "")]


PARTS = [" ", "  ", "'", "s", "'s", "'S", "'re", "'ve", "ll", "'ll", "d", "t", "\n", "\t", " ", "é", "日", "1", "½", "!", "?", "<|endoftext|>", "abc", "The", "'m", " '", "''", "　", "\U0001f600", "r", "e", "\x1c", "\x85", "\U00031350", "࢏", "Ᲊ"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.vocabulary(bpe.default_vocabulary()), special_tokens={})


def test_encoder_equals_the_library(library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(20_000)] + ["a" * 3000, " " * 3000, "aé" * 2000, LONG, "", None]
    own = bpe.encoder(bpe.default_vocabulary())
    ids, at = own.encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert list(ids[at[k] : at[k + 1]]) == library.encode_ordinary(text or ""), repr(text)
    assert own.decode(ids, at).to_pylist() == [(t or "").encode() for t in texts]
    for few in ([], [None], ["", None, ""]):
        assert [len(x) for x in own.encode(pa.array(few, pa.string()))] == [0, len(few) + 1]


def test_classes_of_all_characters_are_those_of_the_library():
    ranks = {bytes([b]): b for b in range(256)}
    for a in b"a1!":
        for b in range(256):
            ranks[bytes([a, b])] = len(ranks)
    probe = tiktoken.Encoding("probe", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    kinds = bpe.kinds()
    for c in range(0, 0x110000):
        if not 0xD800 <= c < 0xE000:
            joined = [len(probe.encode_ordinary(x + chr(c))) == len(chr(c).encode()) for x in "a1!"]
            assert (kinds[c] == np.array([bpe.LETTER, bpe.NUMBER, bpe.OTHER])).tolist() == joined, hex(c)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 3000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64))
    assert sorted(bpe.PerfectHash(keys).slots(keys)) == list(range(len(keys)))


def test_broken_bytes_become_replacement_characters(library):
    texts = pa.array([b"ab\xff c", b"\xc3"], pa.binary())
    ids, at = bpe.encoder(bpe.default_vocabulary()).encode(texts)
    assert [list(ids[i:j]) for i, j in zip(at, at[1:])] == [library.encode_ordinary("ab� c"), library.encode_ordinary("�")]


def test_bpe_query_equals_the_library(spark, library, tmp_path):
    docs = odd(spark).unionByName(spark.read.parquet(f"{SF}/documents.parquet"), allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want[(r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.op12(spark, str(tmp_path)).collect())) == want
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def pieces(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for p in re.split(r"[.,;:!?\x0A-\x0D]", lower) if (w := [x for x in re.split(r"[\x20\x09]+", p) if x])]


def counted(docs, longest):
    n, f = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            f.update((lang, " ".join(w[i : i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    return n, f


def ranked(docs, least, longest, top):
    n, f = counted(docs, longest)
    often = {k: a for k, a in f.items() if a >= least}
    held = Counter()
    for (lang, phrase), a in often.items():
        w = phrase.split(" ")
        for i in range(len(w)):
            for j in range(i + 1, len(w) + 1):
                if j - i < len(w):
                    held[lang, " ".join(w[i:j])] = max(held[lang, " ".join(w[i:j])], a)
    out = {}
    for (lang, phrase), a in often.items():
        w = phrase.split(" ")
        if len(w) > 1 and held[lang, phrase] < a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, " ".join(w[:k])] * f[lang, " ".join(w[k:])]), k, f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    return {(lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items() for k, (s, a, p, l, r) in enumerate(sorted(rows)[:top])}


def found(spark, docs, least, longest, top):
    got = phrases.best(phrases.collocations(docs, least, longest), top)
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got.collect()}


@pytest.mark.parametrize("least, longest, bits, shard", [(20, 5, 1 << 26, 8 << 20), (5, 3, 1 << 26, 20_000), (20, 5, 64, 1 << 20)])
def test_phrases_equal_counting(spark, monkeypatch, least, longest, bits, shard):
    monkeypatch.setattr(phrases, "SHARD_BYTES", shard)
    plain = phrases.marks
    monkeypatch.setattr(phrases, "marks", lambda hashes: plain(hashes, bits))  # of 64 bits most are set: nothing is spared, all is right
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    want = ranked(zip(docs.text, docs.lang), least, longest, 300)
    assert len(want) > 100 and found(spark, spark.read.parquet(f"{SF}/documents.parquet"), least, longest, 300) == want


def test_phrases_of_odd_rows(spark):
    rows = [(None, "en"), ("", "en"), ("a b a b a b, A B.", None), ("a b a b\x0ba\tb\x1cc", None), ("a b", "und"), ("a b c " * 5, "en"), ("é É " * 4, "fr")] * 3
    docs = odd(spark).drop("text", "lang").limit(1).crossJoin(spark.createDataFrame(rows, "text string, lang string"))
    assert found(spark, docs, 3, 5, 10) == ranked(rows, 3, 5, 10)
    assert phrases.best(phrases.collocations(docs.limit(0))).count() == 0


def test_suffix_arrays_of_words_are_sorted():
    rng = np.random.default_rng(5)
    shard = phrases.Shard(pa.array([" ".join(rng.choice(list("abc"), 40)) + "," + " ".join(rng.choice(list("ab"), 30)) for _ in range(20)]), pa.array(["en", "fr"] * 10))
    order = phrases.suffix_array(shard.ids, shard.left, 5)
    begins = [tuple(shard.ids[i : i + min(5, shard.left[i])]) for i in order]
    assert begins == sorted(begins) and sorted(order) == list(range(len(order)))
    common = phrases.common_prefixes(order, shard.ids, shard.left, 5)
    assert all(sum(1 for _ in iter_common(a, b)) == c for a, b, c in zip(begins, begins[1:], common[1:]))


def iter_common(a, b):
    for x, y in zip(a, b):
        if x != y:
            return
        yield x


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10**14 + 7
    rows = [("en", None, big), ("en", "a", 10**9 + 1), ("en", "b", 10**10 + 3), ("en", "a b", 10**9)]
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: spark.createDataFrame(rows, "lang string, phrase string, f long"))
    assert phrases.collocations(None).first().score == 1000 * 10**9 * big // ((10**9 + 1) * (10**10 + 3))

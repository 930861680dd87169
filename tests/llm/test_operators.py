"""Each operator against brute force, an exact round trip or held-out accuracy; and the odd inputs of all."""

import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lawloom.llm import common, embedding_dedup, html_text, language_id, minhash, mixing, packing, quality_classifier, quality_rules, repeats, toxicity
from lawloom.llm.queries import oracle_sql, queries

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SPACE = b" \t\n\x0b\x0c\r"
LONG = " ".join(f"word{i * 7919 % 5003}" for i in range(30_000))
TEXT = "The court shall hear the appeal of the person named in the order and give its reasons in writing to every party before the end of the term."
ODD = [
    (1, TEXT, "en", "a", 1), (2, None, "en", "a", 2), (3, "", None, None, 3), (4, TEXT, "en", "b", 4), (4, TEXT, "en", "b", 4), (5, " \n\t ", "fr", "b", 5),
    (6, LONG, "en", "c", 6), (7, "é" * 60, "fr", None, 7), (8, "a", "en", "a", 8), (None, TEXT + " More.", None, "a", 9), (9, TEXT + " And more words follow here.", "en", "a", 10),
]
EXTRA = "key group bucket place score kept label component node size rep host row content chunk p n marks copy target held_out __score _ had _had many __rest".split()


def words(text):
    return [w for w in (text or "").encode().translate(bytes(range(256)), b"").replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]


def odd(spark, rows=ODD):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit("x") for c in EXTRA})


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def documents(folder=SF):
    return pd.read_parquet(f"{folder}/documents.parquet")


def auc(y, s):
    rank = pd.Series(s).rank().to_numpy()
    y = np.asarray(y) == 1
    return (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())


def shingles(text, size):
    w = [x.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))) for x in words(text)]
    return ({tuple(w)} if w else set()) if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


@pytest.mark.parametrize("size, percent, block", [(3, 85, 256), (5, 80, 256), (3, 85, 2), (3, 50, 3)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)  # small blocks make every cluster a crowd
    docs = documents()
    sets = {i: shingles(t, size) for i, t in zip(docs.doc_id, docs.text)}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = components(ids, links)
    got = minhash.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet"), size, percent).toPandas()
    assert links and dict(zip(got.doc_id, got.component_id)) == want
    assert dict(zip(got.doc_id, got.n_shingles)) == {i: len(s) for i, s in sets.items()}
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_sequential_bounds_keep_pairs_at_the_threshold():
    least = minhash.least_matches(85)
    assert len(least) == minhash.HASHES // minhash.STEP and all(b > a for a, b in zip(least, least[1:]))
    rng = np.random.default_rng(1)
    matches = (rng.random((20_000, minhash.HASHES)) < 0.85).cumsum(1)[:, minhash.STEP - 1 :: minhash.STEP]
    assert (matches < np.array(least)).any(1).mean() < 1e-3


@pytest.mark.parametrize("group_bytes", [repeats.GROUP_BYTES, 20_000])
def test_repeats_equal_brute_force(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)  # one group, or many of them and as many buckets
    docs = documents().sort_values("doc_id")
    first = {}
    for i, t in zip(docs.doc_id, docs.text):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    want = {}
    for i, t in zip(docs.doc_id, docs.text):
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k + 1 : k + 51] = True
        want[i] = (int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), bytes(c for c, g in zip(b, gone[1:]) if not g))
    got = repeats.without_repeats(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {r.doc_id: (sum(x.end - x.start for x in r.removed), len(r.removed), bytes(r.kept)) for r in got} == want
    assert any(w[0] for w in want.values())


def test_hashes_of_repeats_do_not_grow_with_the_buckets():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"], 300)) for _ in range(40)] * 2
    ids = list(range(80))
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "key": pa.array(ids, pa.int64()), "group": pa.array([0] * 80, pa.int64())})
    copies = pa.table({"group": pa.array([0] * 40, pa.int64()), "copy": pa.array(ids[40:], pa.int64())})
    size, held = {}, {}
    for buckets in (1, 64):
        sent = repeats._sent_hashes(buckets)(table, copies)
        size[buckets] = sum(len(x) for n in ("low", "high", "several") for x in sent.column(n).to_pylist())
        held[buckets] = sum(len(x) for x in sent.column("high").to_pylist())
        alone = repeats._sent_hashes(buckets)(table.slice(0, 40), copies.slice(0, 0))
        assert sent == alone  # whole copies send nothing
    assert held[1] == held[64] and size[64] < 1.05 * size[1]


def test_classes_of_a_crowd_meet_one_hub_first(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 64)
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(300):
        own = list(base)
        own[rng.integers(120)] = f"x{rng.integers(10**9)}"
        texts.append(" ".join(own))
    rows, confirmed = [], minhash.confirmed

    def counted(tasks, *rest):
        rows.append(tasks.count())
        return confirmed(tasks, *rest)

    monkeypatch.setattr(minhash, "confirmed", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = minhash.near_duplicates(docs, 5, 80).toPandas()
    assert set(got.component_id) == {0}
    assert sum(rows) < 4 * len(texts)  # each key's hub at once: many times as many


@pytest.mark.parametrize("few", [0, 20, common.FEW_EDGES])
def test_components_take_few_tables(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_EDGES", few)
    rng = np.random.default_rng(8)
    chain = [int(x) for x in rng.permutation(60)]  # 60 nodes in a row, in any order
    edges = list(zip(chain, chain[1:])) + list(zip(range(100, 160), range(101, 161)))
    edges += [(300, 300 + k) for k in range(1, 40)] + [(499, 400 + k) for k in range(40)] + [tuple(int(x) for x in rng.integers(500, 600, 2)) for _ in range(90)]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    tables, scratch = [], common.scratch
    monkeypatch.setattr(common, "scratch", lambda *a: tables.append(1) or scratch(*a))
    docs = spark.createDataFrame(edges + edges[:9] + [(None, 1), (7, None), (900, 900)], "a long, b long")
    got = common.components(docs).collect()
    assert len(got) == len(nodes) and {r.node: r.component for r in got} == components(nodes, [e for e in edges if e[0] != e[1]])
    assert few <= 20 or len(tables) <= 4  # a table of each step of every round: ten and more
    assert common.components(docs.limit(0)).count() == 0


def test_packing_is_a_round_trip(spark):
    from tokenizers import Tokenizer

    docs = documents()
    docs.loc[len(docs)] = [10**6, "\x1cab\x85cd <|endoftext|> İstanbul ﬁ é 日本語 don't I'LL ½ Ǆ ß\x0bq 's", "en", "s", 1]
    got = packing.pack(spark.createDataFrame(docs), packing.default_tokenizer()).toPandas()
    tool = Tokenizer.from_file(packing.default_tokenizer())
    pieces = {i: g.sort_values("start") for i, g in got.groupby("doc_id")}
    for i, t in zip(docs.doc_id, docs.text):
        ids, g = [*tool.encode(t or "", add_special_tokens=False).ids, 2], pieces[i]
        assert list(np.frombuffer(b"".join(map(bytes, g.ids)), "<u4")) == ids
        assert list(g.start) == list(np.cumsum([0, *g.length])[:-1]) and set(g.doc_tokens) == {len(ids)}
    # documents of full sequences follow the curve: places do not fall within a task, whose number the id holds
    place = {r.doc_id: r.place for r in packing.tokenised(spark.createDataFrame(docs), None).collect()}
    full = got[got.groupby("sequence_id")["length"].transform("sum") == 4096].sort_values(["sequence_id", "offset"])
    for _, g in full.groupby(full.sequence_id // 2**36):
        at = g.doc_id.map(place).tolist()
        assert at == sorted(at)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        n = g.length.sum()
        assert list(g.offset) == list(np.cumsum([0, *g.length])[:-1]) and n <= 4096 and n & (n - 1) == 0


def test_one_vec_id_may_have_several_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.999, 0.01], 1), (3, [1.0, 0.0], 2), (3, [1.0, 0.0], 3), (4, [1.0, 0.01], 2), (5, [1.0, 0.01], 3), (5, [1.0, 0.01], 3), (None, [1.0, 0.0], 1)]
    rows += [(int(rng.integers(10, 30)), [float(x) for x in rng.integers(-2, 3, 2)], int(rng.integers(4, 6))) for _ in range(80)]
    vectors = [np.array(v) / (np.linalg.norm(v) or 1) for _, v, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if None not in (rows[i][0], rows[j][0]) and rows[i][2] == rows[j][2] and vectors[i] @ vectors[j] >= 0.93]
    count, part = Counter(x for pair in links for x in pair), components(range(len(rows)), links)
    least = {}
    for k, p in part.items():
        least[p] = min(least.get(p, rows[k][0] or 0), rows[k][0] or 0)
    want = sorted((r[0] or 0, count[k], least[part[k]]) for k, r in enumerate(rows))
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id)


def test_other_tokenizers_encode_whole_texts(spark):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer().replace("word_bpe_49k", "byte_bpe_50k")
    assert packing.Words(packing.default_tokenizer()).by_words and not packing.Words(path).by_words
    docs = documents().head(20)
    got = packing.pack(spark.createDataFrame(docs), path).toPandas()
    tool = Tokenizer.from_file(path)
    for i, t in zip(docs.doc_id, docs.text):
        ids = np.frombuffer(b"".join(map(bytes, got[got.doc_id == i].sort_values("start").ids)), "<u4")
        assert list(ids) == [*tool.encode(t or "", add_special_tokens=False).ids, 2]


def test_hilbert_curve_is_a_walk_over_neighbours():
    x = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    place = packing.hilbert(x, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(x[np.argsort(place)], axis=0)).sum(1) == 1).all()


def test_near_vectors_equal_brute_force(spark):
    rows = pd.read_parquet(f"{SF}/embeddings.parquet")
    rng = np.random.default_rng(3)
    moved = rows.assign(vec_id=rows.vec_id + 10_000, embedding=[x + rng.normal(0, s, len(x)) * np.abs(x).mean() for x, s in zip(rows.embedding, rng.uniform(0.1, 0.9, len(rows)))])
    rows = pd.concat([rows, moved.assign(embedding=[x.astype(np.float32) for x in moved.embedding])], ignore_index=True)
    unit = np.stack(rows.embedding).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (rows.label.to_numpy()[:, None] == rows.label.to_numpy()[None, :])
    np.fill_diagonal(near, False)
    want = components(rows.vec_id, [(rows.vec_id[a], rows.vec_id[b]) for a, b in zip(*np.nonzero(near))])
    table = spark.createDataFrame([(int(v), [float(c) for c in e], int(n)) for v, e, n in zip(rows.vec_id, rows.embedding, rows.label)], "vec_id long, embedding array<float>, label int")
    got = embedding_dedup.near_vectors(table).toPandas()
    assert near.any() and dict(zip(got.vec_id, got.component_id)) == want
    assert dict(zip(got.vec_id, got.n_links)) == dict(zip(rows.vec_id, near.sum(1)))


def test_vectors_with_odd_values(spark):
    v, nan = [1.0, 2.0, 3.0], float("nan")
    rows = [(1, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.1], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [0.0] * 3, 0), (8, [1.0, nan, 1.0], 0), (9, [1.0, None, 1.0], 0), (10, [], 0), (11, [1.0, 2.0], 0), (2, v, 0), (None, v, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1)).withColumn("n", F.lit(1))
    got = sorted((tuple(r) for r in embedding_dedup.near_vectors(df).collect()), key=str)
    linked = [r for r in got if r[1]]
    assert {r[0]: r[1:3] for r in linked if r[0]} == {1: (3, 1), 2: (3, 1), 3: (3, 1)} and len(got) == len(rows)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_mixing_meets_targets(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    got, again = mixing.plan(docs).toPandas(), mixing.plan(docs.repartition(5)).toPandas()
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, again.values.tolist()))
    assert len(got) == docs.count() and (got["size"] == [len(words(t)) for t in documents(LARGER).set_index("doc_id").text[got.doc_id]]).all()
    rate = got.target / got.source_size
    assert ((got.copies >= np.floor(rate - 1e-9)) & (got.copies <= np.ceil(rate + 1e-9)))[got["size"] > 0].all() and got.copies.max() <= 3
    by = got.assign(taken=got.copies * got["size"]).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), largest=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.largest / 2 + 1).all() and (by.taken - by.target).abs().sum() < 0.01 * by.target.sum()
    assert abs(by.target.sum() - got["size"].sum()) < 1
    mixed = mixing.mix(docs).groupBy("doc_id").count().toPandas()
    assert dict(zip(mixed.doc_id, mixed["count"])) == {i: c for i, c in zip(got.doc_id, got.copies) if c}


def test_targets_stop_at_three_times_a_source(spark):
    rows = [(i, "w " * n, s, None, 0) for i, (s, n) in enumerate([("a", 1000), ("b", 10), ("c", 100), (None, 500)])]
    sized = mixing.sizes(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long"))
    got = {r.source: r.target for r in mixing.targets(sized).collect()}
    # weights 1, 2, 3, 1: b and c stop at 30 and 300, the others share the rest alike
    assert got["b"] == 30 and got["c"] == 300 and got["a"] == pytest.approx(640) and got[None] == pytest.approx(640)


def test_mixing_expects_the_rate(spark, monkeypatch):
    rows = [(i, "w " * (1 + i * i % 40), "ab"[i % 3 == 0], None, 0) for i in range(60)]
    rows += [(100 + i, "w " * 400, "a", None, 0) for i in range(2)]  # giants
    sized = mixing.materialised(mixing.sizes(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")))
    total, draws = Counter(), 12
    for seed in range(draws):
        monkeypatch.setattr(mixing, "SEED", 100 + seed)
        got = mixing.rounded(sized, mixing.targets(sized), chunk=8, giants=16).toPandas()
        by = got.assign(taken=got.copies * got["size"]).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
        assert ((by.taken - by.target).abs() <= [200, 40]).all()  # giants make up half of source a
        for i, c in zip(got.doc_id, got.copies):
            total[i] += c
    rate = {i: r for i, r in zip(got.doc_id, got.target / got.source_size) if i < 100}
    miss = np.array([total[i] / draws - rate[i] for i in rate])
    spread = np.array([(rate[i] % 1 * (1 - rate[i] % 1) / draws) ** 0.5 for i in rate])
    assert miss.mean() == pytest.approx(0, abs=0.06) and (np.abs(miss) < 4.5 * spread + 1e-9).all()  # each document expects its own rate


def test_quality_scores_held_out_documents(spark):
    got = quality_classifier.op1(spark, LARGER).toPandas().merge(pd.read_parquet(f"{LARGER}/labels.parquet"), on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all() and got.score.between(0, 1).all()
    rest = got[got.held_out]
    assert auc(rest.quality, rest.score) > 0.88 and (rest.predicted == rest.quality).mean() > 0.9


def test_quality_odds_do_not_depend_on_the_sample(spark):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"word{k}" for k in rng.integers(0, 400, 150))) for i in range(700)]  # texts say nothing about labels
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 7 > 0).cast("int").alias("label"))
    for bound in (60, 3000):
        scores = quality_classifier.score(docs, quality_classifier.fit(docs, labels, bound)).toPandas().score
        assert abs(scores.mean() - 6 / 7) < 0.06, bound


def test_quality_scores_equal_plain_compression(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_classifier.fitted(spark, docs, SF)
    got = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    good, bad = quality_classifier.compressors(model)
    for i, text in zip(documents().doc_id, documents().text):
        data = (text or "").encode()
        diff = sum(len(bad.compress(data[k : k + 1024])) - len(good.compress(data[k : k + 1024])) for k in range(0, len(data), 1024))
        z = model.slope * np.arcsinh(200 * (diff + 1) / (len(data) + 32)) + model.bias
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def test_toxicity_scores_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = pd.read_parquet(f"{folder}/labels.parquet")
    assert (toxicity.op3(spark, LARGER).toPandas().score.between(0, 1)).all()
    got = toxicity.op3(spark, folder).toPandas().merge(labels, on="doc_id")
    rest = got[got.held_out]
    toxic = rest.toxic == 1
    assert auc(rest.toxic, rest.score) > 0.95 and rest.predicted[toxic].mean() > 0.8 and rest.predicted[~toxic].mean() < 0.02
    assert "lang" not in toxicity.score(docs.drop("lang", "source"), toxicity.Model(constant=0.5)).columns


def test_words_group_texts_by_language():
    docs = documents("/root/testdata/sf0.1").dropna(subset=["text", "lang"]).head(800)
    data = [t.encode() for t in docs.text]
    ids, first = toxicity.word_ids(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    m = toxicity.Model(languages=toxicity.word_groups([ids[a:b] for a, b in zip(first[:-1], first[1:])]))
    counts = pd.crosstab(m.language(ids, first), docs.lang.to_numpy())
    assert counts.max(1).sum() > 0.95 * len(docs)


def test_every_language_has_a_threshold_of_its_own():
    rng = np.random.default_rng(12)
    n, m = 600, toxicity.Model(constant=0.0)
    y, group = (rng.random(n) < 0.2).astype(int), rng.integers(0, 3, n)
    y[group == 2] = np.where(np.arange((group == 2).sum()) < 2, 1, 0)  # two toxic rows alone
    z = y * 2.0 + rng.normal(0, 0.6, n) + np.array([0.0, 3.0, 3.0])[group]
    m.languages = np.zeros((1, 3))
    m.logits, m.projected, m.language = lambda *_: z, lambda: None, lambda *_: group
    toxicity.calibrate(m, [np.zeros((1, 3), np.uint16)] * n, y, float(y.mean()))
    assert m.thresholds[0] < m.thresholds[1] and len(set(np.round(m.thresholds, 6))) == 3


def test_thresholds_are_the_best_of_all():
    rng = np.random.default_rng(8)
    ids = [rng.integers(0, 300, (20, 3)).astype(np.uint16) + (60_000 if k % 5 == 0 and j > 3 else 0) for k in range(200) for j in [rng.integers(0, 8)]]
    y = np.array([int(k % 5 == 0) for k in range(200)])
    m = toxicity.train(ids, y, epochs=2)
    m.languages = np.zeros((toxicity.BUCKETS, 1), np.float32)
    toxicity.calibrate(m, ids, y, 0.2)
    z = m.logits(np.concatenate(ids), np.arange(0, 20 * 201, 20), m.projected())
    f1 = lambda t: 2 * ((z >= t) & (y == 1)).sum() / ((z >= t).sum() + (y == 1).sum())
    assert f1(m.thresholds[0]) == pytest.approx(max(f1(t) for t in z), abs=1e-9) and f1(m.thresholds[0]) > 0.6


def test_training_follows_the_gradient(monkeypatch):
    """One step on a batch moves each filter weight against the sign of the numeric gradient of the loss."""
    rng = np.random.default_rng(6)
    ids, y = [rng.integers(0, 12, (n, 3)).astype(np.uint16) + 20 * (k % 2) for k, n in enumerate((9, 12, 10, 11, 9, 9))], np.array([1, 0] * 3)
    first = np.cumsum([0, *map(len, ids)])

    class Dense:  # no drop-out
        def __init__(self, rng):
            self.rng = rng

        def __getattr__(self, name):
            return getattr(self.rng, name)

        def random(self, shape):
            return np.ones(shape)

    real = np.random.default_rng
    monkeypatch.setattr(np.random, "default_rng", lambda seed: Dense(real(seed)))
    before, after = toxicity.train(ids, y, epochs=0), toxicity.train(ids, y, epochs=1)

    def loss(m):
        z = m.logits(np.concatenate(ids), first, m.projected()).astype(float)
        z = (z - m.constant) / 0.8 + m.constant  # what is kept is scaled up
        return np.log1p(np.exp(np.where(y == 1, -z, z))).sum()

    checked = 0
    for k, w in enumerate(before.filters):
        for at in np.ndindex(w.shape):
            old = w[at]
            w[at] = old + 1e-2
            up = loss(before)
            w[at] = old - 1e-2
            slope = (up - loss(before)) / 2e-2
            w[at] = old
            if abs(slope) > 1e-2:
                checked += 1
                assert np.sign(after.filters[k][at] - old) == -np.sign(slope)
    assert checked > 20


def test_pooled_maxima_equal_a_plain_convolution():
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, toxicity.BUCKETS, (n, 3)).astype(np.uint16) for n in (0, 1, 2, 7, 0, 30)]
    y = np.array([0, 1, 0, 1, 0, 1])
    m = toxicity.train(ids, y, epochs=1)
    first = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    got = m.logits(np.concatenate(ids), first, m.projected())
    for doc, value in zip(ids, got):
        e, z = sum(t[doc[:, k]] for k, t in enumerate(m.tables)), []
        for k, w in enumerate(m.filters):
            maps = [sum(e[i + j] @ w[j] for j in range(len(w))) for i in range(len(e) - len(w) + 1)]
            z.append(np.maximum(np.max(maps, 0) + m.bias[k * 8 : k * 8 + 8], 0) if maps else np.zeros(8))
        assert value == pytest.approx(float(np.concatenate(z) @ m.weights + m.constant), abs=1e-3)


def test_languages_of_held_out_documents(spark):
    got = language_id.op7(spark, LARGER).toPandas().merge(documents(LARGER), on="doc_id")
    rest = got[got.held_out]
    assert (rest.lang == rest.lang_pred).mean() > 0.97
    model = language_id.fit(spark.read.parquet(f"{LARGER}/documents.parquet"))
    texts = rest.drop_duplicates("lang").set_index("lang").text
    two = " ".join(texts["en"].split()[:150] + texts["de"].split()[:150])
    _, _, (shares,) = model.predict([two])
    assert {n for n, _ in shares} == {"en", "de"} and sum(s for _, s in shares) == pytest.approx(1)
    assert model.predict(["", "12 !"])[0] == ["und", "und"]


def test_language_sets_equal_all_sets(spark):
    """Against plain EM over every set of languages: the chosen set has the best penalised likelihood."""
    model = language_id.fit(spark.read.parquet(f"{LARGER}/documents.parquet"))
    texts = documents(LARGER).dropna(subset=["text"])
    whole = [t for t in texts.text if 5 < len(t.split()) < 400][:60]
    by = [t.text.iloc[0].split()[:40] for _, t in texts.groupby("lang")]
    whole += [" ".join(a[: 40 - k] + b[:k]) for a, b in zip(by, by[1:]) for k in (2, 8, 20)]
    _, _, sets = model.predict(whole)
    singles = 0
    for text, chosen in zip(whole, sets):
        grams, first = language_id.trigrams(text)
        like = np.add.reduceat(model.table[grams], first[:-1], 0).astype(float)
        costs = {}
        for bits in range(1, 1 << len(model.names)):
            own = [k for k in range(len(model.names)) if bits >> k & 1]
            pi = np.full(len(own), 1 / len(own))
            top = like[:, own].max(1, keepdims=True)
            p = np.exp(like[:, own] - top)
            for _ in range(language_id.ROUNDS):
                w = p * pi
                pi = (w / w.sum(1, keepdims=True)).mean(0)
            fit = (top[:, 0] + np.log((p * pi).sum(1))).sum()
            costs[tuple(model.names[k] for k in own)] = -2 * fit + language_id.PENALTY * (len(own) - 1) * np.log(max(2, len(like)))
        best = min(costs.values())
        singles += len(chosen) == 1
        got = [c for names, c in costs.items() if set(n for n, s in chosen if s > 1e-6) <= set(names)]
        assert min(got) <= best + (0.5 if len(chosen) == 1 else 0.002 * best), text  # larger sets are tried in the order of their shares
    assert 20 < singles < len(whole)


def test_line_rules_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(oracle_sql()["op2_line_frequency_rules"]).df()
    got = quality_rules.op2(spark, SF).toPandas()[list(want.columns)]
    assert sorted(map(tuple, want.values.tolist())) == sorted(map(tuple, got.values.tolist()))


def test_documents_of_common_lines_are_depleted(spark):
    menu = "\n".join(f"menu entry {k} of the site with some more words" for k in range(6))
    rows = [(i, menu + "\n" + " ".join(f"own{chr(97 + i)}x{j}" for j in range(10 if i < 5 else 200)), "h", None, 0) for i in range(26)]
    rows += [(100 + i, " ".join(f"copy{j}" for j in range(60)), "h", None, 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    for copies in (False, True):  # exact copies deplete nothing where they count once
        got = {r.doc_id: r for r in quality_rules.rules(docs, copies).collect()}
        assert all(got[i].kept == (i >= 5) and got[i].n_common_words == 60 for i in range(26)) and all(got[100 + i].kept != copies for i in range(40))


def test_lines_of_many_documents_are_common_in_any_host(spark, monkeypatch):
    own = lambda i: "".join(chr(97 + int(d)) for d in str(i))  # noqa: E731 (digits are all alike in a line)
    rows = [(i, f"own{own(i)} words here\n" + ("shared line of a few\n" if i % 200 == 0 else "") + "x", "h") for i in range(6000)]
    docs = quality_rules.measures(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    common = lambda **limits: {r.docs for r in quality_rules.common_lines(docs, **limits).collect()}
    assert common() == {6000} and common(many=30) == {6000, 30} and common(least_docs=31, many=30) == {6000}


def test_common_lines_are_removed(spark):
    notice = "All rights  reserved by site 7"
    own = [[" ".join(f"own{i}x{j}" for j in range(30 + i)), "", f"tail {chr(97 + i % 26) * (1 + i // 26)} of this document"] for i in range(30)]
    rows = [(i, "\n".join([notice.upper() if i % 2 else notice, own[i][0], own[i][1], notice.replace("7", "8"), own[i][2]]), "h") for i in range(30)]
    rows += [(3, rows[3][1], "h"), (50, rows[4][1], "other"), (51, None, "h"), (52, notice, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = defaultdict(list)
    for r in quality_rules.cleaned(docs).collect():
        got[r.doc_id].append(r.text)
    want = {i: ["\n".join(own[i])] * (2 if i == 3 else 1) for i in range(30)}
    assert dict(got) == want | {50: [rows[4][1]]}
    every = {r.doc_id: r for r in quality_rules.rules(docs).collect()}
    assert every[52].cleaned == "" and every[51].cleaned == "" and every[0].n_common_words == 12
    assert all(r.n_left == len(words(r.cleaned)) for r in every.values())


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
        ("<body><nav><a>Menu</a></nav><article><h1>T</h1><p>One  two\n three<br>four<p>Five &lt;six&gt; &eacute;</article><footer>f</footer>", "T\nOne two three four\nFive <six> é"),
        ("<article><p>a</p><div class='comments'><p>I disagree</p></div><script>var x='</p>';</script><p>b</p></article>", "a\nb"),
        ("<div class=ad>Buy</div><main><p>A</p><aside>side</aside><form><p>f</p></form><p>B</p></main>", "A\nB"),
        ("<div><p>" + "long text of a page " * 20 + "</p></div><div class='cookie-notice'>We use cookies</div>", ("long text of a page " * 20).strip()),
    ],
)
def test_main_text(html, text):
    assert html_text.extract(html)[0] == text


@pytest.mark.parametrize("raw", ["<script>for(var i=0;i<n;i++){f(i)}</script>", "<SCRIPT>if(a<b)x='<!--'</Script >", "<style>/* <a */</style>", "<title>a <b</title>", "<script>x='</scripty>'</script>"])
def test_content_of_raw_elements_is_no_markup(raw):
    assert html_text.extract(f"<article><p>a</p>{raw}<p>b</p></article>")[0] == "a\nb"
    assert html_text.extract(f"<article><p>a</p>{raw[: raw.rindex('</')]}")[0] == "a"


def test_long_paragraphs_cut_nothing_at_the_ends():
    short = ["A title of the page", *(f"line {k} of about thirty letters" for k in range(4))]
    for n in (1, 5):
        lines = [*short, *["long text " * 500] * n, "Last words of the text"]
        html = "<ul><li><a>Menu</a></li></ul>" + "".join(f"<p>{x}</p>" for x in lines)
        assert html_text.extract(html)[0] == "\n".join(x.strip() for x in lines)


def test_marks_are_whole_classes_and_no_anchors_of_text():
    kept = "<h2 id='related'>Related work</h2><p id='share'>a</p><div class='share-prices'>b</div><div id='notice-of-appeal'>c</div>"
    gone = "<div class='site-menu'>x</div><div class='big cookie-notice'>x</div><div id='comments'>x</div><div class='related'>x</div><div class='postComments2'>x</div>"
    assert html_text.extract(f"<article>{kept}{gone}</article>")[0] == "Related work\na\nb\nc"


def test_windows_decide_where_text_begins_and_ends():
    body = "Long body line of the page. " * 30
    around = [f"<div>{x}</div>" for x in ("Subscribe to our newsletter", "12", body, "Short.", body, "34", "Read more stories")]
    for page in ("<article>{}</article>", "<div class='content has-sidebar'>{}</div>"):
        assert html_text.extract(page.format("".join(around)))[0] == "\n".join([body.strip(), "Short.", body.strip()])
    short = "<nav><a>x</a></nav><div>Ad of the day</div><article><h1>T</h1><p>Enoipa.</p></article><p>Imprint and contact of the site, which is a long line</p>"
    assert html_text.extract(short)[0] == "T\nEnoipa." and html_text.extract("<article>Tiny</article>")[0] == "Tiny"
    far = "<p>We use cookies</p>" + "<ul><li><a>menu</a></li></ul>" * 4 + f"<p>{body}</p>"
    text, spans = html_text.extract(far)
    assert text == body.strip() and spans == [(5, 6)]


def test_what_stands_beside_the_text_goes_and_linked_text_stays():
    title = "<article><h1><a href=x>The Title Of It</a></h1><p>Start text here.</p><p><a href=y>All of it is a link</a></p></article>"
    assert html_text.extract(title)[0] == "The Title Of It\nStart text here.\nAll of it is a link"
    remarks = "<div class='reader-comments'><p>A long remark of a reader that goes on for more than sixty letters.</p></div><section class='user-comments'>Yes, of course.</section><ol class='commentlist'><li>Hello there.</li></ol>"
    assert html_text.extract(f"<article><p>Main.</p>{remarks}<p>End.</p></article>")[0] == "Main.\nEnd."
    body = "<p>" + "Body of the page. " * 20 + "</p>"
    plain = f"<div class='advert-box-wide'><p>Buy now, many words of an advert, more than sixty letters long.</p></div><h1>T</h1>{body}<p>Short.</p><ul><li>Apples</li></ul><ul><li>Terms of use apply.</li><li>Copyright 2024</li></ul>"
    assert html_text.extract(plain)[0] == f"T\n{body[3:-5].strip()}\nShort.\nApples"
    assert html_text.extract(f"<div class='comment-on-the-bill'>{body}</div><p class='editor has-sidebar'>More.</p>")[0].endswith("More.")


def plain_regions(weight, shown):
    """Surge and dive of each region, from every window there is."""
    n = len(weight)
    windows = [range(i, j) for i in range(n) for j in range(i + 1, min(n, i + html_text.WINDOW) + 1)]
    sums = [sum(weight[k] for k in w) for w in windows]
    least = min(html_text.THRESHOLD, max(sums, default=0))
    if least <= 0:
        return []
    held = {k for w, s in zip(windows, sums) if s >= least for k in w}
    weighty = [p for p, w in zip(shown, weight) if w > 0]
    flat = max(sum(weighty[i : i + html_text.WINDOW]) for i in range(len(weighty))) < html_text.THRESHOLD
    edge = 1 if flat else min(html_text.EDGE, max(weight))
    out, region = [], []
    for k in range(n + 1):
        if k in held:
            region.append(k)
        elif region:
            text = [j for j in region if weight[j] >= edge]
            out += [(text[0], text[-1] + 1)] if text else []
            region = []
    return out


def test_regions_equal_those_of_all_windows():
    rng = np.random.default_rng(9)
    for _ in range(2000):
        shown = rng.choice([0, 3, 12, 29, 31, 59, 60, 200], rng.integers(0, 12)).tolist()
        weight = [-1000 if rng.random() < 0.2 else x for x in shown]
        assert html_text.surges(weight, shown) == plain_regions(weight, shown)


def test_windows_decide_every_given_page():
    for html in pd.read_parquet(f"{LARGER}/pages.parquet").html:
        text, every = html_text.extract(html)[0], "\n".join(x.text for x in html_text.lines(html))
        assert text and text != every and text in every  # without surge and dive, what stands beside it would be text


@pytest.mark.parametrize("piece", ["<a ", '<a x="', "<div></p>", "<", "<!--", "<a x='\">", "a<b it's "])
def test_broken_markup_takes_linear_time(piece):
    start = time.perf_counter()
    html_text.extract(piece * 40_000 + "<p>end</p>")
    assert time.perf_counter() - start < 20  # a quadratic scan takes minutes


def test_pages_keep_their_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>x</p></article>"), (1, "u", "<article><p>x</p></article>"), (None, None, None)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted(map(str, html_text.main_text(pages).select("page_id", "text").collect())) == ["Row(page_id=1, text='x')"] * 2 + ["Row(page_id=None, text='')"]
    assert html_text.main_text(pages.limit(0)).count() == 0


def per_document(spark, docs):
    """Every operator on documents, by name: one row (or more pieces) for each document."""
    labelled = spark.createDataFrame([(1, 1), (4, 0), (6, 1), (9, 0), (None, 1)], "doc_id long, label int")
    return {
        "quality": quality_classifier.score(docs, quality_classifier.fit(docs, labelled)),
        "rules": quality_rules.rules(docs),
        "toxicity": toxicity.score(docs, toxicity.fit(docs, labelled)),
        "packing": packing.pack(docs),
        "near": minhash.near_duplicates(docs),
        "language": language_id.predict(docs, language_id.fit(docs)),
        "mixing": mixing.plan(docs),
        "rules_copies": quality_rules.rules(docs, copies=False),
        "repeats": repeats.without_repeats(docs, EXTRA),
    }


def test_odd_documents(spark):
    got = {name: df.collect() for name, df in per_document(spark, odd(spark)).items()}
    for name, rows in got.items():
        count = Counter(r.doc_id for r in rows)
        assert set(count) == {r[0] for r in ODD} and (name == "packing" or count == Counter(r[0] for r in ODD)), name
    by = {name: defaultdict(list) for name in got}
    for name, rows in got.items():
        for r in rows:
            by[name][r.doc_id].append(r)
    assert [r.component_id for r in by["near"][4]] == [1, 1] and by["near"][None][0].kept and by["near"][2][0].component_id == 2
    assert all(bytes(r.kept) == b"" for r in by["repeats"][4]) and bytes(by["repeats"][None][0].kept).decode() == ODD[9][1] and by["repeats"][6][0].n_bytes == len(LONG)
    assert by["language"][2][0].lang_pred == "und" and not by["rules"][5][0].kept
    assert by["mixing"][2][0].copies * by["mixing"][2][0].size == 0
    assert sum(r.length for r in by["packing"][6]) == by["packing"][6][0].doc_tokens and by["packing"][3][0].doc_tokens == 1


def test_empty_tables(spark):
    for name, df in per_document(spark, odd(spark).limit(0)).items():
        assert df.count() == 0, name
    assert mixing.mix(odd(spark).limit(0)).count() == 0


def test_mix_keeps_all_columns(spark):
    docs = odd(spark)
    assert mixing.mix(docs).columns == docs.columns
    clash = docs.withColumns({c: F.lit("mine") for c in ("__key", "__content", "__copies", "__rows", "__own", "__n", "row", "own", "turn", "copies")})
    got = mixing.mix(clash).collect()
    assert got and all(r["__key"] == r["own"] == r["copies"] == "mine" for r in got)


def test_every_operator_has_its_query():
    assert [sum(name.startswith(f"op{n}_") for name in queries()) for n in range(1, 14)] == [1] * 13


def test_rows_of_one_id_with_different_texts(spark):
    long = lambda tag: " ".join(f"{tag}{k}" for k in range(40))
    a, b, c = long("alpha"), long("beta"), long("gamma")
    docs = spark.createDataFrame([(1, a + " " + c), (1, b + " " + c), (2, b + " " + c), (3, a + " " + c), (4, c)], "doc_id long, text string")
    near = minhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in near) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]
    left = sorted((r.doc_id, bytes(r.kept).decode()) for r in repeats.without_repeats(docs).collect())
    assert left == sorted([(1, a + " " + c), (1, b + " " + c), (2, ""), (3, ""), (4, "")])
    sizes = {(r.doc_id, r.size) for r in mixing.plan(docs.withColumn("source", F.lit("s"))).collect()}
    assert sizes == {(1, 80), (2, 80), (3, 80), (4, 40)}


def test_pairs_that_steps_leave_open_are_recomputed(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=64)
    other = rng.normal(size=64)
    base, other = base / np.linalg.norm(base), other - other @ base / (base @ base) * base
    other /= np.linalg.norm(other)
    angles = np.arccos(0.93 + np.array([-1e-3, -1e-7, -1e-9, 1e-9, 1e-7, 1e-3]))
    rows = [(0, base.tolist(), 1)] + [(k + 1, (np.cos(t) * base + np.sin(t) * other).tolist(), 1) for k, t in enumerate(angles)]
    unit = np.array([r[1] for r in rows])
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == dict(enumerate(near.sum(1))) and near[0].sum() == 3

"""The corpus pipeline: each stage against the operator or brute force on what the stage before it kept."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from lawloom.llm import minhash, quality_classifier

from .test_operators import EXTRA, SF, odd

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "minhash near-dedup", "suffix-array dedup", "source mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, SF)
    scores = {r.doc_id: r.score for r in quality_classifier.score(docs, quality_classifier.fitted(spark, docs, SF)).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= 0.3} and good.columns == COLUMNS
    first = corpus_pipeline.near_duplicates(spark, good, SF)
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in minhash.near_duplicates(good).collect() if r.kept}
    cut = corpus_pipeline.repeated_strings(spark, first, SF)
    texts, seen = {r.doc_id: r.text for r in cut.collect()}, {}
    assert cut.columns == COLUMNS and all(t.strip() for t in texts.values())
    whole = {r.doc_id: r.text for r in first.collect()}
    for i in sorted(whole):
        b = whole[i].encode()
        if all(b[k : k + 50] not in seen for k in range(len(b) - 49)):
            assert texts[i] == whole[i]  # nothing repeats, nothing goes
        seen.update((b[k : k + 50], i) for k in range(len(b) - 49))
    mixed = corpus_pipeline.mixed(spark, cut, SF)
    assert mixed.columns == COLUMNS and {r.doc_id for r in mixed.collect()} <= set(texts)
    pieces = corpus_pipeline.packed(spark, mixed, SF).toPandas()
    whole_docs = pieces[pieces.start == 0].groupby("doc_id").size()
    assert dict(whole_docs) == dict(Counter(r.doc_id for r in mixed.collect()))


def test_repeats_lose_only_broken_characters_and_texts_with_words(spark):
    shared = "".join(f"passage{k}" for k in range(12))
    rows = [(1, "é" + shared + "ü", "h"), (2, "own \ufffd text è" + shared + "ý and \ufffd more", "h"), (3, None, "h"), (4, "", "h"), (5, " \n", "h"), (6, "é" + shared + "ü", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_strings(spark, docs, SF).collect()}
    assert got[1] == rows[0][1] and got[3] is None and got[4] == "" and got[5] == " \n" and 6 not in got
    assert got[2] in ("own \ufffd text  and \ufffd more", "own \ufffd text è and \ufffd more", "own \ufffd text ý and \ufffd more", "own \ufffd text èý and \ufffd more")


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_no_rows(spark, stage):
    docs = odd(spark)
    out = stage(spark, docs, SF)
    rows = out.collect()
    assert rows and (stage is corpus_pipeline.packed or out.columns == docs.columns and set(EXTRA) < set(out.columns))
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_near_duplicates_keep_one_of_equal_rows(spark):
    text = " ".join(f"word{k}" for k in range(30))
    rows = [(1, text, "a"), (1, text, "a"), (2, text, "a"), (3, text + " more", "b"), (4, "other words of this document only", "b"), (4, "other words of this document only", "c"), (None, text, "a"), (None, text, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id or 0, r.source) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert got == [(0, "a"), (0, "a"), (1, "a"), (4, "b"), (4, "c")]


def test_tasks_ask_for_one_worker_each(spark):
    def most(node, held=0):
        """Python steps between two exchanges: each of them has a worker of its own in every task."""
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return most(node.initialPlan(), held)
        held = 0 if "Exchange" in name else held + bool(re.search("Arrow|Python|Pandas", name))
        below = node.children()
        return max([held, *(most(below.apply(k), held) for k in range(below.size()))])

    docs = spark.createDataFrame([(k, f"text of document {k} " * 9, "en", "h", 9) for k in range(9)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert most(stage(spark, docs, SF)._jdf.queryExecution().executedPlan()) <= 1, name

"""Rewriting to a fixpoint, lists of contents, bodies of annexes, and patches of single laws."""

import random

import pytest

from lawloom.operators import rewritings as rw

#: The marks as rules that are applied until nothing changes.
C = r"\[::content::\]"
RULES = (
    [(rf"^({rw.CONTENTS[1:]}.*)", r"[::content::]\1")]
    + [(rf"^({C}.*)\n({p[1:]}.*)", r"\1\n[::content::]\2") for p in rw.ONE_LINE]
    + [(rf"^({C}.*)\n({p[1:-1]})\n({q[1:] if q[0] == '^' else q}.*)", r"\1\n[::content::]\2 \3") for p, q in rw.TWO_LINES]
)


@pytest.mark.parametrize("seed", range(4))
def test_contents_equal_the_fixpoint_of_their_rules(seed):
    rng = random.Random(seed)
    shapes = ["Inhaltsverzeichnis", "§ 1. Zweck", "§ 2.", "Geltung", "3. Abschnitt: Ziel", "Anhang 1: Liste", "Anhang A:", "liste", "Text", "", "§ 12 Ort"]
    for _ in range(150):
        text = "\n".join(rng.choice(shapes) for _ in range(rng.randrange(14)))
        assert rw.contents_marked(text) == rw.fixpoint(text, RULES), text


def test_fixpoint_has_no_depth_and_tells_circles():
    assert rw.fixpoint("(" * 400 + ")" * 400, [(r"\(\)", "")]) == ""
    assert rw.contents_marked("Inhaltsverzeichnis\n" + "§ 1. Zweck\n" * 5000).count(rw.CONTENT) == 5001
    with pytest.raises(ValueError):
        rw.fixpoint("a", [("a", "b"), ("b", "a")])


def test_bodies_of_annexes_go(spark):
    laws = {"x": ["a", "[::annex::]1", "b", "c", "[::annex::]2", "[::annex::]3", "d"], "y": ["a", "b"], "z": ["[::annex::]1", None]}
    rows = [(law, k, t) for law, texts in laws.items() for k, t in enumerate(texts)]
    got = sorted((r.law, r.line, r.text) for r in rw.without_annex_bodies(spark.createDataFrame(rows, "law string, line int, text string"), "law").collect())
    assert [(law, t) for law, _, t in got] == [("x", "a"), ("x", "[::annex::]1"), ("x", "[::annex::]2"), ("x", "[::annex::]3"), ("y", "a"), ("y", "b"), ("z", "[::annex::]1")]


def test_patches_of_single_laws(spark):
    texts = spark.createDataFrame([("a", "one two"), ("a", None), ("b", "one two"), (None, "one")], "law string, text string")
    patches = spark.createDataFrame([("a", 2, "(?m)^1", "I"), ("a", 1, "one", "1"), ("c", 1, "one", "x")], "law string, ord int, pattern string, replacement string")
    got = sorted(((r.law or ""), r.text or "") for r in rw.patched(texts, patches, "law").collect())
    assert got == [("", "one"), ("a", ""), ("a", "I two"), ("b", "one two")]
    assert rw.patched(texts, patches.limit(0), "law").count() == 4


def test_patterns_of_contents_are_compiled_once(monkeypatch):
    def looked_up(*_, **__):
        raise AssertionError("a pattern is looked up for each line")

    text = "Inhaltsverzeichnis\n§ 1. Zweck\n§ 2.\nGeltung\nEnde"
    with monkeypatch.context() as m:
        m.setattr(rw.re, "match", looked_up)
        got = rw.contents_marked(text)
    assert got == "[::content::]Inhaltsverzeichnis\n[::content::]§ 1. Zweck\n[::content::]§ 2. Geltung\nEnde"

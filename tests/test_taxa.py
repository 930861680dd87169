"""Classes of texts: one look serves all patterns, and what is found is what a plain search of every pattern finds."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lawloom.functions import taxonomies as t
from lawloom.operators import classifiers as cl

from .test_spread import plan

WORDS = "policy;Risk Control;control;of the risk;Fee;fee,;coffee;Licence;licensed;licensing;training,;competent authority;competent person;for;substitute;entry;shall be omitted;omit the;words;there is inserted;Amendment;“a”;means;is ;Act;apply; exemption;OEP;ONR;Crown;Agency;He;he;Public;public interest;owners;employer;—;\r; ;\u2028;\x85;é;𝔸;\n".split(";")


def odd_texts(n: int) -> list[str]:
    rng = random.Random(3)
    cut = lambda x: x if rng.random() < 0.8 else x[: rng.randrange(len(x) + 1)]
    return ["", "a", "éé", *[rng.choice([" ", "", "\n"]) + rng.choice([" ", " ", ""]).join(cut(rng.choice(WORDS)) for _ in range(rng.randint(1, 30))) for _ in range(n)]]


def plainly(text: str, patterns: tuple[str, ...]) -> list[int]:
    found = []
    for k, p in enumerate(patterns):
        left, n = re.subn(p, "", text, flags=re.M)
        if n:
            found, text = [*found, k], left
    return found


def test_no_pattern_of_classes_is_searched_for_by_the_plan(spark):
    texts = spark.createDataFrame([(1, " Every employer shall keep a policy. "), (2, "for x substitute y"), (3, None)], "id int, text string")
    got = cl.provisions(texts)
    assert "RLIKE" not in plan(got)
    assert [(r.duty_type, r.popimar) for r in got.orderBy("id").collect()] == [(["Duty"], ["Policy"]), (["Amendment"], []), ([], [])]


@pytest.mark.parametrize("table", [t.THEMES, {"Amendment": t.AMENDMENT}], ids=["themes", "amendment"])
def test_classes_are_those_that_java_finds(spark, table):
    texts = spark.createDataFrame([(x,) for x in odd_texts(400)], "text string")
    rows = texts.select("text", cl.labels(F.col("text"), table).alias("java"), cl.classes(table)(F.col("text")).alias("here")).collect()
    assert [r for r in rows if r.java != r.here] == []
    assert sum(map(bool, (r.here for r in rows))) > 50


@pytest.mark.parametrize("table, edges", [(t.KINDS, False), (t.GOVERNED, True), (t.GOVERNMENT, True)], ids=["kinds", "governed", "government"])
def test_what_is_taken_is_what_every_pattern_in_turn_takes(table, edges):
    patterns = tuple(t.python(cl.actor_pattern(ps)) if edges else t.python("|".join(f"(?:{p})" for p in ps)) for ps in table.values())
    texts = odd_texts(400)
    found = [cl.taken(x, patterns) for x in texts]
    assert found == [plainly(x, patterns) for x in texts]
    assert sum(map(bool, found)) > 50


def test_a_match_that_taking_makes_is_found():
    assert cl.taken("emplxxxxoyer", ("xxxx", "employer")) == [0, 1] and cl.taken("emplxxxoyer", ("xxxx", "employer")) == []


def test_a_screen_keeps_patterns_that_tell_no_strings():
    screen = cl.Screen([("abcd", "xyz"), (), ("ab",), ("”",)])
    assert screen("") == [1, 2] and screen("..xyz") == [0, 1, 2] and screen("abcd”") == [0, 1, 2, 3] and cl.Screen([()])("a") == [0]
    assert cl.needed("[Ll]i[sc]en") == ("Lisen", "Licen", "lisen", "licen") and cl.needed("[A-Z ]”.*?(?:is |are)") == ("”",)

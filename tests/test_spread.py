"""Costly rows are dealt to many tasks, and strings that a pattern needs spare its search."""

import random
import re

from lawloom.functions import taxonomies as t
from lawloom.operators import classifiers as cl
from lawloom.operators import fitness as ft
from lawloom.plans import annotation_queries

from .conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_of_a_small_file_are_dealt_to_many_tasks(spark):
    texts = spark.range(8).coalesce(1).selectExpr("id", "' Every employer shall ensure the health of people. ' AS text")
    got = cl.provisions(texts)
    assert "REPARTITION_BY_NUM" in plan(got)
    assert [r.dutyholder for r in got.collect()] == [["Org: Employer"]] * 8


def test_rules_of_a_small_file_are_dealt_to_many_tasks(spark):
    rules = spark.range(8).coalesce(1).selectExpr("id", "'These Regulations shall apply to a contractor' AS rule", "'applies-to' AS category")
    assert "REPARTITION_BY_NUM" in plan(ft.parsed(rules))


def test_acts_are_dealt_by_key_to_many_tasks(spark):
    assert "REPARTITION_BY_NUM" in plan(annotation_queries.annotated_sections(spark, SF))


def test_every_match_holds_a_needed_string():
    rng = random.Random(5)
    kinds = [p for ps in t.KINDS.values() for p in ps]
    actors = [cl.actor_pattern(ps) for ps in [*t.GOVERNED.values(), *t.GOVERNMENT.values()]]
    roles = [p.replace("@", cl.actor_pattern(["[Oo]wners?"])) for ps in t.ROLES.values() for p, _ in ps]
    words = [re.sub(r"\[(\w)\w?\]|[?()|\\:]", r"\1", x) for ps in [*t.GOVERNED.values(), *t.KINDS.values()] for x in ps] + "owner shall must may not be the The a apply to means by regulations direct is liable — . ” he\n".split(" ")
    texts = [" ".join(rng.choice(words) for _ in range(25)) for _ in range(120)]
    met = 0
    for p in map(t.python, kinds + actors + roles):
        strings = cl.needed(p)
        held = [x for x in texts if cl._regex(p, re.M).search(x)]
        met += len(held) * bool(strings)
        assert all(cl.may_match(x, strings) for x in held), p
    assert met > 500
    assert cl.needed("(?:abcd|efg)h?") == ("abcd", "efg") and cl.needed("(?:abc)*x?") == () and cl.needed("(?i:abcd)") == ()

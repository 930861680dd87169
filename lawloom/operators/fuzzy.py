"""Best fuzzy match of names among the candidates of a block."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def jaro(a: str, b: str) -> float:
    """Jaro similarity of two strings; 0 if either is empty."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    left = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                left.append(x)
                break
    if not left:
        return 0.0
    right = [y for y, t in zip(b, taken) if t]
    swapped = sum(x != y for x, y in zip(left, right)) // 2
    m = len(left)
    return (m / len(a) + m / len(b) + (m - swapped) / m) / 3


def bag_distance(a: str, b: str) -> float:
    """1 - (larger of the two bag differences) / (length of the longer string)."""
    if not a and not b:
        return 1.0
    x, y = Counter(a), Counter(b)
    return 1 - max((x - y).total(), (y - x).total()) / max(len(a), len(b))


@F.pandas_udf(DoubleType())
def jaro_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro(x or "", y or "") for x, y in zip(a, b)])


@F.pandas_udf(DoubleType())
def bag_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([bag_distance(x or "", y or "") for x, y in zip(a, b)])


def _score(least: float):
    """An Arrow function for the Jaro similarity of two columns; pairs whose shared letters rule out `least` are null."""

    def scores(a: pd.Series, b: pd.Series) -> pd.Series:
        bags: dict[str, Counter] = {}
        known: dict[tuple[str, str], float | None] = {}  # blocks of one batch may repeat a pair

        def bag(x: str) -> Counter:
            if x not in bags:
                bags[x] = Counter(x)
            return bags[x]

        def one(x: str | None, y: str | None) -> float | None:
            x, y = x or "", y or ""
            if (x, y) not in known:
                shared = min((bag(x) & bag(y)).total(), len(y)) if x and y else 0
                most = (shared / len(x) + shared / len(y) + 1) / 3 if shared else 0.0
                known[x, y] = jaro(x, y) if most >= least - 1e-9 else None
            return known[x, y]

        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(scores, DoubleType())


def best_match(names: DataFrame, candidates: DataFrame, block: list[str], name: str, candidate: str, key: str, least: float = 0.0) -> DataFrame:
    """Each row of names with its best candidate of the same block and the score; ties go to the first by name.

    A candidate that equals the name is its match at once. Others are compared only where their lengths, and the
    letters they share, leave a score of `least` possible. Names without such a candidate have a null match.
    Names that a block repeats meet its candidates once, and their rows take the answer.
    """
    wanted = names.select(*block, key, name)
    each = candidates.select(*block, candidate).distinct()
    same = wanted.join(each.select(*block, F.col(candidate).alias(name), F.lit(True).alias("same")), [*block, name], "left")
    rest = same.filter("same IS NULL").drop("same")
    a, b = F.col(name), F.col(candidate)

    def possible(shared: Column) -> Column:
        """The Jaro similarity that so many shared letters allow, at most."""
        return F.when(shared > 0, (shared / F.length(a) + shared / F.length(b) + 1) / 3).otherwise(F.lit(0.0))

    pairs = rest.select(*block, name).distinct().join(each, block).filter(possible(F.least(F.length(a), F.length(b))) >= least)
    pairs = pairs.withColumn("score", F.round(_score(least)(a, b), 6)).filter(F.col("score") >= least)
    best = pairs.groupBy(*block, name).agg(F.min(F.struct((-F.col("score")).alias("s"), b.alias("c"))).alias("b"))
    near = rest.join(best, [*block, name], "left").select(*block, key, name, F.col("b.c").alias("match"), (-F.col("b.s")).alias("score"))
    return same.filter("same").select(*block, key, name, a.alias("match"), F.lit(1.0).alias("score")).unionByName(near)

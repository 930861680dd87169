"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document of a source should appear target / source_size times. The whole part
is certain; the fractional parts are rounded dependently, in words: two fractional
parties meet, and a random transfer of words between them, which leaves the expected
words of both and the sum unchanged, makes one of them whole. One party is a document,
the other all smaller documents of its group together (the transfer scales their
fractions), so the largest documents become whole first and what stays fractional at
the end of a group is small. Groups form a reduction tree:

1. the root, which comes first: documents of more than 1 / GIANTS of the words of their
   source (so fewer than GIANTS of them) meet all the rest of the source;
2. the rest, and the document that the root may leave fractional, is dealt into groups of
   about CHUNK documents by a hash; each group hands one residual up, and residuals are
   grouped again until one group a source is left.

The last residual of a source is drawn with its probability, so every document expects its
rate, and a source misses its target by less than one document that is no giant. Only where
giants leave nothing to make up for the last of them, that one goes to the nearer whole
number, which keeps the source near its target. Draws are hashes of the seed, the level and the row, so
reruns agree.

Defined results: a null or empty text has size 0 and takes 0 words; a null source
is one source, ordered last; a source without words has target 0; repeated rows are
rounded one by one; an empty table gives an empty result. Columns other than
doc_id, text and source are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, materialised

CHUNK = 128
GIANTS = 256
MOST = 3
SEED = 8


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and a hash of the text."""
    words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE + "+"), ""))
    return docs.select("doc_id", "source", words.cast("long").alias("size"), F.xxhash64("text").alias("content"))


def targets(sized: DataFrame, most: int = MOST) -> DataFrame:
    """source, source_size, n and target of every source.

    Sources weigh 1, 2, 3, 1, ... by code point. The level is raised by weight until the words are shared; a source
    stops at `most` times its size. Sorted by size over weight, the sources that stop come first, so one running sum
    gives the level of the others. The windows run over one row a source.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    weighed = by.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    cap = most * F.col("source_size")
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = weighed.withColumn("ratio", cap / F.col("weight"))
    rest = (F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    level = level.withColumn("rest", rest)
    level = level.withColumn("level", F.max(F.when(F.col("ratio") >= F.col("rest"), F.col("rest"))).over(every))
    return level.select("source", "source_size", "n", F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _uniform(*of: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), *of), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _let(values: dict[str, Column], then) -> Column:
    """`then` of a struct of values, each of them computed once."""
    return F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), then)[0]


def _meet(s: Column, x: Column) -> Column:
    """The document x meets all documents after it, whose fraction p0 stands for add + times * p0 by now.

    s: settled documents, that map, and the size and fractional words (by p0) of x and all after it.
    """
    zero, one = F.lit(0.0), F.lit(1.0)

    def transfer(a: Column) -> Column:
        mass = F.least(a["rest"], F.greatest(zero, s["add"] * a["rest"] + s["times"] * a["held"]))  # fractional words of the others
        return _let({"mass": mass, "room": a["rest"] - mass}, lambda b: _let({"up": F.least((1 - a["p"]) * a["size"], b["mass"]), "down": F.least(a["p"] * a["size"], b["room"])}, lambda c: result(a, b, c)))

    def result(a: Column, b: Column, c: Column) -> Column:
        raised = x["u"] * (c["up"] + c["down"]) < c["down"]
        whole = F.when(raised, (1 - a["p"]) * a["size"] <= b["mass"]).otherwise(a["p"] * a["size"] <= b["room"]) & (a["rest"] > 0)
        return _let({"raised": raised, "whole": whole, "fixed": (a["p"] <= 0) | (a["p"] >= 1)}, lambda d: state(a, b, c, d))

    def state(a: Column, b: Column, c: Column, d: Column) -> Column:
        settled = (
            F.when(d["fixed"] | (a["rest"] <= 0), a["p"]).when(d["whole"], d["raised"].cast("double")).when(d["raised"], a["p"] + c["up"] / a["size"]).otherwise(a["p"] - c["down"] / a["size"])
        )
        # a transfer of all they have, or all they can take, makes the others whole
        scale = F.when(d["fixed"], one).when(~d["whole"], zero).when(d["raised"], 1 - c["up"] / b["mass"]).otherwise(1 - c["down"] / b["room"])
        lift = F.when(d["fixed"] | d["raised"], zero).when(d["whole"], c["down"] / b["room"]).otherwise(one)
        done = F.concat(s["done"], F.array(F.struct(x["i"].alias("i"), settled.alias("p"))))
        maps = _let({"scale": F.coalesce(scale, zero), "lift": F.coalesce(lift, zero)}, lambda m: F.struct((m["lift"] + m["scale"] * s["add"]).alias("add"), (m["scale"] * s["times"]).alias("times")))
        return _let({"done": done, "maps": maps}, lambda r: F.struct(r["done"].alias("done"), r["maps"]["add"].alias("add"), r["maps"]["times"].alias("times"), a["rest"].alias("rest"), a["held"].alias("held")))

    start = {"size": x["size"], "p": s["add"] + s["times"] * x["p"], "rest": F.greatest(zero, s["rest"] - x["size"]), "held": F.greatest(zero, s["held"] - x["size"] * x["p"])}
    return _let(start, transfer)


def _level(rows: DataFrame, group: list[Column], level: int, others: Column | None = None) -> DataFrame:
    """Round within groups of rows (doc_id, source, size, content, p): source, doc_id, size, content, p, add, times.

    others: size and fractional words of documents that take part but are not among the rows; add and times map their
    fractions. Without others at most one row of a group stays fractional.
    """
    item = F.struct((-F.col("size")).alias("order"), _uniform(F.lit(level), F.col("doc_id"), F.col("content")).alias("u"), "doc_id", "content", "size", "p")
    outside = others if others is not None else F.struct(F.lit(0.0).alias("rest"), F.lit(0.0).alias("held"))
    grouped = rows.withColumn("outside", outside).groupBy("source", *group).agg(F.sort_array(F.collect_list(item)).alias("items"), F.first("outside").alias("outside"))
    numbered = F.transform("items", lambda x, i: F.struct(i.alias("i"), x["size"].cast("double").alias("size"), x["p"].alias("p"), x["u"].alias("u")))
    total = lambda f: F.aggregate(numbered, F.lit(0.0), lambda s, x: s + f(x))
    start = F.struct(
        F.array().cast("array<struct<i:int,p:double>>").alias("done"),
        F.lit(0.0).alias("add"),
        F.lit(1.0).alias("times"),
        (F.col("outside.rest") + total(lambda x: x["size"])).alias("rest"),
        (F.col("outside.held") + total(lambda x: x["size"] * x["p"])).alias("held"),
    )
    folded = grouped.select("source", "items", F.aggregate(numbered, start, _meet).alias("f"))
    flat = folded.select("source", "items", "f.add", "f.times", F.explode("f.done").alias("e"))
    item = F.col("items")[F.col("e.i")]
    return flat.select(item["doc_id"].alias("doc_id"), "source", item["size"].alias("size"), item["content"].alias("content"), F.col("e.p").alias("p"), "add", "times")


def rounded(sized: DataFrame, goal: DataFrame, chunk: int = CHUNK, giants: int = GIANTS) -> DataFrame:
    """doc_id, source, size, content, copies, source_size, target of every row of sized."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(F.floor(rate))
    goal = goal.withColumn("whole", whole.cast("long")).withColumn("rest", F.greatest(F.lit(0.0), rate - F.col("whole")))
    goal = materialised(goal)
    most = goal.agg(F.max("n")).first()[0] or 0
    named = goal.withColumnRenamed("source", "of")

    def with_source(rows: DataFrame, of: DataFrame, how: str = "inner") -> DataFrame:
        return rows.join(of, rows["source"].eqNullSafe(of["of"]), how).drop("of")

    joined = with_source(sized, named)
    columns = ["doc_id", "source", "size", "content", "p"]
    fractional = (F.col("rest") > 1e-9) & (F.col("size") > 0)
    settled = joined.filter(~fractional).withColumn("p", F.lit(0.0)).select(columns)
    open_ = joined.filter(fractional).withColumn("p", F.col("rest"))
    giant = F.col("size") * giants > F.col("source_size")
    large = open_.filter(giant)
    sums = large.groupBy("source").agg(F.sum("size").alias("large")).withColumnRenamed("source", "of")
    outside = (F.col("source_size") - F.col("large")).cast("double")
    top = materialised(_level(with_source(large, sums), [], 0, F.struct(outside.alias("rest"), (outside * F.col("p")).alias("held"))))
    changed = top.groupBy("source").agg(F.first("add").alias("add"), F.first("times").alias("times")).withColumnRenamed("source", "of")
    moved = F.col("add") + F.col("times") * F.col("p")
    others = with_source(open_.filter(~giant), changed, "left").withColumn("p", F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), moved)), "p"))
    is_whole = F.col("p").isin(0.0, 1.0)
    settled = settled.unionByName(top.filter(is_whole).select(columns)).unionByName(others.filter(is_whole).select(columns))
    residual = with_source(top.filter(~is_whole).select(columns), named.select("of", "n"))
    open_ = others.filter(~is_whole).select(*columns, "n").unionByName(residual)
    level = 1
    while True:
        chunks = F.greatest(F.lit(1), F.ceil(F.col("n") / chunk)).cast("long")
        done = materialised(_level(open_.withColumn("chunk", F.pmod(F.xxhash64(F.lit(SEED + level), "doc_id", "content"), chunks)), [F.col("chunk")], level))
        settled = settled.unionByName(done.filter(is_whole).select(columns))
        left = done.filter(~is_whole).select(columns)
        most = math.ceil(most / chunk)
        if most <= 1:
            break
        level += 1
        here = left.groupBy("source").agg(F.count("*").alias("n")).withColumnRenamed("source", "of")
        open_ = with_source(left, here)
    sized_left = with_source(left, named.select("of", "source_size"))
    drawn = F.when(F.col("size") * giants > F.col("source_size"), F.col("p") >= 0.5).otherwise(_uniform(F.lit(-1), F.col("doc_id"), F.col("content")) < F.col("p"))
    last = sized_left.withColumn("p", drawn.cast("double")).select(columns)
    out = with_source(settled.unionByName(last), named)
    return out.select("doc_id", "source", "size", "content", (F.col("whole") + F.col("p").cast("long")).alias("copies"), "source_size", "target")


def plan(docs: DataFrame) -> DataFrame:
    """How often each document enters the mix."""
    sized = materialised(sizes(docs))
    return rounded(sized, targets(sized))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents themselves, with the columns of docs; a document taken k times comes k times.

    Equal rows of one doc_id share the copies of all of them.
    """
    keys = [F.xxhash64("doc_id", "source").alias("key"), F.xxhash64("text").alias("content")]
    by = plan(docs).groupBy(keys[0], "content").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).filter("copies > 0")
    whole = docs.select(*keys, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # the columns of docs cannot clash
    joined = whole.join(by, ["key", "content"])
    turn = F.row_number().over(Window.partitionBy("key", "content").orderBy("rows"))
    own = F.floor(F.col("copies") / F.col("rows")) + (turn <= F.col("copies") % F.col("rows")).cast("long")
    return joined.withColumn("own", own.cast("int")).filter("own > 0").withColumn("turn", F.explode(F.array_repeat(F.lit(0), F.col("own")))).select("row.*")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("copies") * F.col("size")).alias("taken"))

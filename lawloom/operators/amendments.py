"""Amendment edges between laws: statistics, status, descriptions, and the laws within reach.

An edge has law, path, path_of_law, title, name, year, target, affect and applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import settled

# Status marks of a law.
FULL, PART, LIVE = "❌ Revoked / Repealed / Abolished", "⭕ Part Revocation / Repeal", "✔ In force"
LINK = "https://legislation.gov.uk"
# Shorter forms used when a description is too long for its cell, in order.
SHORT_FORMS = [
    (r"(s|reg|Sch|Pt)\. (\d)", "$1.$2"),
    (r"applied in part \(with modifications\)", "ap in pt w/ mods"),
    ("applied in part", "ap in pt"),
    (r"applied \(with modifications\)", "ap w/ mods"),
    ("applied", "ap"),
    ("modified", "mod"),
    ("extended", "ext"),
    ("amended", "amd"),
    ("repealed in part", "rep in pt"),
    ("repealed", "rep"),
    ("transfer of functions", "trans func"),
    ("power to apply in part for certain purposes conferred", "pwr to app in pt for certain purp conf"),
    ("as inserted", "as ins"),
    ("savings for effects", "svg fr eff"),
    ("amendment to earlier affecting provision", "amd to earlier aff prov"),
    (r"\[Yes\]", "[Y]"),
    (" {2,}", " "),
    (" - ", "-"),
]
CELL = 90_000
CONDENSED = "Text condensed to meet the cell limit of 100K characters"


def is_repeal(affect: Column) -> Column:
    return affect.rlike("repeal|revoke")


def is_full_repeal(target: Column, affect: Column, european: Column | None = None) -> Column:
    """Whether a row repeals a law as a whole; european: which laws are named by no target, as those of the EU are."""
    whole = target.isin("Regulations", "Order", "Act") & affect.isin("revoked", "repealed")
    return whole if european is None else F.when(european, (F.coalesce(target, F.lit("")) == "") & affect.isin("repeal", "revoked")).otherwise(whole)


def by_other_law(edges: DataFrame) -> DataFrame:
    """One row for each law and the law it meets: number of edges, distinct targets, affects and applied marks, details."""
    detail = F.concat("target", F.lit(" "), "affect", F.lit(" ["), "applied", F.lit("]"))
    return edges.groupBy("law", "path").agg(
        F.count("*").alias("affect_count"),
        F.max("name").alias("name"),
        F.max("title").alias("title"),
        F.max("year").alias("year"),
        F.count_if(F.col("path") == F.col("path_of_law")).alias("self_count"),
        F.array_sort(F.collect_set("target")).alias("targets"),
        F.array_sort(F.collect_set("affect")).alias("affects"),
        F.array_sort(F.collect_set("applied")).alias("applied"),
        F.array_sort(F.collect_list(detail)).alias("details"),
    )


def statistics(edges: DataFrame) -> DataFrame:
    """One row a law: amendments, self, laws, links, counts and counts_detailed.

    Two aggregates: first by law and other law, then by law, so a law with very many edges meets them combined.
    Other laws are listed by year, latest first, then by path.
    """
    grouped = by_other_law(edges)
    line = F.concat("name", F.lit(" - "), "affect_count", F.lit("\n"), "title", F.lit("\n" + LINK), "path")
    full = F.concat("affect_count", F.lit(" - "), "title", F.lit("\n" + LINK), "path", F.lit("\n "), F.array_join("details", "\n "))
    item = F.struct((-F.col("year")).alias("order"), "path", "name", line.alias("line"), full.alias("full"))
    by_law = grouped.groupBy("law").agg(F.sum("affect_count").alias("amendments"), F.sum("self_count").alias("self"), F.count("*").alias("laws"), F.array_sort(F.collect_list(item)).alias("items"))
    joined = lambda field, sep: F.array_join(F.transform("items", lambda x: x[field]), sep)
    return by_law.select("law", "amendments", "self", "laws", joined("name", ",").alias("links"), joined("line", "\n\n").alias("counts"), condensed(joined("full", "\n\n"), 50_000).alias("counts_detailed"))


def condensed(text: Column, limit: int) -> Column:
    """Text over the limit in short forms, links without their host where it is still too long, and cut at the cell's size."""
    short = text
    for pattern, form in SHORT_FORMS:
        short = F.regexp_replace(short, F.lit(pattern), F.lit(form))
    short = F.concat(F.lit(CONDENSED + "\n\n"), short)
    bare = F.when(F.length(short) > CELL, F.replace(short, F.lit(LINK), F.lit(""))).otherwise(short)
    return F.when(F.length(text) > limit, F.substring(bare, 1, CELL)).otherwise(text)


def status(edges: DataFrame) -> DataFrame:
    """One row a law: live status from its repeals and revocations, and how many there are."""
    repeal = is_repeal(F.col("affect"))
    return edges.groupBy("law").agg(
        F.count_if(repeal).alias("repeals"),
        F.when(F.bool_or(is_full_repeal(F.col("target"), F.col("affect"))), FULL).when(F.bool_or(repeal), PART).otherwise(LIVE).alias("live"),
    )


def description(edges: DataFrame) -> DataFrame:
    """One row a law: repeals by repealing law (by year), then by affect, with sorted targets."""
    repeals = edges.filter(is_repeal(F.col("affect")))
    one = repeals.groupBy("law", "title", "path", "year", "affect").agg(F.array_join(F.array_sort(F.collect_list("target")), ", ").alias("targets"))
    two = one.groupBy("law", "title", "path", "year").agg(F.array_sort(F.collect_list(F.concat(F.lit("\n "), "affect", F.lit("\n "), "targets"))).alias("parts"))
    text = F.concat(F.lit("\n"), "title", F.lit("\n" + LINK), "path", F.array_join("parts", ""))
    three = two.groupBy("law").agg(F.array_sort(F.collect_list(F.struct("year", "path", text.alias("text")))).alias("items"))
    return three.select("law", F.array_join(F.transform("items", lambda x: x["text"]), "").alias("live_description"))


def reach(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(node, level) of all nodes within depth steps of the seeds; each at its first level.

    edges: (a, b), followed both ways. The frontier is joined and the visited nodes taken out, level by level, so
    each step moves only the new nodes. Each level is settled: the plan of a level does not hold those before it, and
    the walk ends with the first level that finds nothing new.
    """
    both = settled(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    frontier = settled(seeds.select("node").distinct().withColumn("level", F.lit(0)))
    seen = frontier
    for level in range(1, depth + 1):
        step = both.join(frontier.select(F.col("node").alias("a")), "a").select(F.col("b").alias("node")).distinct()
        frontier = settled(step.join(seen.select("node"), "node", "left_anti").withColumn("level", F.lit(level)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen

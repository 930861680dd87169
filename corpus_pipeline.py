"""A corpus through five operators: quality, near-duplicates, repeats, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's docs. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.llm import minhash, mixing, packing, quality_classifier, repeats
from lawloom.llm.common import materialised, scratch

#: A document below this score is rejected.
LEAST_QUALITY = 0.3


def free(name: str, taken: list[str]) -> str:
    """The name, or the name with as many underscores before it as it takes to be none of the taken ones."""
    while name.lower() in {x.lower() for x in taken}:
        name = "_" + name
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores LEAST_QUALITY or more."""
    model = quality_classifier.fitted(spark, docs, sf_dir)
    score = free("score", docs.columns)
    return quality_classifier.scored(docs, model, score).filter(F.col(score) >= LEAST_QUALITY).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates (five-word shingles, similarity 0.8).

    A document is what bears one doc_id: equal rows of it become one row, rows that differ stay together. Rows without
    a doc_id stay as they are.
    """
    gone = minhash.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    gone = materialised(gone.orderBy("doc_id"))
    twice = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").join(gone, "doc_id", "left_anti")
    twice = materialised(twice.select("doc_id"))
    # most documents stay as they are, so they meet the ids of the others: where these are few, no text moves
    once = docs.join(gone.unionByName(twice), "doc_id", "left_anti").select(*docs.columns)
    more = docs.join(twice, "doc_id", "left_semi").select(*docs.columns).dropDuplicates()
    return once.unionByName(more)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that smaller documents hold already; a document that loses all its words goes.

    A cut may fall inside a character; the broken bytes at such a cut are left out. Null and blank texts stay as they are.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    word = r"[^\x20\x09-\x0D]"
    had = free("had", rest)
    was = F.struct(F.col("text").isNull().alias("null"), F.coalesce(F.col("text").rlike(word), F.lit(False)).alias("words"))
    whole = docs.select("doc_id", "text", F.struct(was.alias(had), *rest).alias("__rest"))
    cut = repeats.without_repeats(whole, ["__rest"], whole=True).select("doc_id", "kept", "__rest")
    was = F.col("__rest").getField(had)
    text = F.col("kept").cast("string")
    out = cut.select("doc_id", F.when(~was["words"] & was["null"], F.lit(None)).otherwise(text).alias("text"), "__rest").filter(~was["words"] | F.col("text").rlike(word))
    named = {c: F.col("__rest")[c] for c in rest} | {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*(named[c].alias(c) for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences along the curve."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("source mixing", mixed),
    ("packing", packed),
]

#: The stages learn, cut bytes and tokenise, which SQL cannot express; tests hold each of them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = scratch(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

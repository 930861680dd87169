"""Structured Streaming: counts by window, and upserts of a register by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.registers import merged


def windowed_counts(events: DataFrame, at: str, by: list[str], window: str, late: str) -> DataFrame:
    """Events by window and group; events later than `late` are left out and closed windows leave the state."""
    grouped = events.withWatermark(at, late).groupBy(F.window(at, window), *by).agg(F.count("*").alias("n"))
    return grouped.select(F.col("window.start").alias("start"), *by, "n")


def latest(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    values = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*values), order).alias("r")).select(*key, "r.*")


def maintained(stream: DataFrame, path: str, key: list[str], order: str, checkpoint: str, parts: int = 64, transform: Callable[[DataFrame], DataFrame] = lambda d: d, first: int = 0) -> StreamingQuery:
    """Keep a register under path: each batch is merged into the parts of it that its keys fall into, and only these are written anew.

    Keys are dealt into parts by a hash. A batch writes its parts as v<version>, and a list of the version of every part
    as m<version>; a batch that is run again after a failure writes the same, and readers see whole states only. A row
    that is older by `order` than the one held is left out, however late it comes; of equal ones the later batch stays.

    Versions are numbered from `first` on. A register that exists is only continued with the checkpoint that made it, or
    with a new checkpoint and first=newest_version() + 1; else this raises ValueError. Old versions are for the caller to remove.
    """
    spark = stream.sparkSession
    newest = newest_version(spark, path)
    if not _exists(spark, f"{checkpoint}/metadata") and newest is not None and newest + 1 != first:
        raise ValueError(f"{path} holds versions up to {newest}, which this checkpoint does not know: pass first={newest + 1} to go on from them")

    def step(batch: DataFrame, number: int) -> None:
        spark, number = batch.sparkSession, first + number
        part = F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")
        rows = latest(transform(batch), key, order).persist()
        held = _versions(spark, path, number - 1)
        touched = [r[0] for r in rows.select(part).distinct().collect()]  # parts at most
        known = [f"{path}/v{held[p]}/part={p}" for p in touched if p in held]
        out = rows
        if known:
            register = spark.read.parquet(*known)
            at = register.select(*key, F.col(order).alias("_held"))
            new = rows.join(at, key, "left").filter(F.col("_held").isNull() | (F.col(order) >= F.col("_held"))).drop("_held")
            out = merged(register, new, key).drop("action")
        out.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(f"{path}/v{number}")
        state = sorted((held | dict.fromkeys(touched, number)).items())
        spark.createDataFrame(state, "part int, version long").coalesce(1).write.mode("overwrite").parquet(f"{path}/m{number}")
        rows.unpersist()

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.format("binaryFile").load(path).isEmpty()
    except AnalysisException:
        return False


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the last version of a register; None if there is none."""
    try:
        files = spark.read.format("binaryFile").load(f"{path}/m*").select(F.regexp_extract("path", r"/m(\d+)/[^/]*$", 1).cast("long").alias("n"))
        return files.agg(F.max("n")).first()[0]
    except AnalysisException:
        return None


def _versions(spark: SparkSession, path: str, number: int) -> dict[int, int]:
    return {r["part"]: r["version"] for r in spark.read.parquet(f"{path}/m{number}").collect()} if number >= 0 else {}


def version(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    """The register after a batch; None before the first."""
    held = _versions(spark, path, number)
    return spark.read.parquet(*[f"{path}/v{v}/part={p}" for p, v in held.items()]) if held else None

"""Rows dealt to tasks by what is done with them, not by their bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to at least as many tasks as a shuffle has, by the keys if there are any.

    Spark cuts files and merges shuffles by bytes. Where a row costs far more time than its bytes tell, as in Arrow
    functions over texts, a small file is one task however many cores there are; a number that is named stays.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, *keys)

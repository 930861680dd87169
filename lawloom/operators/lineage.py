"""Cutting the plan of a DataFrame, for operators that go on from their own results."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the folder of spark.checkpoint.dir, so that no later step repeats the work or carries its plan.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    spark = df.sparkSession
    ctx = spark.sparkContext
    if ctx.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not ctx.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        ctx.setCheckpointDir(named or tempfile.mkdtemp())
    return df.checkpoint()

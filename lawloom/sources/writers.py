"""Writers. Each puts rows into a folder; Spark's own commit makes a failed write leave nothing behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def records(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a line, empty values left out."""
    rows.write.mode(mode).option("ignoreNullFields", True).json(path)


def table(rows: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Delimited text with a header; arrays joined by commas."""
    flat = [F.array_join(c, ",").alias(c) if t.startswith("array<string") else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).write.mode(mode).csv(path, header=True, sep=sep, quote='"', escape='"')


def categorised(rows: DataFrame, path: str, category: str = "category", mode: str = "overwrite") -> None:
    """One folder for each category."""
    rows.write.mode(mode).partitionBy(category).json(path)


def tab_line(*columns: Column) -> Column:
    """Values joined by tabs; nulls and the text 'sub 0' as empty."""
    clean = [F.when(F.coalesce(c.cast("string"), F.lit("")) == "sub 0", "").otherwise(F.coalesce(c.cast("string"), F.lit(""))) for c in columns]
    return F.concat_ws("\t", *clean)


def fixed_width(rows: DataFrame, columns: list[str], limit: int = 100) -> DataFrame:
    """One line a row, each column as wide as its longest value, values cut at the limit. The widths are one row."""
    cut = rows.select(*[F.substring(F.coalesce(F.col(c).cast("string"), F.lit("")), 1, limit).alias(c) for c in columns])
    widths = cut.agg(*[F.max(F.length(c)).alias(f"__{c}") for c in columns]).first()
    return cut.select(F.concat_ws(" ", *[F.rpad(c, widths[f"__{c}"] or 0, " ") for c in columns]).alias("line"))


# The columns of an article table.
ARTICLE_COLUMNS = ["id", "name", "flow", "type", "part", "chapter", "heading", "section", "sub_section", "para", "sub_para", "amendment", "text", "region", "changes"]


def article_table(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The columns of an article table, in their order; missing ones are empty."""
    table(rows.select(*[F.col(c) if c in rows.columns else F.lit("").alias(c) for c in ARTICLE_COLUMNS]), path, mode=mode)


def pasted(lines: DataFrame, by: list[str], size: int = 200) -> DataFrame:
    """Lines (seq, line) of each group joined in chunks of so many lines."""
    items = F.array_sort(F.collect_list(F.struct("seq", "line")))
    number = F.row_number().over(Window.partitionBy(*by).orderBy("seq")) - 1
    grouped = lines.withColumn("chunk", F.floor(number / size)).groupBy(*by, "chunk").agg(items.alias("i"))
    return grouped.select(*by, "chunk", F.array_join(F.transform("i", lambda x: x["line"]), "\n").alias("text"))

"""Records in a hierarchy: building them from lines, rolling tags up, inverted indexes, numbering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.titles import natural_key

# Levels of a law from the widest to the narrowest.
LEVELS = ["part", "chapter", "heading", "section", "sub_section", "para", "sub_para"]


def tagged_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, seq, tag and body of each line; a line is '[::tag::]body', and lines without a tag continue the last one."""
    lines = docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("seq", "line"))
    pattern = r"^\[::([a-z_]+)::\](.*)$"
    own = F.when(F.col("line").rlike(pattern), F.regexp_extract("line", pattern, 1))
    return lines.select(key, "seq", own.alias("tag"), F.when(own.isNull(), F.col("line")).otherwise(F.regexp_extract("line", pattern, 2)).alias("body"))


def joined_lines(lines: DataFrame, key: str) -> DataFrame:
    """Lines without a tag joined to the tagged line before them."""
    run = Window.partitionBy(key).orderBy("seq")
    numbered = lines.withColumn("__n", F.sum(F.col("tag").isNotNull().cast("int")).over(run))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "body"))), lambda x: x["body"]), " ")
    return numbered.groupBy(key, "__n").agg(F.min("seq").alias("seq"), F.max("tag").alias("tag"), body.alias("body")).drop("__n")


def levelled(lines: DataFrame, key: str, levels: list[str] = LEVELS) -> DataFrame:
    """Each line with the number of every level that it stands in; a wider level resets the narrower ones.

    lines: key, seq, tag, number. All levels share one window: a level holds its last number unless a wider level came after it.
    """
    run = Window.partitionBy(key).orderBy("seq")
    last = lambda c: F.last(c, ignorenulls=True).over(run)
    out = {}
    for k, level in enumerate(levels):
        own = (F.col("tag") == level) & F.col("number").isNotNull()
        at, number = last(F.when(own, F.col("seq"))), last(F.when(own, F.col("number")))
        out[level] = F.when(at >= F.coalesce(last(F.when(F.col("tag").isin(levels[:k]), F.col("seq"))), at), number) if k else number
    return lines.withColumns(out)


def running_counters(rows: DataFrame, key: list[str], seq: str, counted: dict[str, Column]) -> DataFrame:
    """Rows with running counts of the conditions given by name."""
    run = Window.partitionBy(*key).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({n: F.sum(c.cast("int")).over(run) for n, c in counted.items()})


def carried(rows: DataFrame, key: list[str], seq: str, columns: list[str], starts: Column | None = None) -> DataFrame:
    """Rows with the last value that is not null carried forward; a row where starts holds begins anew."""
    run = Window.partitionBy(*key).orderBy(seq)
    if starts is None:
        return rows.withColumns({c: F.last(c, ignorenulls=True).over(run) for c in columns})
    inside = Window.partitionBy(*key, "__start").orderBy(seq)
    return rows.withColumn("__start", F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(run)).withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns}).drop("__start")


def distinct_ids(rows: DataFrame, key: list[str], column: str, seq: str, suffix: Callable[[Column], Column] | None = None) -> DataFrame:
    """Repeated values of a column told apart by A, ..., Z, AA, ... in the order in which they come; the first stays as it is.

    suffix: what the n-th repetition gets instead, such as code_point.
    """
    n = F.row_number().over(Window.partitionBy(*key, column).orderBy(seq))
    return rows.withColumn("__n", n).withColumn(column, F.when(F.col("__n") == 1, F.col(column)).otherwise(F.concat(F.col(column), (suffix or letters)(F.col("__n") - 1)))).drop("__n")


def letters(n: Column) -> Column:
    """1, 2, ... as A, ..., Z, AA, ..., as wide as any int needs."""
    state = F.struct(n.cast("long").alias("n"), F.lit("").alias("text"))
    step = lambda s, _: F.when(s["n"] > 0, F.struct(F.floor((s["n"] - 1) / 26).alias("n"), F.concat(F.chr(F.pmod(s["n"] - 1, F.lit(26)) + 65), s["text"]).alias("text"))).otherwise(s)
    return F.aggregate(F.sequence(F.lit(1), F.lit(7)), state, step, lambda s: s["text"])


def code_point(n: Column) -> Column:
    """1, 2, ... as A, B, ..., Z, [, ...: the character of the code point 64 + n, also beyond 255."""
    return F.decode(F.unhex(F.lpad(F.hex(64 + n), 8, "0")), "UTF-32")


def skipped_numbers(rows: DataFrame, key: list[str], seq: str, number: str) -> DataFrame:
    """Rows whose number does not follow that of the row before."""
    last = F.lag(number).over(Window.partitionBy(*key).orderBy(seq))
    return rows.withColumn("previous", last).filter(F.col("previous").isNotNull() & (F.col(number) != F.col("previous") + 1))


def batches(rows: DataFrame, order: list[str], size: int, by: list[str]) -> DataFrame:
    """Rows with the number of their batch of `size` within each group of `by`."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("batch", F.floor((n - 1) / size))


def rolled_up(records: DataFrame, law: str, path: list[str], tags: str) -> DataFrame:
    """Tags of every node of the hierarchy: the union over all records at or below it.

    path: columns from the widest level to the narrowest. Each record is exploded to its own prefixes (as many as there
    are levels), so the roll-up is one aggregate without comparing records to one another.
    """
    prefixes = F.array(*[F.concat_ws("/", *path[: k + 1]) for k in range(len(path))])
    present = F.array(*[F.col(p).isNotNull() for p in path])
    nodes = F.array_distinct(F.filter(prefixes, lambda x, k: F.get(present, k)))
    exploded = records.select(law, tags, F.explode(nodes).alias("node")).select(law, "node", F.explode(tags).alias("tag"))
    return exploded.distinct().groupBy(law, "node").agg(F.array_sort(F.collect_list("tag")).alias(tags))


def inverted_index(records: DataFrame, by: list[str], tags: str, ref: str) -> DataFrame:
    """For each tag, the references that bear it in natural order, and how many there are."""
    rows = records.select(*by, F.explode(tags).alias("tag"), ref).distinct()
    refs = F.array_sort(F.collect_list(F.struct(natural_key(F.col(ref)).alias("k"), F.col(ref).alias("v"))))
    return rows.groupBy(*by, "tag").agg(F.transform(refs, lambda x: x["v"]).alias("refs"), F.count("*").alias("n"))


def rendered(index: DataFrame, by: list[str]) -> DataFrame:
    """An inverted index as text: '[tag]' and its references, line by line, tags in order."""
    part = F.concat(F.lit("["), "tag", F.lit("]\n"), F.array_join("refs", "\n"))
    items = F.array_sort(F.collect_list(F.struct("tag", part.alias("text"))))
    return index.groupBy(*by).agg(F.array_join(F.transform(items, lambda x: x["text"]), "\n\n").alias("text"))


def lettered_headings(rows: DataFrame, key: list[str], seq: str) -> DataFrame:
    """Headings (tag heading) without a number get the number of the last one that has it and a letter, A, B, ..., in the order in which they come."""
    run = Window.partitionBy(*key).orderBy(seq)
    heading, own = F.col("tag") == "heading", F.col("number").isNotNull()
    last = F.last(F.when(heading & own, F.col("number")), ignorenulls=True).over(run)
    start = F.sum((heading & own).cast("int")).over(run)
    count = F.sum((heading & ~own).cast("int")).over(Window.partitionBy(*key, "__start").orderBy(seq))
    out = rows.withColumns({"__last": last, "__start": start}).withColumn("__count", count)
    number = F.when(heading & ~own, F.concat(F.coalesce("__last", F.lit("")), letters(F.col("__count")))).otherwise(F.col("number"))
    return out.withColumn("number", number).drop("__last", "__start", "__count")

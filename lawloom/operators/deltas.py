"""Differences between two states of a record, and the change logs that tell them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.titles import is_empty, split_name


def csv_set(c: Column) -> Column:
    """Trimmed members of a comma-separated list; the empty array for null or ''."""
    return F.when(is_empty(c), F.array().cast("array<string>")).otherwise(F.transform(F.split(c, ","), lambda x: F.trim(x)))


def added(old: Column, new: Column) -> Column:
    """Members of the second comma-separated list that the first lacks, sorted."""
    return F.array_sort(F.array_distinct(F.array_except(csv_set(new), csv_set(old))))


def change(old: Column, new: Column, log_from_empty: bool = True) -> Column:
    """'old -> new' where the value has changed; null where it has not, or where the new value is empty."""
    o, n = old.cast("string"), new.cast("string")
    first = F.concat(F.lit("nil -> "), n) if log_from_empty else F.lit(None).cast("string")
    return F.when(is_empty(n), F.lit(None)).when(is_empty(o), first).when(o != n, F.concat(o, F.lit(" -> "), n))


def change_log(changes: dict[str, Column], day: Column, history: Column, newest_first: bool = True) -> Column:
    """The history with an entry of all changes that are not null: the day, then each field and its change."""
    lines = [F.when(c.isNotNull(), F.concat(F.lit(name + "\n"), c)) for name, c in changes.items()]
    none = F.coalesce(*[c for c in changes.values()]).isNull()
    entry = F.concat_ws("\n", day, *lines)
    old = F.coalesce(history, F.lit(""))
    joined = F.concat_ws("\n", entry, F.nullif(old, F.lit(""))) if newest_first else F.concat_ws("\n", F.nullif(old, F.lit("")), entry)
    return F.when(none, old).otherwise(joined)


def compared(old: DataFrame, new: DataFrame, key: list[str], sets: list[str], scalars: list[str], day: str, log: str = "change_log", newest_first: bool = True, log_from_empty: bool = True) -> DataFrame:
    """Rows of new with the log that tells what has changed since old; rows that old lacks start from nothing."""
    o = old.select(*key, *[F.col(c).alias(f"__{c}") for c in [*sets, *scalars, log]])
    joined = new.drop(log).join(o, key, "left")
    changes = {c: F.nullif(F.array_join(added(F.col(f"__{c}"), F.col(c)), "\n"), F.lit("")) for c in sets}
    changes |= {c: change(F.col(f"__{c}"), F.col(c), log_from_empty) for c in scalars}
    return joined.withColumn(log, change_log(changes, F.lit(day), F.col(f"__{log}"), newest_first)).drop(*[f"__{c}" for c in [*sets, *scalars, log]])


def missing_keys(master: DataFrame, copy: DataFrame, column: str, copy_column: str) -> DataFrame:
    """Distinct members of the lists in master that no list in copy holds."""
    m = master.select(F.explode(csv_set(F.col(column))).alias("name")).filter("name <> ''").distinct()
    c = copy.select(F.explode(csv_set(F.col(copy_column))).alias("name"))
    return m.join(c, "name", "left_anti")


def dotted(name: str, width: int) -> str:
    """A name and as many dots as its field asks for."""
    return name + "." * width


# Fields of the change logs of metadata and of repeals, and the dots after their names.
METADATA_FIELDS = {"md_description": 20, "md_subjects": 24, "md_modified": 23, "md_total_paras": 18, "md_body_paras": 18, "md_schedule_paras": 11, "md_attachment_paras": 6, "md_images": 26}


def logged(old: DataFrame, new: DataFrame, key: list[str], fields: dict[str, int], day: str, log: str, sets: list[str] = (), first: str | None = None, sep: str = "\n", newest_first: bool = False) -> DataFrame:
    """Rows of new with a log of what has changed in the fields: the day, then each field, its dots and 'old -> new'.

    first: what is told of a field that had no value before; None tells nothing. sets: comma-separated fields of which
    only new members are told. A field that is empty now is never told.
    """
    o = old.select(*key, *[F.col(c).alias(f"__{c}") for c in [*fields, log]])
    joined = new.drop(log).join(o, key, "left")

    def told(c: str) -> Column:
        a, b = F.col(f"__{c}").cast("string"), F.col(c).cast("string")
        if c in sets:
            return F.nullif(F.array_join(added(a, b), sep), F.lit(""))
        fresh = F.lit(first).cast("string") if first else F.lit(None).cast("string")
        return F.when(is_empty(b), F.lit(None)).when(is_empty(a), fresh).when(a != b, F.concat(a, F.lit(" -> "), b))

    lines = F.concat_ws(sep, *[F.concat(F.lit(dotted(c, n)), told(c)) for c, n in fields.items()])
    entry = F.when(lines != "", F.concat_ws(sep, F.lit(day), lines))
    history = F.nullif(F.col(f"__{log}"), F.lit(""))
    parts = (entry, history) if newest_first else (history, entry)
    return joined.withColumn(log, F.concat_ws(sep, *parts)).drop(*[f"__{c}" for c in [*fields, log]])


def missing_laws(master: DataFrame, copy: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Distinct identities in the lists of master that no list of the paired column of copy holds, split, latest year first."""
    parts = [missing_keys(master, copy, a, b).select("name") for a, b in pairs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct().select("name", split_name(F.col("name")).alias("s")).select("name", "s.*").orderBy(F.col("year").desc_nulls_last(), "name")

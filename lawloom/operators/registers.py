"""Register maintenance: who is known, what to post or patch, and how stores are merged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.identities import code_and_regions, flags
from ..functions.provisions import clean_extent, nations


def known(new: DataFrame, base: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new whose key is in base."""
    return new.join(base.select(*key).distinct(), key, "left_semi")


def unknown(new: DataFrame, base: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new whose key is not in base."""
    return new.join(base.select(*key), key, "left_anti")


def routed(new: DataFrame, base: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new with the action 'patch' where base has the key, else 'post'."""
    flag = base.select(*key).distinct().withColumn("__known", F.lit(True))
    return new.join(flag, key, "left").withColumn("action", F.when(F.col("__known"), "patch").otherwise("post")).drop("__known")


def two_stores(new: DataFrame, first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new with what each of two stores needs: 'patch' or 'post'."""
    out = routed(new, first, key).withColumnRenamed("action", "first_action")
    return routed(out, second, key).withColumnRenamed("action", "second_action")


def merged(base: DataFrame, new: DataFrame, key: list[str], keep_if_empty: list[str] = (), union: list[str] = ()) -> DataFrame:
    """base with the rows of new: new values win, except that an empty one keeps the old value of keep_if_empty columns, and arrays of union columns are united. action tells what has happened to each row."""
    values = [c for c in base.columns if c not in key]
    n = new.select(*key, *[F.col(c).alias(f"__{c}") for c in values], F.lit(True).alias("__new"))
    joined = base.withColumn("__old", F.lit(True)).join(n, key, "full_outer")

    def value(c: str) -> Column:
        if c in union:
            return F.when(F.col("__new").isNull(), F.col(c)).otherwise(F.array_sort(F.array_union(F.coalesce(c, F.array().cast(base.schema[c].dataType)), F.coalesce(f"__{c}", F.array().cast(base.schema[c].dataType)))))
        if c in keep_if_empty:
            filled = F.when(F.col(f"__{c}").cast("string") == "", F.lit(None)).otherwise(F.col(f"__{c}"))
            return F.when(F.col("__new").isNull(), F.col(c)).otherwise(F.coalesce(filled, F.col(c)))
        return F.when(F.col("__new").isNull(), F.col(c)).otherwise(F.col(f"__{c}"))

    action = F.when(F.col("__new").isNull(), "keep").when(F.col("__old").isNull(), "insert").otherwise("update")
    return joined.select(*key, *[value(c).alias(c) for c in values], action.alias("action"))


def linked_names(rows: DataFrame, names: str, register: DataFrame, key: str) -> DataFrame:
    """rows with the array of names cut down to those that the register holds, sorted."""
    kept = rows.select(key, F.explode(names).alias("name")).join(register.select("name").distinct(), "name", "left_semi")
    kept = kept.groupBy(key).agg(F.array_sort(F.collect_set("name")).alias("__kept"))
    return rows.drop(names).join(kept, key, "left").withColumn(names, F.coalesce("__kept", F.array().cast("array<string>"))).drop("__kept")


def predicate(**wanted) -> Column:
    """All of the given equalities; a list is any of its members; None and '' ask nothing."""
    parts = [F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == v for k, v in wanted.items() if v not in (None, "", [], ())]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def stale(date: Column, today: str, days: int = 7) -> Column:
    """Blank, or more than so many days before today."""
    return date.isNull() | (date < F.date_sub(F.lit(today).cast("date"), days))


def tier(plan: Column, order: list[str]) -> Column:
    """Rank of a plan in an order of access; null if it is none of them."""
    return reduce(lambda w, k: w.when(plan == order[k], k), range(1, len(order)), F.when(plan == order[0], 0))


# Plans of access, from the narrowest to the widest.
PLANS = ["PUBLIC", "STARTER", "SUPPORTER", "SPONSOR"]


def cleaned(old: DataFrame, new: DataFrame, key: list[str], drop: list[str], keep_if_empty: list[str]) -> DataFrame:
    """What a workflow patches: rows of new without its dropped columns; an empty value of keep_if_empty leaves the old one."""
    out = new.drop(*drop)
    kept = [c for c in keep_if_empty if c in out.columns]
    joined = out.join(old.select(*key, *[F.col(c).alias(f"__{c}") for c in kept]), key, "left")
    return joined.select(*[F.coalesce(F.nullif(F.col(c), F.lit("").cast(out.schema[c].dataType)), F.col(f"__{c}")).alias(c) if c in kept else F.col(c) for c in out.columns])


def post_image(rows: DataFrame, computed: list[str], renamed: dict[str, str], texts: list[str], lists: list[str]) -> DataFrame:
    """Rows as a store takes them: computed columns go, others are renamed, hearts in texts are line ends, and lists are array literals."""
    out = rows.drop(*computed).withColumns({c: F.regexp_replace(c, "💚️?", "\n") for c in texts} | {c: F.concat(F.lit("{"), F.array_join(c, ","), F.lit("}")) for c in lists})
    return out.withColumnsRenamed(renamed)


def numbered(rows: DataFrame, order: list[str], by: list[str]) -> DataFrame:
    """Rows numbered from 1 within each group, in the given order."""
    return rows.withColumn("number", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def found(rows: DataFrame, store: DataFrame, key: list[str], id_: str) -> DataFrame:
    """Rows with how many records of the store have their key, and the id where it is one."""
    by = store.groupBy(*key).agg(F.count("*").alias("matches"), F.max(id_).alias(id_))
    out = rows.join(by, key, "left")
    return out.withColumns({"matches": F.coalesce("matches", F.lit(0).cast("long")), id_: F.when(F.col("matches") == 1, F.col(id_))})


def first_published(laws: DataFrame, days: DataFrame, key: list[str]) -> DataFrame:
    """Laws with the first day on which a list of new laws names them, and the link of that day."""
    first = days.groupBy(*key).agg(F.min(F.struct("day", "link")).alias("f"))
    return laws.join(first, key, "left").select(*laws.columns, F.col("f.day").alias("published"), F.col("f.link").alias("link"))


def revoked_by(edges: DataFrame) -> DataFrame:
    """By law: the distinct names of the laws that repeal or revoke it, by year and path."""
    rows = edges.filter(F.col("affect").rlike("repeal|revoke")).groupBy("law", "path").agg(F.min("name").alias("name"), F.min("year").alias("year"))
    items = F.array_sort(F.collect_list(F.struct("year", "path", "name")))
    return rows.groupBy("law").agg(F.array_join(F.array_distinct(F.transform(items, lambda x: x["name"])), ",").alias("revoked_by"))


def extent_provisions(rows: DataFrame) -> DataFrame:
    """By law: its extents, longest first, each with its flags and provisions; a single extent holds All provisions.

    rows: law, seq, provision, extent.
    """
    clean = rows.filter("extent IS NOT NULL").withColumn("extent", clean_extent(F.col("extent")))
    one = clean.groupBy("law", "extent").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "provision"))), lambda x: x["provision"]), ", ").alias("provisions"))
    item = F.struct((-F.octet_length("extent")).alias("size"), "extent", "provisions")
    two = one.groupBy("law").agg(F.array_sort(F.collect_list(item)).alias("items"))
    line = lambda x, text: F.concat(flags(x["extent"]), F.lit("💚️"), text)
    text = F.when(F.size("items") == 1, line(F.col("items")[0], F.lit("All provisions"))).otherwise(F.array_join(F.transform("items", lambda x: line(x, x["provisions"])), "💚️"))
    every = F.transform("items", lambda x: x["extent"])
    return two.select("law", text.alias("geo_extent"), F.array_join(nations(every), ",").alias("geo_region"))


def listed(rows: DataFrame, by: list[str], column: str) -> DataFrame:
    """By group: the distinct members of comma-separated lists, sorted and joined again."""
    each = rows.select(*by, F.explode(F.split(column, ",")).alias("x")).select(*by, F.trim("x").alias("x")).filter("x <> ''").distinct()
    return each.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("x")), ",").alias(column))


def names_in(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct names in comma-separated columns."""
    every = F.flatten(F.array(*[F.split(F.coalesce(c, F.lit("")), ",") for c in columns]))
    return rows.select(F.explode(every).alias("name")).select(F.trim("name").alias("name")).filter("name <> ''").distinct()


def found_terms(rows: DataFrame, key: list[str], title: str, terms: dict[str, list[str]]) -> DataFrame:
    """By law: the search terms in its title, in the order of the terms."""
    every = F.array(*[F.when(F.contains(F.lower(title), F.lit(t.lower())), F.lit(t)) for ts in terms.values() for t in ts])
    return rows.select(*key, F.filter(every, lambda x: x.isNotNull()).alias("terms")).filter(F.size("terms") > 0)


def case_results(offences: DataFrame) -> DataFrame:
    """By case: how many offences, and the result of the last one (case, seq, result)."""
    return offences.groupBy("case").agg(F.count("*").alias("offences"), F.max_by("result", "seq").alias("result"))


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that more than one row has, and how many."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def code_groups(rows: DataFrame, code: str) -> DataFrame:
    """Rows with the file that their subject code goes to: empty, error, region or plain; and code and regions."""
    c = F.col(code)
    parts = code_and_regions(F.upper(c))
    group = F.when(c.isNull() | (c == ""), "empty").when(c.rlike("(?i)^error"), "error").when(F.size(parts["regions"]) > 0, "region").otherwise("plain")
    return rows.withColumns({"file": group, "si_code": parts["code"], "regions": F.array_join(parts["regions"], ",")})


def days_between(ranges: DataFrame, key: list[str], first: str = "first", last: str = "last") -> DataFrame:
    """(key, day, path): the days of each range and the path of the list of new laws of each; a range that ends before it begins has none."""
    days = ranges.filter(F.col(first) <= F.col(last)).select(*key, F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"))).alias("day"))
    return days.select(*key, "day", F.concat(F.lit("/new/all/"), F.date_format("day", "yyyy-MM-dd")).alias("path"))

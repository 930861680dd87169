"""Article records of laws: keys of the hierarchy, tags rolled up and written back, taxa of a whole law, changes and their articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identities import trimmed_id
from ..functions.taxonomies import RANKED_KINDS, THEMES
from ..functions.titles import natural_key

# The kinds of record that own tags of their own, and how many numbers of an id their key keeps.
OWNERS = {"part": 1, "chapter": 2, "heading": 3, "section": 4, "article": 4}
# Kinds of change by the letter of their code.
CHANGES = {"F": "amendment", "C": "modification", "I": "commencement", "E": "extent", "X": "editorial"}


def hierarchy_key(id_: Column, record_type: Column) -> Column:
    """The law and the numbers of a part, chapter, heading, section or article that its id begins with; null for other records.

    An id is UK_code_year_number and part, chapter, heading, section, ..., all joined by _.
    """
    parts = F.split(id_, "_")
    out = F.lit(None).cast("string")
    for kind, n in OWNERS.items():
        out = F.when(record_type == kind, F.array_join(F.slice(parts, 1, 4 + n), "_")).otherwise(out)
    return out


def owned(records: DataFrame, tags: str) -> DataFrame:
    """(record_id, tags): for each record that owns tags, the distinct tags of all records whose id begins with its key.

    Every record meets the five keys that its own id can begin with, never other records.
    """
    parts = F.split("id", "_")
    # an id and the keys that it begins with share their first four parts, so one exchange by these serves all steps
    base = F.array_join(F.slice(parts, 1, 4), "_")
    keys = F.array_distinct(F.array(*[F.array_join(F.slice(parts, 1, 4 + n), "_") for n in sorted(set(OWNERS.values()))]))
    dealt = records.select("record_id", base.alias("__base"), keys.alias("keys"), hierarchy_key(F.col("id"), F.col("record_type")).alias("key"), tags).repartition("__base")
    given = dealt.select("__base", F.explode("keys").alias("key"), tags)
    union = given.groupBy("__base", "key").agg(F.array_sort(F.array_compact(F.array_distinct(F.flatten(F.collect_set(tags))))).alias(tags))
    owners = dealt.select("record_id", "__base", "key").filter("key IS NOT NULL")
    return owners.join(union, ["__base", "key"], "left").select("record_id", F.coalesce(tags, F.array().cast("array<string>")).alias(tags))


def written_back(records: DataFrame, aggregates: DataFrame, column: str) -> DataFrame:
    """Records with the aggregates of their record_id in the column; records without one keep what they have."""
    new = aggregates.select("record_id", F.col(column).alias("__new"))
    return records.join(new, "record_id", "left").withColumn(column, F.coalesce("__new", column)).drop("__new")


def _ranked(tags: Column, order: list[str]) -> Column:
    return F.filter(F.array(*map(F.lit, order)), lambda x: F.array_contains(tags, x))


#: Columns of tags with an order of rank of their own.
RANKS = {"duty_type": RANKED_KINDS, "popimar": list(THEMES)}


def law_tags(records: DataFrame, law: str, columns: list[str]) -> DataFrame:
    """The distinct tags of a law in each column: in order of rank where there is one, else sorted."""
    collected = [F.array_distinct(F.flatten(F.collect_set(c))).alias(c) for c in columns]
    out = records.groupBy(law).agg(*collected)
    return out.select(law, *[(_ranked(F.col(c), RANKS[c]) if c in RANKS else F.array_sort(c)).alias(c) for c in columns])


def article_tags(records: DataFrame, law: str, tags: str) -> DataFrame:
    """Text by law: each article (id without its region) in natural order, and the tags of its records: 'article\\n[tag; tag]'."""
    rows = records.select(law, trimmed_id(F.col("id")).alias("article"), tags).filter(F.size(tags) > 0).repartition(law)
    one = rows.groupBy(law, "article").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(tags)))), "; ").alias("tags"))
    item = F.struct(natural_key(F.col("article")).alias("k"), F.concat("article", F.lit("\n["), "tags", F.lit("]")).alias("text"))
    two = one.groupBy(law).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return two.select(law, F.array_join(F.transform("items", lambda x: x["text"]), "\n\n").alias("text"))


def tag_clauses(records: DataFrame, law: str, tags: str, clause: str, url: str) -> DataFrame:
    """By law and tag: the addresses in natural order, each with the clauses that gave the tag. A clause begins with 👤tag."""
    rows = records.select(law, F.explode(tags).alias("tag"), F.col(url).alias("url"), F.col(clause).alias("clauses"))
    own = F.filter(F.split("clauses", r"\n(?=[A-Z]+\n👤)"), lambda c: F.contains(c, F.concat(F.lit("👤"), F.col("tag"), F.lit("\n"))))
    told = rows.withColumn("text", F.concat_ws("\n", "url", F.array_join(own, "\n")))
    item = F.struct(natural_key(F.col("url")).alias("k"), "text")
    out = told.distinct().groupBy(law, "tag").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return out.select(law, "tag", F.array_join(F.transform("items", lambda x: x["text"]), "\n").alias("text"))


def with_changes(records: DataFrame, codes: DataFrame, law: str) -> DataFrame:
    """Records with the codes of changes that stand in their text, the highest first. codes: law and code, such as F12.

    Only codes that the law has count; a code is followed by a blank in the text.
    """
    known = codes.select(law, "code").repartition(law).groupBy(law).agg(F.collect_set("code").alias("__known"))
    own = F.array_distinct(F.regexp_extract_all("text", F.lit(r"\b([FCIEX]\d+) "), F.lit(1)))
    item = lambda c: F.struct((-F.substring(c, 2, 20).cast("long")).alias("n"), c.alias("code"))
    valid = F.array_intersect(own, F.coalesce("__known", F.array().cast("array<string>")))
    changes = F.transform(F.array_sort(F.transform(valid, item)), lambda x: x["code"])
    return records.repartition(law).join(known, law, "left").withColumn("changes", F.coalesce(changes, F.array().cast("array<string>"))).drop("__known")


def change_articles(records: DataFrame, law: str) -> DataFrame:
    """(law, code, articles): the records that bear each change, in natural order of their ids."""
    rows = records.select(law, F.explode("changes").alias("code"), "id").distinct()
    item = F.struct(natural_key(F.col("id")).alias("k"), "id")
    return rows.groupBy(law, "code").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["id"]).alias("articles"))


def change_counts(codes: DataFrame, law: str) -> DataFrame:
    """The highest number of each kind of change by law: amendment, modification, commencement, extent, editorial."""
    number = F.substring("code", 2, 20).cast("int")
    return codes.groupBy(law).agg(*[F.coalesce(F.max(F.when(F.substring("code", 1, 1) == k, number)), F.lit(0)).alias(n) for k, n in CHANGES.items()])


def spare_codes(records: DataFrame, law: str) -> DataFrame:
    """Codes that are missing between the lowest and the highest of their kind: (law, kind, number)."""
    found = records.select(law, F.explode(F.regexp_extract_all("text", F.lit(r"\b([FCIEX]\d+)\b"), F.lit(1))).alias("code")).distinct()
    rows = found.select(law, F.substring("code", 1, 1).alias("kind"), F.substring("code", 2, 20).cast("int").alias("number"))
    last = F.lag("number").over(Window.partitionBy(law, "kind").orderBy("number"))
    gaps = rows.withColumn("last", last).filter(F.col("number") > F.col("last") + 1)
    return gaps.select(law, "kind", F.explode(F.sequence(F.col("last") + 1, F.col("number") - 1)).alias("number"))


def optimised_ranges(codes: DataFrame, law: str) -> DataFrame:
    """(law, code, section) of codes with the sections of the range that they name: where a range has as many sections as codes name it, one each in order, else all of them.

    codes: law, code, range and sections (the range in full).
    """
    rank = F.row_number().over(Window.partitionBy(law, "range").orderBy(natural_key(F.col("code"))))
    many = F.count("*").over(Window.partitionBy(law, "range"))
    each = codes.withColumns({"rank": rank, "many": many})
    own = F.when((F.col("many") > 1) & (F.size("sections") == F.col("many")), F.slice("sections", F.col("rank"), F.lit(1))).otherwise(F.col("sections"))
    return each.select(law, "code", F.explode(own).alias("section"))


#: Columns of a law that its records fill: tags of each kind, and those that clauses prove.
TAXA = ["duty_actor", "duty_actor_gvt", "dutyholder", "rights_holder", "responsibility_holder", "power_holder", "duty_type", "popimar"]
CLAUSED = {c: f"{c}_txt" for c in ("dutyholder", "rights_holder", "responsibility_holder", "power_holder")}


def law_taxa(records: DataFrame, law: str, columns: list[str] = TAXA, clauses: dict[str, str] = CLAUSED, url: str = "url") -> DataFrame:
    """One row a law: for each column its distinct tags; article_<column>, the tags of each article; <column>_article, the addresses of each tag; and
    for the columns of clauses article_<column>_clause, each tag with its addresses and clauses.

    Tags of all columns are taken apart once, as (law, column, tag, article, address), and three aggregates make the texts of all
    columns; pivots by law set them side by side. Records are dealt by law before they are taken apart, so that none of these steps
    moves rows again. A law without tags of a column has an empty list and nulls.
    """
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("tags")) for c in columns])).alias("e")
    told_of = records.select(law, trimmed_id(F.col("id")).alias("article"), F.col(url).alias("url"), *columns).repartition(law)
    rows = told_of.select(law, "article", "url", each).select(law, "article", "url", "e.column", F.explode("e.tags").alias("tag")).distinct()
    tags = rows.groupBy(law, "column").agg(F.array_sort(F.collect_set("tag")).alias("tags"))

    def told(inner: str, title: Column, lines: Column, name: Column) -> DataFrame:
        one = rows.groupBy(law, "column", inner).agg(lines.alias("lines"))
        item = F.struct(natural_key(F.col(inner)).alias("k"), F.concat(title, F.lit("\n"), "lines").alias("text"))
        two = one.groupBy(law, "column").agg(F.array_sort(F.collect_list(item)).alias("items"))
        return two.select(law, name.alias("field"), F.array_join(F.transform("items", lambda x: x["text"]), "\n\n").alias("text"))

    own = F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_set("tag")), "; "), F.lit("]"))
    addresses = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(natural_key(F.col("url")).alias("k"), "url"))), lambda x: x["url"]), "\n")
    wide = [
        (told("article", F.col("article"), own, F.concat(F.lit("article_"), "column")), [f"article_{c}" for c in columns]),
        (told("tag", F.concat(F.lit("["), "tag", F.lit("]")), addresses, F.concat("column", F.lit("_article"))), [f"{c}_article" for c in columns]),
    ]
    wide = [texts.groupBy(law).pivot("field", fields).agg(F.first("text")) for texts, fields in wide]
    for c, clause in clauses.items():
        found = tag_clauses(records, law, c, clause, url).groupBy(law).agg(F.array_sort(F.collect_list(F.struct("tag", "text"))).alias("items"))
        wide.append(found.select(law, F.array_join(F.transform("items", lambda x: F.concat(F.lit("["), x["tag"], F.lit("]\n"), x["text"])), "\n\n").alias(f"article_{c}_clause")))
    lists = tags.groupBy(law).pivot("column", columns).agg(F.first("tags"))
    none = F.array().cast("array<string>")
    lists = lists.select(law, *[(_ranked(F.coalesce(c, none), RANKS[c]) if c in RANKS else F.coalesce(c, none)).alias(c) for c in columns])
    out = records.select(law).distinct().join(lists, law, "left")
    for texts in wide:
        out = out.join(texts, law, "left")
    return out.withColumns({c: F.coalesce(c, none) for c in columns})

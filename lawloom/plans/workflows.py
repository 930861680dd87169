"""Workflows: ordered lists of steps, each a function from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import identities, titles
from ..operators import amendments, annotations, articles, classifiers, enactments, fitness, interpretations, registers, rules, schemes
from ..sources import acts, readers

Step = Callable[[DataFrame], DataFrame]


def run(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    for step in steps:
        df = step(df)
    return df


def credentials(laws: DataFrame) -> DataFrame:
    """Identity columns of laws (title, type_code, year, number); a number with a slash keeps its old form beside it."""
    title, number = F.col("title"), F.col("number")
    code = F.coalesce(F.nullif(F.col("type_code"), F.lit("")), titles.type_code(title))
    return laws.withColumns(
        {
            "name": titles.law_name(code, F.col("year"), titles.number_tail(number)),
            "acronym": titles.acronym(title),
            "old_number": F.when(number.contains("/"), number),
            "type": identities.type_of(code),
            "type_class": titles.type_class(title),
            "tags": titles.tags(title),
        }
    )


def metadata(laws: DataFrame) -> DataFrame:
    """Columns read from the XML of laws (xml), and the first date among enactment, coming into force, making and validity."""
    out = laws.withColumn("__m", readers.law_metadata(F.col("xml"))).select(*[c for c in laws.columns if c not in ("xml", "title")], "__m.*")
    date = titles.first_date(F.col("md_enactment_date"), F.col("md_coming_into_force_date"), F.col("md_made_date"), F.col("md_dct_valid_date"))
    return out.withColumn("md_date", date)


def extent(laws: DataFrame) -> DataFrame:
    """geo_extent and geo_region by law, from the XML of contents lists (law, xml)."""
    rows = laws.select("law", F.posexplode(readers.extents(F.col("xml"))).alias("seq", "e")).select("law", "seq", "e.provision", "e.extent")
    return registers.extent_provisions(rows)


def enacted(laws: DataFrame) -> DataFrame:
    return enactments.enacting_laws(laws)


def amended(edges: DataFrame) -> DataFrame:
    """One row a law: statistics, status and description of what changed it, and who revoked it."""
    out = amendments.statistics(edges).join(amendments.status(edges), "law")
    return out.join(amendments.description(edges), "law", "left").join(registers.revoked_by(edges), "law", "left")


def taxa(records: DataFrame) -> DataFrame:
    """Actors, role holders, kinds and themes of article records."""
    return classifiers.provisions(records)


def law_taxa(records: DataFrame) -> DataFrame:
    """Article records (law, id, url, record_type, text) to one row a law with its actors, holders, kinds and themes, by article and by tag."""
    found = taxa(records)
    return articles.law_taxa(found, "law")


def applicability(provisions: DataFrame) -> DataFrame:
    return rules.single_rules(provisions, ["law", "provision"])


def fit(provisions: DataFrame) -> DataFrame:
    """Provisions (law, provision, text) to what their rules are about."""
    single = applicability(provisions).withColumn("provision", F.array().cast("array<string>"))
    return fitness.fitnesses(single)


def act_records(pages: DataFrame) -> DataFrame:
    """Pages of laws (law, html) to their components: law, line, component, number, text, region."""
    lines = schemes.with_headings(acts.law_lines(pages, "law"), "law")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"])
    texts = lines.groupBy("law").agg(F.array_join(ordered, "\n").alias("annotated"))
    return annotations.components(texts, "law")


def interpretation(records: DataFrame) -> DataFrame:
    return interpretations.defined_terms(records, ["law"], "seq")


def new_laws(laws: DataFrame, base: DataFrame, wanted: list[str], terms: dict[str, list[str]]) -> DataFrame:
    """Laws (title, type_code, year, number, codes) with their credentials, family, category, and action: post or patch, none for excluded ones; these are numbered."""
    out = run(laws, WORKFLOWS["credentials"])
    out = registers.routed(classifiers.categorised(out, "title", "codes", wanted, terms), base, ["name"])
    out = out.withColumn("action", F.when(F.col("category") != "exc", F.col("action")))
    return registers.numbered(out, ["name"], ["category"]).withColumn("number_excluded", F.when(F.col("category") == "exc", F.col("number"))).drop("number")


WORKFLOWS: dict[str, list[Step]] = {
    "credentials": [credentials],
    "metadata": [metadata],
    "extent": [extent],
    "enacted_by": [enacted],
    "amended_by": [amended],
    "taxa": [taxa],
    "law_taxa": [law_taxa],
    "applicability": [applicability],
    "fitness": [fit],
    "act_records": [act_records],
    "interpretation": [interpretation],
    "new_with_metadata": [metadata, credentials],
}

"""Breaches of law as regulators write them: title, year and article; and the law that is meant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fuzzy import best_match
from ..functions.identities import lookup
from ..functions.titles import rewritten, type_code

# How regulators shorten titles, in the order in which they are replaced.
TITLES = [
    ("Regs", "Regulations"),
    (" {2,}", " "),
    ("&", "and"),
    ("Equip", "Equipment"),
    ("^Electricity at Work$", "Electricity at Work Regulations"),
    ("Equipmentment", "Equipment"),
    ("Offshore Prevention Of Fire", "Offshore Prevention Of Fire Regulations"),
    (r"Health and Safety \(First Aid\)", "Health and Safety (First-Aid) Regulations"),
    (r"Reporting of Injuries Diseases and Dangerous \(1995\)", "Reporting of Injuries, Diseases and Dangerous Occurrences Regulations"),
    ("Employers Liability Compulsory Insurance", "Employers' Liability (Compulsory Insurance) Regulations"),
    ("Control of Pesticides", "Control of Pesticides Regulations"),
    ("Classif,label and pack of substancesandmixtu", "Classification, Labelling and Packaging of Chemicals (Amendments to Secondary Legislation) Regulations"),
    (r"Mines and Quarry \(Tips\)", "Mines and Quarries (Tips) Act"),
    ("Offshore Design and Construction", "Offshore Installations and Wells (Design and Construction, etc.) Regulations"),
    ("Make available on market and use biocid pr", "Biocidal Products Regulations"),
    ("Corp Manslaughter and Corp Homicide|Manslaughter", "Corporate Manslaughter and Corporate Homicide Act"),
    ("Notification of Cooling Towers and Evaporative Condensers", "Notification of Cooling Towers and Evaporative Condensers Regulations"),
]

# Years of titles that come without one.
YEARS = {
    "Electricity at Work Regulations": "1989",
    "Workplace (Health, Safety and Welfare) Regulations": "1992",
    "Manual Handling Operations Regulations": "1992",
    "Offshore Prevention Of Fire Regulations": "1995",
    "Asbestos (Licensing) Regulations": "1983",
    "Health and Safety (First-Aid) Regulations": "1981",
    "Employers' Liability (Compulsory Insurance) Regulations": "1998",
    "Control of Pesticides Regulations": "1986",
    "Mines and Quarries (Tips) Act": "1969",
    "Biocidal Products Regulations": "2001",
    "Health and Safety (Display Screen Equipment) Regulations": "1992",
    "Corporate Manslaughter and Corporate Homicide Act": "2007",
    "Notification of Cooling Towers and Evaporative Condensers Regulations": "1992",
    "Reporting of Injuries, Diseases and Dangerous Occurrences Regulations": "1995",
    "Classification, Labelling and Packaging of Chemicals (Amendments to Secondary Legislation) Regulations": "2015",
    "Offshore Installations and Wells (Design and Construction, etc.) Regulations": "1996",
}


def breach_title(title: Column) -> Column:
    return rewritten(title, TITLES)


def breach(text: Column) -> Column:
    """Struct of title, year, article and sub_article of a breach such as "Title 1992 / 5 / 1"."""
    parts = F.transform(F.split(F.regexp_replace(F.trim(text), "( /)+$", ""), "/"), lambda x: F.trim(x))
    head, pattern = F.get(parts, F.lit(0)), r"^(.*?) (\d{4})"
    dated = head.rlike(pattern)
    title = breach_title(F.when(dated, F.regexp_extract(head, pattern, 1)).otherwise(head))
    year = F.when(dated, F.regexp_extract(head, pattern, 2)).otherwise(lookup(YEARS, title))
    return F.struct(title.alias("title"), year.alias("year"), F.get(parts, F.lit(1)).alias("article"), F.get(parts, F.lit(2)).alias("sub_article"))


def breached_laws(breaches: DataFrame, laws: DataFrame) -> DataFrame:
    """breach_id, law and score of every breach (breach_id, title, year).

    laws: law, title, year and type_code. A title and year that are known, in any case of letters, give the law (score 1);
    else the law of the same year and type with the most similar title does; null if there is none.
    """
    known = laws.select(F.concat(F.lower("title"), F.lit(" "), F.col("year")).alias("term"), F.col("law").alias("exact")).groupBy("term").agg(F.min("exact").alias("exact"))
    found = breaches.withColumn("term", F.concat(F.lower("title"), F.lit(" "), F.col("year"))).join(known, "term", "left").withColumn("type_code", type_code(F.col("title")))
    rest = found.filter("exact IS NULL AND year IS NOT NULL AND type_code IS NOT NULL").select("breach_id", "title", "year", "type_code")
    names = laws.groupBy("year", "type_code", F.col("title").alias("other")).agg(F.min("law").alias("law"))
    block = ["year", "type_code"]
    titles = rest.select(*block, "title", F.col("title").alias("key")).distinct()  # each title is compared once, however many breaches name it
    near = best_match(titles, names.select(*block, "other"), block, "title", "other", "key")
    near = near.join(names.withColumnRenamed("other", "match"), [*block, "match"], "left").select(*block, "title", F.col("law").alias("near"), "score")
    near = rest.join(near, [*block, "title"]).select("breach_id", "near", "score")
    out = found.select("breach_id", "exact").join(near, "breach_id", "left")
    return out.select("breach_id", F.coalesce("exact", "near").alias("law"), F.when(F.col("exact").isNotNull(), F.lit(1.0)).otherwise(F.col("score")).alias("score"))


def breach_summary(breaches: DataFrame) -> DataFrame:
    """By notice: its breaches, sorted and joined by "; ", and the distinct laws."""
    return breaches.groupBy("notice").agg(F.array_join(F.array_sort(F.collect_list("breach")), "; ").alias("breaches"), F.array_join(F.array_sort(F.collect_set("law")), ",").alias("laws"))

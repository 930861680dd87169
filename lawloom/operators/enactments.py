"""Laws that enact other laws, as their introductory texts and footnotes name them."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.identities import SITE, is_act

# Enacting laws and the clauses that name them.
CLAUSES = [
    *[(law, clause.format(title)) for clause in (r"an Order under sections?.*? of the {}", r"in exercise of the powers.*?(?: in)? sections?.*? of(?: the)? {}") for title, law in (("Transport and Works Act 1992", "UK_ukpga_1992_42"), (r"European Union \(Withdrawal\) Act 2018", "UK_ukpga_2018_16"), ("Planning Act 2008", "UK_ukpga_2008_29"))],
    ("UK_ukpga_2008_29", "An application has been made to the Secretary of State under section 37 of the Planning Act 2008"),
    ("UK_ukpga_2008_29", "[Tt]he Secretary of State, in exercise of the powers.*? sections? 114.*? and 120.*? of the 2008 Act"),
    ("UK_ukpga_2008_29", "The Secretary of State has decided to grant development consent.*? of the 2008 Act"),
    ("UK_ukpga_2000_1", "powers conferred by paragraph.*?Schedule.*?to the +Northern Ireland Act 2000"),
    ("UK_ukpga_1974_28", "powers conferred by paragraph.*?Schedule.*?to the +Northern Ireland Act 1974"),
]
# Clauses that confer powers, in the order in which they are taken out of a text.
CONFERRED = [
    r"powers? conferred.*?by.*?and now vested in",
    r"powers? conferred.*?by.*?having been designated",
    r"powers? conferred.*?by.*?the Health and Safety at Work etc\. Act 1974 (?:\(“the 1974 Act”\) )?(?:f\d{5})?",
    r"powers? conferred.*?by.*?the Health and Safety at Work etc\. Act 1974 (?:f\d{5} )?(?:\(“the 1974 Act”\))?",
    r"powers? conferred.*?by.*?(?:etc\.).*?[.:;]",
    r"powers? conferred.*?by.*?[.:;]",
    r"powers under.*?f\d{5}",
]
_CODE = r"f\d{5}|\[start_ref\](.*?)\[end_ref\]"


def named_laws(text: Column) -> Column:
    """Laws that a clause of their own names, once each."""
    each = F.array(*[F.when(text.rlike(clause), F.lit(law)) for law, clause in CLAUSES])
    return F.array_distinct(F.filter(each, lambda x: x.isNotNull()))


@F.pandas_udf(ArrayType(StringType()))
def conferring(texts: pd.Series) -> pd.Series:
    """The clauses of a text that confer powers; each is taken out before the next pattern looks."""

    def one(text: str | None) -> list[str]:
        found, text = [], text or ""
        for p in CONFERRED:
            m = re.search(p, text)
            if m:
                found.append(m[0])
                text = re.sub(p, "", text)
        return found

    return texts.map(one)


def codes(text: Column) -> Column:
    """Footnote codes (f00001) and references between marks in a text."""
    found = F.regexp_extract_all(text, F.lit(_CODE), F.lit(0))
    return F.transform(found, lambda c: F.regexp_replace(c, r"\[(?:start|end)_ref\]", ""))


def cited(text: Column, urls: Column) -> Column:
    """Addresses of the codes in a text that hold one of the years in it. urls: a map from codes to arrays of addresses."""
    years = F.transform(F.regexp_extract_all(text, F.lit(r" (\d{4})(?= )"), F.lit(1)), lambda y: y)
    every = F.flatten(F.filter(F.transform(codes(text), lambda c: F.try_element_at(urls, c)), lambda x: x.isNotNull()))
    return F.array_distinct(F.filter(every, lambda u: F.exists(years, lambda y: F.contains(u, y))))


def law_of_url(url: Column) -> Column:
    """The identity of the law at an address; that of a European directive has eudr as its type; null for other addresses."""
    european, national = r"/european/directive/(\d{4})/(\d+)$", r"/id/([a-z]+)/(\d{4})/(\d+)$"
    part = lambda p, k: F.regexp_extract(url, p, k)
    return F.when(url.rlike(european), F.concat_ws("_", F.lit("UK_eudr"), part(european, 1), part(european, 2))).when(url.rlike(national), F.concat_ws("_", F.lit("UK"), part(national, 1), part(national, 2), part(national, 3)))


def enacting_laws(laws: DataFrame) -> DataFrame:
    """Laws (name, type_code, type_class, text, enacting_text, urls) with enacted_by, an array of identities.

    Acts are enacted by none. Others are by the laws that clauses of their own name and those cited where powers are
    conferred; only if there are none, by those cited anywhere in the enacting text.
    """
    text = F.coalesce("text", F.lit(""))
    of = lambda urls: F.filter(F.transform(urls, law_of_url), lambda x: x.isNotNull())
    out = laws.withColumn("__clauses", conferring(text))
    by_clause = F.flatten(F.transform("__clauses", lambda c: cited(c, F.col("urls"))))
    first = F.array_distinct(F.concat(named_laws(text), of(by_clause)))
    swept = F.array_distinct(of(cited(F.coalesce("enacting_text", F.lit("")), F.col("urls"))))
    none = F.array().cast("array<string>")
    out = out.withColumn("__first", first)
    found = F.when(is_act(F.col("type_code"), F.col("type_class")), none).when(F.size("__first") > 0, F.col("__first")).otherwise(swept)
    return out.withColumn("enacted_by", F.coalesce(found, none)).drop("__clauses", "__first")


def enactment_lines(laws: DataFrame, titles: DataFrame) -> DataFrame:
    """name, enacted_by joined by commas, and enacted_by_description: identity, title and address of each enacting law. titles: name, title."""
    each = laws.select("name", F.posexplode_outer("enacted_by").alias("k", "by")).join(titles.select(F.col("name").alias("by"), "title"), "by", "left")
    path = F.regexp_replace(F.substring("by", 3, 1 << 20), "_", "/")
    line = F.concat_ws("\n", "by", F.coalesce("title", F.lit("")), F.concat(F.lit(SITE), path, F.lit("/introduction")))
    items = F.array_sort(F.collect_list(F.when(F.col("by").isNotNull(), F.struct("k", "by", line.alias("line")))))
    out = each.groupBy("name").agg(items.alias("i"))
    return out.select("name", F.array_join("i.by", ",").alias("enacted_by"), F.array_join("i.line", "\n\n").alias("enacted_by_description"))


def distinct_enacting(laws: DataFrame) -> DataFrame:
    return laws.select(F.explode("enacted_by").alias("name")).distinct()



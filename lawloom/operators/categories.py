"""New laws by what a register does with them, by subject codes and by terms in titles; and the filters of article tables.

A law that is not left out for its title is inc_w_si (a subject code of the register), inc_wo_si (a
term of the register in its title) or exc (neither). Which of the two is asked first is the mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomies as t
from .classifiers import first_term, matches_any

#: The kinds of record that classifying reads.
CLASSIFIED = ["part", "chapter", "section", "sub-section", "heading", "article", "sub-article"]
MODES = ("term_si", "si_term")


def with_code_family(laws: DataFrame, key: list[str], codes: str, families: DataFrame) -> DataFrame:
    """Laws with code_member (one of their codes has a family) and code_family: that of the first code, empty if it has none.

    families: code and family, one row a code. Laws without codes are no members and have no family.
    """
    each = laws.select(*key, F.posexplode(codes).alias("k", "code")).join(families.select("code", "family"), "code", "left")
    by = each.groupBy(*key).agg(F.count("family").alias("known"), F.min_by(F.coalesce("family", F.lit("")), "k").alias("code_family"))
    out = laws.join(by, key, "left")
    member = F.coalesce(F.col("known") > 0, F.lit(False))
    return out.withColumns({"code_member": member, "code_family": F.when(member, F.col("code_family"))}).drop("known")


def categorised(laws: DataFrame, key: list[str], title: str, codes: str, families: DataFrame, terms: dict[str, list[str]], mode: str = "term_si") -> DataFrame:
    """Laws with category and family; those that are left out for their title go.

    term_si: a law needs a term in its title, and its codes tell inc_w_si from inc_wo_si; si_term: a law with a code is
    inc_w_si, and of the others those with a term are inc_wo_si. The family is that of the code where the code decides,
    else that of the first term.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    kept = laws.filter(~F.coalesce(matches_any(F.lower(F.col(title)), t.EXCLUDED_TITLES), F.lit(False)))
    found = with_code_family(kept, key, codes, families).withColumn("term_family", first_term(F.col(title), terms))
    term, member = F.col("term_family").isNotNull(), F.col("code_member")
    first = term & member if mode == "term_si" else member
    category = F.when(first, "inc_w_si").when(term, "inc_wo_si").otherwise("exc")
    family = F.when(first, F.col("code_family")).otherwise(F.col("term_family"))
    return found.withColumns({"category": category, "family": family}).drop("code_member", "code_family", "term_family")


def category_counts(laws: DataFrame) -> DataFrame:
    """Laws by category."""
    return laws.groupBy("category").agg(F.count("*").alias("n"))


def with_base(laws: DataFrame, bases: DataFrame) -> DataFrame:
    """Laws with the base (family, base) that holds their family; null if none does."""
    return laws.join(bases.select("family", "base"), "family", "left")


def classified(name: str = "", type_code: str = "", year: int | None = None, number: str = "", part: str = "", chapter: str = "", section: str = "") -> Column:
    """Records of main text of the kinds that classifying reads: of a law by type, year and number, or else by name, and of a part, chapter or section where that is a number."""
    out = (F.col("flow") == "main") & F.col("record_type").isin(CLASSIFIED)
    if any(c.islower() for c in type_code) and isinstance(year, int) and any(c.isdigit() for c in number):
        out = out & (F.col("type_code") == type_code) & (F.col("year") == year) & (F.col("number") == number)
    elif name:
        out = out & (F.col("law") == name)
    for column, value in (("part", part), ("chapter", chapter), ("section", section)):
        if any(c.isdigit() for c in value):
            out = out & (F.col(column) == value)
    return F.coalesce(out, F.lit(False))


def holding(column: str, values: list[str]) -> Column:
    """Rows whose text, or list as text, holds one of the values; null holds none."""
    text = F.concat_ws(",", F.col(column))
    out = F.lit(False)
    for v in values:
        out = out | (F.instr(text, v) > 0)
    return out

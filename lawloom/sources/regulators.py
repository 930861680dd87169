"""Notices and cases of a regulator, from landed pages: lists, details and breaches, joined by their number.

A details page is a table of labels and values, two or four cells a row. Every page becomes
rows of cells once; labels name their values, and lists, details and breaches meet by number.
A notice or case whose further pages are missing stays, with nulls and no breaches; a number that is
listed on several pages is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identities import title_case
from ..functions.titles import iso_date, money
from .readers import table_rows

# Labels of details, the column of each, and what becomes of its value.
NOTICE_LABELS = {
    "HSE Directorate": ("regulator_function", "phrase"), "Compliance Date": ("offence_compliance_date", "date"), "Revised Compliance Date": ("offence_revised_compliance_date", "date"),
    "Description": ("offence_description", "text"), "Main Activity": ("offender_main_activity", "text"), "Industry": ("offender_industry", "text"), "Result": ("offence_result", "text"),
}
CASE_LABELS = {
    "HSE Directorate": ("regulator_function", "phrase"), "Main Activity": ("offender_main_activity", "text"), "Industry": ("offender_industry", "text"), "Local Authority": ("offender_local_authority", "text"),
    "Total Fine": ("offence_fine", "money"), "Total Costs Awarded to HSE": ("offence_costs", "money"),
}
#: Fixed value: what stands before the numbers of related cases.
PREFIX = "HSE_"
KINDS = {"text": F.trim, "date": iso_date, "money": money, "phrase": lambda c: title_case(F.lower(F.trim(c)))}


def _cell(k: int) -> Column:
    return F.trim(F.get("cells", F.lit(k)))


def _linked(k: int) -> Column:
    return F.coalesce(F.get("links", F.lit(k)) != "", F.lit(False))


def notice_list(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """regulator_id and what the list tells of each notice: rows of six cells, of which the first is a link."""
    rows = table_rows(pages, key, html).filter((F.size("cells") == 6) & _linked(0))
    told = {"offender_name": _cell(1), "offence_action_type": _cell(2), "offence_action_date": iso_date(_cell(3)), "offender_local_authority": _cell(4), "offender_sic": _cell(5)}
    return rows.select(_cell(0).alias("regulator_id"), *[c.alias(n) for n, c in told.items()]).dropDuplicates(["regulator_id"])


def case_list(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """regulator_id and what the list tells of each case: rows of five cells, of which the first is a link."""
    rows = table_rows(pages, key, html).filter((F.size("cells") == 5) & _linked(0))
    told = {"offender_name": _cell(1), "offence_action_date": iso_date(_cell(2)), "offender_local_authority": _cell(3), "offender_main_activity": _cell(4)}
    return rows.select(_cell(0).alias("regulator_id"), *[c.alias(n) for n, c in told.items()]).dropDuplicates(["regulator_id"])


def details(pages: DataFrame, key: str, labels: dict[str, tuple[str, str]], html: str = "html") -> DataFrame:
    """One row a page (key): the values of its labels; of a label that comes twice, the last one; null where it has none."""
    rows = table_rows(pages, key, html)
    pairs = F.array(*[F.struct(_cell(k).alias("label"), _cell(k + 1).alias("value")) for k in (0, 2)])
    each = rows.select(key, "row", F.posexplode(pairs).alias("k", "p")).select(key, "row", "k", "p.label", "p.value").filter(F.col("label").isin(list(labels)) & F.col("value").isNotNull())
    wide = each.groupBy(key).agg(*[F.max_by(F.when(F.col("label") == label, F.col("value")), F.when(F.col("label") == label, F.struct("row", "k"))).alias(column) for label, (column, _) in labels.items()])
    return wide.select(key, *[KINDS[kind](F.col(column)).alias(column) for column, kind in labels.values()])


def notice_breaches(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, offence_breaches): the breaches of each page of breaches, in order."""
    rows = table_rows(pages, key, html).filter((F.size("cells") == 5) & ~F.coalesce(_cell(3).isin("Breach", ""), F.lit(False)))
    items = F.array_sort(F.collect_list(F.struct("row", _cell(3).alias("breach"))))
    return rows.groupBy(key).agg(F.transform(items, lambda x: x["breach"]).alias("offence_breaches"))


def case_breaches(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, offence_number, offence_breaches, offence_result, offence_hearing_date): of the last row the result and the hearing."""
    dated = _cell(2).rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{4}$")
    rows = table_rows(pages, key, html).filter((F.size("cells") == 6) & dated)
    items = F.array_sort(F.collect_list(F.struct("row", _cell(5).alias("breach"), _cell(3).alias("result"), iso_date(_cell(2)).alias("at"))))
    one = rows.groupBy(key).agg(items.alias("items"))
    last = F.element_at("items", -1)
    return one.select(key, F.size("items").cast("long").alias("offence_number"), F.transform("items", lambda x: x["breach"]).alias("offence_breaches"), last["result"].alias("offence_result"), last["at"].alias("offence_hearing_date"))


def related_cases(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, offender_related_cases): numbers of the cases that the page of a case lists, joined by commas."""
    rows = table_rows(pages, key, html).filter((F.size("cells") == 5) & _linked(0))
    items = F.array_sort(F.collect_list(F.struct("row", F.concat(F.lit(PREFIX), _cell(0)).alias("id"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(items, lambda x: x["id"]), ",").alias("offender_related_cases"))


def _joined(listed: DataFrame, parts: list[DataFrame]) -> DataFrame:
    out = listed
    for part in parts:
        part = part.withColumnRenamed(part.columns[0], "regulator_id")
        both = [c for c in part.columns if c in out.columns and c != "regulator_id"]
        out = out.join(part.select("regulator_id", *[F.col(c).alias(f"_{c}" if c in both else c) for c in part.columns[1:]]), "regulator_id", "left")
        out = out.withColumns({c: F.coalesce(f"_{c}", c) for c in both}).drop(*[f"_{c}" for c in both])
    return out.withColumn("offence_breaches", F.coalesce("offence_breaches", F.array().cast("array<string>")))


def notices(lists: DataFrame, detail_pages: DataFrame, breach_pages: DataFrame) -> DataFrame:
    """One row a notice. lists: (page, html); the others: (regulator_id, html). What details tell wins over the list."""
    return _joined(notice_list(lists, "page"), [details(detail_pages, "regulator_id", NOTICE_LABELS), notice_breaches(breach_pages, "regulator_id")])


def cases(lists: DataFrame, detail_pages: DataFrame, breach_pages: DataFrame, related_pages: DataFrame) -> DataFrame:
    """One row a case, with its fine and costs, breaches, last result, and related cases."""
    found = _joined(case_list(lists, "page"), [details(detail_pages, "regulator_id", CASE_LABELS), case_breaches(breach_pages, "regulator_id"), related_cases(related_pages, "regulator_id")])
    both = F.when(F.col("regulator_function").isNotNull(), F.concat(F.lit(PREFIX), "regulator_function"))
    return found.withColumns({"offence_number": F.coalesce("offence_number", F.lit(0).cast("long")), "regulator_regulator_function": both})

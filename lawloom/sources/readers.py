"""Readers. Each takes a session and a path and gives a DataFrame with a fixed schema."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.titles import clean_title, law_name, si_codes, split_path


def records(spark: SparkSession, path: str, fields: T.StructType) -> DataFrame:
    """Rows of {"records": [{"id", "createdTime", "fields": {...}}]} files; unknown fields are left out, missing ones are null."""
    envelope = T.StructType([T.StructField("id", T.StringType()), T.StructField("createdTime", T.StringType()), T.StructField("fields", fields)])
    rows = spark.read.schema(T.StructType([T.StructField("records", T.ArrayType(envelope))])).json(path, multiLine=True)
    return rows.select(F.explode("records").alias("r")).select(F.col("r.id").alias("record_id"), "r.createdTime", "r.fields.*")


def articles(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of {"records": [{...}]} files."""
    rows = spark.read.schema(T.StructType([T.StructField("records", T.ArrayType(schema))])).json(path, multiLine=True)
    return rows.select(F.inline("records"))


def table(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Rows of delimited files with a header line; quoted text may span lines."""
    return spark.read.csv(path, schema=schema, header=True, sep=sep, quote='"', escape='"', multiLine=True)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """path and text of whole files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _plain(xml: Column) -> Column:
    """XML whose names have no prefix and no name space."""
    return F.regexp_replace(F.regexp_replace(xml, r"<(/?)[A-Za-z]+:", "<$1"), r"\sxmlns(:\w+)?=\"[^\"]*\"", "")


def law_metadata(xml: Column) -> Column:
    """Struct of title, description, modified, subjects, SI codes, paragraph counts, dates, extent and its date of a law's XML."""
    plain = _plain(xml)
    one = lambda p: F.nullif(F.xpath_string(plain, F.lit(p)), F.lit(""))
    many = lambda p: F.xpath(plain, F.lit(p))
    count = lambda n: F.xpath_string(plain, F.lit(f"//Statistics/{n}/@Value")).try_cast("int")
    return F.struct(
        one("//Metadata/title/text()").alias("title"),
        one("//Metadata/description/text()").alias("md_description"),
        one("//Metadata/modified/text()").alias("md_modified"),
        F.transform(many("//Metadata/subject[not(@scheme)]/text()"), lambda s: F.regexp_replace(F.lower(s), ", england( and wales)?$", "")).alias("md_subjects"),
        si_codes(F.array_join(many("//Metadata/subject[@scheme='SIheading']/text()"), ";")).alias("si_codes"),
        count("TotalParagraphs").alias("md_total_paras"),
        count("BodyParagraphs").alias("md_body_paras"),
        count("ScheduleParagraphs").alias("md_schedule_paras"),
        count("AttachmentParagraphs").alias("md_attachment_paras"),
        count("TotalImages").alias("md_images"),
        one("//Metadata//Made/@Date").alias("md_made_date"),
        one("//Metadata//EnactmentDate/@Date").alias("md_enactment_date"),
        one("//Metadata//ComingIntoForce/DateTime/@Date").alias("md_coming_into_force_date"),
        one("//Metadata/valid/text()").alias("md_dct_valid_date"),
        F.replace(one("/Legislation/@RestrictExtent"), F.lit("."), F.lit("")).alias("md_restrict_extent"),
        one("/Legislation/@RestrictStartDate").alias("md_restrict_start_date"),
    )


def revoke_state(xml: Column) -> Column:
    """Struct of title, whether it says that the law is revoked or repealed, its dates and extent."""
    plain = _plain(xml)
    one = lambda p: F.nullif(F.xpath_string(plain, F.lit(p)), F.lit(""))
    title = one("//Metadata/title/text()")
    gone = F.coalesce(title.rlike("REVOKED|Revoked|revoked|REPEALED|Repealed|repealed"), F.lit(False))
    return F.struct(title.alias("title"), gone.alias("revoked"), F.replace(one("/Legislation/@RestrictExtent"), F.lit("."), F.lit("")).alias("restrict_extent"), one("/Legislation/@RestrictStartDate").alias("restrict_start_date"), one("//Metadata/valid/text()").alias("dct_valid"))


def enacting_text(xml: Column) -> Column:
    """Struct of the introductory and enacting text of a law's XML and a map from footnote codes to addresses.

    A footnote stands as its code, a citation of its own between [start_ref] and [end_ref].
    """
    notes = F.regexp_replace(xml, r"<(?:\w+:)?FootnoteRef\s+Ref=\"([^\"]+)\"\s*/>", " $1 ")
    cited = F.regexp_replace(notes, r"<(?:\w+:)?Citation\s+id=\"([^\"]+)\"[^>]*>", "[start_ref]$1[end_ref]")
    part = lambda n: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(cited, rf"<(?:\w+:)?{n}\b[^>]*>([\s\S]*?)</(?:\w+:)?{n}>", 1), "<[^>]*>", " "), r"\s+", " "))
    foot = F.regexp_extract_all(xml, F.lit(r"<(?:\w+:)?Footnote\s[\s\S]*?</(?:\w+:)?Footnote>"), F.lit(0))
    noted = F.transform(foot, lambda x: F.struct(F.regexp_extract(x, r"id=\"([^\"]+)\"", 1).alias("code"), F.regexp_extract_all(x, F.lit(r"URI=\"([^\"]+)\""), F.lit(1)).alias("urls")))
    own = F.regexp_extract_all(xml, F.lit(r"<(?:\w+:)?Citation\s[^>]*>"), F.lit(0))
    cites = F.transform(own, lambda x: F.struct(F.regexp_extract(x, r"id=\"([^\"]+)\"", 1).alias("code"), F.array(F.regexp_extract(x, r"URI=\"([^\"]+)\"", 1)).alias("urls")))
    known = F.filter(F.concat(noted, cites), lambda x: x["code"] != "")
    first = F.filter(known, lambda x, i: F.array_position(F.transform(known, lambda y: y["code"]), x["code"]) == i + 1)
    return F.struct(part("IntroductoryText").alias("introductory"), part("EnactingText").alias("enacting"), F.map_from_entries(first).alias("urls"))


def extents(xml: Column) -> Column:
    """Array of (provision, extent) of a contents list; points in extents are dropped."""
    refs, codes = F.xpath(xml, F.lit("//ContentsItem[@RestrictExtent]/@ContentRef")), F.xpath(xml, F.lit("//ContentsItem[@RestrictExtent]/@RestrictExtent"))
    return F.transform(F.arrays_zip(refs.alias("provision"), codes.alias("extent")), lambda x: F.struct(x["provision"].alias("provision"), F.replace(x["extent"], F.lit("."), F.lit("")).alias("extent")))


class _Rows(HTMLParser):
    """Cells of table rows: (text, first link)."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[tuple[str, str]]] = []
        self.cell: list[str] | None = None
        self.link = ""

    def _end(self) -> None:
        if self.cell is not None and self.rows:
            self.rows[-1].append((" ".join("".join(self.cell).split()), self.link))
        self.cell, self.link = None, ""

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self._end()
            self.rows.append([])
        elif tag in ("td", "th"):
            self._end()
            self.cell = []
        elif tag == "a" and self.cell is not None and not self.link:
            self.link = dict(attrs).get("href") or ""

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self._end()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


class _Headings(HTMLParser):
    """Headings with a link, each with the paragraph that follows."""

    def __init__(self) -> None:
        super().__init__()
        self.found: list[list[str]] = []
        self.at = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("h4", "h5", "h6"):
            self.at = "h"
            self.found.append(["", "", ""])
        elif tag == "a" and self.at == "h":
            self.found[-1][1] = dict(attrs).get("href") or ""
        elif tag == "p" and self.found:
            self.at = "p"

    def handle_endtag(self, tag):
        if tag in ("h4", "h5", "h6", "p"):
            self.at = ""

    def handle_data(self, data):
        if self.at == "h":
            self.found[-1][0] += data
        elif self.at == "p":
            self.found[-1][2] += data


def _parsed(html: str | None, parser: HTMLParser) -> HTMLParser:
    parser.feed(html or "")
    parser.close()
    return parser


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, row number, texts and links of the cells of every table row."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, i, [c[0] for c in row], [c[1] for c in row]) for k, h in zip(batch[key], batch[html]) for i, row in enumerate(_parsed(h, _Rows()).rows) if row]
            yield pd.DataFrame(rows, columns=[key, "row", "cells", "links"])

    return pages.select(key, html).mapInPandas(work, f"{key} {pages.schema[key].dataType.simpleString()}, row int, cells array<string>, links array<string>")


def amendment_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Amendment edges of the nine-cell rows of a changes table: what is affected, how, by which law, applied or not."""
    cell, link = (lambda k: F.col("cells")[k]), (lambda k: F.col("links")[k])
    rows = table_rows(pages, key, html).filter(F.size("cells") == 9)
    return rows.select(key, "row", cell(0).alias("affected_title"), link(1).alias("path_of_law"), cell(2).alias("target"), cell(3).alias("affect"), cell(4).alias("title"), link(5).alias("path"), cell(6).alias("provision"), cell(7).alias("applied"), cell(8).alias("note"))


def new_laws(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Title, path, type_code, year, number and description of each law announced on a page; a paragraph belongs to the heading before it."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, " ".join(t.split()), p, " ".join(d.split())) for k, h in zip(batch[key], batch[html]) for t, p, d in _parsed(h, _Headings()).found]
            yield pd.DataFrame(rows, columns=[key, "title", "path", "md_description"])

    found = pages.select(key, html).mapInPandas(work, f"{key} {pages.schema[key].dataType.simpleString()}, title string, path string, md_description string")
    return found.select(key, "title", "path", split_path(F.col("path")).alias("s"), "md_description").select(key, "title", "path", "s.*", "md_description")


#: Types of laws of the European Union, which searches leave out.
EUROPEAN = ["eur", "eudn", "eudr"]


def search_results(pages: DataFrame, html: str, term: str) -> DataFrame:
    """Laws in the rows of search tables: name, cleaned title, path, type_code, year, number and the terms that found them.

    A row has a linked title, a number and a type; rows of European laws, and those of fewer cells (Welsh titles), are left out.
    """
    rows = table_rows(pages, term, html).filter(F.size("cells") >= 3).select(term, F.col("cells")[0].alias("title"), F.col("links")[0].alias("path"))
    parts = r"^/([a-z]+)/(\d{4})/(\d+)(?:/|$)"
    part = lambda k: F.regexp_extract("path", parts, k)
    laws = rows.filter(F.col("path").rlike(parts)).withColumns({"type_code": part(1), "year": part(2), "number": part(3)}).filter(~F.col("type_code").isin(EUROPEAN))
    named = laws.withColumns({"name": law_name(F.col("type_code"), F.col("year"), F.col("number")), "title": clean_title(F.col("title"))})
    return named.groupBy("name").agg(F.min("title").alias("title"), F.min("path").alias("path"), F.first("type_code").alias("type_code"), F.first("year").alias("year"), F.first("number").alias("number"), F.array_sort(F.collect_set(term)).alias("terms"))


def links(html: Column) -> Column:
    """Targets of the links of a page, in order."""
    return F.regexp_extract_all(html, F.lit(r"<a\s[^>]*?href=\"([^\"]*)\""), F.lit(1))

"""Rewritings of whole texts: until nothing changes, and for single laws alone."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

CONTENT, ANNEX = "[::content::]", "[::annex::]"
# Headings of lists of contents, and entries of them: on one line, or on two, of which the second is a title.
CONTENTS = r"^(?:Inhaltsverzeichnis|INHALTSVERZEICHNIS)"
ONE_LINE = [r"^§ \d+\.? [A-ZÄÖÜ]", r"^\d+\. Abschnitt: ", r"^Anhang ?\d?: [A-Z]"]
TWO_LINES = [(r"^§ \d+\.$", r"^[A-ZÄÖÜ]"), (r"^Anhang [A-Z]:$", r"^[^\[\n]")]

_CONTENTS, _ONE_LINE = re.compile(CONTENTS), re.compile("|".join(ONE_LINE))
_TWO_LINES = [(re.compile(p), re.compile(q)) for p, q in TWO_LINES]


def fixpoint(text: str, rules: list[tuple[str, str]]) -> str:
    """The text rewritten by the first rule that changes it, again and again, until none does. Rules that go round in circles raise."""
    seen = set()
    while True:
        new = next((n for p, to in rules if (n := re.sub(p, to, text, flags=re.M)) != text), None)
        if new is None:
            return text
        if new in seen:
            raise ValueError("the rules make a text again that they have left")
        seen.add(text)
        text = new


def contents_marked(text: str) -> str:
    """Entries of lists of contents marked: those that follow the heading, or another entry, at once.

    An entry is marked if the line before it is; so marks spread from a heading line by line, which one walk over the lines does.
    """
    rows, out, k, inside = text.split("\n"), [], 0, False
    while k < len(rows):
        row, following = rows[k], rows[k + 1] if k + 1 < len(rows) else None
        if _CONTENTS.match(row):
            inside, row = True, CONTENT + row
        elif row.startswith(CONTENT):
            inside = True
        elif inside and _ONE_LINE.match(row):
            row = CONTENT + row
        elif inside and following is not None and not _CONTENTS.match(following) and any(p.match(row) and q.match(following) for p, q in _TWO_LINES):
            row, k = f"{CONTENT}{row} {following}", k + 1
        else:
            inside = False
        out.append(row)
        k += 1
    return "\n".join(out)


@F.pandas_udf(StringType())
def with_contents(texts: pd.Series) -> pd.Series:
    """Texts with the entries of their lists of contents marked; null stays null."""
    return pd.Series([None if t is None else contents_marked(t) for t in texts])


def without_annex_bodies(lines: DataFrame, key: str, line: str = "line", text: str = "text") -> DataFrame:
    """Lines without what follows a tagged heading of an annex, up to the next one or the end: the headings stay."""
    heading = F.coalesce(F.col(text).startswith(ANNEX), F.lit(False))
    begun = F.max(heading).over(Window.partitionBy(key).orderBy(line).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return lines.withColumns({"_heading": heading, "_begun": begun}).filter("_heading OR NOT _begun").drop("_heading", "_begun")


def patched(texts: DataFrame, patches: DataFrame, law: str, text: str = "text") -> DataFrame:
    """Texts with the patches of their own law applied in order; the texts of other laws are not looked at.

    patches: the law, ord, pattern and replacement (as regexp_replace takes them), one row a patch. They are gathered by law,
    so a law meets one row; nulls stay null.
    """
    item = F.struct("ord", "pattern", "replacement")
    own = patches.groupBy(law).agg(F.array_sort(F.collect_list(item)).alias("_patches"))
    step = lambda s, p: F.regexp_replace(s, p["pattern"], p["replacement"])
    c: Column = F.when(F.col("_patches").isNull(), F.col(text)).otherwise(F.aggregate("_patches", F.col(text), step))
    return texts.join(own, law, "left").withColumn(text, c).drop("_patches")

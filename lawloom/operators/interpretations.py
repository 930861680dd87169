"""Defined terms of laws: which provisions define, the terms and their definitions, and how a register takes them up."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.titles import first_match, rewritten
from .fuzzy import bag_similarity

# Phrases that tell the scope of a definition, in the order in which they are tried.
SCOPES = [
    ("[Ff]or these purposes|[Ii]n these [Rr]egulations|[Ii]n this [Oo]rder", "law"),
    (r"[Ff]or the purposes? of this (?:[Rr]egulation|[Oo]rder|[Aa]rticle)|[Ff]or the purposes? of paragraph \(\d+\)|for this purpose|In (?:subsection|paragraph) \(\d+\)|[Ii]n (?:this|that) (?:[Rr]egulation|[Oo]rder|[Aa]rticle)|[Ss]ection|[Ss]ubsection", "provision"),
    ("In this [Pp]art", "part"),
]
# Phrases of provisions that change other texts and define nothing themselves.
CHANGING = "substitute—|substitute–|” substitute “|inserte?d?:?—"
# Definitions that refer to another law.
REFERRING = [
    r"has?v?e? the meanings? (?:in|they bear|that it bears|assigned|given|respectively assigned).*(?:in the|to the|of the|of).*(?:Act|Regulation|Order)",
    r"has?v?e? the same meanings? (?:as in|as in the|given|assigned).*(?:Act|Regulation|Order)",
    r"has?v?e? the respective meanings? (?:as in|as in the|given|assigned).*(?:Act|Regulation|Order)",
    r"(?:is to be|shall) be construed (?:as provided|in accordance).*(?:of the|of).*(?:Act|Regulation|Order)",
    r"as defined by.*(?:Act|Regulation|Order)",
]
# What may follow a definition.
_ENDS = [r"\.$", r"[,;][ ]?\n(?:[ ]?“|the[ ]“|\([a-z]\)[ ](?:the[ ]|any reference to a[ ])?“)", r"[,;][ ]and[ ]?\n[ ]?“", r"\.[ ]\n“", r"[ ]\n“", r"[ ]\n[ ]“", r". . .\n“"]


def scope(text: Column) -> Column:
    return first_match(text, SCOPES, F.lit(""))


def refers_to_law(definition: Column) -> Column:
    return F.coalesce(definition.rlike("|".join(f"(?:{p})" for p in REFERRING)), F.lit(False))


def clean_term(term: Column) -> Column:
    return F.lower(rewritten(term, [("^the ", ""), ("^a ", "")]))


def clean_definition(definition: Column) -> Column:
    """Trimmed; marks at its end, empty parentheses and note codes go."""
    return F.trim(F.regexp_replace(F.trim(definition), r"(?:\s*(?:[,;.(]|\( ?\)| [MF]\d+))+$", ""))


def defining(records: DataFrame, key: list[str], seq: str) -> DataFrame:
    """Provisions that may define, and whether they stand in an interpretation section (`inter`).

    records: type and text. The last heading or section before a provision decides; provisions that change other texts are left out.
    """
    opens = F.when(F.col("type") == "heading", F.col("text").rlike("[Ii]nterpretation")).when(F.col("type") == "section", F.col("text").rlike("[Ii]nterpretation|Application"))
    run = Window.partitionBy(*key).orderBy(seq)
    rows = records.withColumn("inter", F.coalesce(F.last(opens, ignorenulls=True).over(run), F.lit(False)))
    rows = rows.filter(F.col("type").isin("article", "sub-article", "sub-section") & ~F.coalesce(F.col("text").rlike(CHANGING), F.lit(False)))
    return rows.withColumn("text", F.regexp_replace("text", " ?📌", "\n"))


def _patterns(welsh: bool) -> list[re.Pattern]:
    """Three terms, two terms, one term, each with what follows up to an end that the next one may need."""
    term = "“([^”\\n]*)”" + (" \\(“([^”\\n]*)”\\)" if welsh else "")
    end = rf"([\s\S]*?)(?=(?:{'|'.join(_ENDS)}))"
    return [re.compile(f"{term}, {term} and {term} {end}", re.M), re.compile(f"{term} and {term} {end}", re.M), re.compile(f"{term}[, ]{end}", re.M)]


def definitions(welsh: bool = False):
    """An Arrow function from texts to their (term, welsh, definition): a match goes out of the text before shorter patterns look."""
    kind = "array<struct<term:string,welsh:string,definition:string>>"

    def find(texts: pd.Series) -> pd.Series:
        patterns = _patterns(welsh)

        def one(text: str | None) -> list[dict]:
            text = re.sub(r"\(fn\d*\)|\[F[0-9]*|\]", "", text or "").replace("📌", "\n").strip()
            found = []
            for p in patterns:
                matches = list(p.finditer(text))
                for m in matches:
                    *terms, definition = m.groups()
                    if definition:
                        named = zip(terms[::2], terms[1::2]) if welsh else ((x, None) for x in terms)
                        found += [{"term": a, "welsh": b, "definition": definition.strip()} for a, b in named]
                for m in matches:
                    text = text.replace(m[0], "")
            return found

        return texts.map(one)

    return F.pandas_udf(find, kind)


def defined_terms(records: DataFrame, key: list[str], seq: str, welsh: bool = False) -> DataFrame:
    """The terms that a law defines: key, seq, inter, term, welsh, definition, scope and whether it refers to another law."""
    rows = defining(records, key, seq)
    found = rows.select(*key, seq, "inter", scope(F.col("text")).alias("scope"), F.inline(definitions(welsh)(F.col("text"))))
    out = found.withColumns({"term": clean_term(F.col("term")), "definition": clean_definition(F.col("definition"))})
    return out.withColumn("refers", refers_to_law(F.col("definition")))


#: Definitions at least so similar, by bag distance, are the same.
SAME = 0.9


def taken_up(found: DataFrame, register: DataFrame) -> DataFrame:
    """What a register does with each found (term, law, definition): action and the id of the register row that it concerns.

    register: id, term, definition and laws (an array). none: the law defines the term so already; update: it is the only
    law of a row whose definition differs; split: it is one of several laws of such a row, so it leaves the row and a new
    one is made; link: another row has the definition, and the law joins it; create: there is no such row.
    """
    rows = found.select("term", "law", "definition")
    pairs = rows.join(register.select("id", "term", F.col("definition").alias("known"), "laws"), "term")
    a, b = F.length("definition"), F.length("known")
    may_be = (F.col("definition") != F.col("known")) & (F.greatest(a, b) - F.least(a, b) < (1 - SAME) * F.greatest(a, b))  # lengths alone rule out most
    like = pairs.filter(may_be).select("definition", "known").distinct()
    like = like.filter(bag_similarity(F.col("definition"), F.col("known")) > SAME).withColumn("like", F.lit(True))
    same = (F.col("definition") == F.col("known")) | F.coalesce("like", F.lit(False))
    scored = pairs.join(like, ["definition", "known"], "left").withColumns({"same": same, "own": F.array_contains("laws", F.col("law"))})
    action = F.when(F.col("own") & F.col("same"), F.lit(0)).when(F.col("own") & (F.size("laws") == 1), F.lit(1)).when(F.col("own"), F.lit(2)).when(F.col("same"), F.lit(3))
    best = scored.withColumn("rank", action).filter("rank IS NOT NULL").groupBy("term", "law", "definition").agg(F.min(F.struct("rank", "id")).alias("b"))
    names = F.array(*map(F.lit, ["none", "update", "split", "link"]))
    joined = rows.distinct().join(best, ["term", "law", "definition"], "left")
    return joined.select("term", "law", "definition", F.coalesce(F.get(names, F.col("b.rank")), F.lit("create")).alias("action"), F.col("b.id").alias("id"))

"""What rules of applicability are about: persons, processes, places, plant and their properties, as fields.

A template is an order of fields. Each field stands for the phrases that it may be, in the
order in which they are tried, and anything but a line end may come between; the first
template that a rule holds gives its fields. Rules that apply and rules that do not are read
from their verb on, qualified ones as a whole.

As one regular expression, a template backtracks over every gap. Here the phrases are written
out once, those of a rule are found once, and a template walks over what was found: if the
rest of a template fails from some place on, it fails from all later ones. So a rule takes
time in proportion to its length. The walk is one Arrow function; all that follows from the
phrases is Spark's own.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.identities import lookup
from ..functions.spread import spread
from ..functions.titles import slug
from .fuzzy import jaro
from .rules import DISAPPLIES, OUTSIDE, fit_id, persons, processes, rule_scope

# Phrases of each field, in the order in which they are tried.
PHRASES = {
    "person": [
        "individual", "(?:any other )?person at work", "master (?:or (?:a )?|and )crew of a (?:sea-going )?ship,? or to the employer of (?:such )?persons", "employer of (?:such )?persons",
        "persons who are not (?:his|its) employees", "persons who are not employees of that employer", "person other than a self-employed person or relevant self-employed person", "self-employed(?: person)?",
        "persons?", "people", "worker", "employees?", "employer", "contractor", "sub-contractor", "subcontractor", "sub contractor", "agency worker", "agency-worker", "agency",
    ],
    "person_verb": [
        "affected by", "present", "carried out by", "exposure to", "engaged in", "control to any extent of",
        "supplied by him by way of sale, agreement for sale or hire-purchase agreement", "provided for use or used", "used",
    ],
    "person_ii": ["employer of (?:such )?persons", "employer", "person at work", "person under his control", "persons?"],
    "person_ii_verb": ["affected by", "carried out by", "uses or supervises or manages the use of"],
    "process": [
        "work in compressed air which is construction work", "construction work", "work activity", "activity", "work involves any of the relevant operations (?:in dock premises|in a shipyard)", "used on or off the ship",
        "uses?d? at work", "work", "construction, reconstruction, alteration, repair, maintenance, cleaning, demolition and dismantling of any building or other structure not being a vessel",
        "construction, reconstruction, finishing, refitting, repair, maintenance, cleaning or breaking up", "passage through territorial waters", "diving (?:project|operation)",
        "normal ship-?board activities(?: of a ship's crew)?", "risk assessment", "fish loading", "loading, unloading, fuelling or provisioning", "(?:specified )?operation", "designs, manufactures, imports or supplies",
        "designs or manufactures", "air monitoring", "health surveillance", "information and training", "information, instruction and training", "dealing with accidents",
        "supply of any dangerous substance, preparation, product or equipment", "transport by road, rail, inland waterway, sea or air", "regulating road, rail, inland waterway, sea or air traffic",
    ],
    "place": [
        "construction site", "outside Great Britain", "Great Britain", "outside-gb", "territorial waters", "workplace on a construction site", "(?:work)?place (?:located )?below ground (?:at|in) a mine",
        "workplace located above ground at a mine that is a tip", "mines", "workplace which is or is in or on a ship", "ship in dock premises",
        "workplace which is in fields, woods or other land forming part of an agricultural or forestry undertaking",
        "workplace which is or is in or on an aircraft, locomotive or rolling stock, trailer or semi-trailer used as a means of transport", "drivers' cabs or control cabs for vehicles or machinery", "(?:premises|workplace)",
    ],
    "plant": [
        "vessels", "asbestos", "installation", "ship's work equipment", "ship", "work equipment", "pressure system, or any article which is intended to be a component part of any pressure system", "pressure system",
        "window typewriters", "calculators, cash registers or any equipment having a small data or measurement display required for direct use of the equipment", "portable systems", "display screen equipment", "signs", "dangerous goods",
    ],
    "property": [
        "registered outside the United Kingdom", "set aside for purposes other than", "where the work is (?:being )?carried out", "sporadic and of low intensity", "fighting a fire or in an emergency", "whether at work or not", "at work",
        "indoors", "carried out solely by (?:a ship's|the) crew under the direction of the master", "not liable to expose persons at work other than the master and crew to a risk to their safety",
        r"trade, business or other undertaking carried on by him \(whether for profit or not\)", "matters within his control", "not in prolonged use", "on board a means of transport",
    ],
}
# The templates, in the order in which they are tried.
TEMPLATES = [
    "person person_verb person_ii person_ii_verb plant", "person person_verb place property", "person process plant property", "person person_verb plant process", "process plant person property",
    "process person_verb person place", "process person_verb plant person", "person_verb plant person property", "plant person_verb person process", "person person_verb plant", "person person_verb place",
    "person process property", "person process plant", "person plant person_verb", "person plant process", "person place property", "plant property process", "plant person_verb process", "plant person property",
    "place property process", "process plant person", "person plant", "person process", "plant process", "plant person_verb", "process person", "process plant", "place process", "place", "plant", "process", "person",
]
# Templates of like duties, tried after all others of rules that apply, and what stands before them.
LIKE_DUTIES = ["person_ii property person_ii_verb process person_verb person", "person_ii person_ii_verb process person_verb person"]
LIKE_DUTY = "(?:he|employer) (?:is|must|shall).*?under a like duty in respect of"
# Fixed value: a rule that holds this is read as a whole.
QUALIFIED = "Any requirement or prohibition imposed"
# Names that much the same words are given.
STANDARD_PROCESS, STANDARD_PROPERTY = "normal-ship-board-activities", "carried-out-solely-by-the-crew-under-the-direction-of-the-master"
LIKE = 0.8
FIELDS = list(PHRASES)


#: What stands before the fields of a rule of each kind; the earliest end of it counts.
BEFORE = {"applies-to": [r" (?:apply|extend).*?(?:to|within|in|outside)"], "disapplies-to": [DISAPPLIES], "qualified": [""]}


def written_out(pattern: str) -> list[str]:
    """The phrases of a pattern of letters, groups of alternatives and optional parts, in the order in which it tries them."""
    at = 0

    def alternatives() -> list[str]:
        nonlocal at
        found, sequence = [], [[""]]
        while at < len(pattern) and pattern[at] != ")":
            if pattern.startswith("(?:", at):
                at += 3
                item = alternatives()
                at += 1
            elif pattern[at] == "|":
                found += map("".join, product(*sequence))
                sequence, at = [[""]], at + 1
                continue
            else:
                at += pattern[at] == "\\"
                item, at = [pattern[at]], at + 1
            if at < len(pattern) and pattern[at] == "?":
                item, at = [*item, ""], at + 1
            sequence.append(item)
        return found + list(map("".join, product(*sequence)))

    return list(dict.fromkeys(alternatives()))


@lru_cache(1)
def _phrases() -> dict[str, list[str]]:
    return {f: list(dict.fromkeys(x for p in ps for x in written_out(p))) for f, ps in PHRASES.items()}


class Found:
    """Where the phrases of each field stand in a line: the starts in order, and the ends at each start in the order of the phrases."""

    def __init__(self, line: str):
        self.line, self.fields = line, {}

    def of(self, field: str) -> tuple[list[int], dict[int, list[int]]]:
        if field not in self.fields:
            ends: dict[int, list[int]] = {}
            for phrase in _phrases()[field]:
                start = self.line.find(phrase)
                while start >= 0:
                    ends.setdefault(start, []).append(start + len(phrase))
                    start = self.line.find(phrase, start + 1)
            self.fields[field] = sorted(ends), ends
        return self.fields[field]

    def walk(self, fields: list[str], start: int) -> list[str] | None:
        """The phrases of the fields in their order from start on, or None: the earliest start of each, the first phrase there."""
        out: list[str] = []
        hopeless = [len(self.line) + 1] * (len(fields) + 1)  # from here on, the fields from k on are not to be found

        def rest(k: int, start: int) -> bool:
            if k == len(fields):
                return True
            if start >= hopeless[k]:
                return False
            starts, ends = self.of(fields[k])
            for at in starts[bisect_left(starts, start) :]:
                for end in ends[at]:
                    out.append(self.line[at:end])
                    if rest(k + 1, end):
                        return True
                    out.pop()
            hopeless[k] = start
            return False

        return out if rest(0, start) else None


@lru_cache(256)
def _before(pattern: str) -> re.Pattern:
    return re.compile(pattern)


def captured(rule: str, kind: str) -> tuple[list[str], list[str]] | None:
    """Fields and phrases of the first template that the rule holds; kind: applies-to, disapplies-to or qualified."""
    ways = [(TEMPLATES, BEFORE[kind][0])] + ([(LIKE_DUTIES, LIKE_DUTY)] if kind == "applies-to" else [])
    lines = [Found(x) for x in rule.split("\n")]
    for templates, before in ways:
        after = [(line, m.end()) for line in lines if (m := _before(before).search(line.line))]
        for template in templates:
            for line, start in after:
                if (found := line.walk(template.split(), start)) is not None:
                    return template.split(), found
    return None


@F.pandas_udf(StructType([StructField("fields", ArrayType(StringType())), StructField("phrases", ArrayType(StringType()))]))
def _captured(rules: pd.Series, kinds: pd.Series) -> pd.DataFrame:
    """Fields and phrases of the first template that each rule holds; nulls if there is none."""
    out = [(rule is not None and kind is not None and captured(rule, kind)) or (None, None) for rule, kind in zip(rules, kinds)]
    return pd.DataFrame(out, columns=["fields", "phrases"])


@F.pandas_udf(ArrayType(StringType()))
def _standard(values: pd.Series, standards: pd.Series) -> pd.Series:
    return pd.Series([None if v is None else [s if jaro(x, s) > LIKE else x for x in v] for v, s in zip(values, standards)])


def parsed(rules: DataFrame, rule: str = "rule", kind: str = "category") -> DataFrame:
    """The rows with the columns pattern (fields in angle brackets) and FIELDS; all null where no template fits.

    person, process and place are lists, the other fields single names. A null category gives nulls.
    """
    text, category = F.col(rule), F.col(kind)
    read = F.when(category.isin("applies-to", "disapplies-to"), F.when(text.rlike(QUALIFIED), "qualified").otherwise(category))
    out = spread(rules).withColumn("_captured", _captured(text, read))
    at = lambda f: F.array_position("_captured.fields", f)
    phrase = lambda f: F.when(at(f) > 0, F.element_at("_captured.phrases", at(f).cast("int")))
    none = F.when(F.col("_captured.fields").isNotNull(), F.array().cast("array<string>"))
    listed = lambda f, made: F.when(phrase(f).isNotNull(), made).otherwise(none)
    fields = {"pattern": F.transform("_captured.fields", lambda x: F.concat(F.lit("<"), x, F.lit(">")))}
    fields |= {"person": listed("person", persons(phrase("person"))), "place": listed("place", F.array(slug(phrase("place")))), "process": _standard(listed("process", processes(phrase("process"))), F.lit(STANDARD_PROCESS))}
    fields |= {"property": F.element_at(_standard(F.array(slug(phrase("property"))), F.lit(STANDARD_PROPERTY)), 1)}
    return out.withColumns(fields | {f: slug(phrase(f)) for f in FIELDS if f not in fields}).drop("_captured")


def outside_great_britain(fits: DataFrame, rule: str = "rule", kind: str = "category", heading: Column | None = None) -> DataFrame:
    """Fits of rules that apply outside Great Britain: what they apply to there names the process, the place and the category."""
    beyond = r"^.*?shall.*?apply(.*?)? outside Great Britain.*$"
    titled = F.lit(False) if heading is None else F.coalesce(F.contains(heading, F.lit("extension outside great britain")), F.lit(False))
    about = F.array_contains("place", "outside-great-britain") | titled | F.contains(F.col(rule), F.lit("Great Britain"))
    out = fits.withColumn("_activity", F.when(F.col("pattern").isNotNull() & about & F.col(rule).rlike(beyond), F.trim(F.regexp_extract(rule, beyond, 1))))
    activity = F.col("_activity")
    known = F.coalesce(activity.isin(list(OUTSIDE)), F.lit(False))
    return out.withColumns({
        "pattern": F.when(activity == "", F.array(F.lit("<place>"))).when(activity != "", F.array(F.lit("<process>"), F.lit("<place>"))).otherwise(F.col("pattern")),
        "process": F.when(activity != "", F.array(lookup(OUTSIDE, activity, F.lit("other")))).otherwise(F.col("process")),
        "place": F.when(known, F.array(F.lit("outside-great-britain"))).otherwise(F.col("place")),
        kind: F.when(known, "extends-to").otherwise(F.col(kind)),
    }).drop("_activity")


def _listed(fields: dict[str, Column]) -> dict[str, Column]:
    lists = ("person", "process", "place", "provision")
    return {f: c if f in lists else F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(c)) for f, c in fields.items()}


def fit_text(kind: Column, pattern: Column, fields: dict[str, Column]) -> Column:
    """The category and each field of the pattern, a line each: lists in brackets, names in quotes, nil for none."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    lists = ("person", "process", "place")
    values = {f: F.concat(F.lit("["), F.array_join(F.transform(c, quoted), ", "), F.lit("]")) if f in lists else F.coalesce(quoted(c), F.lit("nil")) for f, c in fields.items()}
    told = F.create_map(*[x for f, c in values.items() for x in (F.lit(f"<{f}>"), c)])
    lines = F.transform(pattern, lambda p: F.concat(p, F.lit(": "), F.coalesce(F.try_element_at(told, p), F.lit("nil"))))
    return F.concat_ws("\n", F.concat(F.lit("category: "), kind), F.array_join(lines, "\n"))


def fitnesses(rules: DataFrame, heading: Column | None = None) -> DataFrame:
    """Of rules (rule, category, provision, provision_number): pattern, FIELDS, fit_id, ppp, scope and whether they are matched.

    The provisions that a rule names come first in its pattern. Rules without a category are left out; those that no
    template fits stay, unmatched, with null fields.
    """
    found = outside_great_britain(parsed(rules.filter("category IS NOT NULL")), heading=heading)
    named = F.coalesce(F.size("provision") > 0, F.lit(False))
    found = found.withColumn("pattern", F.when(named, F.concat(F.array(F.lit("<provision>")), "pattern")).otherwise(F.col("pattern")))
    matched, fields = F.col("pattern").isNotNull(), {f: F.col(f) for f in FIELDS}
    ids = fit_id(F.col("category"), F.col("pattern"), _listed(fields | {"provision": F.col("provision")}))
    text = fit_text(F.col("category"), F.col("pattern"), fields)
    scope = rule_scope(F.col("provision_number"))  # by number, also where a rule applies outside Great Britain
    return found.withColumns({"fit_id": F.when(matched, ids), "ppp": F.when(matched, text), "scope": scope, "matched": matched})

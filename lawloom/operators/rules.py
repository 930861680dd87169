"""Rules of applicability: cutting the text of a provision into single rules, the provisions that they name, and what they fit."""

from __future__ import annotations

import logging
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.identities import lookup
from ..functions.titles import rewritten, slug

# Phrases by which a rule applies, or does not.
APPLIES = "(?<!Nothing).*?(?:shall|doe?s?)? (?:also )?(?:apply|extend).*?(?:only )?(?:to|within|in|outside)"
DISAPPLIES = "(?:shall|doe?s?) not (?:apply|extend|impose) (?:to|where|any)"
# Tags of persons by the words for them.
PERSONS = {"persons": "person", "persons-who-are-not-its-employees": "x-employee", "persons-who-are-not-his-employees": "x-employee", "persons-who-are-not-employees-of-that-employer": "x-employee"}
CREW = ["master-of-a-ship", "crew-of-a-ship", "employer-of-such-persons"]
# What a law applies to outside Great Britain, and the process that this is.
OUTSIDE = {"to and in relation to any activity": "activity", "to and in relation to the premises and activities": "premises-activity", "to any work": "work"}
# Marks of amendments in texts, and what becomes of them.
MARKS = [(r"\[F\d+ (.*)\]$", "$1"), (r" \[F\d+ (.*) \] ,", " $1,"), (r"[\[\]]", ""), (r"F\d+", "")]


def heading_tag(heading: Column) -> Column:
    """A heading in lower case, without amendment marks."""
    return F.lower(F.trim(rewritten(heading, MARKS)))


def heading_key(heading: Column) -> Column:
    return F.replace(F.regexp_replace(heading_tag(heading), r"\p{Punct}", ""), F.lit(" "), F.lit("-"))


def clean_rule(text: Column) -> Column:
    """A rule without marks, its number and notes; line marks become lines."""
    notes = [(r"^[^A-Z]*([A-Z])", "$1"), (" ?📌", "\n"), (r"\(fn\d+\) ?", ""), ("–", "—"), ("’", "'")]
    return F.trim(rewritten(F.trim(rewritten(F.trim(text), MARKS)), notes))


def _capital(text: str) -> str:
    return text[:1].upper() + text[1:]


def _period(text: str) -> str:
    return text.rstrip(".") + "."


# Cuts: each takes a rule and gives the rules that it stands for, or None if it has nothing to cut.


def _such(rule: str) -> list[str] | None:
    """"In respect of any X, ... shall apply to such X": such X is the X of the text before."""
    m = re.search(r"(?:apply|extend only) to such (?:a )?(.*?) (?:or (.*?) )?", rule)
    if not m:
        return None
    first, second = m.groups()
    subject = re.escape(first) + (f",? or (?:any )?{re.escape(second)}" if second else "")
    clause = re.search(rf"(?:any|in respect of)(.*?{subject}.*?),? shall (?:apply|extend only)", rule) or re.search(rf"({subject} which is.*?,)", rule)
    if not clause:
        return None
    new = re.sub(rf"such (a )?{subject}", lambda x: (x[1] or "") + clause[1].strip(), rule)
    return None if new == rule else [new]


def _but(rule: str) -> list[str] | None:
    """"X shall apply to a but not to b" is a rule for each side, with the same subject."""
    if " but " not in rule:
        return None
    m = re.search(r"(.*?)((?: (?:shall|doe?s?) not| (?:shall|does)|, to the)? (?:extend?t?|apply)[\s\S]*)", rule)
    if not m:
        return None
    sides = re.split(r",? but ", m[2], maxsplit=1)
    return [f"{m[1]} {s.strip()}" for s in sides] if len(sides) == 2 else None


def _exception(text: str, word: str) -> list[str]:
    """"X shall not extend to a unless b": the rule, and its opposite for b."""
    m = re.search(r".*?(?:shall|do) not extend to", text)
    if word not in text or not m:
        return [text]
    opposite = m[0].replace("shall not", "shall") if "shall not" in m[0] else m[0].replace("do not", "do")
    parts = re.split(rf",? {word}", text, maxsplit=1)
    return [parts[0], opposite + parts[1]] if len(parts) == 2 else [text]


def _items(rule: str) -> list[str] | None:
    """A leader ending in a dash, and a list of lettered or numbered items: a rule for each item."""
    leader, dash, rest = rule.partition("—\n")
    if not dash:
        return None
    items, tail = re.split(r"(?<=[^—])\n\([a-z]\) ", rest), ""
    if len(items) > 1:
        items = [re.sub(r"(?:;|,)? (?:or|and)$", ".", re.sub(r"^\([a-z]\) ", "", x)) for x in items]
    else:
        m = re.search(r"\n([^(\n].*)$", rest)
        if m:
            rest, tail = rest[: m.start()], " " + m[1]
        items = re.split(r"(?<=[^—])\n\([ivx]+\) ", rest)
        if len(items) == 1:
            return None
        items = [re.sub(r"(?:;|,)? (?:or|and)$", "", re.sub(r"^\([ivx]+\) ", "", x)) for x in items]
    items = [y for x in items for y in _exception(x, "unless")]
    items = [y for x in items for y in _exception(x, "other than")]
    if "except" in leader:
        main, exception = (re.split(r",? except ", leader, maxsplit=1) + [""])[:2]
        out = [main, *(f"{exception} {x}{tail}" for x in items)]
    else:
        out = [f"{leader} {x}{tail}" for x in items]
    return [_period(x) for x in out]


def _save_that(rule: str) -> list[str] | None:
    """"X shall not apply to a Y Z, save that it ...": the rule, and what is saved, with X or Y Z in full."""
    m = re.search(r"(.*?) (?:shall|does) not apply to a (.*?),? (?:save|except) that ", rule)
    if not m:
        return None
    head, tail = re.split(r",? (?:save|except) that ", rule, maxsplit=1)
    if re.search(r"apply to it|^it", tail):
        tail = tail.replace("it", m[1], 1)
    elif such := re.search(r"appl(?:y|ies) to (?:any )?such (?:a )?(.*?)[ .]", tail):
        own = re.search(rf"{re.escape(such[1])} (.*)", m[2])
        if own:
            tail = tail.replace(f"to such a {such[1]}", f"to a {such[1]} {own[1]}".replace("but", "_but_"))
    return [_capital(head), _capital(tail)]


def _as_respects(rule: str) -> list[str] | None:
    """"As respects any X Z, regulation n applies to any such X": regulation n applies to an X Z."""
    such = re.search(r"As respects any .*? to (?:any )?such (?:a )?(.*?)[ .]", rule)
    if not such:
        return None
    own = re.search(rf"As respects any {re.escape(such[1])} (.*?),? regulation", rule)
    if not own:
        return None
    rest = rule.split("regulation", 1)[1]
    full = f"to a {such[1]} {own[1]}".replace("but", "_but_")
    return ["Regulation" + re.sub(rf"to (?:any )?such (?:a )?{re.escape(such[1])}", lambda _: full, rest)]


def _except(rule: str) -> list[str] | None:
    sides = re.split(r",? except (?:that )?", rule, maxsplit=1)
    return sides if len(sides) == 2 else None


CUTS = (_such, _but, _items, _save_that, _as_respects, _except)
#: A text that is cut deeper than this is left as it is by then, with a warning; a cut that makes its own rule again ends earlier.
DEEPEST = 50


def separate(rule: str, depth: int = DEEPEST) -> list[str]:
    """The single rules of a text, tidied, in order and once each."""
    if not depth:
        logging.getLogger(__name__).warning("cuts of a rule do not end: %s", rule[:200])
    for cut in CUTS if depth else ():
        parts = cut(rule)
        if parts and parts != [rule]:
            return list(dict.fromkeys(x for p in parts for x in separate(p, depth - 1)))
    text = re.sub("^that the", "the", rule.strip())
    text = _period(_capital(text)).replace("_but_", "but")
    return [text.replace("Nothing in these Regulations shall apply to or in relation to", "These Regulations shall not apply to or in relation to")]


@F.pandas_udf(ArrayType(StringType()))
def separated(rules: pd.Series) -> pd.Series:
    return rules.map(lambda r: separate(r) if r else [])


def provision_numbers(rule: Column) -> Column:
    """Numbers of provisions that a rule is about: those before its verb; ranges such as 3 to 6 in full; (2) after 7(1) is 7(2)."""
    before = F.regexp_extract(rule, r"^([\s\S]*?)(?: do not | shall not | shall | )?(?:appl|extend to|have effect)", 1)
    spans = F.regexp_extract_all(before, F.lit(r"\d+ to \d+"), F.lit(0))
    ends = F.transform(spans, lambda s: F.transform(F.split(s, " to "), lambda x: x.cast("int")))
    full = F.flatten(F.transform(ends, lambda e: F.transform(F.when(e[0] <= e[1], F.sequence(e[0], e[1])).otherwise(F.array(e[0])), lambda x: x.cast("string"))))
    single = F.regexp_extract_all(before, F.lit(r"\d+\(?\d*[A-Z]?\)?\(?[a-z]?\)?"), F.lit(0))
    start = F.struct(F.array().cast("array<string>").alias("all"), F.lit("").alias("major"))

    def step(s: Column, x: Column) -> Column:
        inner = x.rlike(r"^\d+\)")
        value = F.when(inner, F.concat(s["major"], F.lit("("), x)).otherwise(x)
        return F.struct(F.concat(s["all"], F.array(value)).alias("all"), F.when(inner, s["major"]).otherwise(F.regexp_extract(x, r"^\d+", 0)).alias("major"))

    return F.when(F.size(spans) > 0, full).otherwise(F.aggregate(single, start, step, lambda s: s["all"]))


def category(rule: Column) -> Column:
    return F.when(rule.rlike(DISAPPLIES), "disapplies-to").when(rule.rlike(APPLIES), "applies-to")


def rule_scope(numbers: Column) -> Column:
    return F.when(F.coalesce(F.size(numbers) > 0, F.lit(False)), "Part").otherwise("Whole")


def persons(words: Column) -> Column:
    """Tags of the persons that a phrase names."""
    tag = slug(words)
    return F.when(tag.startswith("master"), F.array(*map(F.lit, CREW))).otherwise(F.array(lookup(PERSONS, tag, tag)))


def processes(words: Column) -> Column:
    """Tags of processes: lists and alternatives are cut; "on or off" is both."""
    each = F.flatten(F.transform(F.split(words, " and "), lambda x: F.split(x, ", ")))
    both = F.flatten(F.transform(each, lambda x: F.when(x.rlike(".* on or off .*"), F.array(F.replace(x, F.lit(" on or off "), F.lit(" on ")), F.replace(x, F.lit(" on or off "), F.lit(" off ")))).otherwise(F.array(x))))
    return F.transform(F.flatten(F.transform(both, lambda x: F.split(x, " or "))), slug)


def split_and(words: Column) -> Column:
    """"a of b and c" as "a of b" and "a of c"; "a, b and c" as its parts."""
    head, tail = F.regexp_extract(words, r"^([\s\S]*?) and [\s\S]*$", 1), F.regexp_extract(words, r"^[\s\S]*? and ([\s\S]*)$", 1)
    bare = F.regexp_replace(head, "^which relate respectively to ", "")
    lead = F.regexp_extract(head, r"^.*? of", 0)
    cut = F.when(head.startswith("which relate respectively to ") | (lead == ""), F.concat(F.split(bare, ", "), F.array(tail))).otherwise(F.array(head, F.concat(lead, F.lit(" "), tail)))
    return F.when(F.contains(words, F.lit(" and ")), cut).otherwise(F.array(words))


def fit_id(kind: Column, pattern: Column, fields: dict[str, Column]) -> Column:
    """The category and, in the order of the pattern, the values of the fields that it names as <field>."""
    values = F.create_map(*[x for k, v in fields.items() for x in (F.lit(f"<{k}>"), F.array_join(v, ":"))])
    return F.concat_ws("|", kind, F.array_join(F.transform(pattern, lambda p: F.coalesce(F.try_element_at(values, p), F.lit(""))), "|"))


def outside_gb(rules: DataFrame, law: str) -> DataFrame:
    """What laws apply to outside Great Britain: law, rule, category and process; a law without such a rule gets a row that says so."""
    activity = F.trim(F.regexp_extract("rule", r"^.*?shall.*?apply(.*?) outside Great Britain.*$", 1))
    found = rules.filter(F.col("rule").rlike(r"^.*?shall.*?apply.*? outside Great Britain")).select(law, "rule", activity.alias("activity"))
    found = found.withColumn("process", F.when(F.col("activity") != "", lookup(OUTSIDE, F.col("activity"), F.lit("other"))))
    found = found.select(law, "rule", F.when(F.col("activity").isin(list(OUTSIDE)), "extends-to").alias("category"), "process")
    extends = found.filter("category = 'extends-to'").select(law).distinct()
    rest = rules.select(law).distinct().join(extends, law, "left_anti")
    none = rest.select(law, F.lit("Does not extend outside Great Britain").alias("rule"), F.lit("does-not-extend-to").alias("category"), F.lit(None).cast("string").alias("process"))
    return found.unionByName(none)


def single_rules(provisions: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """The single rules of provisions, with their category, the provisions that they name and their scope."""
    cut = provisions.select(*key, F.posexplode(separated(clean_rule(F.col(text)))).alias("k", "rule"))
    out = cut.withColumn("provision_number", provision_numbers(F.col("rule")))
    return out.withColumns({"category": category(F.col("rule")), "scope": rule_scope(F.col("provision_number"))})


def with_headings(rules: DataFrame, headings: DataFrame, law: str) -> DataFrame:
    """Rules with the headings (law, number, text) of the provisions that they name, in the order of their numbers."""
    each = rules.select(law, "rule", F.posexplode("provision_number").alias("n", "number")).withColumn("number", F.substring_index("number", "(", 1))
    found = each.join(headings.select(law, "number", heading_key(F.col("text")).alias("heading")), [law, "number"])
    items = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("n", "heading"))), lambda x: x["heading"]))
    return rules.join(found.groupBy(law, "rule").agg(items.alias("provision")), [law, "rule"], "left").withColumn("provision", F.coalesce("provision", F.array().cast("array<string>")))

"""Text classifiers: labels by pattern, first label, and folds that consume what they have matched."""

from __future__ import annotations

import re
from functools import lru_cache
from re import _parser as parser

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomies as t
from ..functions.spread import spread


def matches_any(text: Column, patterns: list[str]) -> Column:
    return text.rlike(t.java("|".join(f"(?:{p})" for p in patterns)))


def labels(text: Column, table: dict[str, list[str]]) -> Column:
    """Names of all classes with a pattern in the text, in the order of the table."""
    return F.filter(F.array(*[F.when(matches_any(text, p), F.lit(n)) for n, p in table.items()]), lambda x: x.isNotNull())


def first_label(text: Column, table: dict[str, list[str]]) -> Column:
    """The name of the first class with a pattern in the text; null if there is none."""
    return F.coalesce(*[F.when(matches_any(text, p), F.lit(n)) for n, p in table.items()])


def first_term(title: Column, terms: dict[str, list[str]]) -> Column:
    """The first family with a term in the lower-cased title; null if there is none."""
    low = F.lower(title)
    return F.coalesce(*[F.when(_any([low.contains(w) for w in words]), F.lit(n)) for n, words in terms.items()])


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def themes(found: Column, kinds: Column) -> Column:
    """Management themes of a provision whose kinds allow any, of those found in its text; the default where none is found."""
    return F.when(F.arrays_overlap(kinds, F.array(*map(F.lit, t.THEMED_KINDS))), F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(t.DEFAULT_THEME)))).otherwise(F.array().cast("array<string>"))


_EDGES = "[[:blank:][:punct:]“]{}[[:blank:][:punct:]”]"


def actor_pattern(patterns: list[str]) -> str:
    """An actor with a blank or a mark on both sides; its last name is tried first."""
    wrapped = [_EDGES.format(p) for p in reversed(patterns)]
    return wrapped[0] if len(wrapped) == 1 else f"(?:{'|'.join(wrapped)})"


@lru_cache(4096)
def _compiled(pattern: str, flags: int) -> re.Pattern:
    """A pattern compiled once a worker."""
    return re.compile(pattern, flags)


def _python(pattern: str, flags: int) -> re.Pattern:
    """A pattern of the tables, compiled once a worker."""
    return _compiled(t.python(pattern), flags)


@lru_cache(16384)
def _regex(pattern: str, flags: int) -> regex.Pattern:
    return regex.compile(pattern, flags)


def _least(strings: list[str]) -> int:
    """Bytes of the shortest string; a mark outside ASCII tells as much as three letters."""
    return min((len(x.encode()) for x in strings), default=0)


def _letters(op, value, sets: bool) -> list[str]:
    """The characters that a part of a pattern stands for, if they are few and known: a literal, or with sets a small set."""
    if op is parser.LITERAL:
        return [chr(value)]
    return [chr(x) for _, x in value] if sets and op is parser.IN and all(kind is parser.LITERAL for kind, _ in value) else []


def _needed(items, sets: bool) -> list[str]:
    """Strings of which every match of a parsed pattern holds at least one; none if nothing is told of it."""
    ways, runs = [], [""]
    for op, value in [*items, (None, None)]:
        letters = _letters(op, value, sets)
        if 0 < len(letters) * len(runs) <= 8:
            runs = [r + x for r in runs for x in letters]
            continue
        ways, runs = ways + [runs] * (runs != [""]), [""]
        if op is parser.SUBPATTERN:
            ways.append([] if value[1] & re.I else _needed(value[3], sets))
        elif op is parser.BRANCH:
            each = [_needed(x, sets) for x in value[1]]
            ways.append([x for found in each for x in found] if all(each) else [])
        elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT) and value[0]:
            ways.append(_needed(value[2], sets))
    return max(ways, key=_least, default=[])


@lru_cache(16384)
def needed(pattern: str) -> tuple[str, ...]:
    """Strings of which every text that the pattern matches holds at least one; none if the pattern tells no such strings.

    Looking for strings takes a small part of the time of a search, and most texts hold few classes. Small sets of
    characters are written out where the strings would be short without.
    """
    parsed = parser.parse(pattern)
    found = _needed(parsed, False)
    if _least(found) < 4:
        found = max(found, _needed(parsed, True), key=_least)
    return tuple(found) if _least(found) > 1 else ()


def may_match(text: str, strings: tuple[str, ...]) -> bool:
    if not strings:
        return True
    for x in strings:
        if x in text:
            return True
    return False


def _runs(text: str) -> np.ndarray:
    """Numbers of the runs of three bytes of a text; different runs may share one."""
    x = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint16)
    return x[:-2] + x[1:-1] * np.uint16(211) + x[2:] * np.uint16(44497)


class Screen:
    """Numbers of the patterns that a text may match, in order: those with a needed string of which the text holds all runs of three bytes, and those without such strings.

    One look at the text serves all patterns; looking for each string would take a look at the whole text each.
    """

    def __init__(self, needs: list[tuple[str, ...]]) -> None:
        strings = [(k, _runs(x)) for k, found in enumerate(needs) if _least(found) > 2 for x in found]
        sizes = [len(runs) for _, runs in strings]
        self.always = np.array([_least(found) < 3 for found in needs], bool)
        self.owners = np.array([k for k, _ in strings], np.int64)
        self.runs = np.concatenate([runs for _, runs in strings] or [_runs("")]).astype(np.intp)
        self.starts = np.cumsum([0, *sizes[:-1]])[: len(sizes)]

    def __call__(self, text: str) -> list[int]:
        may = self.always.copy()
        if len(self.owners):
            here = np.zeros(1 << 16, bool)
            here[_runs(text).astype(np.intp)] = True
            may[self.owners[np.logical_and.reduceat(here[self.runs], self.starts)]] = True
        return np.flatnonzero(may).tolist()


@lru_cache(64)
def _screened(patterns: tuple[str, ...]) -> tuple[Screen, list[tuple[tuple[str, ...], re.Pattern, re.Pattern]]]:
    """Patterns of Python with their screen, once a worker: the needed strings of each, the pattern, and the pattern by lines."""
    each = [(needed(p), _compiled(p, 0), _compiled(p, re.M)) for p in patterns]
    return Screen([strings for strings, _, _ in each]), each


def taken(text: str, patterns: tuple[str, ...], test: bool = False) -> list[int]:
    """Numbers of the patterns that take matches out of the text, each looking at what those before it have left.

    test: a pattern looks at the text as one line first; it takes its matches out of all lines in any case.
    """
    screen, each = _screened(patterns)
    found, todo = [], screen(text)
    while todo:
        k, *todo = todo
        strings, whole, lines = each[k]
        if may_match(text, strings) and (not test or whole.search(text)):
            text, n = lines.subn("", text)
            if n or test:
                found.append(k)
                todo = list(range(k + 1, len(each)))  # what is left may hold other strings
    return found


def classes(table: dict[str, list[str]]):
    """An Arrow function from texts to the names of all classes with a pattern in the text, in the order of the table, as `labels` finds them.

    Patterns are read as Java reads them. Strings are looked for first, so most patterns never run.
    """
    names = [n for n, ps in table.items() for _ in ps]
    patterns = tuple(t.python_lines(p) for ps in table.values() for p in ps)

    def find(texts: pd.Series) -> pd.Series:
        screen, each = _screened(patterns)

        def one(text: str | None) -> list[str]:
            text, found = text or "", {}
            for k in screen(text):
                strings, p, _ = each[k]
                if names[k] not in found and may_match(text, strings) and p.search(text):
                    found[names[k]] = True
            return list(found)

        return texts.map(one)

    return F.pandas_udf(find, "array<string>")


def consumed(table: dict[str, list[str]], before: list[str] = (), edges: bool = False):
    """An Arrow function from texts to the names of the classes they hold, each class taking its matches out of the text before the next one looks.

    edges: a match needs a blank or a mark on both sides, which it consumes as well.
    """
    names = list(table)
    patterns = tuple(t.python(actor_pattern(p) if edges else "|".join(f"(?:{x})" for x in p)) for p in table.values())

    def fold(texts: pd.Series) -> pd.Series:
        gone = [(needed(t.python(p)), _python(p, re.M)) for p in before]

        def one(text: str | None) -> list[str]:
            text = text or ""
            for strings, p in gone:
                if may_match(text, strings):
                    text = p.sub("", text)
            return [names[k] for k in taken(text, patterns)]

        return texts.map(one)

    return F.pandas_udf(fold, "array<string>")


def actors(table: dict[str, list[str]]):
    """Actors of a text, sorted. Longer names come before the shorter ones that they hold."""
    return consumed(table, t.NO_ACTORS, edges=True)


def governed(text: Column) -> Column:
    return F.array_sort(actors(t.GOVERNED)(text))


def government(text: Column) -> Column:
    return F.array_sort(actors(dict(sorted(t.GOVERNMENT.items(), reverse=True)))(text))


def generic_kinds():
    """An Arrow function from texts to their kinds: each pattern in turn takes its matches out of the text.

    A pattern looks at the text as one line, and takes its matches out of all lines.
    """
    names = [n for n, ps in t.KINDS.items() for _ in ps]
    patterns = tuple(t.python(p) for ps in t.KINDS.values() for p in ps)

    def fold(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: list(dict.fromkeys(names[k] for k in taken(text or "", patterns, test=True))))

    return F.pandas_udf(fold, "array<string>")


HOLDER = "struct<holders:array<string>,text:string>"


def role_holders(role: str, actors: dict[str, list[str]]):
    """An Arrow function from texts and the actors found in them to those that hold a role, and the clauses that say so.

    Actors are tried in the order given; they and their clauses stand in the reverse order in which they were found.
    """
    he = actor_pattern(t.GOVERNED[": He"])

    def fold(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        known = {n: actor_pattern(p) for n, p in actors.items()}
        gone = [(needed(t.python(p)), _regex(p, 0)) for p in t.NO_ROLES]
        rules_of: dict = {}

        def patterns(actor: str) -> list:
            if actor not in rules_of:
                own = known[actor]
                rules = t.HE_DUTY if role == "duty" and own == he else t.ROLES[role]
                whole = [(t.python(p.replace("@", own)), take) for p, take in rules]
                rules_of[actor] = [(needed(p), p, take) for p, take in whole]
            return rules_of[actor]

        def one(text: str | None, names) -> dict:
            text, holders, clauses = text or "", [], []
            for strings, p in gone:
                if may_match(text, strings):
                    text = p.sub(" ", text)
            for actor in names if names is not None else []:
                if actor not in known:
                    continue
                for strings, p, take in patterns(actor):
                    m = _regex(p, regex.M).search(text) if may_match(text, strings) else None
                    if m:
                        holders.insert(0, actor)
                        clauses.insert(0, f"{role.upper()}\n👤{actor}\n📌{m[0]}\n")
                        if take:
                            text = m.re.sub("", text)
            return {"holders": list(dict.fromkeys(holders)), "text": "\n".join(c.strip() for c in dict.fromkeys(clauses))}

        return pd.DataFrame([one(x, n) for x, n in zip(texts, found)], columns=["holders", "text"])

    return F.pandas_udf(fold, HOLDER)


def ranked(kinds: Column) -> Column:
    """The known kinds in order of rank, once each."""
    return F.filter(F.array(*map(F.lit, t.RANKED_KINDS)), lambda k: F.array_contains(kinds, k))


#: The roles, the column of their actors, and the columns of their holders and clauses.
ROLE_COLUMNS = {
    "duty": ("duty_actor", "dutyholder", "dutyholder_txt"),
    "right": ("duty_actor", "rights_holder", "rights_holder_txt"),
    "responsibility": ("duty_actor_gvt", "responsibility_holder", "responsibility_holder_txt"),
    "power": ("duty_actor_gvt", "power_holder", "power_holder_txt"),
}


def with_roles(records: DataFrame, text: str = "text", record_type: str | None = None) -> DataFrame:
    """Records with duty_actor and duty_actor_gvt get the holders of each role, their clauses, and duty_type.

    A provision that amends is an Amendment and nothing else. Headings, parts and chapters have no kinds; a section of
    one line has only the generic ones; without any kind a provision is of the default kind.
    """
    c, none = F.col(text), F.array().cast("array<string>")
    kind = F.col(record_type) if record_type else F.lit("article")
    full = kind.isin("sub-section", "article", "sub-article") | ((kind == "section") & c.contains("\n"))
    full = F.coalesce(full & (c != ""), F.lit(False))
    out = records.withColumns({"__kinds": generic_kinds()(c), "__amends": classes({"Amendment": t.AMENDMENT})(c)})
    amends = F.size("__amends") > 0
    for role, (actors, holders, clauses) in ROLE_COLUMNS.items():
        table = t.GOVERNED if actors == "duty_actor" else t.GOVERNMENT
        told = full & ~amends & (F.size(actors) > 0)
        found = role_holders(role, table)(F.when(told, c), F.when(told, F.col(actors)))
        out = out.withColumn("__role", found).withColumns({holders: F.col("__role.holders"), clauses: F.col("__role.text")}).drop("__role")
    roles = F.concat(*[F.when(F.size(h) > 0, F.array(F.lit(role.capitalize()))).otherwise(none) for role, (_, h, _) in ROLE_COLUMNS.items()], "__kinds")
    kinds = F.when(full & amends, F.array(F.lit("Amendment"))).when(full, F.when(F.size(roles) > 0, ranked(roles)).otherwise(F.array(F.lit(t.DEFAULT_KIND)))).when(kind == "section", F.col("__kinds")).otherwise(none)
    return out.withColumn("duty_type", kinds).drop("__kinds", "__amends")


def without_unbinding(records: DataFrame) -> DataFrame:
    """No dutyholder where the kinds of a provision are none, or one that binds nobody."""
    k = F.col("duty_type")
    free = (F.size(k) == 0) | ((F.size(k) == 1) & F.get(k, F.lit(0)).isin(t.UNBINDING_KINDS))
    return records.withColumn("dutyholder", F.when(free, F.array().cast("array<string>")).otherwise(F.col("dutyholder")))


def provisions(records: DataFrame, text: str = "text") -> DataFrame:
    """Records with actors, role holders, kinds and themes of their text."""
    c = F.col(text)
    out = with_roles(spread(records).withColumns({"duty_actor": governed(c), "duty_actor_gvt": government(c), "__themes": classes(t.THEMES)(c)}), text)
    return out.withColumn("popimar", themes(F.col("__themes"), F.col("duty_type"))).drop("__themes")


def categorised(laws: DataFrame, title: str, codes: str, wanted: list[str], terms: dict[str, list[str]]) -> DataFrame:
    """Laws with family and category: exc for excluded titles, inc_w_si where a subject code is wanted, inc for a term in the title, else inc_wo_si."""
    excluded = matches_any(F.lower(F.col(title)), t.EXCLUDED_TITLES)
    family = first_term(F.col(title), terms)
    hit = F.arrays_overlap(F.col(codes), F.array(*map(F.lit, wanted)))
    category = F.when(excluded, "exc").when(F.coalesce(hit, F.lit(False)), "inc_w_si").when(family.isNotNull(), "inc").otherwise("inc_wo_si")
    return laws.withColumns({"family": family, "category": category})

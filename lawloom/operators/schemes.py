"""Parts and chapters of laws: which numbering a law uses, and its headings tagged by that numbering alone.

A law numbers its parts with digits, Roman numerals, both, or letters. What looks like a
numeral in one of them is the beginning of a title in another (PART IN FORCE, PART A), so the
lines of the whole law choose the numbering first, and the headings are read by it afterwards:
one window over the lines of a law, and expressions on each line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identities import lookup
from .annotations import GEO

# Words of the headings of each component.
WORDS = {"part": "PART|Part", "chapter": "CHAPTER|Chapter|chapter"}
# Beginnings of words (five letters at most) to which a last I or V may belong, not to the numeral before it.
BEGINNINGS = tuple("impac imple impor impos impri incid inclu incom incor indem index indic indus infor initi injur inspe insta instr insur inter inval inves invol issue items vacan valid value varia vehic verif vesse vehicl veter visio visit vocat volun votes votin".split())
ROMAN = r"(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})"
_TENS = {"": 0, "X": 10, "XX": 20, "XXX": 30, "XL": 40, "L": 50, "LX": 60, "LXX": 70, "LXXX": 80, "XC": 90}
_UNITS = {u: k for k, u in enumerate(["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"])}


def numeral(c: Column) -> Column:
    """The value of a Roman numeral up to XCIX, as a string; an empty one is 0, what is none is null."""
    tens, units = (F.regexp_extract(c, f"^{ROMAN}$", k) for k in (1, 2))
    value = lookup({k: str(v) for k, v in _TENS.items()}, tens).cast("int") + lookup({k: str(v) for k, v in _UNITS.items()}, units).cast("int")
    return F.when(c.rlike(f"^{ROMAN}$"), value.cast("string"))


def scheme(lines: DataFrame, law: str, component: str, text: str = "text") -> Column:
    """The numbering of a component in the law of a line: roman_numeric, numeric, alphabetic or roman; null if it has none."""
    whole = Window.partitionBy(law)
    has = lambda what: F.max(F.col(text).rlike(rf"^({WORDS[component]}) +{what}")).over(whole)
    digits, roman = has(r"\d+"), has("I")
    return F.when(digits & roman, "roman_numeric").when(digits, "numeric").when(has("A"), "alphabetic").when(roman, "roman")


def _numeric(c: Column, component: str) -> tuple[Column, Column]:
    pattern = rf"^({WORDS[component]}) (\d+) ?({GEO})(.*)"
    word, number, region, title = (F.regexp_extract(c, pattern, k) for k in range(1, 5))
    return c.rlike(pattern), F.concat(F.lit(f"[::{component}::]"), number, F.lit(" "), word, F.lit(" "), number, F.lit(" "), title, F.lit(" [::region::]"), region)


def _roman(c: Column, component: str, beginnings: tuple[str, ...]) -> tuple[Column, Column]:
    pattern = rf"^({WORDS[component]}) {ROMAN}([A-D]?) ?({GEO})(.*)"
    word, tens, units, letter, region, title = (F.regexp_extract(c, pattern, k) for k in range(1, 7))
    whole = F.concat(tens, units)
    word = F.when(title.rlike("[A-Z]{2,}"), F.when(word == "chapter", "CHAPTER").otherwise(word)).when(title.rlike("[A-Z][a-z]+"), F.when(word == "chapter", "Chapter").otherwise(word)).otherwise(word)
    last = F.right(whole, F.lit(1))
    glued = F.substring(F.lower(F.concat(last, title)), 1, 5).isin(list(beginnings)) & (whole != "")
    short = F.left(whole, F.length(whole) - 1)
    number = F.when(glued, numeral(short)).otherwise(numeral(whole))
    shown = F.when(glued, F.concat(short, F.lit(" "), last, letter)).otherwise(F.concat(whole, letter))
    return c.rlike(pattern), F.concat(F.lit(f"[::{component}::]"), number, letter, F.lit(" "), word, F.lit(" "), shown, F.lit(" "), title, F.lit(" [::region::]"), region)


def _alphabetic(c: Column, component: str) -> tuple[Column, Column]:
    pattern = rf"^({WORDS[component]}) ([A-Z]) ?([ A-Z]+)"
    word, letter, title = (F.regexp_extract(c, pattern, k) for k in range(1, 4))
    rest = F.substring(c, F.length(F.regexp_extract(c, pattern, 0)) + 1, F.length(c))
    return c.rlike(pattern), F.concat(F.lit(f"[::{component}::]"), (F.ascii(letter) - 64).cast("string"), F.lit(" "), word, F.lit(" "), letter, F.lit(" "), title, rest)


def _amended(c: Column, component: str) -> tuple[Column, Column]:
    """Headings that the annotation has tagged already get their number before the codes."""
    pattern = rf"^\[::{component}::\]((?:\[?F\d+)+) (\[?)({WORDS[component]}) (\S+?)(\]?) (.*?) ?\[::region::\](.*)$"
    codes, bracket, word, number, closed, title, region = (F.regexp_extract(c, pattern, k) for k in range(1, 8))
    head = F.regexp_extract(number, f"^{ROMAN}", 0)
    value = F.when(head != "", F.concat(numeral(head), F.substring(number, F.length(head) + 1, F.length(number)))).otherwise(number)
    return c.rlike(pattern), F.concat(F.lit(f"[::{component}::]"), value, F.lit(" "), codes, F.lit(" "), bracket, word, F.lit(" "), number, closed, F.lit(" "), title, F.lit(" [::region::]"), region)


def with_headings(lines: DataFrame, law: str, text: str = "text", beginnings: tuple[str, ...] = BEGINNINGS) -> DataFrame:
    """Lines with the headings of their law's parts and chapters tagged by its own numbering, and the columns part_scheme and chapter_scheme.

    beginnings: of words that may swallow the last letter of a numeral. Null lines stay null; lines that are no heading stay
    as they are. All lines of a law meet in one window.
    """
    out = lines.withColumns({f"{c}_scheme": scheme(lines, law, c, text) for c in WORDS})
    for component in WORDS:
        c, own = F.col(text), F.col(f"{component}_scheme")
        ways = [(own.isin("numeric", "roman_numeric"), _numeric(c, component)), (own.isin("roman", "roman_numeric"), _roman(c, component, beginnings)), (own == "alphabetic", _alphabetic(c, component))]
        amended, heading = _amended(c, component)
        chosen = F.when(amended, heading)
        for applies, (matches, made) in ways:
            chosen = chosen.when(applies & matches, made)
        out = out.withColumn(text, F.regexp_replace(chosen.otherwise(c), r"^(\[::\w+::\].*?) {2,}(?=\[::region::\])", "$1 "))
    return out

"""Provision numbers, section ranges and territorial extents, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nations by their letter in an extent, in the order of display.
NATIONS = [("E", "England"), ("W", "Wales"), ("S", "Scotland"), ("NI", "Northern Ireland")]
# Other spellings of extents.
SPELLINGS = {"(E+W)": "E+W", "EW": "E+W", "EWS": "E+W+S"}
# Short names of sets of nations.
PAN_REGIONS = {"E+W+S+NI": "UK", "E+W+S": "GB", "E+W": "E+W", "E+S": "E+S", "E": "E", "W": "W", "S": "S", "NI": "NI"}
# Roman numerals I to XV.
ROMAN = "I II III IV V VI VII VIII IX X XI XII XIII XIV XV".split()


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def clean_extent(extent: Column) -> Column:
    return F.coalesce(F.try_element_at(_map(SPELLINGS), extent), extent)


def nations(extents: Column) -> Column:
    """Names of the nations in an array of extents, in the order of display."""
    letters = F.flatten(F.transform(extents, lambda e: F.split(clean_extent(e), r"\+")))
    return F.filter(F.array(*[F.when(F.array_contains(letters, k), F.lit(n)) for k, n in NATIONS]), lambda x: x.isNotNull())


def pan_region(extents: Column) -> Column:
    """UK, GB or the letters of the nations; the empty string for sets without a name."""
    names = nations(extents)
    letters = F.array_join(F.filter(F.array(*[F.when(F.array_contains(names, n), F.lit(k)) for k, n in NATIONS]), lambda x: x.isNotNull()), "+")
    return F.coalesce(F.try_element_at(_map(PAN_REGIONS), letters), F.lit(""))


def roman_number(c: Column) -> Column:
    return F.try_element_at(_map({r: k + 1 for k, r in enumerate(ROMAN)}), c)


def _letters(prefix: Column, first: Column, last: Column) -> Column:
    codes = F.when(F.ascii(first) <= F.ascii(last), F.sequence(F.ascii(first), F.ascii(last)))
    return F.transform(F.coalesce(codes, F.array().cast("array<int>")), lambda k: F.concat(prefix, F.chr(k)))


def expand_range(c: Column) -> Column:
    """Provision numbers of a range such as 25-27, 25B-25D, 19-25D or 105ZA-105ZI; null if it is none.

    A range of letters ends with the number that bears them, as in 25B, 25C, 25D, 25.
    """
    pattern = r"^(\d+)([A-Z]?)([A-Z]?)-(\d+)([A-Z]?)([A-Z]?)$"
    n1, a1, b1, n2, a2, b2 = (F.regexp_extract(c, pattern, k) for k in range(1, 7))
    numbers = F.transform(F.when(n1.try_cast("int") <= n2.try_cast("int"), F.sequence(n1.try_cast("int"), n2.try_cast("int"))), lambda k: k.cast("string"))
    plain = (a1 == "") & (b1 == "") & (a2 == "") & (b2 == "")
    one, none = F.array(n1), F.array().cast("array<string>")
    letters = lambda n, a, b: F.concat(_letters(n, a, b), F.array(n))
    return F.array_distinct(
        F.when(~c.rlike(pattern), F.lit(None))
        .when(plain, numbers)
        .when((n1 == n2) & (a1 == a2) & (b1 != "") & (b2 != ""), F.concat(_letters(F.concat(n1, a1), b1, b2), F.array(F.concat(n1, a1))))
        .when((n1 == n2) & (a1 == "") & (b2 == ""), letters(n1, F.lit("A"), a2))
        .when((n1 == n2) & (b1 == "") & (b2 == ""), letters(n1, a1, a2))
        .when((a1 == "") & (b2 == ""), F.concat(numbers, _letters(n2, F.lit("A"), a2)))
        .when((b1 == "") & (b2 == ""), F.concat(letters(n1, a1, F.lit("Z")), letters(n2, F.lit("A"), a2)))
        .when((n1 == n2) & (b1 == ""), F.concat(letters(n1, a1, a2), _letters(F.concat(n1, a1), F.lit("A"), b2), F.array(F.concat(n1, a1))))
    )

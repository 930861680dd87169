"""Titles, classes, tags, codes and identities of laws, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings of titles, in the order in which they are tried, and the class each of them names.
TYPE_CLASSES = [
    (r"Act ?$|Act \(Northern Ireland\) ?$", "Act"),
    (r"Regulations? ?$|Regulations? \(Northern Ireland\) ?$", "Regulation"),
    (r"Order ?$|Order \(Northern Ireland\) ?$", "Order"),
    (r"Rules? ?$|Rules? \(Northern Ireland\) ?$", "Rules"),
    (r"Scheme$|Scheme \(Northern Ireland\)$", "Scheme"),
    (r"Confirmation Instrument$|Confirmation Instrument \(Northern Ireland\)$", "Confirmation Instrument"),
    (r"Byelaws$|Bye-?laws \(Northern Ireland\)$", "Byelaws"),
    (r"Regulation \(EU\)|Council Directive", "EU"),
]

# Words that tags leave out, as patterns applied one after the other.
TAG_PATTERNS = [
    (r"[^a-zA-Z\s:]+", ""),
    (r" {2,}", " "),
    (r" to | th[a|e|i|o]t?s?e? ", " "),
    (r"^a | a | an | and | at | are ", " "),
    (r" f?or ", " "),
    (r" [Ii][f|n] | [Ii][s|t]s? ", " "),
    (r" [Oo][f|n]f? ", " "),
    (r" [Nn]ot? ", " "),
    (r" [Bb][e|y] ", " "),
    (r" [Ww]i?t?ho? ", " "),
    (r"[H| h]as?v?e? ", " "),
    (r" [A-Z|a-z][ |\.|,]", " "),
    (r" {2,}", " "),
    (r"^, ", ""),
]

# Endings that statutory-instrument subject codes lose, in order.
NATION_SUFFIXES = [", ENGLAND AND WALES", ", ENGLAND & WALES", ", WALES", ", ENGLAND", ", SCOTLAND", ", NORTHERN IRELAND"]

# Kinds of company by what their names contain, in the order in which they are tried.
BUSINESS_TYPES = [("LLC", "LLC"), (r"[Ii]nc$|Inc\.|INC", "INC"), (r"[Cc]orp|CORP", "CORP"), (r"PLC|[Pp]lc", "PLC"), (r"[Ll]imited|LIMITED|Ltd|LTD", "LTD"), ("LLP", "LLP")]

# Ordinal words.
ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split()


def is_empty(c: Column) -> Column:
    """Null, or the empty string."""
    return F.coalesce(c == "", F.lit(True))


def first_match(c: Column, rules: list[tuple[str, str]], other: Column | None = None) -> Column:
    """The value of the first pattern that matches."""
    out = reduce(lambda w, r: w.when(c.rlike(r[0]), r[1]), rules[1:], F.when(c.rlike(rules[0][0]), rules[0][1]))
    return out if other is None else out.otherwise(other)


def rewritten(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Replacements applied one after the other."""
    return reduce(lambda x, r: F.regexp_replace(x, F.lit(r[0]), F.lit(r[1])), rules, c)


def without_the(title: Column) -> Column:
    return F.regexp_replace(title, "^The ", "")


def clean_title(title: Column) -> Column:
    """Without a leading The, a note of repeal or revocation, and the year at the end."""
    return rewritten(without_the(title), [(r" \(repealed \d+\.\d+\.\d{4}\)$", ""), (r" \(repealed\)$", ""), (r" \(revoked\)$", ""), (r"[ |]\d{4}$", "")])


def acronym(title: Column) -> Column:
    """Upper-case letters of the title without its The."""
    return F.regexp_replace(without_the(title), r"[^\p{Lu}]", "")


def type_class(title: Column) -> Column:
    return first_match(title, TYPE_CLASSES)


def type_code(title: Column) -> Column:
    return F.when(title.rlike("Act$"), "ukpga").when(title.rlike("(Regulations?|Order)$"), "uksi")


def tags(title: Column) -> Column:
    """Distinctive words of the title, capitalised."""
    words = F.split(F.trim(rewritten(F.lower(F.trim(title)), TAG_PATTERNS)), " ")
    return F.transform(words, lambda w: F.concat(F.upper(F.substring(F.trim(w), 1, 1)), F.lower(F.trim(w).substr(2, 1 << 20))))


def kept_tags(existing: Column, title: Column) -> Column:
    """Tags that stand already, where there are exactly two of them; else those of the title, and none without one."""
    return F.when(F.size(existing) == 2, existing).when(title.isNotNull(), tags(title)).otherwise(existing)


def si_codes(codes: Column) -> Column:
    """Subject codes: split at semicolons, upper case, without nation endings; distinct and sorted."""

    def stripped(c: Column) -> Column:
        return reduce(lambda x, s: F.replace(x, F.lit(s), F.lit("")), NATION_SUFFIXES, F.upper(c))

    return F.array_sort(F.array_distinct(F.transform(F.split(codes, ";"), stripped)))


def law_name(code: Column, year: Column, number: Column) -> Column:
    """The identity UK_code_year_number."""
    return F.concat_ws("_", F.lit("UK"), code, year.cast("string"), number.cast("string"))


def split_name(name: Column) -> Column:
    """Struct of type_code, year and number of an identity; nulls if it has not that form."""
    pattern = r"([a-z]*?)_(\d{4})_(.*)$"
    found = name.rlike(pattern)
    part = lambda k: F.when(found, F.regexp_extract(name, pattern, k))
    return F.struct(part(1).alias("type_code"), part(2).alias("year"), part(3).alias("number"))


def split_path(path: Column) -> Column:
    """Struct of type_code, year and number of a resource path such as /id/uksi/2013/1966."""
    pattern = r"/([a-z]*?)/(\d{4})/(\d+)"
    found = path.rlike(pattern)
    part = lambda k: F.when(found, F.regexp_extract(path, pattern, k))
    return F.struct(part(1).alias("type_code"), part(2).alias("year"), part(3).alias("number"))


def number_tail(number: Column) -> Column:
    """Digits at the end of a number that holds a slash; other numbers as they are."""
    return F.when(number.contains("/"), F.regexp_extract(number, r"\d+$", 0)).otherwise(number)


def business_type(name: Column) -> Column:
    return first_match(name, BUSINESS_TYPES, F.lit("SOLE"))


def index_letter(name: Column) -> Column:
    return F.upper(F.substring(name, 1, 1))


def money(amount: Column) -> Column:
    """Pounds as a number; null if it is none."""
    return F.regexp_replace(amount, "[£,]", "").try_cast("double")


def ordinal_number(word: Column) -> Column:
    """first..twentieth as digits; other words as they are."""
    table = F.create_map(*[x for k, w in enumerate(ORDINALS) for x in (F.lit(w), F.lit(str(k + 1)))])
    return F.coalesce(F.try_element_at(table, F.lower(word)), word)


def slug(text: Column) -> Column:
    """Lower case; runs of blanks and commas as one hyphen."""
    return F.lower(rewritten(text, [(r"[ ,]+", "-")]))


def iso_date(date: Column) -> Column:
    """d/m/y or d-m-y as y-m-d; other forms as they are."""
    t = F.trim(date)
    return rewritten(t, [(r"^([^/]*)/([^/]*)/([^/]*)$", "$3-$2-$1"), (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1")])


def display_date(date: Column) -> Column:
    """y-m-d as d/m/y."""
    return F.regexp_replace(date, r"^.*?(\d{4})-(\d{2})-(\d{2}).*$", "$3/$2/$1")


def first_date(*dates: Column) -> Column:
    """The first date that is not empty; the empty string if all are."""
    return F.coalesce(*[F.nullif(d, F.lit("")) for d in dates], F.lit(""))


def natural_key(c: Column) -> Column:
    """A string that sorts digit runs by value, however long: each is written as the length of its length, its length and its digits."""
    runs = F.regexp_extract_all(c, F.lit(r"(\d+|\D+)"), F.lit(1))

    def key(x: Column) -> Column:
        digits = F.regexp_replace(x, "^0+(?=.)", "")
        size = F.length(digits).cast("string")
        return F.when(x.rlike(r"^\d"), F.concat(F.length(size).cast("string"), size, F.lit("."), digits)).otherwise(x)

    return F.array_join(F.transform(runs, key), "")

"""Codes, names, links and ids of laws and articles, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .titles import rewritten

SITE = "https://legislation.gov.uk"

# What each type code stands for.
TYPES = {
    "ukpga": "Public General Act of the United Kingdom Parliament",
    "uksi": "UK Statutory Instrument",
    "asp": "Act of the Scottish Parliament",
    "ssi": "Scottish Statutory Instrument",
    "nisr": "Northern Ireland Statutory Rule",
    "nisi": "Northern Ireland Order in Council 1972-date",
    "wca": "Act of the National Assembly for Wales",
    "asc": "Act of the Senedd Cyrmu 2020-date",
    "anaw": "Act of the National Assembly for Wales 2012-2020",
    "wsi": "Wales Statutory Instrument 2018-date",
    "mwa": "Measure of the National Assembly for Wales 2008-2011",
    "ukci": "Church Instrument",
    "ukla": "UK Local Act",
    "ukmo": "UK Ministerial Order",
}

# Endings of subject codes that name regions, in the order in which they are tried: the whole ending, what is cut off, the regions.
REGIONS = [
    (r", +ENGLAND +AND +WALES +[A-Z ]*?, SCOTLAND$", r", +ENGLAND +AND +WALES.*$", ["England", "Wales", "Scotland"]),
    (r" +ENGLAND +AND +WALES +AND +SCOTLAND$", r" +ENGLAND +AND +WALES.*$", ["England", "Wales", "Scotland"]),
    (r", +ENGLAND +AND +WALES$", r", +ENGLAND +AND +WALES$", ["England", "Wales"]),
    (r", +ENGLAND$", r", +ENGLAND$", ["England"]),
    (r", +WALES$", r", +WALES$", ["Wales"]),
    (r", +SCOTLAND$", r", +SCOTLAND$", ["Scotland"]),
    (r", +NORTHERN IRELAND$", r", +NORTHERN IRELAND$", ["Northern Ireland"]),
]

# Regions of articles: the code of an id, and the names.
ARTICLE_REGIONS = {
    "U.K.": ("UK", "UK,England,Wales,Scotland,Northern Ireland"),
    "E+W+S": ("GB", "GB,England,Wales,Scotland"),
    "E.W.S.": ("", "GB,England,Wales,Scotland"),
    "E+W+N.I.": ("EWNI", "England,Wales,Northern Ireland"),
    "E+W": ("EW", "England,Wales"),
    "S+N.I.": ("SNI", "Scotland,Northern Ireland"),
    "E": ("E", "England"),
    "W": ("W", "Wales"),
    "S": ("S", "Scotland"),
    "N.I.": ("NI", "Northern Ireland"),
}

# How ids name the annotations of an article: of a heading, and of a content before its code.
ANNOTATIONS = {
    "amendment,heading": "_a", "amendment,textual": "_ax_",
    "extent,heading": "_e", "extent,content": "_ex_",
    "modification,heading": "_m", "modification,content": "_mx_",
    "commencement,heading": "_c", "commencement,content": "_cx_",
    "editorial,heading": "_x", "editorial,content": "_xx_",
    "subordinate,heading": "_p", "subordinate,content": "_px_",
    "table": "_tbl", "note": "_nt",
}

# Flags of nations.
FLAGS = {"E": "\U0001f3f4\U000e0067\U000e0062\U000e0065\U000e006e\U000e0067\U000e007f", "W": "\U0001f3f4\U000e0067\U000e0062\U000e0077\U000e006c\U000e0073\U000e007f", "S": "\U0001f3f4\U000e0067\U000e0062\U000e0073\U000e0063\U000e0074\U000e007f", "NI": "\U0001f1ee\U0001f1ea"}
UK_FLAG = "\U0001f1ec\U0001f1e7"

# Groups of type codes and of type classes that an option may name.
CODE_GROUPS = {
    "ni": ["nia", "apni", "nisi", "nisr", "nisro"],
    "s": ["asp", "ssi"],
    "uk": ["ukpga", "uksi"],
    "w": ["anaw", "mwa", "wsi"],
    "o": ["ukcm", "ukla", "asc"],
}

# Codes and classes of acts, which no other law enacts.
ACT_CODES = ["ukpga", "anaw", "asp", "nia", "apni"]

# Months.
MONTHS = "january february march april may june july august september october november december".split()


def _sql(value: str | int) -> str:
    """A literal as SQL writes it."""
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup(table: dict, key: Column, other: Column | None = None) -> Column:
    """The value of a key in a small fixed table."""
    found = F.try_element_at(F.expr(f"map({', '.join(_sql(x) for kv in table.items() for x in kv)})"), key)
    return found if other is None else F.coalesce(found, other)


def type_of(code: Column) -> Column:
    return lookup(TYPES, code)


def code_and_regions(code: Column) -> Column:
    """Struct of a subject code without its ending, and the regions that the ending names."""
    out = F.struct(code.alias("code"), F.array().cast("array<string>").alias("regions"))
    for whole, cut, names in reversed(REGIONS):
        out = F.when(code.rlike(whole), F.struct(F.regexp_replace(code, cut, "").alias("code"), F.array(*map(F.lit, names)).alias("regions"))).otherwise(out)
    return out


def type_codes(options: list[str]) -> list[str]:
    """Type codes of options, each of them a code or the name of a group; unknown ones raise."""
    known = {*TYPES, *(c for g in CODE_GROUPS.values() for c in g)}
    for o in options:
        if o not in CODE_GROUPS and o not in known:
            raise ValueError(f"no type code: {o}")
    return [c for o in options for c in CODE_GROUPS.get(o, [o])]


def is_act(code: Column, cls: Column) -> Column:
    return F.coalesce(code.isin(ACT_CODES) | (cls == "Act"), F.lit(False))


def flags(extent: Column) -> Column:
    """The flags of an extent such as E+W, and the extent itself."""
    each = F.filter(F.transform(F.split(extent, r"\+"), lambda x: lookup(FLAGS, x)), lambda x: x.isNotNull())
    return F.concat(F.when(extent == "E+W+S+NI", F.lit(UK_FLAG)).otherwise(F.array_join(each, " ")), F.lit(" "), extent)


def law_url(code: Column, year: Column, number: Column, part: str = "") -> Column:
    """Address of a law, or of one of its resources such as /introduction, /made, /contents."""
    return F.concat(F.lit(SITE + "/"), code, F.lit("/"), year.cast("string"), F.lit("/"), number.cast("string"), F.lit(part))


def changes_url(kind: str, code: Column, year: Column, number: Column, results: int = 1000) -> Column:
    """Address of the table of changes that a law made (affecting) or that were made to it (affected)."""
    return F.concat(F.lit(f"{SITE}/changes/{kind}/"), code, F.lit("/"), year.cast("string"), F.lit("/"), number.cast("string"), F.lit(f"?results-count={results}&sort=affecting-year-number"))


def heading_slug(heading: Column) -> Column:
    """A cross-heading as addresses write it."""
    return F.lower(rewritten(F.trim(heading), [(r"\[?[Ff]\d+ ", ""), (" ", "-"), (r"[,.:\]]", "")]))


def article_url(record_type: Column, law: Column, part: Column, chapter: Column, section: Column, text: Column) -> Column:
    """Address of a part, chapter, heading, section or article of the law at address `law`; empty for others."""
    kinds = {"part": ("part", part), "chapter": ("chapter", chapter), "heading": ("crossheading", heading_slug(text)), "article": ("regulation", section), "section": ("section", section)}
    out = F.lit("")
    for kind, (name, value) in kinds.items():
        out = F.when(record_type == kind, F.concat(law, F.lit(f"/{name}/"), value)).otherwise(out)
    return out


def trimmed_id(id_: Column) -> Column:
    """An id without the region at its end."""
    return F.regexp_replace(id_, "_*[A-Z]*$", "")


def region_code(region: Column) -> Column:
    return F.coalesce(lookup({k: f"_{c}" for k, (c, _) in ARTICLE_REGIONS.items() if c}, region), F.lit(""))


def region_names(region: Column) -> Column:
    """Names of the nations of a region, with commas; other texts as they are."""
    return lookup({k: names for k, (_, names) in ARTICLE_REGIONS.items()}, region, region)


def annotation_code(kind: Column, code: Column) -> Column:
    found = lookup(ANNOTATIONS, kind)
    return F.coalesce(F.when(found.endswith("_"), F.concat(found, code)).otherwise(found), F.lit(""))


def article_id(name: Column, flow: Column, path: Column, region: Column, kind: Column, code: Column) -> Column:
    """The id of an article: its law, the place in the law's flow, the numbers of its levels, region and annotation.

    path: part, chapter, heading, section, sub-section and paragraph, joined by _.
    """
    ending = F.concat(region_code(region), annotation_code(kind, code))
    whole = F.concat(path, ending)
    return (
        F.when(flow == "pre", F.concat(name, whole))
        .when(flow.isin("", "main"), F.concat(name, F.lit("_"), whole))
        .when(flow == "post", F.concat(name, F.lit("-"), whole))
        .when(flow == "signed", F.concat(name, region_code(region)))
        .otherwise(F.concat(name, F.lit("-"), flow, F.lit("_"), whole))
    )


def letter_number(letter: Column) -> Column:
    """1 to 26 for a letter of either case; null for others."""
    k = F.ascii(F.lower(letter)) - 96
    return F.when((F.length(letter) == 1) & k.between(1, 26), k)


def first_capital(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), text.substr(F.lit(2), F.greatest(F.length(text), F.lit(1))))


def title_case(text: Column) -> Column:
    """Each word with a capital, and its other letters as they are."""
    return F.array_join(F.transform(F.split(text, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 20))), " ")


def single_spaced(text: Column) -> Column:
    return F.regexp_replace(text, " {2,}", " ")


def free_date(text: Column) -> Column:
    """A date in words, such as 1st April 2004 or "at 9.00 am on 4thMay2004", as y-m-d; null if it holds none."""
    t = rewritten(F.lower(text), [(r"[,;()\[\]]", " "), (r"(\d)(st|nd|rd|th)", "$1 "), (r"([a-z])(\d)", "$1 $2"), (r"(\d)([a-z])", "$1 $2")])
    pattern = rf"(\d{{1,2}}) +({'|'.join(MONTHS)}) +(\d{{4}})"
    month = lookup({m: f"{k + 1:02d}" for k, m in enumerate(MONTHS)}, F.regexp_extract(t, pattern, 2))
    return F.when(t.rlike(pattern), F.concat_ws("-", F.regexp_extract(t, pattern, 3), month, F.lpad(F.regexp_extract(t, pattern, 1), 2, "0")))


def search_link(term: Column) -> Column:
    """A term and the address of its search in titles, with a heart between them."""
    return F.concat(term, F.lit("💚"), F.lit(SITE + "/all?title="), F.url_encode(term))


def formula(equal: dict[str, str], any_of: dict[str, list[str]] | None = None) -> Column:
    """Rows whose columns equal the given values; an empty value asks nothing. any_of: the column holds one of some values."""
    out = F.lit(True)
    for c, v in equal.items():
        if v:
            out = out & (F.col(c) == v)
    for c, vs in (any_of or {}).items():
        if vs:
            out = out & F.col(c).isin(vs)
    return out


def dated(column: str, mode: str, today: str) -> Column:
    """Rows by a date column: today, blank, not_today, week (older than a week), and blank_or_ with each of the last three but blank."""
    c, day = F.col(column), F.lit(today).cast("date")
    blank, d = c.isNull() | (c.cast("string") == ""), c.try_cast("date")
    modes = {"today": d == day, "blank": blank, "not_today": d != day, "week": d < F.date_sub(day, 7)}
    modes |= {f"blank_or_{k}": blank | F.coalesce(modes[k], F.lit(False)) for k in ("today", "not_today", "week")}
    return F.coalesce(modes[mode], F.lit(False))


def all_empty(columns: list[str]) -> Column:
    """Rows where each of these columns is null, empty or an empty list as text."""
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(F.trim(F.col(c).cast("string")).isin("", "[]"), F.lit(True))
    return out


def in_period(column: str, year: int, month: int | None = None, first: int | None = None, last: int | None = None) -> Column:
    """Rows whose date lies in a year, a month, a day, or a range of days."""
    d = F.col(column).cast("date")
    out = F.year(d) == year
    if month:
        out = out & (F.month(d) == month)
    if first:
        out = out & F.dayofmonth(d).between(first, last or first)
    return F.coalesce(out, F.lit(False))

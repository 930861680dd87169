"""Texts of statutes as records: cleaning, one row a line, lines told apart by rules of their country, headings, and the levels they stand in.

A country is an ordered table of rules. The first rule whose pattern a line matches names its kind and number; the rest
is windows over the lines of a text: a heading goes to the line before or after it, lines of no kind go to the last line
of a kind, and each record gets the numbers of the levels around it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identities import lookup
from ..functions.titles import rewritten
from .hierarchies import levelled


def roman(n: int) -> str:
    """A number as a roman numeral."""
    out = ""
    for value, letters in ((100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        out, n = out + letters * (n // value), n % value
    return out


#: Roman numerals that lines bear.
ROMAN = {roman(n): str(n) for n in range(1, 120)}
_R = "[CLXVI]+"

# Ordinal words of parts, chapters and sections.
GERMAN = "Erster Zweiter Dritter Vierter Fünfter Sechster Siebter Achter Neunter Zehnter Elfter Zwölfter Dreizehnter Vierzehnter Fünfzehnter Sechzehnter Siebzehnter Achtzehnter Neunzehnter Zwanzigstel".split()
TURKISH = "BİRİNCİ İKİNCİ ÜÇÜNCÜ DÖRDÜNCÜ BEŞİNCİ ALTINCI YEDİNCİ SEKİZİNCİ DOKUZUNCU".split()
RUSSIAN = "ПЕРВАЯ СЕКОНД ТРЕТЬЯ ЧЕТВЕРТАЯ ФИФТХ ШЕСТАЯ".split()
ENGLISH = "One Two Three Four Five Six Seven Eight Nine Ten".split()
WORDS = {w: str(k + 1) for words in (GERMAN, TURKISH, RUSSIAN, ENGLISH) for k, w in enumerate(words)}
# Authorities that sign Danish laws.
DANISH_APPROVERS = ["Arbejdstilsynet", "Beskæftigelsesministeriet", "Sundhedsministeriet", "Miljøministeriet", "Klima-, Energi- og Forsyningsministeriet", "Givet på Christiansborg Slot", "Færdselsstyrelsen", "Miljø- og Fødevareministeriet", "Søfartsstyrelsen", "Trafik-, Bygge- og Boligstyrelsen", "Transport-, Bygnings- og Boligministeriet", "Miljøstyrelsen", "Erhvervs- og Vækstministeriet", "Ministeriet for Sundhed og Forebyggelse", "Statens Luftfartsvæsen", "Arbejdsministeriet", "Direktoratet for Arbejdstilsynet"]


@dataclass
class Rule:
    """Lines of a kind: pattern, whose first group is the number (none: no number), and where their heading stands."""

    tag: str
    pattern: str
    heading: str = ""  # "next": the line after it; "before": the line before it


@dataclass
class Country:
    rules: list[Rule]
    clean: list[tuple[str, str]] = field(default_factory=list)
    #: Bodies of these kinds are left out if they are longer than LONG.
    cut: tuple[str, ...] = ()


LONG = 5000
LEVELS = ["annex", "part", "chapter", "section", "sub_section", "article", "sub_article", "para"]
_words = "|".join

# How the statutes of each country clean their texts and write their lines, in the order in which rules are tried.
COUNTRIES = {
    "AUT": Country(
        [
            Rule("chapter", r"^(\d*[A-Z]*)\. +(?:Haupstück|HAUPTSTÜCK)$", "next"),
            Rule("chapter", r"^(\d*[A-Z]*)\. +(?:Haupstück|HAUPTSTÜCK):? "),
            Rule("chapter", r"^Artikel (\d+)$", "next"),
            Rule("section", r"^(\d+)\. (?:Abschnitt|ABSCHNITT)$", "next"),
            Rule("section", r"^(\d+)\. (?:Abschnitt|ABSCHNITT): "),
            Rule("section", r"^(?:Abschnitt|ABSCHNITT|Unterabschnitt) (\d+[a-z]*):"),
            Rule("article", r"^§ (\d+[a-z]?)\.$", "before"),
            Rule("sub_article", r"^\((\d+[a-z]?)\) "),
            Rule("annex", r"^(?:ANHANG|Anhang|Anlage) ([A-Z]*\d*/?\d*)", "next"),
        ],
        [(r"(?s)^.*?\nLangtitel\n", ""), (r"(?s)\nZum Seitenanfang.*$", "")],
        ("annex",),
    ),
    "DE": Country(
        [
            Rule("part", r"^Teil (\d+)"),
            Rule("part", rf"^({_words(GERMAN)}) Teil$", "next"),
            Rule("part", r"^Part (\d+|[A-Za-z]+)"),
            Rule("chapter", r"^Kapitel (\d+)"),
            Rule("section", rf"^({_words(GERMAN)}) Abschnitt"),
            Rule("section", r"^Abschnitt (\d+)"),
            Rule("section", r"^(\d+)\. Abschnitt"),
            Rule("section", rf"^({_R})\.$", "next"),
            Rule("section", r"^Section (\d+[a-z]*)"),
            Rule("sub_section", r"^Unterabschnitt (\d+)"),
            Rule("amendment", r"^§§"),
            Rule("article", r"^§ (\d+[a-z]*)"),
            Rule("para", r"^\((\d+)\) "),
            Rule("approval", r"^(?:Eingangsformel|Introductory Clause)"),
            Rule("annex", rf"^(?:Anlage|Appendix|Anhang|Annex) ?(\d+|{_R})?(?![a-zäöü])"),
            Rule("footnote", r"^Fußnote"),
        ],
        cut=("annex", "footnote"),
    ),
    "DK": Country(
        [
            Rule("annex", rf"^Bilag ?(\d+|{_R})?$", "next"),
            Rule("note", r"^Officielle noter"),
            Rule("chapter", r"^Kapitel (\d+)$", "next"),
            Rule("article", r"^§ (\d+)", "before"),
            Rule("approval", rf"^(?:{_words(DANISH_APPROVERS)})"),
        ],
        [(r"(?s)^.*?Yderligere oplysninger", ""), (r"(?s)\nOm\n.*$", "")],
        ("annex", "note"),
    ),
    "FIN": Country(
        [
            Rule("chapter", r"^(\d+ ?[a-zåäö]?) ?luku", "next"),
            Rule("article", r"^(\d+ ?[a-zåäö]?) ?§", "next"),
            Rule("annex", r"^(?:Liite|Liitteet) ?([0-9A-Za-z]+(?:-[0-9A-Za-z]+)?)? ?:?", "next"),
        ],
        [(" ", " "), (r"(?s)^.*?Viitetiedot\n[ \t]+På svenska\n", ""), (r"(?s)(?:Muutossäädösten voimaantulo ja soveltaminen:|Säädökset alkuperäisinä|Sisällysluettelo).*$", "")],
    ),
    "NO": Country(
        [
            Rule("chapter", rf"^(?:Kap(?:ittel|\.)?|Chapter\.?) *(\d+ ?[A-Z]?|{_R})\b[^.\n]*\.?[^.\n]*$"),
            Rule("section", rf"^({_R})\. +[A-ZÅØ]"),
            Rule("sub_article", r"^§ +((?:\d*-)?\d+ ?[a-z]+)\. ?"),
            Rule("article", r"^(?:§|Section) +((?:\d* ?[A-Za-z]?-)?\d+)\. *[(A-ZÅØ]"),
            Rule("para", r"^\((\d+)\)"),
            Rule("annex", rf"^(?:Vedlegg|Annex)\.? ({_R}|\d+):?\.? +[A-ZÅØ]"),
            Rule("amendment", r"^(\d+)[ \t]+(?:Jf\.|Kapittel|Kapitlene|Endret|Tilføyd|Vedlegg|Opphevet|Hele|Overskrift endret|Henvisningen|Cf\.|Chapters?|Modified|Added|Attachments|Repealed|Entire|Headline Modified|Reference)"),
        ]
    ),
    "RUS": Country(
        [
            Rule("part", rf"^ЧАСТЬ ({_words(RUSSIAN)})"),
            Rule("part", rf"^({_R})\. "),
            Rule("chapter", rf"^(?:РАЗДЕЛ|Раздел|ГЛАВА) ({_R})\b"),
            Rule("section", r"^(?:ГЛАВА|Глава) (\d+)"),
            Rule("annex", r"^Приложение ?N? ?(\d*)"),
            Rule("form", r"^Форма ?N? ?(\d*)"),
            Rule("article", r"^Статья (\d+-?\d*)"),
            Rule("sub_article", r"^(\d+\.\d+\.\d+)\. "),
            Rule("para", r"^\d+\.(\d+)\. "),
            Rule("article", r"^(\d+)\. "),
            Rule("table", r"^Таблица ?N? ?(\d*)"),
        ],
        [(r"(?s)^.*?Попробовать бесплатно", ""), (r"(?s)\n(?:Редакция документа с учетом|Электронный текст документа|Текст документа).*$", "")],
    ),
    "SWE": Country(
        [
            Rule("chapter", r"^Kap\. (\d+)"),
            Rule("chapter", r"^(\d+) kap\. ?"),
            Rule("note", r"^(?:Ikraftträdande|Övergångsbestämmelser)"),
            Rule("article", r"^(\d+(?: [a-z])?) ?§", "before"),
            Rule("annex", r"^Bilaga ?(\d*)"),
        ],
        [(r"(?m)^\d+\n", ""), (r"(?m)^ ", "")],
    ),
    "TUR": Country(
        [
            Rule("part", rf"^({_words(TURKISH)}) KISIM$", "next"),
            Rule("chapter", rf"^({_words(TURKISH)}) BÖLÜM$", "next"),
            Rule("amendment", r"^(?:GEÇİCİ MADDE|Geçici Madde) (\d+)"),
            Rule("article", r"^(?:Madde|MADDE) (\d+(?:/[A-Z])?)", "before"),
            Rule("footnote", r"^\(\d+\) \d{1,2}/\d{1,2}/\d{4} "),
            Rule("sub_article", r"^\((\d+)\) "),
            Rule("annex", rf"^Ek ({_R})$", "next"),
            Rule("sub_article", r"^\((?:Ek (?:fıkra|cümleler)|Değişik)"),
        ],
        [(r"(?m)^\d{1,4}-?\d*\n", "")],
        ("annex",),
    ),
    "UK": Country(
        [
            Rule("annex", r"^(?:THE )?(?:SCHEDULE|Schedule)S? ?(\d*[A-Z]?)(?![A-Za-z])", "next"),
            Rule("part", rf"^(?:PART|Part) (\d+[A-Z]?|{_R}|[A-Z])\b"),
            Rule("chapter", rf"^(?:CHAPTER|Chapter) (\d+[A-Z]?|{_R}|[A-Z])\b"),
            Rule("amendment_heading", r"^Textual Amendments"),
            Rule("modification_heading", r"^Modifications etc\. \(not altering text\)"),
            Rule("commencement_heading", r"^Commencement Information"),
            Rule("extent_heading", r"^Extent Information"),
            Rule("editorial_heading", r"^Editorial Information"),
            Rule("amendment", r"^(F\d+)"),
            Rule("modification", r"^(C\d+)"),
            Rule("commencement", r"^(I\d+)"),
            Rule("extent", r"^(E\d+)(?!\+)"),
            Rule("editorial", r"^(X\d+)"),
            Rule("section", r"^\[?(\d{1,3}[A-Z]*)\.? ?(?:—|-)?\(1\)", "before"),
            Rule("section", r"^\[?(\d{1,3}[A-Z]*)\.? +[A-Z\[“]", "before"),
            Rule("sub_section", r"^\[?\((\d+[A-Z]?[A-Z]?)\)\]? ?[,\[“A-Z]"),
            Rule("table", r"^Table (\d+)"),
            Rule("signed", r"^(?:Signed by|Sealed with the Official Seal)"),
        ],
        cut=(),
    ),
}


def number_of(text: Column) -> Column:
    """The number of a line: roman numerals and ordinal words as digits, others as they are, without blanks."""
    bare = F.regexp_replace(text, " ", "")
    return F.coalesce(lookup(WORDS, text), lookup(ROMAN, text), bare)


def told(lines: DataFrame, country: str) -> DataFrame:
    """Lines (..., line) with their tag, number and where their heading stands; nulls for lines of no kind."""
    rules, line = COUNTRIES[country].rules, F.col("line")
    which = F.coalesce(*[F.when(line.rlike(r.pattern), F.lit(k)) for k, r in enumerate(rules)])
    out = lines.withColumn("__k", which)
    pick = lambda values: reduce(lambda w, k: w.when(F.col("__k") == k, values(rules[k])), range(1, len(rules)), F.when(F.col("__k") == 0, values(rules[0])))
    has_group = lambda p: "(" in p.replace("(?", "").replace(r"\(", "")
    number = pick(lambda r: F.nullif(F.regexp_extract(line, r.pattern, 1), F.lit("")) if has_group(r.pattern) else F.lit(None).cast("string"))
    return out.withColumns({"tag": pick(lambda r: F.lit(r.tag)), "number": number_of(number), "heading_at": pick(lambda r: F.lit(r.heading))}).drop("__k")


def statute_lines(texts: DataFrame, key: str, text: str, country: str) -> DataFrame:
    """key, seq and line of the cleaned text, without empty lines and leading tabs."""
    clean = rewritten(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "\r", ""), COUNTRIES[country].clean)
    lines = texts.select(key, F.posexplode(F.split(clean, "\n")).alias("seq", "line"))
    return lines.withColumn("line", F.regexp_replace("line", r"^\t+", "")).filter(F.trim("line") != "")


def statute(texts: DataFrame, key: str, text: str, country: str) -> DataFrame:
    """Records of statutes: key, seq, tag, number, heading, text, and the number of each level they stand in.

    Lines before the first line of a kind are the title. Lines that follow are joined with 📌. Bodies that the country
    cuts are empty if they are longer than LONG.
    """
    run = Window.partitionBy(key).orderBy("seq")
    lines = told(statute_lines(texts, key, text, country), country)
    lines = lines.withColumns({"next_at": F.lead("heading_at").over(run), "last_at": F.lag("heading_at").over(run), "last_line": F.lag("line").over(run), "next_line": F.lead("line").over(run), "next_tag": F.lead("tag").over(run), "last_tag": F.lag("tag").over(run), "has_last": F.lag("seq").over(run).isNotNull()})
    untold = F.col("tag").isNull()
    is_heading = untold & ((F.coalesce("next_at", F.lit("")) == "before") | (F.coalesce("last_at", F.lit("")) == "next"))
    above = (F.col("heading_at") == "before") & F.col("last_tag").isNull() & F.col("has_last")
    below = (F.col("heading_at") == "next") & F.col("next_tag").isNull()
    lines = lines.withColumn("heading", F.when(above, F.col("last_line")).when(below, F.col("next_line")))
    body = lines.filter(~is_heading).withColumn("__n", F.sum(F.when(F.col("tag").isNotNull(), 1).otherwise(0)).over(run))
    rest = F.transform(F.array_sort(F.collect_list(F.when(F.col("tag").isNull() | (F.col("__n") == 0), F.struct("seq", "line")))), lambda x: x["line"])
    first = F.min_by(F.struct("tag", "number", "heading", "line"), "seq")
    grouped = body.groupBy(key, "__n").agg(F.min("seq").alias("seq"), first.alias("f"), F.array_join(rest, "📌").alias("rest"))
    tag = F.when(F.col("__n") == 0, F.lit("title")).otherwise(F.col("f.tag"))
    cut = tag.isin(list(COUNTRIES[country].cut)) & (F.length("rest") > LONG) if COUNTRIES[country].cut else F.lit(False)
    whole = F.when(F.col("__n") == 0, F.col("rest")).otherwise(F.concat_ws("📌", F.col("f.line"), F.when(cut | (F.col("rest") == ""), F.lit(None)).otherwise(F.col("rest"))))
    records = grouped.select(key, "seq", tag.alias("tag"), F.col("f.number").alias("number"), F.col("f.heading").alias("heading"), whole.alias("text"))
    return levelled(records, key, LEVELS)


def repaired_numbers(records: DataFrame, key: str, seq: str, number: str) -> DataFrame:
    """Article numbers that run together with another: one that is too long to follow the number before it gets a hyphen after the number that would."""
    before = F.lag(F.col(number).try_cast("long")).over(Window.partitionBy(key).orderBy(seq))
    n, follows = F.col(number), F.col("__before").cast("string")
    following = (F.col("__before") + 1).cast("string")
    long = (F.length(n) > F.length(following)) & n.rlike(r"^\d+$")
    fixed = F.when(long & n.startswith(following), F.concat(following, F.lit("-"), n.substr(F.length(following) + 1, F.lit(20)))).when(long & n.startswith(follows), F.concat(follows, F.lit("-"), n.substr(F.length(follows) + 1, F.lit(20)))).otherwise(n)
    return records.withColumn("__before", before).withColumn(number, fixed).drop("__before")

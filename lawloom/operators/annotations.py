"""Annotated lines of acts: what the codes of amendments (F12), modifications (C3), extents (E1) and notes (X5) tell of the lines that bear them.

The text of an act as published glues codes, numbers, titles and regions together. The
annotation of one act is a fold over its lines by a table of rules, each of which sees what
the rules before it have left:

- a rewriting rule tags the lines that match its pattern;
- a rule of codes reads the clauses of amendments, marked 🔻F12🔻, for the codes that made
  sections, paragraphs, headings or tables, and tags the lines that begin with such a code.
  An index from codes to lines finds them, so an act costs about as much as it has lines, not
  lines times codes. A line that is tagged no longer begins with its code: codes are used up;
- a rule of ranges writes the provisions of a repealed range in full.

Main text and schedules are told apart and have rules of their own. A tagged line reads
`[::component::]number text [::region::]region`; `components` takes these apart in Spark.

Defined results: null stays null; texts of other laws than acts stay as they are; repeated
rows are annotated one by one; a code that names no line changes nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Regions and countries at the end of titles.
REGION = r"U\.K\.|E\+W\+N\.I\.|E\+W\+S|E\+W|S\+N\.I\."
GEO = REGION + r"|N\.I\.|S|W|E"
# Beginnings of the clauses of textual amendments.
CLAUSES = r"Ss?c?h?s?\. [^.]|S[Ss][. ]|s ?\.|W[O|o]rds?|In s. |The words repealed|Definition |Entry?i?e?s?|By.*?S\.I\.|Para\.? |Pt. |[Cc]ross[- ]?heading|Chapter.*?\(ss\. .*?\) inserted|Act repealed|Sum in [Ss]\."
# Numbers of provisions in clauses, lists and ranges of them.
_N = r"\d+[A-Z]{0,2}"
SECTIONS = rf"{_N}-{_N}|(?:{_N}, )+{_N} and {_N}-{_N}|(?:{_N}, )+{_N}"
_P = r"(?:\d+[A-Z]{0,3}-\d+[A-Z]{0,3}|\d+[A-Z]{0,3})"
PARAGRAPHS = rf"(?:{_P}, )+{_P} and {_P}-{_P}|(?:{_P}, )+{_P}|{_P}"
# How schedules begin: several or one, with a region or without.
SCHEDULES = [
    (rf"^(?:F\d* ?)?(SCHEDULES|Schedules) ?({REGION})", r"[::annex::] \1 [::region::]\2"),
    (r"^(?:F\d* ?)?(SCHEDULES|Schedules)", r"[::annex::] \1 [::region::]"),
    (rf"^((?:THE )?SCHEDULE|(?:The)?Schedule)(.*?)({REGION})(.*)", r"[::annex::]\1 \2\4 [::region::]\3"),
    (r"^((?:THE )?SCHEDULE|(?:The)?Schedule)(.*?)", r"[::annex::]\1 \2 [::region::]"),
]


def tag(component: str) -> str:
    return f"[::{component}::]"


def range_of(span: str) -> list[str]:
    """Numbers of a range: 1-3; 1-1C (with 1 itself at the end); 19-21D; 2C-3B; 78A-78YC; 105ZA-105ZI. What is none stands for itself."""
    m = re.fullmatch(r"(\d+)([A-Z]?)([A-Z]?)-(\d+)([A-Z]?)([A-Z]?)", span)
    if not m:
        return [span]
    low, a, b, high, c, d = m[1], m[2], m[3], m[4], m[5], m[6]
    letters = lambda stem, x, y: [stem + chr(k) for k in range(ord(x), ord(y) + 1)]
    if not a and not c:
        out = [str(k) for k in range(int(low), int(high) + 1)]
    elif low == high:
        out = letters(low + a, b, d) + [low + a] if b else letters(low, a or "A", c) + (letters(low + c, "A", d) if d else []) + [low]
    elif not a:
        out = [str(k) for k in range(int(low), int(high) + 1)] + letters(high, "A", c)
    else:
        out = letters(low, a, "Z") + [low] + letters(high, "A", c) + [high]
    return list(dict.fromkeys(out))


def _natural(text: str) -> list:
    return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.findall(r"\d+|\D+", text)]


#: Clauses and lines with a tag, which codes leave alone.
TAKEN = ("🔻", "[::")
_CODE = re.compile(r"F\d+")


class Lines:
    """The lines of an act, or of a part of it, and where each code stands. Text and rows are made of each other when they are asked for."""

    def __init__(self, text: str):
        self._text: str | None = text
        self._rows: list[str] = []
        self.at: dict[str, list[int]] | None = None

    @property
    def rows(self) -> list[str]:
        """The lines, which a rule may change in place."""
        if self._text is not None:
            self._rows, self._text = self._text.split("\n"), None
        return self._rows

    @rows.setter
    def rows(self, rows: list[str]):
        self._rows, self._text = rows, None

    @property
    def text(self) -> str:
        if self._text is None:
            self._text = "\n".join(self._rows)
        return self._text

    def bearing(self, code: str) -> list[int]:
        """Lines that may bear a code; a number may be glued to it, so every beginning of the digits counts."""
        if self.at is None:
            self.at = defaultdict(list)
            for k, row in enumerate(self.rows):
                if "F" in row and not row.startswith(TAKEN):
                    for end in {run[:n] for run in _CODE.findall(row) for n in range(2, len(run) + 1)}:
                        self.at[end].append(k)
        return self.at.get(code, [])

    def clauses(self, pattern: re.Pattern) -> list[re.Match]:
        return [m for row in self.rows if "🔻" in row and (m := pattern.search(row))]


# Kinds of rules: each takes Lines and gives Lines.


@dataclass(frozen=True)
class Rewrite:
    """Lines (or with `whole`, the text across lines) that match are written anew; with `tidy`, runs of blanks in tagged lines become one."""

    pattern: str
    to: str | Callable
    whole: bool = False
    tidy: bool = False

    def __call__(self, lines: Lines) -> Lines:
        pattern = _compiled(self.pattern)
        if self.whole:
            return Lines(pattern.sub(self.to, lines.text))
        # a line is left as it is without a look at its replacement, and at its later characters where a match begins the line
        meets = pattern.match if _begins(self.pattern) else pattern.search
        rows, changed = lines.rows, False
        for k, row in enumerate(rows):
            if meets(row):
                new = pattern.sub(self.to, row)
                rows[k] = re.sub(r" {2,4}", " ", new) if self.tidy and new != row else new
                changed = True
        lines.at = None
        return Lines(lines.text) if changed else lines


@dataclass(frozen=True)
class Codes:
    """Clauses that match name codes, each with what it made; `forms` tag the lines that bear them.

    sections: reads (code, number) pairs out of the clauses; forms: (pattern, new line) of a code, a number and the
    numbers that the clauses know.
    """

    clause: str
    forms: Callable[[str, str, set[str]], list[tuple[str, str | Callable]]]
    sections: Callable[[list[re.Match]], list[tuple[str, str]]]

    def __call__(self, lines: Lines) -> Lines:
        pairs = self.sections(lines.clauses(_compiled(self.clause)))
        if not pairs:
            return lines
        numbers = {n for _, n in pairs}
        for code, number in pairs:
            known = None
            for k in lines.bearing(code):
                row = lines.rows[k]
                if row.startswith(TAKEN):
                    continue
                known = known or [(_compiled(p), to) for p, to in self.forms(code, number, numbers)]
                for pattern, to in known:
                    if pattern.search(row):
                        row = pattern.sub(to, row)
                lines.rows[k] = row
        return lines


@lru_cache(4096)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.M)


@lru_cache(4096)
def _begins(pattern: str) -> bool:
    """True if every match begins a line: the pattern begins with ^ and has no alternatives outside its groups."""
    bare = re.sub(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]", "", pattern)
    while (inner := re.sub(r"\([^()]*\)", "", bare)) != bare:
        bare = inner
    return pattern.startswith("^") and "|" not in bare


def one_each(found: list[re.Match]) -> list[tuple[str, str]]:
    """Code and number of each clause, in the order of the text."""
    return [(m[1], m[2]) for m in found]


def in_full(found: list[re.Match]) -> list[tuple[str, str]]:
    """Code and number of all provisions that clauses list, ranges in full, the last first, so that 78YA comes before 78Y.

    A range that as many codes name as it has provisions gives one to each code, in order.
    """
    spans = list(dict.fromkeys((m[1], x.strip()) for m in found for part in m[2].split(",") for x in part.split("and")))
    by_range = defaultdict(list)
    for code, span in spans:
        if "-" in span:
            by_range[span].append(code)
    own = {}
    for span, codes in by_range.items():
        numbers = range_of(span)
        if len(numbers) == len(codes):
            own |= {(code, span): [n] for code, n in zip(sorted(codes, key=_natural), numbers)}
    pairs = {(code, n) for code, span in spans for n in own.get((code, span), range_of(span) if "-" in span else [span])}
    return sorted(pairs, key=lambda p: _natural(p[0] + p[1]), reverse=True)


def numbered(component: str) -> Callable:
    """Forms of a line that begins a numbered provision with its code: before the number, after it, before other codes, after a note."""

    def forms(code: str, number: str, _: set[str]):
        def before(m):
            codes, outer, inner, text, first = m.groups()
            return f"{tag(component)}{number}{'-1' if first else ''} {codes}{outer}{code} {inner}{number} {text}"

        def behind(m):
            outer, mid, inner, text, first = m.groups()
            if first not in (None, "1"):
                return m[0]  # a later subsection of its own
            return f"{tag(component)}{number}{'-1' if first else ''} {outer}{number} {mid}{code} {inner}{text}"

        return [
            (rf"^((?:\[?F\d+)*?)(\[?){code} ?(\[?) ?{number}[ .]?([A-Z\[\] ][^()].*|\((1)\).*)", before),
            (rf"^(\[?) ?{number} ?(\[?){code} ?(\[?)([A-Z].*|\((\d+)\).*)", behind),
            (rf"^(\[?){code}((?:\[?F\d+)*?){number}[ .]?(\]?[A-Z].*)", rf"{tag(component)}{number} \g<1>{code}\g<2> {number} \g<3>"),
            (rf"^🔺?(X\d+)🔺? ?(\[?){code}{number}", rf"{tag(component)}{number} \g<1> \g<2>{code} {number}"),
        ]

    return forms


def listed(code: str, number: str, known: set[str]):
    """The form of a section that a list of sections names. A letter glued to the number is part of it if the clauses know such a number."""

    def to(m):
        text, own = m[4], number
        if re.match(r"[A-Z](?=\[?[A-Z])", text) and number + text[0] in known:
            own, text = number + text[0], text[1:]
        return re.sub(r" {2,4}", " ", f"{tag('section')}{own} {m[1] or ''}{m[2] or ''}{code}{m[3] or ''} {own} {text}")

    return [(rf"^(\[?F?\d*)?(\[?)?{code}((?:\[?F?\d*)*) ?{number} ?([A-Z .“].*)", to)]


def heading(code: str, *_):
    return [(rf"^(\[?){code} ?([^0-9].*?)({GEO})$", rf"{tag('heading')}\g<1>{code} \g<2> [::region::]\g<3>")]


def table(code: str, name: str, _: set[str]):
    return [(rf"^((?:\[?F\d*)*?)(\[?){code} ?(\[?) ?{name}(.*)", rf"{tag('table')}\g<1>\g<2>{code} \g<3>{name}\g<4>")]


def provisions(component: str, start: int, code: Callable, tail: Callable, text: Callable = lambda m: m[3][:11]) -> Callable:
    """Writes a range in full: a line for each number from group `start` to the next one."""

    def to(m):
        rows = [f"{tag(component)}{n} {code(m)} {n} {text(m)} [::region::]{m[5] if component != 'annex' else m[3]}" for n in range(int(m[start]), int(m[start + 1]) + 1)]
        return "\n".join(rows) + tail(m)

    return to


def _sub_range(component: str, leading: bool) -> Callable:
    def to(m):
        code, low, high, text = (m[1], m[2], m[3], m[4]) if leading else (m[4], m[1], m[2], m[3])
        return "\n".join(f"{tag(component)}{n} {code} ({n}) {text}" for n in range(int(low), int(high) + 1))

    return to


def _end_range(m: re.Match) -> str:
    """Sections whose code ends the line; digits of the code that stand before the first number are its own."""
    low, high, region, text, code, digits = m.groups()
    low = low.removeprefix(digits) or low
    return "\n".join(f"{tag('section')}{n} {code} {n} {text} [::region::]{region}" for n in range(int(low), int(high or low) + 1))


def _annexes(m: re.Match) -> str:
    return "\n".join(f"{tag('annex')}{n} {m[1]} SCHEDULE {n} {m[5]} [::region::]{m[4]}" for n in range(int(m[2]), int(m[3]) + 1))


def _later_annexes(m: re.Match) -> str:
    if m[5] != m[7]:
        return m[0]
    return "\n".join(f"{tag('annex')}{n} {m[5]} SCHEDULE {n} . . . . . [::region::]{m[3]}" for n in range(int(m[1]), int(m[2]) + 1)) + m[6]


def _ranges(component: str) -> list:
    return [
        Rewrite(rf"^F(\d+) (\d+)(?:-|–|—|, )(\d+)([ .]+)({GEO})([\s\S]+?^🔻F(\d+)🔻)", provisions(component, 2, lambda m: f"F{m[7]}", lambda m: m[6], lambda m: m[4][:11]), whole=True),
        Rewrite(rf"^(\d+)(?:-|–|—|, ?)(\d+)([ .]+)F(\d+) ?({GEO})([\s\S]+?^🔻?F(\d+)🔻?)", provisions(component, 1, lambda m: f"F{m[4]}", lambda m: m[6]), whole=True),
    ]


def _subsections(component: str) -> list:
    return [
        Rewrite(r"^(F\d+)\((\d+)\)(?:-|—)\((\d+)\)([ .]*)", _sub_range(component, True)),
        Rewrite(r"^\((\d+)\)(?:-|—)?\((\d+)\)([ .]*)(F\d+)", _sub_range(component, False)),
        Rewrite(r"^(\( *[A-Z]*\d+[A-Z]* ?\).*?)(\[?F\d+)$", r"\2 \1"),
        Rewrite(r"^(\[?F\d+\[?) ?(\[?F\d+)? *(\[)?\( *([A-Z]*\d+[A-Z]*) ?\) ?(.*)", lambda m: f"{tag(component)}{m[4]} {m[1]}{m[2] or ''} {m[3] or ''}({m[4]}) {m[5]}"),
    ]


def _wash_up(component: str) -> list:
    to = lambda m: f"{tag(component)}{m[2]} {m[1]} {m[2]} {m[4] or ''}{m[5] or ''} [::region::]{m[3] or ''}"
    return [
        Rewrite(rf"^(\[?F\d+) (\d+[A-Z]*)[ .]?(F?\d*)? ?(.*?)({GEO})$", lambda m: f"{tag(component)}{m[2]} {m[1]} {m[2]} {m[3] or ''} {m[4]} [::region::]{m[5]}"),
        Rewrite(rf"^(\[?F\d+) (\d+[A-Z]*)[ .]?(?:({REGION})(.*)|(.*))", to),
    ]


def _notes(lines: Lines) -> Lines:
    """Marks the codes of editorial notes where they begin a line."""
    known = {m for row in lines.rows if row.startswith("[::editorial::]") for m in re.findall(r"^\[::editorial::\](X\d+)", row)}
    if not known:
        return lines

    def marked(row: str) -> str:
        m = re.match(r"(\[F\d+)?(X\d+)( ?)", row)
        if not m or m[2] not in known or len(row) == m.end() and not m[3]:
            return row
        code, rest = m[2], row[m.end() :]
        return f"[🔺{m[1][1:]}🔺 🔺{code}🔺 {rest}" if m[1] else f"🔺{code}🔺 {rest}"

    lines.rows = [marked(row) for row in lines.rows]
    return lines


_LISTS = [(re.compile(p), to) for p, to in ((r" Ss ", " Ss. "), (r" SS\.", " Ss."), (r"([ (])ss\.", r"\1Ss."), (r"( Ss\. \d+[A-Z]*) and", r"\1,"))]


def _lists(lines: Lines) -> Lines:
    """Clauses of amendments write Ss. and hyphens alike."""
    for k, row in enumerate(lines.rows):
        if row.startswith("🔻"):
            if "s" in row or "S" in row:
                for pattern, to in _LISTS:
                    if pattern.search(row):
                        row = pattern.sub(to, row)
            lines.rows[k] = row.replace("–", "-")
    return lines


#: Rules for the whole act before it is divided, for the main text, for the schedules, and for the whole again.
FIRST = [
    Rewrite(r"^(\[?F\d+)(?:\r\n|\n)", r"\1", whole=True),
    Rewrite(r"Sch(?= )", "Sch."),
    Rewrite(r"S\. I\.", "S.I."),
    Rewrite(rf"^(F\d+) ?({CLAUSES})", r"🔻\1🔻 \2"),
    Rewrite(r"^(F\d+?)(\d{4} c\. \d+)", r"🔻\1🔻 \2"),
    Rewrite(rf"^(\[?F\d+)(\[?F\d+)? ?(\[?(?:PART|Part)) ?([IVX\d].*?)({GEO})(.*)", lambda m: f"{tag('part')}{m[1]}{m[2] or ''} {m[3]} {m[4]} {m[6]} [::region::]{m[5]}", tidy=True),
    Rewrite(rf"^(\[?F\d+)(CHAPTER|Chapter)(.*)({REGION})(.*)", rf"{tag('chapter')}\1 \2\3 \5 [::region::]\4", tidy=True),
    Codes(r"🔻(F\d+)🔻 Sch. \d+[A-Z]{0,2} (Table \d+).*", table, one_each),
    Rewrite(r"^(C\d+)(.*)", rf"{tag('modification')}\1 \2"),
    Rewrite(r"^(Commencement Information)\n(I\d+)(.*)", rf"{tag('commencement_heading')}\1\n{tag('commencement')}\2 \3", whole=True),
    Rewrite(r"^(Extent Information)\n(E\d+)(.*)", rf"{tag('extent_heading')}\1\n{tag('extent')}\2 \3", whole=True),
    Rewrite(r"^(Editorial Information)\n(X\d+)(.*)", rf"{tag('editorial_heading')}\1\n{tag('editorial')}\2 \3", whole=True),
    _notes,
    Codes(r"^🔻(F\d+)🔻.*?[Cc]ross[ -]?heading()(?=.*(?:inserted|substituted))", heading, one_each),
]
SECTION_CLAUSES = [r"^🔻(F\d+)🔻 S\. (\d+[A-Z]*)[^(].*", r"^🔻(F\d+)🔻 S\. (\d+).*?(?:repealed|substituted|omitted|ceased|shall cease).*"]
MAIN = [
    *_ranges("section"),
    Rewrite(rf"^(\d+)(?:-|—|, ?)?(\d+)?\.?({GEO})(.*?)(F(\d+))$", _end_range),
    *[Codes(c, numbered("section"), one_each) for c in SECTION_CLAUSES],
    _lists,
    Codes(rf"^🔻(F\d+)🔻(?:.*?[ (]Ss?\. )({SECTIONS}).*?(repealed|inserted|substituted|omitted)", listed, in_full),
    *_subsections("sub_section"),
    *_wash_up("section"),
]
ANNEX = [
    Rewrite(rf"^(F\d+)SCHEDULES (\d+)(?:-|—|, ?)(\d+)\.?({GEO})(.*)", _annexes),
    Rewrite(rf"^SCHEDULES (\d+)(?:-|—|, ?| AND )(\d+)\.?({GEO})(.*?)(F\d+)([\s\S]+?^🔻?(F\d+)🔻?)", _later_annexes, whole=True),
    *_ranges("paragraph"),
    Rewrite(rf"^(\[?[XF]\d+)?(\[?F?\d*) ?(SCHEDULE|Schedule) ([A-Z]*\d+[A-Z]*)[\] .]?({GEO}) ?([A-Z]?.*)", lambda m: f"{tag('annex')}{m[4]} {m[1] or ''}{m[2]} {m[3]} {m[4]} {m[6]} [::region::]{m[5]}", tidy=True),
    Rewrite(r"^(\[?)(F\d{1,3}) ?SCHEDULES", rf"{tag('annex')} \g<0>"),
    Codes(rf"^🔻(F\d+)🔻.*?Schs?\. \d*[A-Z]*.*?paras?\. ?({PARAGRAPHS}).*?by", numbered("paragraph"), in_full),
    *_subsections("sub_paragraph"),
    *_wash_up("paragraph"),
]
LAST = [
    Rewrite(r"^(\[?F\d+)(\[?F?\d*)? *(\[)?\( *([a-z]*) ?\) ?(.*)", lambda m: f"🔸{m[1]}{m[2] or ''} {m[3] or ''}({m[4]}) {m[5]}"),
    Rewrite(rf"^(\[?F\d+) ?(.*?)({REGION})", rf"{tag('heading')}\1 \2 [::region::]\3"),
    Rewrite(r"^(F\d+)([^.\[0-9].*)$", r"🔻\1🔻 \2"),
    Rewrite(r"(\[?F\d{1,4})([A-Za-z])", r"\1 \2"),
]


#: Regions glued to the text of a provision go to its end; provisions without one get an empty one.
REGIONS = [
    Rewrite(rf"^(\[::(?:section|article|paragraph)::\]\S+ (?:[\[XF\d]* ?)?\S*?\d[A-Z]*(?:\(\d+\))?)[ .]?({REGION}) ?((?!\[::region::\]).*)$", lambda m: f"{m[1]} {m[3]} [::region::]{m[2]}" if "[::region::]" not in m[3] else m[0]),
    Rewrite(rf"^(\[::(?:section|article|paragraph|annex|part|chapter|heading)::\](?!.*\[::region::\]).*?) ?({GEO})$", r"\1 [::region::]\2"),
    Rewrite(r"^(.*)( \[::region::\].*?)([ 📌].*)", r"\1\3\2"),
    Rewrite(r" {2,}\[::region::\]", " [::region::]"),
    Rewrite(r"^(\[::(?:section|annex|heading|article|part|chapter|paragraph|sub_paragraph)::\](?!.*\[::region::\]).*)$", r"\1 [::region::]"),
]


def folded(lines: Lines, rules: list) -> Lines:
    for rule in rules:
        lines = rule(lines)
    return lines


def divided(text: str) -> tuple[str, str]:
    """Main text and schedules, whose first line is tagged; no schedules: an empty text."""
    for pattern, to in SCHEDULES:
        found = _compiled(pattern)
        if found.search(text):
            text = found.sub(to, text)
            at = text.rfind("\n" + tag("annex")) + 1
            return (text[:at], text[at:]) if at else ("", text)
    return text, ""


def annotate(text: str) -> str:
    """The annotated text of an act."""
    main, schedules = divided(folded(Lines(text), FIRST).text)
    main = folded(Lines(main), MAIN).text
    schedules = folded(Lines(schedules), ANNEX).text if schedules else ""
    return folded(Lines(f"{main}\n{schedules}" if schedules else main), [*LAST, *REGIONS]).text


@F.pandas_udf(StringType())
def _annotated(texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else annotate(t) for t in texts])


def annotated(laws: DataFrame, text: str = "text", act: Column | None = None) -> DataFrame:
    """The rows with the column `annotated`; act: which of them are acts (all, if not given)."""
    acts = F.lit(True) if act is None else F.coalesce(act, F.lit(False))
    return laws.withColumn("annotated", F.when(acts, _annotated(F.when(acts, F.col(text)))).otherwise(F.col(text)))


def components(laws: DataFrame, law: str, text: str = "annotated") -> DataFrame:
    """(law, line, component, number, text, region) of each line; lines without a tag have no component, clauses of amendments are amendments."""
    rows = laws.select(law, F.posexplode(F.split(text, "\n")).alias("line", "row")).filter(F.trim("row") != "")
    part = lambda k: F.regexp_extract("row", r"^\[::(\w+)::\](\S*) ?(.*?)(?: ?\[::region::\](.*))?$", k)
    clause = F.when(F.col("row").startswith("🔻"), F.regexp_extract("row", r"^🔻(F\d+)🔻 ?(.*)$", 1)).otherwise("")
    tagged = F.col("row").startswith("[::") & (part(1) != "")
    return rows.select(
        law, "line",
        F.when(tagged, part(1)).when(clause != "", "amendment").alias("component"),
        F.when(tagged, part(2)).otherwise(clause).alias("number"),
        F.when(tagged, part(3)).when(clause != "", F.regexp_extract("row", r"^🔻(F\d+)🔻 ?(.*)$", 2)).otherwise(F.col("row")).alias("text"),
        F.when(tagged, part(4)).otherwise("").alias("region"),
    )

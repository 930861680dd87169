"""Laws as published pages, to lines that name their component: `[::section::]4A Title [::region::]E+W`.

A page is a tree of elements whose classes tell what they hold. It is rewritten from the
leaves up: an element that a rule knows becomes one string, made of its children's strings;
any other element stays what its children are. So a rule sees what the rules below it have
made. What is left are the leaves, one line each, which ordered rewritings tidy, and a window
over the lines of a law tells which component a subordinate clause belongs to.

Defined results: null or empty html, and a page without a container, give an empty text;
what the page says is not yet in force, and explanatory notes, are left out; broken markup is
read as far as it goes; repeated rows repeat their result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser
from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.spread import spread
from ..functions.titles import ORDINALS
from ..operators.annotations import Lines, Rewrite, folded, tag

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Tags of the headings of notes, by what they say.
NOTE_HEADINGS = {
    "Modifications etc. (not altering text)": "modification_heading", "Extent Information": "extent_heading", "Commencement Information": "commencement_heading",
    "Textual Amendments": "amendment_heading", "Subordinate Legislation": "subordinate_heading", "Marginal Citations": "marginal_citation",
}
# Tags of notes by the letter of their code; marginal citations have none.
NOTES = {"C": "modification", "F": "amendment", "I": "commencement", "E": "extent", "P": "subordinate", "X": "editorial"}
# Anchors at which schedules begin, and the words of their title.
SCHEDULES, SCHEDULES_TITLE = ("schedule-1", "schedule-n1", "schedule"), ("SCHEDULES", " SCHEDULES", "SCHEDULE S")


@dataclass
class Node:
    name: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)

    @property
    def kind(self) -> str:
        return self.attributes.get("class", "")

    @property
    def id(self) -> str:
        return self.attributes.get("id", "")


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def handle_starttag(self, name, attributes):
        node = Node(name, {k: v or "" for k, v in attributes})
        self.open[-1].children.append(node)
        if name not in VOID:
            self.open.append(node)

    def handle_startendtag(self, name, attributes):
        self.open[-1].children.append(Node(name, {k: v or "" for k, v in attributes}))

    def handle_endtag(self, name):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name == name:
                del self.open[k:]
                break

    def handle_data(self, data):
        if data.strip("\r\n\t"):
            self.open[-1].children.append(data)


def tree(html: str) -> Node:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    return parser.root


def found(node: Node, wanted: Callable[[Node], bool]) -> Node | None:
    """The first node, from the top, that is wanted."""
    todo = [node]
    while todo:
        at = todo.pop()
        if wanted(at):
            return at
        todo += [c for c in reversed(at.children) if isinstance(c, Node)]
    return None


# Numbers in the ids of anchors.

_ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100}


def roman(text: str) -> str:
    """The value of a Roman numeral; anything else as it is."""
    if not text or set(text) - set(_ROMAN):
        return text
    values = [_ROMAN[c] for c in text]
    return str(sum(-v if v < max(values[k:]) else v for k, v in enumerate(values)))


def _dotted(text: str) -> str:
    """Numbers of which an n stands for a point, or before 1 for a hyphen."""
    head, n, tail = text.partition("n")
    return tail if n and not head else head + ("-1" if tail == "1" else f".{tail}") if n else text


def _ordinal(text: str) -> str:
    return str(ORDINALS.index(text.lower()) + 1) if text.lower() in ORDINALS else text


def _part(number: str) -> str:
    letter = number[-1:] if number[-1:] in tuple("ABCD") and len(number) > 1 else ""
    return "1" if number == "Preliminary" else roman(number.removesuffix(letter)) + letter


def _chapter(number: str) -> str:
    number = _ordinal(_dotted(number))
    return str(ord(number) - 64) if re.fullmatch("[A-HJ-U]", number) else number


def anchor(identity: str) -> str | None:
    """The tag and number that an id such as section-4A, schedule-2-part-IIA or schedule-1-paragraph-3-1 names; None if it names none."""
    parts = identity.split("-")
    at = max((k for k, p in enumerate(parts) if p in ("part", "chapter", "section", "article", "regulation", "schedule", "paragraph")), default=None)
    if at is None:
        return None
    kind, values = parts[at], [v.split("_")[0] for v in parts[at + 1 :]]
    outer = parts[0]
    if kind == "schedule":
        return None if at or len(values) > 1 else tag("annex") + (_ordinal(values[0].removeprefix("n")) if values else "1")
    if not values or not values[0]:
        return None
    if kind in ("part", "chapter") and len(values) == 1:
        return tag(kind) + (_part if kind == "part" else _chapter)(values[0])
    if kind == "section" and not at:
        return tag("section") + values[0] if len(values) == 1 else (tag("sub") + values[1] if re.search(r"\d", values[1]) else "") if len(values) == 2 else None
    if kind == "article" and len(values) == 1:
        return tag("article") + values[0]
    if kind == "regulation" and len(values) == 1 and values[0][:1].isdigit() | values[0].startswith("n"):
        return tag("article") + _dotted(values[0])
    if kind == "paragraph" and outer in ("schedule", "paragraph"):
        if len(values) == 2:
            return f"{tag('paragraph')}{values[0]}-1" if values[1] == "1" else tag("sub") + values[1]
        number = values[0].removeprefix("wrapper")
        number = _dotted(number) if values[0] != number else number.partition("n")[0]
        return tag("paragraph") + number if len(values) == 1 and number[:1].isdigit() else None
    return None


# Rules: what an element becomes, from its own node and its children's strings joined by a separator.


@dataclass(frozen=True)
class Rule:
    names: str  # pattern of element names
    kinds: str  # pattern of whole classes
    between: str = " "
    to: Callable[[Node, str], str | None] = lambda node, text: text
    ids: str = ""  # pattern of ids, where they matter


def _capitals(node: Node, text: str) -> str:
    """Titles of parts in capitals: behind the region, or else the last word."""
    text = text.replace("\xa0", " ")
    m = re.match(r"(.*)(\[::region::\] .*?) (.*)", text)
    return f"{m[1]} {m[3].upper()} {m[2]}" if m else re.sub(r"^(.*) (.*)", lambda m: f"{m[1]} {m[2].upper()}", text)


def _chapter_title(node: Node, text: str) -> str:
    return re.sub(r"^(.*)(\[::region::\] ?.*)", lambda m: f"{m[1].upper()} {m[2]}", text)


def _group_title(node: Node, text: str) -> str:
    return re.sub(r"\[::heading::\] *\[::region::\]", "[::region::]", tag("heading") + text.strip())


def _sub_part(node: Node, text: str) -> str:
    m = re.search(r"SUB-PART ([A-Z])", text)
    return f"{tag('chapter')}{ord(m[1]) - 64} {text}\r" if m else text


def _note(node: Node, text: str) -> str | None:
    m = re.match(r" ?([CFIEPX]\d+)", text)
    return f"{tag(NOTES[m[1][0]])}{m[1]} {text}" if m else None


def _notes(node: Node, text: str) -> str:
    return f"{tag('amendment_heading')}Amendments\n{text}" if text.startswith(tag("amendment")) else text


def _note_heading(node: Node, text: str) -> str:
    return next((tag(t) for words, t in NOTE_HEADINGS.items() if words in text), "") + text


def _number(node: Node, text: str) -> str:
    number = anchor(node.id) if node.id else (re.search(r"\d+[A-Z]*", text) or [""])[0]
    return f"{number or ''} {text}"


def _one_number(kind: str) -> Callable[[Node, str], str]:
    """A container in which the first clause repeats the number: `24 24 24-1 (1) text` is `24-1 24 (1) text`."""

    def to(node: Node, text: str) -> str:
        text = re.sub(rf"^(\[::{kind}::\]\d+[A-Z]?) (?:\[::{kind}::\]\d+[A-Z]? )?(\d+[A-Z]?) \[::(?:sub|{kind})::\](?:\d+[A-Z]?-)?1 \(1\) (.*)", r"\1-1 \2 (1) \3", text)
        return text

    return to


_untagged = lambda node, text: re.sub(r"\[::.*?::\]", "", text) + "\r"
_ended = lambda node, text: text + "\r"
_lines = lambda node, text: text.replace("\r", "\n").replace("\n ", "\n")
# Classes of the elements of published laws; the first rule that fits counts.
RULES = [
    Rule(".*", "LegBlockNotYetInForce", to=lambda node, text: None),
    Rule("h[123]", "LegPart.*", to=_capitals),
    Rule("h4", "LegPartFirst", ""),
    Rule("h\\d", "LegChapter.*", to=_chapter_title),
    Rule("a", "LegAnchorID", to=lambda node, text: anchor(node.id) or text),
    Rule("span", "LegScheduleNo"),
    Rule("span", "LegExtentRestriction", "", to=lambda node, text: tag("region") + text),
    Rule("span", "LegPblockTitle", to=lambda node, text: f"{tag('heading')} {text}\r"),
    Rule("h3", "LegPblock.*", to=_sub_part),
    Rule("h4", "LegPblock.*", to=lambda node, text: f"{tag('heading')} {text}\r"),
    Rule("h\\d", "LegP1GroupTitle(?:First)?", to=_group_title),
    Rule("h\\d", "LegP1GroupTitle(?:First)? LegAmend", to=_untagged),
    Rule("p", "LegAnnotationsGroupHeading", "", to=_note_heading),
    Rule("div", "LegAnnotations", "\n", to=_notes),
    Rule("div", "LegCommentaryItem", ids="commentary.*", to=_note),
    Rule("p", "LegClearFix Leg(?:P2|P3|SP2)Container LegAmend|LegP2ParaText LegAmend", to=_ended),
    Rule("p", "LegP1ParaText LegAmend", to=_untagged),
    Rule("p", "LegListTextStandard LegLevel3Amend", ""),
    Rule("span", "LegAmendingText", ""),
    Rule("div", "LegListItem", to=lambda node, text: text.replace("\r", "\n")),
    Rule("p|span", "LegRHS Leg(?:P1|P3)Text.*|LegRHS LegP2Text|LegP2Text"),
    Rule("p", "LegClearFix LegP2Container LegExtentContainer", to=_one_number("section")),
    Rule("p", "LegClearFix LegSP2Container(?: LegExtentContainer)?", to=_one_number("paragraph")),
    Rule("h\\d|p", "LegClearFix Leg(?:P[1-5]|SP[134])Container(?: LegExtentContainer)?"),
    Rule("p", "LegListTextStandard LegLevel3|LegText|LegP1ParaText(?: LegExtentContainer)?"),
    Rule("p", "LegP2ParaText", to=lambda node, text: re.sub(r"(.*?)\(([A-Z]?\d+[A-Z]*)\)(.*)", r"[::sub::]\2 \1 (\2) \3", text)),
    Rule("a", "previewImg", to=lambda node, text: node.attributes.get("href", text)),
    Rule("div", ".*", ids="fig.*", to=lambda node, text: tag("figure") + re.sub(r"\[::.*?::\].*? ", "", text)),
    Rule("div", "LegClearFix LegTableContainer LegAmend", "\n"),
    Rule("div", "LegClearFix LegTableContainer", "\n", to=lambda node, text: tag("table") + text),
    Rule("tbody", ".*", "\n"),
    Rule("thead", ".*", "\n", to=lambda node, text: text + "\n"),
    Rule("th|td", ".*", to=lambda node, text: text.replace("\r", "")),
    Rule("tr", ".*", "\t"),
    Rule("h1", "LegNo"),
    Rule("div", "LegEnactingText", to=lambda node, text: text.replace("\r ", "\n").replace("\n ", "\n")),
    Rule("p", "LegLongTitleScottish", ""),
    Rule("span", "(?:LegDS )?LegP1No|LegDS LegLHS LegP2No|LegDS LegSN[12]No", to=_number),
    Rule("div", "LegClearFix LegSignedSection", "\n", to=lambda node, text: tag("signed") + _lines(node, text)),
    Rule("div", "LegClearFix LegSignee", "\n"),
    Rule("h\\d", "LegSchedulesTitle", to=lambda node, text: tag("annex") + "SCHEDULES"),
    Rule("h[123]", "LegSchedule(?:First)?"),
    Rule("h4", "LegSchedule(?:First)?", to=lambda node, text: re.sub(r"\[::region::\] ?", "", text)),
    Rule("h\\d", "LegSchedulePblock(?:First)?"),
    Rule("p", "LegArticleRef", "", to=lambda node, text: tag("sRef") + text),
    Rule("div", ".*", ids="Legislation.*"),
]
_RULES = [(re.compile(r.names), re.compile(r.kinds), re.compile(r.ids), r) for r in RULES]


@lru_cache(4096)
def _rules_of(name: str, kind: str) -> list[tuple[re.Pattern, Rule]]:
    """The rules that elements of a name and a class may follow, in their order; pages repeat few of both."""
    return [(ids, r) for names, kinds, ids, r in _RULES if names.fullmatch(name) and kinds.fullmatch(kind)]


def leaves(top: Node) -> list[str]:
    """The strings that the rules make of a tree, in order: from the leaves up, without recursion, so that no page is too deep."""
    made: dict[int, list[str]] = {}
    todo = [(top, False)]
    while todo:
        node, ready = todo.pop()
        if not ready:
            todo.append((node, True))
            todo += [(c, False) for c in node.children if isinstance(c, Node)]
            continue
        own = [[c] if isinstance(c, str) else made.pop(id(c)) for c in node.children]
        rule = next((r for ids, r in _rules_of(node.name, node.kind) if not r.ids or ids.fullmatch(node.id)), None)
        if rule is None:
            made[id(node)] = [x for strings in own for x in strings]
            continue
        text = rule.to(node, rule.between.join(s[0] if len(s) == 1 else " ".join(s).strip(" ") for s in own if s).strip(" "))
        made[id(node)] = [] if text is None or text == "" else [text]
    return made.pop(id(top))


def page_text(html: str | None) -> str:
    """The lines of a law's page, main text before schedules, as the rules make them."""
    if not html:
        return ""
    root = tree(html)
    container = found(root, lambda n: "DocContainer" in n.kind.split()) or found(root, lambda n: n.name == "div" and n.id == "viewLegSnippet")
    if container is None:
        return ""
    parts: list[list] = [[], []]
    at = 0
    for child in container.children:
        if isinstance(child, Node):
            if child.name == "a" and child.id == "Legislation-ExNote":
                break
            begins = child.name == "a" and child.id in SCHEDULES or child.name == "h1" and child.kind == "LegSchedulesTitle" and child.children[:1] and child.children[0] in SCHEDULES_TITLE
            at = 1 if begins else at
        parts[at].append(child)
    return "\n".join("\n".join(leaves(Node("", children=p))) for p in parts)


# Rewritings of the lines of a law, in their order.
TIDY = [
    Rewrite("\xa0+", " ", whole=True), Rewrite(r" {2,}", " ", whole=True), Rewrite(r"\n +", "\n", whole=True), Rewrite(r" $", "", whole=True),
    Rewrite(r"(\[::[a-z_]+::\]) ", r"\1", whole=True), Rewrite(r" +([.\];])$", r"\1", whole=True), Rewrite(r"\[ F", "[F", whole=True), Rewrite("“ ", "“", whole=True), Rewrite(" ”", "”", whole=True),
    Rewrite(r"\. *— *\(", ".—(", whole=True), Rewrite(r"(.)\( (\d+) \)", r"\1 (fn\2)", whole=True), Rewrite(r"\r", "\n", whole=True), Rewrite(r"\n{2,}", "\n", whole=True),
    Rewrite(r"^(\([a-z]+\))\n", r"\1 ", whole=True), Rewrite(r"\[::region::\] ", "[::region::]", whole=True), Rewrite(r"(\[::region::\]){2}", "[::region::]", whole=True),
    Rewrite(r"^(\[::\w+::\]\S+)\n(?=\1(?:[ \n]|$))", "", whole=True),  # an anchor before the clause that bears its number
    Rewrite(r"^(\[::region::\].*)\n(\[::article::\].*)", r"\2 \1", whole=True),
    Rewrite(r"(\[::section::\]|\[::article::\]|\[::paragraph::\])(\d+[A-Z]*)([^-\d].*?—.*?\(([A-Z]?1)\))", r"\1\2-\4\3", whole=True),
    Rewrite(r"(\[::part::\].*)\n((?!\[::).*)\n((?!\[::).*)?", lambda m: f"{m[1]} {m[2]} {m[3] or ''}\n", whole=True),
    Rewrite(r"(\[::chapter::\].*)\n(.*\[::region::\].*)", r"\1 \2", whole=True), Rewrite(r"(\[::chapter::\].*)\n((?!\[::).*)", r"\1 \2", whole=True),
    Rewrite(r"(\d+[A-Z])\n(\[::section::\]\1.*)\n((?!\[::).*)\n(\[::region::\].*)?", lambda m: f"{m[2]} {m[3]} {m[4] or ''}\n", whole=True),
    Rewrite(r"^(\[::section::\].*)\n((?!\[::).*)", r"\1 \2", whole=True),
    Rewrite(r"(\[::part::\].*)\n(?:\[::sRef::\](.*)\n)((?!\[::).*)\n((?!\[::).*)?", lambda m: f"{m[1]} {m[3]} {m[4] or ''}\n{m[2]}\n", whole=True),
    Rewrite(r"(\[::part::\].*)\n(\[::region::\].*)\n((?!\[::).*)", r"\1 \3 \2", whole=True),
    Rewrite(r"(\[::annex::\].*)\n(?:\[::sRef::\](.*)\n)((?!\[::).*)\n((?!\[::).*)?", lambda m: f"{m[1]} {m[3]} {m[4] or ''}\n{m[2]}\n", whole=True),
    Rewrite(r"(\[::annex::\].*)\n(\[::region::\].*)?\n?((?!\[::).+)", lambda m: f"{m[1]} {m[3]} {m[2] or ''}", whole=True),
    Rewrite(r"(\[::heading::\]){2}", "[::heading::]", whole=True), Rewrite(r"^\[::heading::\]\[::region::\].+?\n", "", whole=True), Rewrite(r"^\[::heading::\]\n", "", whole=True),
    Rewrite(r"^\d+ (\[::paragraph::\])", r"\1", whole=True), Rewrite(r"^(\[::paragraph::\][\d.]+)\n((?!\[::).*)", r"\1 \2", whole=True), Rewrite(r"\[::paragraph::\][\d.]*\n", "", whole=True),
    Rewrite(r"^\[::marginal_citation::\].*", "", whole=True), Rewrite(r" {2,}", " ", whole=True), Rewrite(r" $", "", whole=True), Rewrite(r"\n{2,}", "\n", whole=True),
]


def tidied(text: str) -> str:
    return folded(Lines(text), TIDY).text.strip("\n")


@F.pandas_udf(StringType())
def _law_text(pages: pd.Series) -> pd.Series:
    return pd.Series([tidied(page_text(html)) for html in pages])


#: What a clause below it is called, by the component that it stands under.
SUBS = {"article": "sub_article", "section": "sub_section", "paragraph": "sub_paragraph"}


def with_subs(lines: DataFrame, key: str, line: str = "line", text: str = "text") -> DataFrame:
    """Lines whose subordinate clauses are named after the last article, section or paragraph before them; without one they stay [::sub::]."""
    before = Window.partitionBy(key).orderBy(line)
    parent = F.last(F.when(F.col(text).rlike(rf"^\[::({'|'.join(SUBS)})::\]"), F.regexp_extract(text, r"^\[::(\w+)::\]", 1)), ignorenulls=True).over(before)
    named = F.concat(F.lit("[::sub_"), F.col("_parent"), F.lit("::]"), F.substring(text, len("[::sub::]") + 1, 1 << 30))
    return lines.withColumn("_parent", parent).withColumn(text, F.when(F.col(text).startswith("[::sub::]") & F.col("_parent").isNotNull(), named).otherwise(F.col(text))).drop("_parent")


def law_lines(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, line, text) of the pages of laws: their lines with tags, subordinate clauses named after what they stand under."""
    texts = spread(pages.select(key, html)).select(key, _law_text(F.col(html)).alias("text"))
    lines = texts.select(key, F.posexplode(F.split("text", "\n")).alias("line", "text")).filter(F.col("text") != "")
    return with_subs(lines, key)

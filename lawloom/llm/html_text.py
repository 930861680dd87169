"""Main text of web pages by the distribution of text over blocks of lines.

Markup is stripped to lines, one for each block element, and each line gets a weight. What
the markup says only weighs; which lines are text is decided by windows:

- a line weighs its characters outside links (of titles and paragraphs, those in links as
  well); a text element (paragraph, heading, list item, ...) or a line that ends like a
  sentence weighs EDGE at least, so short ones are text too, and THRESHOLD at least inside an
  article or main element. Short lines of legal small print outside articles weigh nothing;
- lines that the markup names as no article text (menus, headers, footers, sidebars, notices,
  adverts, forms, comments), and lines outside the article of a page that has one, weigh
  against: more than all the others of the page together.

Weights are summed over sliding windows of up to WINDOW lines. Windows that reach THRESHOLD (or
the largest sum, where none does) cover regions; the surge of a region is its first line of
weight EDGE, the dive its last one, and the lines between them are the text. No window that
holds a line that weighs against can reach it, so regions end there. The threshold is absolute,
so no long paragraph raises it. A page whose windows all hold fewer characters than that has no
surge to speak of: any line of weight may end its text.

What is not shown (code, styles, templates, hidden elements, buttons and lists of choices) is
no line at all.

Defined results: null or empty html gives the empty text; html without tags is one
line; broken markup is read as far as it goes (an end tag closes what it can, a new
paragraph closes the last, a tag that never ends is text), in time that grows with its
length; repeated rows repeat their result; an empty table gives an empty result. Columns
other than page_id, url and html are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices

WINDOW = 3
#: Weight that a window must reach.
THRESHOLD = 60
#: Weight of a line at which text may begin or end.
EDGE = 30

#: Element names of HTML by their role here.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody tfoot thead tr ul caption noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head button select template svg noscript canvas object map datalist option".split())
ASIDE = frozenset("nav header footer aside form dialog menu fieldset".split())
CELLS = frozenset("td th br".split())
CLOSES = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay sidebar rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments disqus replies respond related recommended share sharing social newsletter subscribe subscription signup login widget widgets toolbar pagination pager".split()
)
#: Marks that name what a class or id is about wherever they begin or end it ("reader-comments", "advert-box-wide"), also with an ending of LISTS.
STRONG = frozenset("advert adverts advertisement advertising adsense sponsored cookie cookies gdpr sidebar nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments disqus newsletter popup modal pagination".split())
LISTS = ("", "list", "lists", "box", "bar", "area", "form", "section", "thread", "wrap", "wrapper", "item", "items")
#: Words that make a name of its own of any mark ("notice-of-appeal", "comment-on-the-bill").
JOINTS = frozenset("of on in for to and the or with without has no about hoc".split())
#: Words that may stand beside any other mark in one class or id ("site-menu", "share-links"); other words make it a name of its own.
BESIDE = frozenset("main site page post article blog global primary secondary top bottom left right header inner outer box bar block container wrapper wrap content section area list item items group links link button buttons icons policy unit slot form title text".split())
#: Elements of running text, whose id is an anchor named after their content.
TEXT = frozenset("h1 h2 h3 h4 h5 h6 p".split())
#: Elements that hold text, not boxes of a layout.
TEXT_BLOCKS = TEXT | frozenset("li dd dt td th tr blockquote pre figcaption caption address".split())
#: These mark no article text only outside the article itself.
OUTER_MARKS = frozenset("header headers site-header page-header".split())

_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_TAG_END = re.compile(r">|=\s*[\"']")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
#: Fixed value: characters that end a sentence.
#: Fixed value: small print of sites; only lines of up to SMALL characters are.
SMALL = 100
_SMALL_PRINT = re.compile(r"©|\(c\) ?\d|\bcopyright\b|all rights reserved|\bterms of (?:use|service)\b|\bprivacy policy\b", re.I)
_SENTENCE_ENDS = tuple('.!?:;…。！？"\'”’»)')


def tokens(html: str):
    """(closing, name, attributes, text) of each piece: a tag, or text where name is None. Each character is visited a bounded number of times."""
    at, n = 0, len(html)
    ends = True  # some '>' may still follow
    quotes = {'"': True, "'": True}
    while at < n:
        left = html.find("<", at)
        if left < 0:
            left = n
        if left > at:
            yield False, None, "", html[at:left]
        if left == n:
            return
        if html.startswith("<!--", left):
            end = html.find("-->", left + 4)
            at = n if end < 0 else end + 3
            continue
        if html.startswith("<![CDATA[", left):
            end = html.find("]]>", left)
            at = n if end < 0 else end + 3
            continue
        m = _TAG.match(html, left + 1)
        bogus = html.startswith(("<!", "<?"), left)
        end = -1
        if ends and (m or bogus):
            pos = m.end() if m else left
            while m and any(quotes.values()) and (hit := _TAG_END.search(html, pos)):
                if hit[0] == ">":
                    end = hit.start()
                    break
                quote = hit[0][-1]
                close = html.find(quote, hit.end()) if quotes[quote] else -1
                quotes[quote] = close >= 0
                pos = close + 1 if close >= 0 else hit.end()
            if end < 0:  # quotes that do not close, or a declaration
                if m:
                    quotes = dict.fromkeys(quotes, False)
                end = html.find(">", m.end() if m else left)
                ends = end >= 0
        if end < 0:
            yield False, None, "", "<"
            at = left + 1
            continue
        at = end + 1
        if not m:
            continue
        closing, name, attributes = bool(m[1]), m[2].lower(), html[m.end() : end]
        yield closing, name, attributes, ""
        if name in RAW and not closing and not attributes.rstrip().endswith("/"):  # its content is no markup
            raw_end = _RAW_END[name].search(html, at)
            at = raw_end.end() if raw_end else n


def _marked(token: str, marks: frozenset[str]) -> bool:
    """Whether a class or id names something beside the text."""
    words = [w.lower() for w in _WORDS.findall(token) if not w.isdigit()]
    if not words or JOINTS & set(words):
        return False
    strong = any(w == m + e for w in (words[0], words[-1]) for m in STRONG & marks for e in LISTS if w.startswith(m))
    return strong or bool(set(words) & marks) and set(words) <= marks | BESIDE


def _place(name: str, attributes: str, in_article: bool) -> int:
    """0: where text may be; 1: what weighs against; 2: what is not shown. Inline elements that are marked are not shown."""
    aside = 1 if name in BLOCKS else 2
    place = 2 if name in UNSEEN else aside if name in ASIDE and not (name == "header" and in_article) else 0
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes and name not in ("body", "html") else ():
        key, value = key.lower(), next((v for v in values if v), "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return 2
        if name == "main" or key == "id" and in_article and name in TEXT:
            continue
        marks = MARKS if in_article else MARKS | OUTER_MARKS
        if key == "role" and value.lower() in ROLES or key in ("class", "id") and any(_marked(t, marks) for t in value.split()):
            place = max(place, aside)
    return place


@dataclass
class Line:
    text: str
    plain: int  # characters outside links
    linked: int  # characters in links
    element: str  # innermost block
    article: bool
    aside: bool  # the markup names it as no article text


def lines(html: str) -> list[Line]:
    """The lines of a page in order."""
    found: list[Line] = []
    stack: list[tuple[str, int, bool, str]] = []  # name, place, article, innermost block
    opened: Counter = Counter()
    parts: list[str] = []
    plain, linked, in_link = 0, 0, False

    def end_line() -> None:
        nonlocal plain, linked
        text = " ".join("".join(parts).split())
        if text:
            _, place, article, block = stack[-1] if stack else ("", 0, False, "")
            found.append(Line(text, plain, linked, block, article, place > 0))
        parts.clear()
        plain, linked = 0, 0

    def close(k: int) -> None:
        for name, *_ in stack[k:]:
            opened[name] -= 1
        del stack[k:]

    for closing, name, attributes, text in tokens(html):
        if name is None:
            if stack and stack[-1][1] == 2:
                continue
            text = unescape(text)
            parts.append(text)
            if in_link:
                linked += len("".join(text.split()))
            else:
                plain += len("".join(text.split()))
            continue
        if name in CELLS:
            parts.append(" ")
        elif name in BLOCKS:
            end_line()
        if closing:
            if name == "a":
                in_link = False
            if opened[name] > 0:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                close(k)
            continue
        if name in RAW or name in VOID or attributes.rstrip().endswith("/"):
            continue
        if name == "a":
            in_link = True
            continue
        for inner, closers in CLOSES.items():
            if stack and stack[-1][0] == inner and name in closers:
                close(len(stack) - 1)
        _, place, article, block = stack[-1] if stack else ("", 0, False, "")
        if name not in BLOCKS and name not in UNSEEN and name not in ASIDE and not attributes:
            continue
        article = article or name in ("article", "main") and not place
        stack.append((name, max(place, _place(name, attributes, article)), article, name if name in BLOCKS else block))
        opened[name] += 1
    end_line()
    return found


def weights(found: list[Line]) -> list[int]:
    """How much each line counts as text; less than nothing where it counts against."""
    inside = any(x.article and not x.aside and x.plain + x.linked for x in found)
    out = []
    for x in found:
        shown = x.plain + (x.linked if x.element in TEXT else 0)
        if x.aside or inside and not x.article:
            out.append(-1)
        elif not shown or not inside and len(x.text) <= SMALL and _SMALL_PRINT.search(x.text):
            out.append(0)
        elif x.element in TEXT_BLOCKS or x.text.endswith(_SENTENCE_ENDS):
            out.append(max(shown, THRESHOLD if inside else EDGE))
        else:
            out.append(shown)
    against = sum(w for w in out if w > 0) + 1
    return [w if w >= 0 else -against for w in out]


def window_sums(weight: list[int]) -> list[int]:
    """The largest sum of the windows of 1 to WINDOW lines that end at each line."""
    return [max(sum(weight[k - n + 1 : k + 1]) for n in range(1, min(WINDOW, k + 1) + 1)) for k in range(len(weight))]


def covered(weight: list[int], least: int) -> list[bool]:
    """Lines that some window of 1 to WINDOW lines with a sum of `least` or more holds."""
    out = [False] * len(weight)
    for k in range(len(weight)):
        total = 0
        for n in range(min(WINDOW, k + 1)):
            total += weight[k - n]
            if total >= least:
                out[k - n : k + 1] = [True] * (n + 1)
    return out


def surges(weight: list[int], shown: list[int]) -> list[tuple[int, int]]:
    """Surge and dive of each region, its first line and one past its last, from the weights and characters of lines."""
    least = min(THRESHOLD, max(window_sums(weight), default=0))
    if least <= 0:
        return []
    flat = max(window_sums([p for p, w in zip(shown, weight) if w > 0])) < THRESHOLD
    edge = 1 if flat else min(EDGE, max(weight))
    held, out, k = covered(weight, least), [], 0
    while k < len(weight):
        if not held[k]:
            k += 1
            continue
        end = k
        while end < len(weight) and held[end]:
            end += 1
        text = [j for j in range(k, end) if weight[j] >= edge]
        if text:
            out.append((text[0], text[-1] + 1))
        k = end
    return out


def extract(html: str | None) -> tuple[str, list[tuple[int, int]]]:
    """The text, and the surge and dive of each region of it."""
    found = lines(html or "")
    spans = surges(weights(found), [x.plain + x.linked for x in found])
    return "\n".join(x.text for a, b in spans for x in found[a:b]), spans


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and spans (surge, dive: line numbers) of every row."""

    def work(batches):
        kind = pa.list_(pa.struct([("surge", pa.int32()), ("dive", pa.int32())]))
        for batch in slices(batches, "html", 4 << 20):
            out = [extract(h) for h in batch.column(2).to_pylist()]
            spans = pa.array([[{"surge": a, "dive": b} for a, b in x[1]] for x in out], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.string()), spans], ["page_id", "url", "text", "spans"])

    return pages.select("page_id", "url", "html").mapInArrow(work, "page_id long, url string, text string, spans array<struct<surge:int,dive:int>>")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

"""Cleaning of statute texts: quotation marks, inserted blocks, numbers without text, empty lines."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .titles import rewritten

# Words before a block of text that goes into another law.
INSERTING = [
    "inserte?d?.*?—",
    "substituted?.*?—",
    "adde?d?—",
    "sections are—$",
    "(?:substituted|inserted) the following (?:subsections?|sections?|Schedules?|Parts?|s?u?b?-?paragraphs?)—",
    "[Tt]he following (?:provisions|sections|sub-paragraph)? ?shall be (?:substituted|inserted) (?:after|in) .*?—",
    "substituted in each case—",
    r"\(and the italic cross-heading before it\) insert—",
]
#: Longer blocks keep so many characters at each end.
LONG_BLOCK, ENDS = 500, 200


def curly_quotes(text: Column) -> Column:
    """Straight double quotes as opening or closing ones, by what stands beside them."""
    return rewritten(text, [(r'(^|[ (“]|F\d+\(?\d*\)?)"(?=\w)', "$1“"), (r'(?m)^" ?', "“"), ('"', "”")])


def numbered_text(text: Column) -> Column:
    """Numbers and letters on a line of their own join the line after them."""
    return rewritten(text, [(r"(?m)^(\((?:[a-z]+|[ivmcldx]+)\))\r?\n", "$1 "), (r"(?m)^(\d+\.?)\n(?=\()", "$1")])


def without_empty_lines(text: Column) -> Column:
    return rewritten(text, [(r"\A\s*\n", ""), (r"(?:\r?\n[ \t]*)+(?=\r?\n)", "")])


def elided(text: Column, limit: int = LONG_BLOCK, ends: int = ENDS) -> Column:
    """A text over the limit as its two ends."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, ends), F.lit("📌...📌"), F.right(text, F.lit(ends)))).otherwise(text)


def prefixed(word: Column, dictionary: list[str], size: int = 5) -> Column:
    """Whether the first letters of a word are those of a word of the dictionary."""
    return F.lower(F.substring(word, 1, size)).isin(sorted({w[:size].lower() for w in dictionary}))


def _block_end(text: str, start: int) -> int:
    """One past the mark that closes the one at start; -1 if none does."""
    depth = 0
    for m in re.compile("[“”]").finditer(text, start):
        depth += 1 if m[0] == "“" else -1
        if not depth:
            return m.end()
    return -1


@F.pandas_udf(StringType())
def joined_inserts(texts: pd.Series) -> pd.Series:
    """Quoted blocks that go into another law on one line: their line ends become 📌, and long ones keep their ends only.

    A block begins on the line after words such as "there is inserted—" and ends where its quotation marks balance.
    """
    opening = re.compile(rf"(?:{'|'.join(INSERTING)})[^\n]*\n[^\n]*?(?=“)", re.M)

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        while m := opening.search(text, at):
            end = _block_end(text, m.end())
            if end < 0:
                out.append(text[at : m.end()])
                at = m.end()
                continue
            line = text.index("\n", m.start(), m.end())
            block = text[line:end]
            if len(block) > LONG_BLOCK:
                block = block[:ENDS] + "📌...📌" + block[-ENDS:]
            out += [text[at:line], block.replace("\n", " 📌")]
            at = end
        return "".join(out) + text[at:]

    return texts.map(one)

"""Paragraph outlines of regulations: list markers, the depth they give, inline markers that begin a clause."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAD = re.compile(r"\(([A-Za-z0-9]+)\)|([A-Za-z0-9]+)[.)]")
INLINE = re.compile(r"(?:\s|[\u2014-])(\(([A-Za-z0-9]+)\))(?=\s|[\u2014-]|$)")
TELEPHONE = re.compile(r"\s*\d{3}[-\s]\d{4}\b")
CLAUSE_END = re.compile(r"[.:;!?\u2014-](?:\s*(?:and|or))?\s*$", re.IGNORECASE)
# What a marker is followed by where it is a citation.
CITED = re.compile(r"\s*(?:of|to)\s+(?:this|that|the|paragraphs?|sections?|subparagraphs?|subsections?|parts?|chapters?|appendix|appendixes|sec\.?|\u00a7|\()", re.IGNORECASE)
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
# The levels of lists, by whether letters or numbers were met first.
LETTERS_FIRST, NUMBERS_FIRST = ("lower", "num", "roman", "upper"), ("num", "lower", "roman", "upper")


def kind_of(token: str) -> str | None:
    """num, upper, lower, roman, ``either`` for i, v and x, or None for what is no marker. Letters may be doubled (aa)."""
    if token.isdigit():
        return "num"
    letters = len(token) == 1 or (len(token) == 2 and token[0] == token[1])
    if token.isupper():
        return "upper" if letters else None
    if not token.islower() or not token.isalpha():
        return None
    if set(token) <= set(ROMAN):
        return "either" if token in ("i", "v", "x") else "lower" if len(token) == 1 else "roman"
    return "lower" if letters else None


def roman(token: str) -> int:
    digits = [ROMAN[c] for c in token.lower()]
    return sum(-d if d < max(digits[i:]) else d for i, d in enumerate(digits))


def leading_markers(text: str) -> Iterator[tuple[str, str]]:
    """(token, kind) of the markers a paragraph begins with, such as (a)(1); numbers that are telephone numbers or years are none."""
    text, at = " ".join((text or "").split()), 0
    while found := LEAD.match(text, at):
        token, rest = found[1] or found[2], text[found.end() :]
        kind, more = kind_of(token), LEAD.match(rest) or rest.startswith("(")
        if not kind or not (more or not rest or rest[0] in " \u2014-"):
            return
        body = rest.lstrip()
        number = kind == "num" and (len(token) > 3 or (len(token) == 3 and body[:1].isdigit()) or TELEPHONE.match(body))
        word = found[2] and kind not in ("num", "roman") and len(token) > 2
        if number or word:
            return
        yield token, kind
        at = found.end()
        if not more:
            return


class Outline:
    """The lists that are open at a point of a section, outermost first."""

    def __init__(self) -> None:
        self.open: list[tuple[str, str]] = []
        self.levels = NUMBERS_FIRST
        self.settled = False

    def reading(self, token: str) -> str:
        """Whether i, v or x is a letter or a roman number here."""
        if not self.open:
            return "lower"
        kind, last = self.open[-1]
        if kind in ("num", "roman"):
            return "roman"
        if kind == "lower":
            return "lower" if len(last) == 1 and ord(token) == ord(last) + 1 else "roman"
        numbers = [t for k, t in self.open[:-1] if k == "roman"]
        return "roman" if numbers and roman(token) - roman(numbers[-1]) in (0, 1) else "lower"

    def add(self, token: str, kind: str) -> int:
        """The depth of a marker: it goes on with an open list, opens one below, or one below the last that ranks higher."""
        kind = self.reading(token) if kind == "either" else kind
        top = self.open[-1][0] if self.open else None
        if not self.settled and {top, kind} == {"lower", "num"}:
            self.levels, self.settled = LETTERS_FIRST if top == "lower" else NUMBERS_FIRST, True
        rank = self.levels.index
        same = [i for i, (k, _) in enumerate(self.open) if k == kind]
        if same and (kind == top or rank(kind) <= rank(top)):
            keep = same[-1]
        elif top and rank(kind) > rank(top):
            keep = len(self.open)
        else:
            keep = max((i + 1 for i, (k, _) in enumerate(self.open) if rank(k) < rank(kind)), default=0)
        self.open[keep:] = [(kind, token)]
        return len(self.open)


def outline_levels(lines: DataFrame, key: str) -> DataFrame:
    """(key, ord, level, depth) of every line (key, ord, text): the depth of its own last marker, null without one, and the depth in force.

    A section's lines pass in order through one task as a stream that holds the open lists alone, so a section may have
    any number of lines. Rows that share ord come in the order of their texts; a null text has no marker; lines before the
    first marker have depth 0. The key may have any type and be null."""
    kept = lines.select(key, "ord", "text")
    shape = f"`{key}` {kept.schema[key].dataType.simpleString()}, ord {kept.schema['ord'].dataType.simpleString()}, level int, depth int"

    def fold(batches):
        section, state, depth = object(), None, 0
        for batch in batches:
            levels, depths = [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if state is None or k != section:
                    section, state, depth = k, Outline(), 0
                level = None
                for token, kind in leading_markers(text):
                    level = state.add(token, kind)
                depth = depth if level is None else level
                levels.append(level)
                depths.append(depth)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(levels, pa.int32()), pa.array(depths, pa.int32())], names=[key, "ord", "level", "depth"])

    return kept.repartition(key).sortWithinPartitions(key, "ord", "text").mapInArrow(fold, shape)


def clauses(text: str) -> list[str]:
    """A paragraph that begins with a marker, cut where its first inline marker begins a clause, and so on with what is left.

    A marker begins a clause after a stop, colon, semicolon or dash (and 'and' or 'or'), if text follows that does not make
    it a citation or part of a number."""
    out, text = [], " ".join((text or "").split())
    while True:
        own = LEAD.match(text)
        found = INLINE.search(text, own.end()) if text.startswith("(") and own and any(leading_markers(text)) else None
        if not found:
            return [*out, text]
        token, tail = found[2], text[found.end() :]
        kind = kind_of(token)
        body = tail.lstrip(" \u2014-")
        odd = kind == "num" and (len(token) > 2 or body[:1].isdigit() or TELEPHONE.match(body))
        if not kind or not body or odd or (kind == "upper" and len(token) > 1) or CITED.match(tail) or not CLAUSE_END.search(text[: found.start(1)]):
            return [*out, text]
        out.append(text[: found.start(1)].strip())
        text = text[found.start(1) :]


def split_clauses(lines: DataFrame, key: str) -> DataFrame:
    """(key, ord, piece, text): lines cut by ``clauses``; blanks are single. Null texts give no piece."""
    kept = lines.select(key, "ord", "text").where("text is not null")
    shape = f"`{key}` {kept.schema[key].dataType.simpleString()}, ord {kept.schema['ord'].dataType.simpleString()}, piece int, text string"

    def cut(batches):
        for batch in batches:
            pieces = [clauses(t) for t in batch.column(2).to_pylist()]
            rows = pa.array([i for i, p in enumerate(pieces) for _ in p], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array([i for p in pieces for i in range(len(p))], pa.int32()), pa.array([t for p in pieces for t in p], pa.string())], names=[key, "ord", "piece", "text"])

    return kept.mapInArrow(cut, shape)

"""Oversized texts in pieces under a limit, by packing a structure tree.

A text is parsed into a tree of contiguous spans: sections (a heading and what follows it, by depth of heading: Markdown,
numbers, LaTeX, HTML), blocks (separated by blank lines), list items with what is indented below them, lines, words and
characters. Subtrees of the same parent are merged from the bottom up as long as they stay within the limit, and only a
node that is too large itself is descended into, so every cut is at the coarsest boundary that serves. How far the descent
into the tree must go at the full limit is the text's coarsest cut. A line of more than HEADING characters is no heading. Each piece but the first is led by the last `overlap` characters before it; overlap and
core together never exceed the limit. Cores follow each other without gap: dropping the overlaps gives the text back.

Blanks, tabs, line breaks (LF or CRLF) and form feeds are white space here; no-break blanks are text. Null and empty
texts give no pieces. A limit that is null or below 1 means no limit; an overlap is cut to the range 0..limit-1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK_LINES = re.compile(r"\r?\n(?:[ \t\f]*\r?\n)+")
LINE = re.compile(r"\r?\n")
WORD = re.compile(r"(?:[ \t\f]|\r?\n)+")
SPACE = " \t\r\n\f"
HEADING = 120
_HASHES = re.compile(r"(#{1,6})[ \t]+\S")
_NUMBERED = re.compile(r"(\d{1,3}(?:\.\d+)*)\.?[ \t]+(\S.*)")
_LATEX = re.compile(r"\\(part|chapter|section|subsection|subsubsection|paragraph|subparagraph)\*?\s*[{\[]")
_LATEX_DEPTH = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
_HTML = re.compile(r"<h([1-6])[\s>]", re.IGNORECASE)
_ITEM = re.compile(r"([ \t\f]*)(?:[-*+•‣]|\d{1,3}[.)]|[a-z][.)]|\\item\b|<li[\s>])(?=[ \t]|[^\s\d]|$)")

KINDS = ("paragraph", "line", "word")


def _parts(text: str, s: int, e: int, cut: re.Pattern) -> list[tuple[int, int]]:
    """Spans of s..e that end after each cut."""
    ends = [m.end() for m in cut.finditer(text, s, e)]
    if not ends or ends[-1] != e:
        ends.append(e)
    return [(a, b) for a, b in zip([s, *ends], ends) if b > a]


def heading_depth(line: str) -> int | None:
    """Depth of a heading: the number of # or of numbers (1.2.3), the kind of LaTeX or HTML heading; None for other lines.

    What follows a number must look like a title: it starts with a capital or a letter without case and ends without a
    mark. Otherwise the line is an item or a sentence.
    """
    line = line.strip(SPACE)
    if len(line) > HEADING or LINE.search(line):
        return None
    if m := _HASHES.match(line):
        return len(m[1])
    if m := _LATEX.match(line):
        return _LATEX_DEPTH[m[1]]
    if m := _HTML.match(line):
        return int(m[1])
    m = _NUMBERED.match(line)
    if not m or (line[m.end(1)] == "." and "." not in m[1]):
        return None
    first = m[2][0]
    return m[1].count(".") + 1 if first.isalpha() and not first.islower() and line[-1] not in ".!?;:,。！？।" else None


def sections(text: str, blocks: list[tuple[int, int]]) -> list[tuple[int | None, int, int]]:
    """(heading depth or None, start, end) of every block."""
    return [(heading_depth(text[a:b]), a, b) for a, b in blocks]


def _tree(items: list[tuple[int | None, int, int]]) -> list:
    """Nodes ([start, end], children) nested by heading depth; blocks have no children."""
    root: list = []
    stack: list[tuple[int, list]] = [(-1, root)]
    for depth, a, b in items:
        if depth is None:
            stack[-1][1].append(([a, b], []))
        else:
            while stack[-1][0] >= depth:
                stack.pop()
            node: tuple = ([a, b], [([a, b], [])])
            stack[-1][1].append(node)
            stack.append((depth, node[1]))
        for _, nodes in stack[:-1]:
            nodes[-1][0][1] = b  # open sections grow
    return root


def parse(text: str) -> list:
    """The tree of sections and blocks."""
    return _tree(sections(text, _parts(text, 0, len(text), BLANK_LINES)))


def _items(text: str, s: int, e: int) -> list:
    """The tree of a block's list items by indentation; lines that start no item belong to the item before."""
    found: list[tuple[int | None, int, int]] = []
    for a, b in _parts(text, s, e, LINE):
        m = _ITEM.match(text, a, b)
        if m:
            found.append((len(m[1].expandtabs()), a, b))
        elif found:
            found[-1] = (found[-1][0], found[-1][1], b)
        else:
            found.append((None, a, b))
    return _tree(found) if any(d is not None for d, _, _ in found) else []


def _body(text: str, s: int, e: int) -> tuple[int, int]:
    """s..e without the white space at its ends."""
    part = text[s:e]
    return e - len(part.lstrip(SPACE)), s + len(part.rstrip(SPACE))


def coarsest_cut(text: str, limit: int, tree: list | None = None) -> str:
    """The coarsest kind of boundary that leaves no stretch above the limit, or none: the level to which the tree must be descended."""
    deepest = 0

    def down(s: int, e: int, level: int) -> None:
        nonlocal deepest
        a, b = _body(text, s, e)
        if b - a > limit:
            deepest = max(deepest, level + 1)
            if level < 2:
                for x, y in _parts(text, s, e, (LINE, WORD)[level]):
                    if y - x > limit:
                        down(x, y, level + 1)

    todo = list(parse(text) if tree is None else tree)
    while todo:
        (s, e), children = todo.pop()
        if e - s > limit:
            if children:
                todo += children
            else:
                down(s, e, 0)
    return (*KINDS, "none")[deepest]


def pack(text: str, limit: int, tree: list | None = None) -> list[tuple[int, int]]:
    """Spans of at most `limit` characters that cover the text."""

    def add(spans: list[tuple[int, int]], into: list[tuple[int, int]]) -> None:
        for a, b in spans:
            if into and b - into[-1][0] <= limit:
                into[-1] = (into[-1][0], b)
            else:
                into.append((a, b))

    def finer(s: int, e: int, level: int) -> list[tuple[int, int]]:
        """A block, line or word that is too large."""
        if level == 2:
            return [(x, min(x + limit, e)) for x in range(s, e, limit)]
        if level == 0 and (items := _items(text, s, e)):
            return descend(items, 1)
        merged: list[tuple[int, int]] = []
        for a, b in _parts(text, s, e, (LINE, WORD)[level]):
            add([(a, b)] if b - a <= limit else finer(a, b, level + 1), merged)
        return merged

    def lines(s: int, e: int) -> list[tuple[int, int]]:
        """An item that is too large."""
        merged: list[tuple[int, int]] = []
        for a, b in _parts(text, s, e, LINE):
            add([(a, b)] if b - a <= limit else finer(a, b, 1), merged)
        return merged

    def descend(nodes: list, level: int) -> list[tuple[int, int]]:
        merged: list[tuple[int, int]] = []
        for (s, e), children in nodes:
            if e - s <= limit:
                add([(s, e)], merged)
            else:
                add(descend(children, level) if children else lines(s, e) if level else finer(s, e, 0), merged)
        return merged

    return descend(parse(text) if tree is None else tree, 0)


def pieces(text: str, limit: int | None, overlap: int | None, tree: list | None = None) -> list[tuple[int, int, int]]:
    """(start with overlap, start of the core, end) of every piece."""
    if not text:
        return []
    if limit is None or limit < 1 or len(text) <= limit:
        return [(0, 0, len(text))]
    overlap = min(max(overlap or 0, 0), limit - 1)
    return [(max(0, a - overlap), a, b) for a, b in pack(text, limit - overlap, tree)]


OUT = "piece int, start_pos int, core_pos int, end_pos int, text string, coarsest_cut string"


def split(df: DataFrame, key: str, text: str, limit: str, overlap: str, with_text: bool = True, oversized_only: bool = False) -> DataFrame:
    """Pieces of df's texts: the columns of `key` (a name), piece (from 0), start_pos, core_pos, end_pos, text, coarsest_cut.

    start_pos counts characters and includes the overlap, which ends at core_pos. coarsest_cut is null for texts within
    the limit. Narrow: texts are handled one by one where they are read.
    """
    kind = df.schema[key].dataType.simpleString()
    size = F.char_length("text")
    base = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(limit).cast("int").alias("lim"), F.col(overlap).cast("int").alias("over")).where(size > 0)
    over = (F.col("lim") >= 1) & (size > F.col("lim"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, t, lim, ov in zip(pdf["key"], pdf["text"], pdf["lim"], pdf["over"]):
                tree = parse(t)
                cut = coarsest_cut(t, int(lim), tree)
                for i, (s, c, e) in enumerate(pieces(t, int(lim), None if pd.isna(ov) else int(ov), tree)):
                    rows.append((k, i, s, c, e, t[s:e] if with_text else None, cut))
            yield pd.DataFrame(rows, columns=["key", "piece", "start_pos", "core_pos", "end_pos", "text", "coarsest_cut"])

    out = base.where(over).mapInPandas(run, f"key {kind}, {OUT}")
    if not oversized_only:
        whole = base.where(~F.coalesce(over, F.lit(False)))
        out = out.unionByName(whole.select("key", F.lit(0).alias("piece"), F.lit(0).alias("start_pos"), F.lit(0).alias("core_pos"), size.cast("int").alias("end_pos"), (F.col("text") if with_text else F.lit(None).cast("string")).alias("text"), F.lit(None).cast("string").alias("coarsest_cut")))
    return out.withColumnRenamed("key", key)

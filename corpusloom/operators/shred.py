"""Nested semi-structured records to related flat tables, by columnar shredding with repetition and definition levels.

Every repeated group has a path: `entries`, `entries/children`, `learning_pathways/checkpoints/assessments`. A record is
shredded into one column per leaf under each path. A column holds, in document order, a repetition level (the repeated
group that repeats at this value), a definition level and the value. Each repeated group adds two definition levels: one
for a slot in the array, one for a slot that is not null; a leaf that is present and not null adds one more. The leaf `@`
is in every group and marks its elements, so that a table's rows and their positions follow from that column alone, and
a query that needs no other field shreds no other column.

Tables come back from the level sequences: a running count per repetition level gives the index at each level, and
with it position and parent position. Both steps work record by record, in Arrow batches and without a shuffle.

Groups may recur (children of children): each depth found is a path of its own. Arrays may come as JSON inside a string,
as a lone element, with null elements, or as a map of lists whose keys then stand for one level. The record may lie
inside envelope objects.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from json.decoder import scanstring

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "@"


@dataclass(frozen=True)
class Group:
    """A repeated group: rows of `kind`, with its repeated groups by field name.

    keyed: the field is a map of lists; its key is a level of its own. Fields in `recursive` hold elements of this same group.
    """

    kind: str
    groups: dict[str, "Group"] = field(default_factory=dict)
    recursive: tuple[str, ...] = ()
    keyed: bool = False

    def child(self, name: str) -> "Group | None":
        return self if name in self.recursive else self.groups.get(name)

    def names(self) -> tuple[str, ...]:
        return (*self.recursive, *self.groups)


#: The records of this project: a book's entries, and a curriculum's pathways.
BOOK_TOC = {"entries": Group("entry", recursive=("children",))}
CURRICULUM = {
    "learning_pathways": Group(
        "pathway",
        {
            "topic_sequence": Group("topic"),
            "checkpoints": Group("checkpoint", {"assessments": Group("assessment")}),
            "adaptive_branching": Group("branch", keyed=True),
        },
    )
}
RECORDS = {**BOOK_TOC, **CURRICULUM}


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


_BLANK = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"(null|true|false)|(-?(?:0|[1-9][0-9]*))(\.[0-9]+)?([eE][-+]?[0-9]+)?")
_CONSTANTS = {"null": None, "true": True, "false": False}


def _parse_deep(text: str):
    """json.loads without recursion, for nesting beyond it: open containers are kept on a stack."""
    skip = _BLANK.match
    i, n = skip(text, 0).end(), len(text)
    holders: list = []  # open objects and arrays; for an object, also the name that waits for a value
    names: list = []
    while True:
        ch = text[i : i + 1]
        if ch in ("{", "["):
            value = {} if ch == "{" else []
            i = skip(text, i + 1).end()
            if text[i : i + 1] == ("}" if ch == "{" else "]"):
                i += 1
            else:
                holders.append(value)
                names.append(None)
                if ch == "{":
                    names[-1], i = _name(text, i)
                continue
        elif ch == '"':
            value, i = scanstring(text, i + 1, True)
        else:
            m = _SCALAR.match(text, i)
            if not m:
                raise ValueError(f"no JSON at {i}")
            i = m.end()
            value = _CONSTANTS[m[1]] if m[1] else float(m[0]) if m[3] or m[4] else int(m[2])
        while True:  # the value goes into what holds it, which may close
            i = skip(text, i).end()
            if not holders:
                if i < n:
                    raise ValueError(f"more text at {i}")
                return value
            top = holders[-1]
            if isinstance(top, dict):
                top[names[-1]] = value
            else:
                top.append(value)
            ch = text[i : i + 1]
            i = skip(text, i + 1).end()
            if ch == ",":
                if isinstance(top, dict):
                    names[-1], i = _name(text, i)
                break
            if ch != ("}" if isinstance(top, dict) else "]"):
                raise ValueError(f"no JSON at {i}")
            value = holders.pop()
            names.pop()


def _name(text: str, i: int) -> tuple[str, int]:
    """The name of a member that starts at i, and where its value starts."""
    if text[i : i + 1] != '"':
        raise ValueError(f"no name at {i}")
    name, i = scanstring(text, i + 1, True)
    i = _BLANK.match(text, i).end()
    if text[i : i + 1] != ":":
        raise ValueError(f"no colon at {i}")
    return name, _BLANK.match(text, i + 1).end()


def _dump_deep(value) -> str:
    """json.dumps without recursion."""
    out: list[str] = []
    todo: list = [("value", value)]
    while todo:
        kind, v = todo.pop()
        if kind == "text" or not isinstance(v, (dict, list)):
            out.append(v if kind == "text" else json.dumps(v, ensure_ascii=False))
            continue
        parts: list = []
        for k, x in v.items() if isinstance(v, dict) else enumerate(v):
            parts += [("text", ", " * bool(parts) + (f"{json.dumps(k, ensure_ascii=False)}: " if isinstance(v, dict) else "")), ("value", x)]
        out.append("{" if isinstance(v, dict) else "[")
        todo += [("text", "}" if isinstance(v, dict) else "]"), *reversed(parts)]
    return "".join(out)


def parse(payload: str | None):
    """The value of well-formed JSON, nested however deeply, else None. NaN and infinities are not well formed."""
    if payload is None:
        return None
    try:
        return json.loads(payload, parse_constant=_refuse)
    except ValueError:
        return None
    except RecursionError:
        try:
            return _parse_deep(payload)
        except ValueError:
            return None


def locate(value, names: frozenset[str]):
    """The outermost object that has one of the names, searched breadth-first through envelope objects."""
    level = [value] if isinstance(value, dict) else []
    while level:
        for x in level:
            if not names.isdisjoint(x):
                return x
        level = [v for x in level for v in x.values() if isinstance(v, dict)]
    return None


def elements(value) -> list:
    """The elements of what stands for an array. Null and blank strings hold none; anything but an array is a lone element."""
    if isinstance(value, str):
        text = value.strip()
        if not text:
            return []
        if text[0] in "[{":
            inner = parse(text)
            if inner is not None:
                value = inner
    if value is None:
        return []
    return value if isinstance(value, list) else [value]


def keyed_lists(value) -> list[tuple[str, list]]:
    """The (key, elements) of a map of lists; anything else has none."""
    if isinstance(value, str):
        value = parse(value)
    return [(k, elements(v)) for k, v in value.items()] if isinstance(value, dict) else []


def _text(v) -> str | None:
    """A value as text: strings as they are (lone surrogates, which no table can hold, become ?), anything else as JSON."""
    if v is None:
        return None
    if not isinstance(v, str):
        try:
            v = json.dumps(v, ensure_ascii=False)
        except RecursionError:
            v = _dump_deep(v)
    return v if v.isascii() else v.encode("utf-8", "replace").decode("utf-8")


class _Columns:
    """The columns of one record, by (path, leaf): lists of repetition levels, definition levels and values."""

    def __init__(self, fields: bool):
        self.fields = fields
        self.data: dict[tuple[str, str], tuple[list, list, list]] = {}
        self.shapes: dict[str, dict] = {}

    def add(self, path: str, leaf: str, r: int, d: int, v) -> None:
        c = self.data.get((path, leaf))
        if c is None:
            c = self.data[path, leaf] = ([], [], [])
        c[0].append(r)
        c[1].append(d)
        c[2].append(v)


def _below(path: str, name: str) -> str:
    """The path of a repeated group below another; a name that follows itself is counted, so that deep paths stay short."""
    head, _, last = path.rpartition("/")
    base, _, times = last.partition("*")
    return f"{head}/{name}*{int(times or 1) + 1}" if head and base == name else f"{path}/{name}"


class _Node:
    """A repeated path as found in one record: its leaves and the paths below."""

    __slots__ = ("group", "path", "leaves", "below")

    def __init__(self, group: Group, path: str):
        self.group, self.path, self.leaves, self.below = group, path, {}, {}


def _shape(node: _Node, items: list, fields: bool) -> None:
    """Finds the leaves and repeated paths of a group's elements (iteratively, whatever the depth)."""
    stack = [(node, items)]
    while stack:
        at, found = stack.pop()
        for x in found:
            if not isinstance(x, dict):
                continue
            for name, v in x.items():
                inner = at.group.child(name)
                if inner is None:
                    if fields:
                        at.leaves[name] = None
                    continue
                lists = [e for _, e in keyed_lists(v)] if inner.keyed else [elements(v)]
                if any(lists):
                    if name not in at.below:
                        at.below[name] = _Node(inner, _below(at.path, name))
                    stack += [(at.below[name], e) for e in lists]


def shred_record(record, groups: dict[str, Group], fields: bool) -> dict[tuple[str, str], tuple[list, list, list]]:
    """All columns of one record. A keyed group has one repetition level for the map's entries and one for the lists."""
    out = _Columns(fields)

    def blank(node: _Node, r: int, d: int) -> None:
        """The group and all below are absent here; every column says so once."""
        stack = [node]
        while stack:
            n = stack.pop()
            for leaf in (MARK, *n.leaves, *(("#key",) if n.group.keyed else ())):
                out.add(n.path, leaf, r, d, None)
            stack += n.below.values()

    def fill(node: _Node, items: list, r: int, d: int, depth: int, key: str | None = None) -> None:
        """items at repetition depth `depth`; the first keeps r, the others repeat at `depth`."""
        for k, x in enumerate(items):
            rr = r if k == 0 else depth
            if x is None:
                blank(node, rr, d + 1)
                continue
            out.add(node.path, MARK, rr, d + 2, None if isinstance(x, dict) else _text(x))
            if node.group.keyed:
                out.add(node.path, "#key", rr, d + 2, _text(key))
            has = x if isinstance(x, dict) else {}
            for leaf in node.leaves:
                v = has.get(leaf)
                out.add(node.path, leaf, rr, d + 2 + (v is not None), _text(v))
            for name, sub in node.below.items():
                descend(sub, has.get(name), rr, d + 2, depth)

    def descend(node: _Node, value, r: int, d: int, depth: int) -> None:
        if node.group.keyed:
            pairs = [(k, e) for k, e in keyed_lists(value) if e]
            if not pairs:
                blank(node, r, d)
            for j, (k, e) in enumerate(pairs):
                fill(node, e, r if j == 0 else depth + 1, d + 2, depth + 2, k)
            return
        items = elements(value)
        fill(node, items, r, d, depth + 1) if items else blank(node, r, d)

    for name, group in groups.items():
        items = elements(record.get(name))
        if items:
            node = _Node(group, name)
            _shape(node, items, fields)
            fill(node, items, 0, 0, 1)
    return out.data


COLUMNS = "path string, leaf string, reps array<int>, defs array<int>, vals array<string>"


def shred(df: DataFrame, key: str, payload: str, groups: dict[str, Group] = RECORDS, fields: bool = True) -> DataFrame:
    """One row per record and column: key, path, leaf, reps, defs, vals.

    Unreadable payloads, and those without any of the groups, give no rows. fields=False shreds only the marks and keys,
    which is all that positions need.
    """
    names = frozenset(groups)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sys

        sys.setrecursionlimit(1 << 30)  # calls between Python functions take no C stack
        sys.set_int_max_str_digits(0)
        for pdf in batches:
            rows = []
            for k, text in zip(pdf["key"], pdf["payload"]):
                record = locate(parse(text), names)
                if record is not None:
                    rows += [(k, p, leaf, *c) for (p, leaf), c in shred_record(record, groups, fields).items()]
            yield pd.DataFrame(rows, columns=["key", "path", "leaf", "reps", "defs", "vals"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(payload).alias("payload")).where("payload is not null").mapInPandas(run, f"key {kind}, {COLUMNS}")


def _group_at(groups: dict[str, Group], path: str) -> tuple[Group, int]:
    """The group at a path and its number of repetition levels."""
    at: Group | None = None
    depth = 0
    for step in path.split("/"):
        name, _, times = step.partition("*")
        before, at = at, at.child(name) if at else groups[name]
        assert at is not None and (not times or at is before)  # only what holds its own kind follows itself
        depth += int(times or 1) * (1 + at.keyed)
    assert at is not None
    return at, depth


def positions(reps: np.ndarray, depth: int) -> np.ndarray:
    """Index at each repetition level (columns 1..depth) of every value, from its repetition level alone."""
    n = len(reps)
    out = np.zeros((n, depth), dtype=np.int64)
    if n < depth:  # few values far down: value by value
        for i, r in enumerate(reps.tolist()):
            if i:
                out[i] = out[i - 1]
            if r:
                out[i, r - 1] += 1
            out[i, r:] = 0
        return out
    at = np.arange(n)
    for j in range(1, depth + 1):
        ticks = np.cumsum(reps == j)
        start = np.maximum.accumulate(np.where(reps < j, at, 0))  # where the enclosing element began
        out[:, j - 1] = ticks - ticks[start]
    return out


def _assembler(groups: dict[str, Group], want: list[str], kind: str | None = None):
    """Makes rows (key, kind, pos, parent_pos, value, wanted leaves) of the columns of records that follow each other."""

    def rows_of(cols: dict, last: Group, depth: int, k) -> list[tuple]:
        reps, defs, vals = cols[MARK]
        idx = positions(np.asarray(reps), depth).astype(str).tolist()
        up = depth - 1 - last.keyed
        out = []
        for i in np.flatnonzero(np.asarray(defs) >= 2 * depth).tolist():
            parent = ".".join(idx[i][:up])
            tail = f"{cols['#key'][2][i]}.{idx[i][-1]}" if last.keyed else idx[i][-1]
            out.append((k, last.kind, f"{parent}.{tail}" if parent else tail, parent, vals[i], *(cols[x][2][i] if x in cols else None for x in want)))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[Group, int]] = {}
        held: dict[str, dict] = {}  # columns of the record that the last batch may have cut in two
        now = None

        def flush(k) -> list[tuple]:
            out = [r for path, cols in held.items() for r in rows_of(cols, *known[path], k)]
            held.clear()
            return out

        names = ["key", "kind", "pos", "parent_pos", "value", *[f"c{i}" for i in range(len(want))]]
        for pdf in batches:
            out = []
            for k, path, leaf, reps, defs, vals in zip(pdf["key"], pdf["path"], pdf["leaf"], pdf["reps"], pdf["defs"], pdf["vals"]):
                if k != now:
                    out += flush(now)
                    now = k
                if path not in known:
                    known[path] = _group_at(groups, path)
                if kind is None or known[path][0].kind == kind:
                    held.setdefault(path, {})[leaf] = (reps, defs, vals)
            yield pd.DataFrame(out, columns=names)
        yield pd.DataFrame(flush(now), columns=names)

    return run


def _assembled(columns: DataFrame, groups: dict[str, Group], want: list[str], kind: str | None) -> DataFrame:
    key_kind = columns.schema["key"].dataType.simpleString()
    names = ", ".join([f"key {key_kind}, kind string, pos string, parent_pos string, value string", *(f"c{i} string" for i in range(len(want)))])
    return columns.where(F.col("leaf").isin(MARK, "#key", *want)).mapInPandas(_assembler(groups, want, kind), names)


def assemble(columns: DataFrame, groups: dict[str, Group] = RECORDS) -> DataFrame:
    """Rows of all tables from shredded columns: key, kind, pos, parent_pos, value.

    Made from the mark columns (and the key columns of keyed groups). value is that of an element that is no object.
    The rows of one record must follow each other, as shred() leaves them.
    """
    return _assembled(columns, groups, [], None)


def table(columns: DataFrame, kind: str, leaves: dict[str, str], groups: dict[str, Group] = RECORDS) -> DataFrame:
    """The table of one kind with the given leaves as columns (leaf name to Spark type): key, pos, parent_pos, value, leaves.

    Columns of one record and path have one value per element and equal repetition levels, so that they are read side by
    side. A leaf that a record lacks is null; a value that the type cannot hold is null. The rows of one record must follow
    each other, as shred() leaves them; a stored table of columns is to be sorted by key within partitions by key first.
    """
    typed = [F.expr(f"try_cast(c{i} as {t})").alias(name) for i, (name, t) in enumerate(leaves.items())]
    return _assembled(columns, groups, list(leaves), kind).select("key", "pos", "parent_pos", "value", *typed)


def found(raw: DataFrame) -> DataFrame:
    """raw_id, kind, pos, parent_pos of every element of the readable payloads of raw_records."""
    rows = assemble(shred(raw, "raw_id", "payload", fields=False))
    return rows.select(F.col("key").alias("raw_id"), "kind", "pos", "parent_pos")

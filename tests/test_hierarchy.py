"""Tree contraction against a walk up every chain."""

import datetime as dt
import random

import pytest

from corpusloom.operators import hierarchy as H

SCHEMA = "row_id long, book_id string, entry_id string, parent_id string, level int, extracted_at timestamp, id string, p string, grp string"


def rows_of(links, level=1):
    t = dt.datetime(2024, 1, 1)
    return [(i, b, k, p, level, t, "x", "y", "z") for i, (b, k, p) in enumerate(links)]


def brute(links):
    """(status, depth, root, path) per (book, key)."""
    parent = {(b, k): p for b, k, p in links}
    out = {}
    for start in parent:
        at, way, seen = start, [start], {start}
        while True:
            p = parent[at]
            if not p:
                out[start] = ("root", len(way), at[1], [k for _, k in reversed(way)])
                break
            if (at[0], p) not in parent:
                out[start] = ("orphan" if at == start else "under_orphan", len(way), at[1], [k for _, k in reversed(way)])
                break
            at = (at[0], p)
            if at in seen:
                out[start] = ("on_cycle" if at == start else None, None, None, None)
                break
            seen.add(at)
            way.append(at)
    for k, v in out.items():
        if v[0] is None:
            at, seen = k, []
            while at not in seen:
                seen.append(at)
                at = (at[0], parent[at])
            cycle = seen[seen.index(at) :]
            out[k] = ("on_cycle" if k in cycle else "under_cycle", None, None, None)
    return out


@pytest.mark.parametrize("tail_rows", [0, 100_000])
def test_random_forest_with_cycles_and_orphans(spark, tail_rows):
    rng = random.Random(7)
    links = []
    for b in ("b1", "b2"):
        for i in range(60):
            links.append((b, f"n{i}", None if i == 0 or rng.random() < 0.05 else f"n{rng.randrange(i)}"))
        links += [(b, f"c{i}", f"c{i - 1}") for i in range(1, 25)] + [(b, "c0", None)]  # a chain
        links += [(b, f"r{i}", f"r{(i + 1) % 5}") for i in range(5)] + [(b, "tail", "r2"), (b, "tail2", "tail"), (b, "self", "self")]
        links += [(b, "lost", "nowhere"), (b, "below", "lost")]
    df = spark.createDataFrame(rows_of(links), SCHEMA)
    got = {(r["grp"], r["key"]): r for r in H.resolve(H.latest_links(df), paths=True, tail_rows=tail_rows).collect()}
    want = brute(links)
    assert got.keys() == want.keys()
    below = dict.fromkeys(want, 0)
    for k, (_, _, _, path) in want.items():
        for a in (path or [])[:-1]:
            below[k[0], a] += 1
    for k, (status, depth, root, path) in want.items():
        r = got[k]
        assert (r["status"], r["depth"], r["root_key"], r["path"]) == (status, depth, root, path), k
        if path:
            assert r["descendants"] == below[k], k
    assert got["b1", "tail"]["descendants"] == 1 and got["b1", "r0"]["descendants"] is None


def test_latest_version_blanks_and_repeats(spark):
    new, old = dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 1)
    rows = [
        (1, "b", "a", None, 1, old, "", "", ""),
        (2, "b", " a\t", "", 1, new, "", "", ""),
        (2, "b", " a\t", "", 1, new, "", "", ""),
        (3, "b", "c", "a ", 2, new, "", "", ""),
        (4, "b", "c", "c", 9, old, "", "", ""),
        (5, "b", "d", "\t", 4, None, "", "", ""),
        (6, None, None, None, None, None, None, None, None),
    ]
    got = {(r["book_id"], r["entry_id"], r["finding"]) for r in H.findings(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("b", "d", "wrong_level")}


def test_empty_table(spark):
    assert H.findings(spark.createDataFrame([], SCHEMA)).count() == 0


def test_descendants(spark):
    df = spark.createDataFrame(rows_of([("b", "a", None), ("b", "c", "a"), ("b", "d", "c")]), SCHEMA)
    got = {tuple(r) for r in H.descendants(H.resolve(H.latest_links(df), paths=True)).collect()}
    assert got == {("b", "a", "c", 1), ("b", "a", "d", 2), ("b", "c", "d", 1)}

"""Splitting, packing and mixing."""

import random
from collections import Counter, defaultdict

import pytest

from corpusloom.llm import mixing, packing, split


def text(seed, n):
    rng = random.Random(seed)
    out = []
    while sum(map(len, out)) < n:
        out.append(rng.choice(["# Head\n\n", "2.1 Part\n\n", "word ", "longer-word, ", "end.\n", "end.\r\n", "x" * 70 + " ", "\n \n", "- item\n", "\t\f", "das\xa0ist ", "光の計算。"]))
    return "".join(out)


@pytest.mark.parametrize("seed", range(12))
def test_pieces_cover_and_overlap(seed):
    t = text(seed, 3000)
    for limit, overlap in ((200, 20), (71, 70), (1000, 0), (50, 5)):
        got = split.pieces(t, limit, overlap)
        assert got[0][:2] == (0, 0) and got[-1][2] == len(t)
        assert all(e - s <= limit for s, _, e in got)
        assert all(c == e0 and s == max(0, c - min(overlap, limit - 1)) for (_, _, e0), (s, c, _) in zip(got, got[1:]))
        assert "".join(t[c:e] for _, c, e in got) == t


def test_cut_kinds():
    p = "a" * 30
    assert split.coarsest_cut(f"{p}\n \n{p}", 30) == "paragraph"
    assert split.coarsest_cut(f"{p}\r\n{p}", 30) == "line"
    assert split.coarsest_cut(f"{p} {p}", 30) == "word"
    assert split.coarsest_cut(f"{p}\xa0{p}", 30) == "none"


def test_cuts_at_the_coarsest_boundary():
    t = "# One\n\n" + "aaaa " * 10 + "\n\n# Two\n\n" + "bbbb " * 10
    assert [t[c:e].split()[0:2] for _, c, e in split.pieces(t, 70, 0)] == [["#", "One"], ["#", "Two"]]


def test_split_frame_edges(spark):
    rows = [(1, "a" * 10, 5, 2, "z"), (2, None, 5, 2, "z"), (3, "", 5, 2, "z"), (4, "b" * 5, 5, 9, "z"), (5, "c" * 6, None, None, "z"), (6, "d" * 12, 5, 50, "z")]
    df = spark.createDataFrame(rows, "rid long, body string, lim int, over int, piece string")
    got = defaultdict(list)
    for r in split.split(df, "rid", "body", "lim", "over").orderBy("rid", "piece").collect():
        got[r["rid"]].append((r["start_pos"], r["core_pos"], r["end_pos"], r["text"]))
    assert set(got) == {1, 4, 5, 6}
    assert got[4] == [(0, 0, 5, "bbbbb")] and got[5] == [(0, 0, 6, "cccccc")]
    assert all(len(t) <= 5 for _, _, _, t in got[1] + got[6])
    assert split.split(df.limit(0), "rid", "body", "lim", "over").count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_solution_holds_every_item_once(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 37, 100, 1024])
    counts = Counter(rng.randint(1, cap) for _ in range(rng.randint(1, 400)))
    if seed % 3 == 0:
        counts[max(1, cap // 3)] += 5000
    used = Counter()
    bins = 0
    for pattern, n in packing.solve(dict(counts), cap):
        assert sum(s * k for s, k in pattern.items()) <= cap
        bins += n
        for s, k in pattern.items():
            used[s] += k * n
    assert used == counts
    # First fit decreasing, item by item, is the yardstick.
    open_, total = [], 0
    for s in sorted(counts.elements(), reverse=True)[:600]:
        i = next((i for i, r in enumerate(open_) if r >= s), None)
        if i is None:
            open_.append(cap - s)
        else:
            open_[i] -= s
    if sum(counts.values()) <= 600:
        assert bins <= len(open_)


def test_reduction_fixes_dominant_sets():
    fixed, left = packing.reduce_dominant({9: 2, 6: 1, 4: 3, 1: 1}, 10)
    assert ((9, 1), 1) in fixed and ((6, 4), 1) in fixed
    assert packing.reduce_dominant({}, 10) == ([], {})


def test_place_every_token_once(spark):
    items = [(i, s, "c") for i, s in enumerate([5, 5, 5, 10, 11, 20, 25, 1, None, 0] + [3] * 50)]
    df = spark.createDataFrame(items, "doc_id long, n_tokens long, container string")
    boxes = spark.createDataFrame([("a", 10), ("b", 7), ("b", 7), ("none", 0)], "container_kind string, capacity_tokens int")
    rows = packing.place(df, boxes).collect()
    for kind, cap in (("a", 10), ("b", 7)):
        spans, load = defaultdict(list), Counter()
        for r in rows:
            if r["container_kind"] == kind:
                spans[r["doc_id"]].append((r["start_token"], r["end_token"]))
                if r["container"] >= 0:
                    load[r["container"]] += r["end_token"] - r["start_token"]
                else:
                    assert r["end_token"] - r["start_token"] == cap
        assert set(spans) == {i for i, s, _ in items if s}
        for i, s, _ in items:
            if s:
                own = sorted(spans[i])
                assert own[0][0] == 0 and own[-1][1] == s and all(a[1] == b[0] for a, b in zip(own, own[1:]))
                assert len(own) == 1 or s > cap
        assert max(load.values()) <= cap
    assert {r["container_kind"] for r in rows} == {"a", "b"}
    assert packing.place(df.limit(0), boxes).count() == 0


DOCS = "doc_id long, text string, source string, cum long"


def test_mix_reaches_shares_and_caps_repeats(spark):
    rng = random.Random(2)
    docs = [(i, "x" * rng.randint(20, 60), rng.choice(["Big ", "big", "mid", " SMALL", None]) if i % 50 else "tiny", 1) for i in range(3000)] + [(9001, None, "big", 1)]
    targets = spark.createDataFrame([("m", "BIG", 0.5, 1, 0.5), ("m", "mid", 0.3, 2, 0.5), ("m", "small", 0.2, 2, 0.5), ("n", "tiny", 0.5, 3, 1.0), ("n", "big", 0.5, 1, 1.0), ("n", "nobody", 0.0, 1, 1.0)], "mix_id string, source string, target_share double, max_repeats int, size_factor double")
    mixes, report = mixing.mix(spark.createDataFrame(docs, DOCS), targets)
    rows = mixes.collect()
    rep = {(r["mix_id"], r["source"]): r for r in report.collect()}
    total = sum(len(t) + 1 for _, t, _, _ in docs if t is not None)
    for m, factor in (("m", 0.5), ("n", 1.0)):
        assert sum(r["tokens"] for r in rows if r["mix_id"] == m) <= factor * total
    uses = Counter((r["mix_id"], r["doc_id"]) for r in rows)
    assert max(n for (m, _), n in uses.items() if m == "m") <= 2
    for s, want in (("big", 0.5), ("mid", 0.3), ("small", 0.2)):
        assert abs(rep["m", s]["actual_share"] - want) < 0.01
    assert rep["n", "tiny"]["short"] and rep["n", "tiny"]["taken_tokens"] == rep["n", "tiny"]["available_tokens"]
    assert not rep["m", "big"]["short"] and not rep["n", "nobody"]["short"]


def test_mix_of_nothing(spark):
    targets = spark.createDataFrame([("m", "a", 1.0, 1, 1.0)], "mix_id string, source string, target_share double, max_repeats int, size_factor double")
    mixes, report = mixing.mix(spark.createDataFrame([], DOCS), targets)
    assert mixes.count() == 0 and report.count() == 1


def test_headings_of_several_kinds():
    depth = split.heading_depth
    assert [depth(x) for x in ("# A", "### b", "2.3 Waves", "4 Waves", "\\section{Waves}", "\\subsection*{x}", "<h2>Waves</h2>")] == [1, 3, 2, 1, 2, 3, 2]
    assert [depth(x) for x in ("3 apples were weighed today", "1999 was a year", "1. Stir the pot", "- item", "2.5 litres of water.", "plain", "x" * 200)] == [None] * 7


def test_lists_are_cut_between_items():
    text = "Intro:\n" + "\n".join(f"- item {i} " + "w " * 8 + f"\n  - below {i} " + "v " * 8 for i in range(6))
    found = split.pieces(text, 70, 0)
    assert "".join(text[a:b] for _, a, b in found) == text and all(b - a <= 70 for _, a, b in found)
    assert all(text[a:b].lstrip().startswith(("Intro", "- item", "- below")) for _, a, b in found)


def test_coarsest_cut_is_that_of_the_stretches():
    rng = random.Random(5)
    for _ in range(300):
        t = "".join(rng.choice(["ab ", "cdefgh", "\n", "\r\n", "\n \n", "  ", "x. ", "# H\n", "1.1 Ti\n", "- i ", "\f"]) for _ in range(rng.randrange(1, 60)))
        limit = rng.randrange(3, 40)
        want = next((k for k, c in zip(split.KINDS, (split.BLANK_LINES, split.LINE, split.WORD)) if max(len(x.strip(split.SPACE)) for x in c.split(t)) <= limit), "none")
        assert split.coarsest_cut(t, limit) == want, (t, limit)

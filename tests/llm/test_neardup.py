"""Near duplicates against all pairs."""

import inspect
import random
import re

import numpy as np
import pytest

from corpusloom.llm import neardup as N

SCHEMA = "subtopic_id long, name string, description string, id long, words string, skey long"


def frame(spark, rows):
    return spark.createDataFrame([(i, n, d, 1, "w", 2) for i, n, d in rows], SCHEMA)


def groups(rows, threshold=0.6):
    sets = {i: frozenset(re.findall(r"[^\W_]+", f"{n or ''} {d or ''}".lower())) for i, n, d in rows}
    ids = [i for i in sets if sets[i]]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                root[find(b)] = find(a)
    return {(a, b) for a in ids for b in ids if a < b and find(a) == find(b)}


def corpus(seed=3, families=25, copies=6):
    rng = random.Random(seed)
    vocab = [f"word{i}" for i in range(4000)]
    rows, k = [], 0
    for _ in range(families):
        base = [rng.choice(vocab) for _ in range(40)]
        for c in range(copies):
            text = list(base)
            for _ in range(c):
                text[rng.randrange(len(text))] = rng.choice(vocab)
            rng.shuffle(text)
            rows.append((k, " ".join(text[:4]), " ".join(text[4:])))
            k += 1
    return rows


@pytest.mark.parametrize("star_above", [2, 32])
def test_against_all_pairs(spark, star_above):
    rows = corpus()
    rows += [(9000 + i, rows[0][1].upper(), rows[0][2] + " .") for i in range(40)]  # a hot group of copies
    got = {tuple(r) for r in N.pairs_in_classes(N.classes(frame(spark, rows), "subtopic_id", ["name", "description"], star_above=star_above)).collect()}
    want = groups(rows)
    assert not got - want
    assert len(got) >= 0.98 * len(want)


def test_nulls_empty_texts_and_empty_table(spark):
    rows = [(1, None, None), (2, "", ""), (3, "!!", None), (4, "one two three", None), (5, None, "Three, two - ONE")]
    assert {tuple(r) for r in N.pairs_in_classes(N.classes(frame(spark, rows), "subtopic_id", ["name", "description"])).collect()} == {(4, 5)}
    assert N.classes(frame(spark, []), "subtopic_id", ["name", "description"]).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 48, 90, dtype=np.uint64)
    a, b = pool[:60], pool[30:]
    level = {int(h): int(i % 4) for i, h in enumerate(pool)}
    of = lambda hs: np.array([level[int(h)] for h in hs])
    sig = N.sign(np.concatenate([np.sort(a), np.sort(b)]), np.array([60, 60]), of, 2048)
    weight = lambda hs: sum(2.0 ** -level[int(h)] for h in hs)
    both = weight(pool[30:60])
    want = both / (weight(a) + weight(b) - both)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.04


def test_light_texts_are_signed_to_the_end():
    hashes = np.arange(1, 6, dtype=np.uint64)
    sig = N.sign(hashes, np.array([5]), lambda h: np.full(len(h), N.DEPTH), 84)
    assert np.isfinite(sig).all()
    assert not np.isfinite(N.sign(hashes, np.array([5]), lambda h: np.full(len(h), N.NONE), 84)).any()


def test_long_text(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, "a", long), (2, "b", long), (3, "c", "short")]
    assert {tuple(r) for r in N.pairs_in_classes(N.classes(frame(spark, rows), "subtopic_id", ["name", "description"])).collect()} == {(1, 2)}


@pytest.mark.parametrize("times", [1, 10, 1000])
def test_links_are_found_as_surely_in_large_tables(times):
    rows = 20_000
    shared, apart = np.full(30, rows // 250), np.full(16, 2)  # plain similarity 30 / 46
    weight = lambda df: (2.0 ** -N.levels(df * float(times), rows * times)).sum()
    s = weight(shared) / (weight(shared) + weight(apart))
    assert 1 - (1 - s**3) ** inspect.signature(N.classes).parameters["bands"].default > 0.98

"""Greedy groups and joins by likeness against plain walks."""

import random

from corpusloom.operators import likeness as L


def test_greedy_groups_against_a_walk(spark):
    rng = random.Random(3)
    ids = list(range(60))
    pairs = [(a, b) for a in ids for b in ids if a != b and rng.random() < 0.05]
    like = {frozenset(p) for p in pairs}
    leaders, want = [], {}
    for i in ids:
        lead = next((x for x in leaders if frozenset((x, i)) in like), None)
        if lead is None:
            leaders.append(i)
        want[i] = i if lead is None else lead
    got = L.greedy_groups(spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(pairs, "a long, b long"))
    assert {r["id"]: r["leader"] for r in got.collect()} == want


def test_joins_of_nothing(spark):
    none = spark.createDataFrame([(1, None), (2, ""), (3, "the of")], "id long, t string")
    assert L.cosine_pairs(L.tfidf_ngrams(none, "id", "t"), 0.5).count() == 0
    words = "a long, words array<string>"
    l = spark.createDataFrame([(1, []), (2, None), (3, ["x", "x", "y"])], words)
    r = spark.createDataFrame([(7, ["x", "y"]), (8, ["x"]), (9, [])], words.replace("a long", "b long"))
    assert [tuple(x) for x in L.jaccard_join(l, r, 0.8).collect()] == [(3, 7, 1.0)]
    assert L.greedy_groups(spark.createDataFrame([], "id long"), spark.createDataFrame([], "a long, b long")).count() == 0


def test_recall_of_the_vector_index(spark):
    import numpy as np

    from corpusloom.operators import similarity, vector_index

    rng = np.random.default_rng(5)
    centre = rng.normal(size=(30, 16))
    rows = [(i, (centre[i % 30] + 0.4 * rng.normal(size=16)).tolist()) for i in range(3000)] + [(9001, None)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = e.where("vec_id % 20 = 0")
    want = {(r["query_id"], r["vec_id"]) for r in similarity.vector_topk(q, e).collect()}
    cells, probes = vector_index.fit(e, "vec_id", "embedding", cells=32)
    assert probes < 32
    got = {(r["query_id"], r["vec_id"]) for r in vector_index.topk(q, e, cells, probes=probes).collect()}
    assert len(got & want) >= 0.9 * len(want)
    whole = {(r["query_id"], r["vec_id"]) for r in vector_index.topk(q, e, cells, probes=32).collect()}
    assert whole == want
    assert vector_index.topk(q.limit(0), e.limit(0), *vector_index.fit(e.limit(0), "vec_id", "embedding")[:1]).count() == 0

import random

from corpusloom.durable import Scratch
from corpusloom.operators.components import components


def test_random_graphs_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(200, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges + edges[:20], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df, Scratch(spark, "test")).collect()}
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    assert got == want
    assert components(df.limit(0), Scratch(spark, "test")).count() == 0

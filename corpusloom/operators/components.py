"""Connected components of an edge table, by alternating large-star and small-star steps.

Edges are first contracted within the partitions they come in, without a shuffle. Every step is a shuffle of what edges
are left; labels never leave the executors. The number of rounds grows with the logarithm of the size of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.durable import Scratch

HELD = 1_000_000  # nodes that one task holds before it passes on what it has contracted


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest of stars (u: least of its tree, v) with the same components as the edges of the partition."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    def stars() -> pa.RecordBatch:
        v = [x for x in root if root[x] != x]
        return pa.RecordBatch.from_arrays([pa.array([find(x) for x in v], pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a < b:
                root[b] = a
            elif b < a:
                root[a] = b
        if len(root) > HELD:
            yield stars()
            root.clear()
    yield stars()


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the edges; root is the least node of its component. Self-loops and repeats do no harm."""
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").mapInArrow(_contract, "u long, v long")
    path = scratch.put(pairs)
    now = scratch.get(path, pairs.schema)
    sign = None
    while True:
        # Large star: every larger neighbour of u is linked to the least of u and its neighbours.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u < v")
        # Small star: u and its lesser neighbours are linked to the least of them.
        floor = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(floor, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).where("u < v").distinct()
        new_path = scratch.put(small)
        now = scratch.get(new_path, pairs.schema)
        scratch.drop(path)
        path = new_path
        new_sign = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if new_sign == sign:
            break
        sign = new_sign
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())

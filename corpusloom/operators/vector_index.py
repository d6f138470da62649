"""Nearest vectors by an inverted file of cells.

Cells are fitted on a bounded sample (`fit_rows`, a parameter) by spherical k-means; every vector is filed in its nearest
cell. A query looks into its `probes` nearest cells. A cell with many vectors is cut into parts, and its queries into
blocks; every pair of part and block is a group of its own, so no task holds a whole cell. Recall against comparing all
(similarity.vector_topk) is measured in the tests; more probes raise it, as many as there are cells make the search exact. fit() chooses their number for a wanted recall.

Null vectors are in no cell; they find nothing and are not found. Vectors must have one length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

PART = 50_000  # vectors in one part of a cell
BLOCK = 5_000  # queries in one block of a cell


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, n, out=np.zeros_like(v), where=n > 0)


def fit(vectors: DataFrame, key: str, column: str, cells: int = 64, fit_rows: int = 20_000, rounds: int = 8, recall: float = 0.95, k: int = 3) -> tuple[np.ndarray, int]:
    """(centres, probes) from at most `fit_rows` vectors, those first in the order of a hash of their key.

    There are at most `cells` centres. probes is the least number of cells that hold at least `recall` of the k nearest
    vectors of 500 of the sample, compared with all of it: few where vectors form clusters, most cells where they do not.
    """
    h = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    base = vectors.where(F.col(column).isNotNull())
    below = int((1 << 40) * min(1.0, 1.2 * fit_rows / max(base.count(), 1)))
    rows = base.where(h < below).select(F.col(column).alias("v"), h.alias("h")).orderBy("h").limit(fit_rows).toPandas()
    if not len(rows):
        return np.zeros((0, 0)), 1
    x = _unit(np.array(rows["v"].tolist(), dtype=np.float64))
    centre = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(rounds):
        own = (x @ centre.T).argmax(axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, x)
        centre = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), centre)
    own = (x @ centre.T).argmax(axis=1)
    some = np.linspace(0, len(x) - 1, min(500, len(x))).astype(int)
    sim = x[some] @ x.T
    sim[np.arange(len(some)), some] = -2.0
    near = np.argsort(-sim, axis=1)[:, : min(k, len(x) - 1)]
    if not near.size:
        return centre, 1
    place = np.argsort(np.argsort(-(x[some] @ centre.T), axis=1), axis=1)  # of every cell, for every query
    needed = np.take_along_axis(place, own[near], axis=1).ravel() + 1
    return centre, int(np.quantile(needed, recall, method="higher"))


def file(vectors: DataFrame, key: str, column: str, centres: np.ndarray, probes: int = 1) -> DataFrame:
    """(cell, key, vector) of the `probes` nearest cells of every vector. Narrow."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(shared.value):
                continue
            v = _unit(np.array(batch.column(1).to_pylist(), dtype=np.float64))
            p = min(probes, len(shared.value))
            near = np.argpartition(-(v @ shared.value.T), p - 1, axis=1)[:, :p]
            at = np.repeat(np.arange(len(v)), p)
            yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int32)), batch.column(0).take(pa.array(at)), pa.array(list(v[at]), pa.list_(pa.float64()))], ["cell", "key", "vector"])

    return vectors.where(F.col(column).isNotNull()).select(key, column).mapInArrow(run, f"cell int, key {kind}, vector array<double>")


def topk(queries: DataFrame, vectors: DataFrame, centres: np.ndarray, k: int = 3, probes: int = 8, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, key, similarity, rank): the k most similar other vectors that the probed cells hold; ties go by key."""
    kind = vectors.schema[key].dataType.simpleString()
    index, asked = file(vectors, key, column, centres), file(queries, key, column, centres, probes)
    parts = index.groupBy("cell").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))  # a row a cell
    blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    plan = F.broadcast(parts.join(blocks, "cell"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(plan, "cell").withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int")).withColumn("part", spread("parts")).select("cell", "part", "block", "key", "vector")
    right = index.join(plan, "cell").withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int")).withColumn("block", spread("blocks")).select("cell", "part", "block", "key", "vector")

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        names = pa.schema([("query_id", a.schema.field("key").type), ("key", b.schema.field("key").type), ("similarity", pa.float64())])
        if not a.num_rows or not b.num_rows:
            return names.empty_table()
        b = b.sort_by("key")
        q, v = (np.array(t.column("vector").to_pylist()) for t in (a, b))
        sim = q @ v.T
        top = np.argsort(-sim, axis=1, kind="stable")[:, : k + 1]
        return pa.Table.from_arrays([a.column("key").take(pa.array(np.repeat(np.arange(len(q)), top.shape[1]))), b.column("key").take(pa.array(top.ravel())), pa.array(np.take_along_axis(sim, top, axis=1).ravel())], schema=names)

    by = ["cell", "part", "block"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(best, f"query_id {kind}, key {kind}, similarity double").where("query_id <> key")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("similarity"), "key"))  # k + 1 rows a query and group
    return found.withColumn("rank", rank).where(F.col("rank") <= k).withColumnRenamed("key", key)

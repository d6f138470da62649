"""Joins by likeness: n-gram TF-IDF cosine, token Jaccard, and greedy groups over the pairs.

Both joins are exact. Terms are put in one global order, rare ones first, and only a prefix of every row's terms is
matched: two rows that reach the threshold must share a term of both prefixes. Frequent terms stand at the end and are hardly
ever part of a prefix, so pairs come from rare terms. Candidates are distinct before they are held against full rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.durable import Scratch
from corpusloom.functions.text import terms


def ngrams(words: Column, most: int = 3) -> Column:
    """All runs of 1 to `most` words, joined by blanks."""
    one = lambda n: F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.concat(*[one(n) for n in range(1, most + 1)])


def tfidf_ngrams(df: DataFrame, key: str, text: str, most: int = 3) -> DataFrame:
    """(key, term, weight, df) with weights of unit length per row: tf x (ln((1 + n) / (1 + df)) + 1) over all rows that have terms.

    Stopwords and words of fewer than three characters are no terms. Nulls and texts without terms give no rows.
    """
    words = df.select(F.col(key).alias("key"), ngrams(terms(F.col(text)), most).alias("g")).where(F.size("g") > 0)
    tf = words.select("key", F.explode("g").alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))
    n = words.agg(F.count("*").alias("n"))
    dfs = tf.groupBy("term").agg(F.count("*").alias("df"))
    raw = tf.join(dfs, "term").crossJoin(F.broadcast(n)).select("key", "term", "df", (F.col("tf") * (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0)).alias("w"))
    length = raw.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l"))
    return raw.join(length, "key").select("key", "term", "df", (F.col("w") / F.col("l")).alias("weight"))


def cosine_pairs(weights: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of all pairs a < b of rows of tfidf_ngrams whose cosine is at least the threshold (above 0)."""
    order = W.partitionBy("key").orderBy("df", "term")  # the terms of one row
    rest = 1.0 - F.coalesce(F.sum(F.col("weight") * F.col("weight")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    prefix = weights.withColumn("rest", rest).where(F.col("rest") >= threshold * threshold - 1e-9).select("key", "term")
    pairs = prefix.select(F.col("key").alias("a"), "term").join(prefix.select(F.col("key").alias("b"), "term"), "term").where("a < b").select("a", "b").distinct()
    full = pairs.join(weights.select(F.col("key").alias("a"), "term", F.col("weight").alias("wa")), "a").join(weights.select(F.col("key").alias("b"), "term", F.col("weight").alias("wb")), ["b", "term"])
    return full.groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("similarity")).where(F.col("similarity") >= threshold - 1e-9)


def jaccard_join(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of all pairs of a row of left (a, words) and a row of right (b, words) with Jaccard above the threshold.

    words are arrays, taken as sets; empty ones are like nothing.
    """
    sets = left.select(F.lit(0).alias("side"), F.col("a").alias("id"), F.array_distinct("words").alias("words")).unionByName(right.select(F.lit(1).alias("side"), F.col("b").alias("id"), F.array_distinct("words").alias("words"))).where(F.size("words") > 0)
    each = sets.select("side", "id", F.size("words").alias("n"), F.explode("words").alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("df"))
    ranked = each.join(counts, "word").withColumn("r", F.row_number().over(W.partitionBy("side", "id").orderBy("df", "word")))
    prefix = ranked.where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).select("side", "id", "word", "n")
    l, r = (prefix.where(F.col("side") == k).select(F.col("id").alias(name), "word", F.col("n").alias(f"n_{name}")) for k, name in ((0, "a"), (1, "b")))
    near = (F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-9)
    pairs = l.join(r, "word").where(near).select("a", "b").distinct()
    full = pairs.join(left.select("a", F.array_distinct("words").alias("wa")), "a").join(right.select("b", F.array_distinct("words").alias("wb")), "b")
    common = F.size(F.array_intersect("wa", "wb"))
    return full.select("a", "b", (common / (F.size("wa") + F.size("wb") - common)).alias("similarity")).where(F.col("similarity") > threshold)


def greedy_groups(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, leader): nodes taken in the order of their id lead a group, unless a leader before them is like them; then they join the first such.

    nodes: id; pairs: a, b of nodes that are like each other, in any order, with or without repeats. A round settles every
    node whose lesser neighbours are all settled or one of whose lesser neighbours leads; ids that do not run along one
    long chain of pairs need few rounds.
    """
    scratch = Scratch(nodes.sparkSession, "greedy")
    both = scratch.cut(pairs.where("a <> b").select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("before")).distinct())
    path = scratch.put(nodes.select("id").distinct().select("id", F.lit(None).cast(nodes.schema["id"].dataType).alias("leader")))
    while True:
        state = scratch.get(path)
        known = both.join(state.select(F.col("id").alias("before"), F.col("leader").alias("l")), "before")
        # The first leader before a node binds it; it leads itself once none before it is open and none leads.
        leads = F.col("l") == F.col("before")
        seen = known.groupBy("id").agg(F.min(F.when(leads, F.col("before"))).alias("first"), F.min(F.when(F.col("l").isNull(), F.col("before"))).alias("open"))
        ready = F.when(F.col("open").isNull(), F.coalesce("first", "id")).when(F.col("first") < F.col("open"), F.col("first"))
        new = state.join(seen, "id", "left").select("id", F.coalesce("leader", ready).alias("leader"))
        new_path = scratch.put(new)
        scratch.drop(path)
        path = new_path
        if scratch.get(path).where("leader is null").isEmpty():
            return scratch.get(path)

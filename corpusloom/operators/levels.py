"""Hierarchies from ordered titles with levels, and taxonomies by parent links to their children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

DEEPEST = 6


def stacked_paths(entries: DataFrame, group: str, order: str, level: str = "level", title: str = "title", deepest: int = DEEPEST) -> DataFrame:
    """group, order, path: the last title of every level above each row, in the given order, and its own.

    A row of level l closes all deeper levels; levels below 1 count as 1, deeper ones than `deepest` as `deepest`. Rows
    without level or title are left out. One window over each group serves all levels.
    """
    lv = F.greatest(F.lit(1), F.least(F.lit(deepest), F.col(level)))
    rows = entries.where(F.col(level).isNotNull() & F.col(title).isNotNull()).select(F.col(group).alias("g"), F.col(order).alias("o"), lv.alias("l"), F.col(title).alias("t"))
    before = W.partitionBy("g").orderBy("o").rowsBetween(W.unboundedPreceding, 0)
    last = [F.last(F.when(F.col("l") == k, F.struct("o", "t")), ignorenulls=True).over(before).alias(f"p{k}") for k in range(1, deepest + 1)]
    stacked = rows.select("g", "o", "l", *last)

    def open_at(k: int) -> Column:
        """The title of level k if no higher level came after it."""
        own = F.col(f"p{k}")
        closed = F.lit(False)
        for j in range(1, k):
            closed = closed | (F.col(f"p{j}.o") > own["o"])
        return F.when((F.col("l") >= k) & own.isNotNull() & ~F.coalesce(closed, F.lit(False)), own["t"])

    path = F.filter(F.array(*[open_at(k) for k in range(1, deepest + 1)]), lambda x: x.isNotNull())
    return stacked.select(F.col("g").alias(group), F.col("o").alias(order), path.alias("path"))


def repaired_json(c: Column) -> Column:
    """Text of a model's answer as JSON: without a code fence, from the first bracket to the last, trailing commas removed.

    Null where nothing in it looks like JSON. What it gives may still be malformed; parse it with try_parse_json or from_json.
    """
    inner = F.coalesce(F.nullif(F.regexp_extract(c, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit("")), c)
    body = F.regexp_extract(inner, r"(?s)([\[{].*[\]}])", 1)
    return F.nullif(F.regexp_replace(body, r",\s*([\]}])", "$1"), F.lit(""))


def step_times(steps: DataFrame) -> DataFrame:
    """step, runs, total, mean, least, most, percent of all time, from rows (step, seconds)."""
    per = steps.groupBy("step").agg(F.count("*").alias("runs"), F.sum("seconds").alias("total"), F.avg("seconds").alias("mean"), F.min("seconds").alias("least"), F.max("seconds").alias("most"))
    every = steps.agg(F.sum("seconds").alias("all_seconds"))
    return per.crossJoin(F.broadcast(every)).withColumn("percent", 100 * F.try_divide("total", "all_seconds")).drop("all_seconds")

"""Sources mixed to target weights, by weighted fair queueing.

Each source's documents are shuffled by a hash of their id. A document's virtual finish time in a mix is the cumulative
token count of its source up to and including it, divided by the source's target share; a further pass over a source
goes on where the last one ended, up to max_repeats passes. In the order of finish times every source gets its share at
any point; the order is cut where the total budget is reached, after the last document that still fits.

Cumulative counts come from sums of small buckets of the shuffled order, so that a source of a third of all rows is no
hot spot. The cut is found from the sources' totals (few numbers per mix): up to a first finish time everything fits,
beyond a second nothing does, and only the few documents between the two are sorted and summed up in one order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ROWS_PER_BUCKET = 200_000


def source_name(c: str):
    return F.lower(F.regexp_replace(F.col(c), r"^\s+|\s+$", ""))


def shuffle_key(key: str, seed: int):
    return F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))


def queued(docs: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """src, key, tokens, cum (tokens of the source up to here, in shuffled order) of the documents of all target sources."""
    wanted = F.broadcast(targets.select("src").distinct())
    rows = docs.join(wanted, "src", "left_semi").withColumn("h", shuffle_key("key", seed))
    sizes = rows.groupBy("src").agg(F.ceil(F.count("*") / ROWS_PER_BUCKET).alias("buckets"))  # one row per target source
    place = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    rows = rows.join(F.broadcast(sizes), "src").withColumn("bucket", F.floor(place * F.col("buckets")))
    sums = rows.groupBy("src", "bucket").agg(F.sum("tokens").alias("t"))
    before = sums.select("src", "bucket", (F.sum("t").over(W.partitionBy("src").orderBy("bucket")) - F.col("t")).alias("before"))
    run = F.sum("tokens").over(W.partitionBy("src", "bucket").orderBy("h", "key").rowsBetween(W.unboundedPreceding, 0))
    return rows.join(before, ["src", "bucket"]).select("src", "key", "tokens", (F.col("before") + run).alias("cum"))


def _cut(budget: float, lanes: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Finish times up to which all fits and beyond which nothing does, of lanes (share, supply, largest document)."""

    def when(total: float) -> float:
        """The finish time at which lanes that run smoothly have given `total`."""
        left, ends = total, sorted((supply / share, share) for share, supply, _ in lanes if share > 0 and supply > 0)
        rate, now = sum(s for _, s in ends), 0.0
        for end, share in ends:
            if (end - now) * rate >= left:
                return now + left / rate
            left -= (end - now) * rate
            now, rate = end, rate - share
        return float("inf")

    slack = sum(m for _, _, m in lanes)
    return when(budget) * (1 - 1e-12), when(budget + slack) * (1 + 1e-9)


def mix(documents: DataFrame, mix_targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The mixes and their report.

    mixes   mix_id, key, source, pass (from 1), tokens, finish: one row per use of a document; sort by finish for the order
    report  one row per row of mix_targets: mix_id, source, target_share, max_repeats, available_tokens (the source's tokens
            times max_repeats), wanted_tokens, taken_tokens, actual_share (of the tokens taken by the mix), short (whether
            the source cannot fill its share)
    Sources are compared without regard to case and surrounding blanks. A null text has no tokens; documents of no source
    count towards the total only. A target source that no document has is short unless it wants nothing.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(key).alias("key"), source_name(source).alias("src"), F.coalesce(F.octet_length(text).cast("long") + 1, F.lit(0)).cast("long").alias("tokens"))
    targets = mix_targets.select("mix_id", source_name("source").alias("src"), "target_share", F.greatest(F.col("max_repeats"), F.lit(0)).alias("max_repeats"), "size_factor")
    totals = {r["src"]: r for r in docs.join(F.broadcast(targets.select("src").distinct()), "src", "left_semi").groupBy("src").agg(F.sum("tokens").alias("t"), F.max("tokens").alias("m")).collect()}  # one row per target source
    total = docs.agg(F.sum("tokens")).first()[0] or 0
    rows = targets.collect()  # a fixed parameter table
    lanes: dict[str, list] = {}
    for r in rows:
        t = totals.get(r["src"])
        lanes.setdefault(r["mix_id"], []).append((float(r["target_share"]), int(t["t"]) * r["max_repeats"] if t else 0, int(t["m"]) if t else 0))
    cuts = {m: _cut(next(r["size_factor"] for r in rows if r["mix_id"] == m) * total, own) for m, own in lanes.items()}
    plan = spark.createDataFrame(
        [(r["mix_id"], r["src"], float(r["target_share"]), int(r["max_repeats"]), r["size_factor"] * total, int(totals[r["src"]]["t"]), *cuts[r["mix_id"]]) for r in rows if r["src"] in totals and r["target_share"] > 0 and r["max_repeats"] > 0]
        or [("", "", 1.0, 0, 0.0, 0, 0.0, 0.0)],
        "mix_id string, src string, share double, max_repeats int, budget double, src_tokens long, sure double, never double",
    )
    queue = queued(docs, targets, seed)
    uses = queue.join(F.broadcast(plan), "src").where("max_repeats > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("max_repeats"))))
    uses = uses.withColumn("finish", ((F.col("pass") - 1) * F.col("src_tokens") + F.col("cum")) / F.col("share")).where("finish <= never")
    sure = uses.where("finish <= sure")
    spent = sure.groupBy("mix_id").agg(F.sum("tokens").alias("spent"))
    edge = uses.where("finish > sure").join(F.broadcast(spent), "mix_id", "left")
    running = F.coalesce("spent", F.lit(0)) + F.sum("tokens").over(W.partitionBy("mix_id").orderBy("finish", "src", "key").rowsBetween(W.unboundedPreceding, 0))
    late = edge.withColumn("running", running).where("running <= budget")
    cols = ["mix_id", "key", "src", "pass", "tokens", "finish"]
    mixes = sure.select(*cols).unionByName(late.select(*cols))
    taken = mixes.groupBy("mix_id", "src").agg(F.sum("tokens").alias("taken_tokens"))
    facts = spark.createDataFrame([(r["mix_id"], r["src"], float(r["target_share"]), int(r["max_repeats"]), int(totals[r["src"]]["t"]) * int(r["max_repeats"]) if r["src"] in totals else 0, r["target_share"] * r["size_factor"] * total) for r in rows], "mix_id string, src string, target_share double, max_repeats int, available_tokens long, wanted_tokens double")
    done = facts.join(taken, ["mix_id", "src"], "left").withColumn("taken_tokens", F.coalesce("taken_tokens", F.lit(0)))
    share = F.col("taken_tokens") / F.nullif(F.sum("taken_tokens").over(W.partitionBy("mix_id")), F.lit(0))
    # A source that cannot fill its share ends before the cut, so the queue has taken all it has.
    short = (F.col("taken_tokens") >= F.col("available_tokens")) & (F.col("available_tokens") < F.col("wanted_tokens"))
    report = done.select("mix_id", F.col("src").alias("source"), "target_share", "max_repeats", "available_tokens", "wanted_tokens", "taken_tokens", share.alias("actual_share"), short.alias("short"))
    return mixes.withColumnRenamed("key", key).withColumnRenamed("src", "source"), report

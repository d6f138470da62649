"""Incremental forms: an index kept up to date from a stream of chapters, windowed counts with late data, expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.search import postings


def keep_index(chapters: DataFrame, table: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Writes the postings of arriving chapters, one folder per batch under `table`; a chapter that comes again replaces itself on reading."""

    def add(batch: DataFrame, number: int) -> None:
        found = postings(batch).withColumn("batch", F.lit(number).cast("long"))
        found.write.mode("overwrite").parquet(f"{table}/batch_id={number}")  # written again after a failure, never twice

    writer = chapters.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def current_index(stored: DataFrame) -> DataFrame:
    """Postings of the last batch of every chapter."""
    last = stored.groupBy("chapter_id").agg(F.max("batch").alias("batch"))
    return stored.join(last, ["chapter_id", "batch"], "left_semi").select("book_id", "chapter_id", "term", "frequency")


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and type; rows later than the watermark are left out by a stream, and by nothing in a batch."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "events", "value")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions per user: runs of events with no longer pause than the gap."""
    return events.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("events")).select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events")


def alive(created: Column, hours: Column, now: Column) -> Column:
    """Whether a cached entry has not expired; no time to live means for ever."""
    return hours.isNull() | (now <= created + F.make_dt_interval(hours=hours))

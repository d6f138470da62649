"""Topics across books: frequency, overlap, alignment, deduplication and merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions.text import group_name, level_name, toc_title
from corpusloom.operators.search import first_per_key


def current_entries(toc: DataFrame) -> DataFrame:
    """The latest row per book and entry, titles trimmed; rows that tie are decided by row_id."""
    rank = F.row_number().over(W.partitionBy("book_id", "entry_id").orderBy(F.desc_nulls_last("extracted_at"), F.desc_nulls_last("loaded_at"), F.desc("row_id")))
    return toc.withColumn("_r", rank).where("_r = 1").drop("_r").withColumn("title", F.trim("title"))


def topic_frequency(entries: DataFrame) -> DataFrame:
    """topic, entries, books: how often a lower-cased title occurs, and in how many books."""
    return entries.where("title <> ''").groupBy(F.lower("title").alias("topic")).agg(F.count("*").alias("entries"), F.countDistinct("book_id").alias("books"))


def toc_overlap(entries: DataFrame) -> DataFrame:
    """Per book: entries, those whose normalised title occurs in another book, their share, and the most other books that share one title.

    Other books are counted per title, so neither lists nor pairs of books are formed.
    """
    named = entries.select("book_id", toc_title(F.col("title")).alias("norm")).where("norm <> ''")
    per_book = named.groupBy("norm", "book_id").agg(F.count("*").alias("n"))
    homes = per_book.groupBy("norm").agg(F.count("*").alias("homes"))
    shared = F.col("homes") > 1
    out = per_book.join(homes, "norm").groupBy("book_id").agg(F.sum("n").alias("entries"), F.sum(F.when(shared, F.col("n")).otherwise(0)).alias("overlapping"), (F.max("homes") - 1).alias("widest"))
    return out.select("book_id", "entries", "overlapping", F.round(F.col("overlapping") / F.col("entries"), 6).alias("share"), "widest")


def alignment(entries: DataFrame, books: DataFrame) -> DataFrame:
    """Normalised titles on more than one level: books, levels and spellings."""
    named = entries.select("book_id", "title", toc_title(F.col("title")).alias("topic")).where("topic <> ''").join(books.select("book_id", level_name(F.col("level")).alias("book_level")), "book_id")
    out = named.groupBy("topic").agg(F.countDistinct("book_id").alias("books"), F.array_sort(F.collect_set("book_level")).alias("levels"), F.countDistinct("title").alias("spellings"))
    return out.where(F.size("levels") > 1)


def book_pairs(entries: DataFrame, least_common: int = 1) -> DataFrame:
    """Pairs of books with their common normalised titles and Jaccard similarity.

    Pairs come from an equi-join on the title; titles are distinct per book before it.
    """
    named = entries.select("book_id", toc_title(F.col("title")).alias("norm")).where("norm <> ''").distinct()
    sizes = named.groupBy("book_id").agg(F.count("*").alias("n"))
    pairs = named.select(F.col("book_id").alias("a"), "norm").join(named.select(F.col("book_id").alias("b"), "norm"), "norm").where("a < b").groupBy("a", "b").agg(F.count("*").alias("common"))
    out = pairs.where(F.col("common") >= least_common).join(sizes.select(F.col("book_id").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("book_id").alias("b"), F.col("n").alias("nb")), "b")
    return out.select("a", "b", "common", F.round(F.col("common") / (F.col("na") + F.col("nb") - F.col("common")), 6).alias("jaccard"))


def by_dimensions(topics: DataFrame) -> DataFrame:
    """Counts by level, by domain and by core flag side by side, in one pass of grouping sets."""
    return topics.groupingSets([["educational_level"], ["domain"], ["is_core"]], "educational_level", "domain", "is_core").agg(
        F.when(F.grouping("educational_level") == 0, "level").when(F.grouping("domain") == 0, "domain").otherwise("core").alias("dimension"), F.count("*").alias("topics")
    )


def statistics(topics: DataFrame) -> DataFrame:
    """One row of totals over topics."""
    return topics.agg(
        F.count("*").alias("topics"), F.sum(F.col("is_core").cast("int")).alias("core"), F.sum("duration_hours").alias("hours"), F.round(F.avg("difficulty"), 6).alias("mean_difficulty"), F.max("depth_level").alias("deepest"),
        F.countDistinct("domain").alias("domains"), F.sum((F.size(F.coalesce("prerequisites", F.array())) > 0).cast("int")).alias("with_prerequisites"),
    )


def duplicate_groups(rows: DataFrame, key: Column, order: list[Column], name: str) -> DataFrame:
    """Rows that share a key with others: the group's size and whether the row is its primary (the first in order)."""
    w = W.partitionBy("_key")
    return rows.withColumn("_key", key).withColumn("copies", F.count("*").over(w)).withColumn("is_primary", F.row_number().over(w.orderBy(*order)) == 1).where("copies > 1").withColumnRenamed("_key", name)


def merge_levels(topics: DataFrame) -> DataFrame:
    """One topic per normalised name: longest name, levels, united prerequisites and objectives, mean hours, modal domain, majority core flag."""
    t = topics.withColumn("base", group_name(F.col("name"))).where("base <> ''")
    needs = t.select("base", F.explode("prerequisites").alias("p")).groupBy("base").agg(F.array_sort(F.collect_set("p")).alias("prerequisites"))
    domains = t.where("domain is not null").groupBy("base", "domain").count().groupBy("base").agg(F.max_by("domain", F.struct(F.col("count"), F.col("domain"))).alias("domain"))
    out = t.groupBy("base").agg(
        F.max_by("name", F.struct(F.char_length("name"), F.col("name"))).alias("name"), F.array_sort(F.collect_set("educational_level")).alias("levels"), F.count("*").alias("members"),
        F.max("depth_level").alias("depth"), F.greatest(F.lit(1), F.floor(F.avg("duration_hours")).cast("int")).alias("hours"), (F.avg(F.col("is_core").cast("int")) > 0.5).alias("is_core"),
    )
    return out.join(domains, "base", "left").join(needs, "base", "left").withColumn("prerequisites", F.coalesce("prerequisites", F.array().cast("array<string>")))


def new_entries(entries: DataFrame, order: list[str]) -> DataFrame:
    """Entries whose lower-cased title no entry before them (in the given order) had."""
    named = entries.where("title <> ''").withColumn("_title", F.lower("title"))
    return first_per_key(named, ["_title"], [F.col(c) for c in order]).drop("_title")


def foundational_book(entries: DataFrame, books: DataFrame) -> DataFrame:
    """Per discipline the book of the lowest level with most entries."""
    rank = F.when(F.col("level_std") == "high_school", 0).when(F.col("level_std") == "undergraduate", 1).otherwise(2)
    sized = entries.groupBy("book_id").agg(F.count("*").alias("entries")).join(books.select("book_id", "discipline", level_name(F.col("level")).alias("level_std")), "book_id")
    return first_per_key(sized.where("discipline is not null"), ["discipline"], [rank, F.desc("entries"), F.col("book_id")])


def extraction_metrics(books: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: books, books with entries, success rate, entries in all and per successful book."""
    j = books.select("book_id").join(counts, "book_id", "left")
    ok = F.col("entries") > 0
    return j.agg(F.count("*").alias("books"), F.count(F.when(ok, 1)).alias("successful"), F.sum(F.coalesce("entries", F.lit(0))).alias("entries")).select("books", "successful", "entries", F.round(F.col("successful") / F.col("books"), 6).alias("success_rate"), F.round(F.try_divide(F.col("entries"), F.col("successful")), 6).alias("mean_entries"))

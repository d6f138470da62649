"""The curriculum pipeline: each stage is a function of DataFrames, composed lazily; nothing runs until a result is written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L
from corpusloom.functions.text import clean_title, group_name, level_name
from corpusloom.operators import graph, hierarchy, lexicon, quality, search, sequence, topics
from corpusloom.sources.tables import table


@dataclass
class Curriculum:
    """Named results of the pipeline."""

    entries: DataFrame
    raw_topics: DataFrame
    alignment: DataFrame
    units: DataFrame
    edges: DataFrame
    order: DataFrame
    checkpoints: DataFrame
    scores: DataFrame


def build(spark: SparkSession, folder: str, checkpoints: int = 20) -> Curriculum:
    """All stages over the tables of a folder."""
    books, toc, subtopics = table(spark, folder, "book_tocs"), table(spark, folder, "toc_entries"), table(spark, folder, "subtopics")
    entries = topics.current_entries(toc)
    raw = entries.where("title is not null").join(books.select("book_id", level_name(F.col("level")).alias("book_level")), "book_id").withColumn("topic", clean_title(F.col("title"))).where(F.length("topic") > 2)
    raw = raw.select("row_id", "book_id", "topic", "book_level", lexicon.first_label(F.lower("topic"), L.DOMAINS_FIRST, "general").alias("domain"))
    units = sequence.units(subtopics)
    resolved = sequence.resolved_prerequisites(units)
    edges = resolved.select(F.col("prerequisite_id").alias("src"), F.col("unit_id").alias("dst"))
    ids = units.select(F.col("unit_id").alias("id"), "pos")
    order = graph.generations(ids.select("id"), graph.acyclic(edges, ids))
    scored = units.select(F.col("unit_id").alias("id"), "title", "level", F.lit(1).alias("depth"), F.lit(None).cast("string").alias("book"), "pos")
    return Curriculum(entries, raw, topics.alignment(entries, books), units, edges, order, sequence.checkpoints(units, checkpoints), quality.overall(scored))


def search_index(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted postings of all chapters."""
    return search.tf_idf(search.postings(table(spark, folder, "chapters").where("content is not null")))


def toc_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Roots, depths and paths of all TOC entries."""
    return hierarchy.resolve(hierarchy.latest_links(table(spark, folder, "toc_entries")), paths=True)


def level_names(subtopics: DataFrame) -> DataFrame:
    """Topics merged over levels."""
    return topics.merge_levels(subtopics).withColumn("group", group_name(F.col("name")))

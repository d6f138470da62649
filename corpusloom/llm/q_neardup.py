"""Queries on near-duplicate records (p1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.llm import neardup


def _subtopics(spark, d):
    return spark.read.parquet(f"{d}/subtopics.parquet")


def p1_found(spark, d):
    """Pairs of subtopics in the same group of near duplicates."""
    members = neardup.classes(_subtopics(spark, d), "subtopic_id", ["name", "description"])
    return neardup.pairs_in_classes(members).select(F.col("a").alias("subtopic_id_a"), F.col("b").alias("subtopic_id_b"))


QUERIES = {"p1_found": p1_found}
SQL: dict[str, str] = {}

"""Exports: TOC as TSV and JSON, chunk files, graphs as DOT, tables as Parquet, hierarchies as nested JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import file_name, level_name
from corpusloom.operators.toc import depth_first


def _read_order(toc: DataFrame) -> DataFrame:
    """Rows of tables of contents with book, depth and their place in reading order (those that reach a root)."""
    newest = toc.groupBy("book_id", "entry_id").agg(F.max_by(F.struct("title", "level", "section_number", "page_number", "parent_id"), F.struct("extracted_at", "row_id")).alias("e"))
    return depth_first(toc).join(newest, ["book_id", "entry_id"]).select("book_id", "place", "depth", "entry_id", "e.*")


def write_toc_tsv(toc: DataFrame, path: str) -> None:
    """Entries of tables of contents, depth first and siblings in the order of row_id, tab separated with a header."""
    rows = _read_order(toc).repartitionByRange("book_id", "place").sortWithinPartitions("book_id", "place")
    rows.select("book_id", "entry_id", "title", "depth", "section_number", "page_number", "parent_id").write.mode("overwrite").option("sep", "\t").option("header", "true").csv(path)


TOC_JSON = "book_id string, entry_id string, parent_id string, title string, level int, page_number int"


def write_toc_json(toc: DataFrame, path: str) -> None:
    """Entries as JSON lines, one per entry with its book, in files of whole ranges of books."""
    toc.select("book_id", "entry_id", "parent_id", "title", "level", "page_number").repartitionByRange("book_id", "entry_id").write.mode("overwrite").json(path)


def read_toc_json(spark: SparkSession, path: str) -> DataFrame:
    """What write_toc_json wrote."""
    return spark.read.schema(TOC_JSON).json(path)


def book_report(books: DataFrame, toc: DataFrame) -> DataFrame:
    """Books by discipline, level and title with the number of their entries and how deep they go (null without entries)."""
    per = depth_first(toc).groupBy("book_id").agg(F.count("*").alias("entries"), F.max("depth").alias("deepest"))
    rows = books.join(per, "book_id", "left").select("discipline", level_name(F.col("level")).alias("level"), "book_title", "book_id", F.coalesce("entries", F.lit(0)).alias("entries"), "deepest")
    return rows.orderBy("discipline", "level", "book_title", "book_id")


def write_book_list(books: DataFrame, path: str) -> None:
    """The list of books as TSV and as JSON lines."""
    rows = books.select("book_id", "book_title", "discipline", "level", "language").repartitionByRange("discipline", "book_title", "book_id").sortWithinPartitions("discipline", "book_title", "book_id")
    rows.write.mode("overwrite").option("sep", "\t").option("header", "true").csv(f"{path}/tsv")
    rows.write.mode("overwrite").json(f"{path}/json")


def catalog_lines(books: DataFrame) -> DataFrame:
    """place, line of a catalog in Markdown: a heading per discipline, then its books with their level. Sort by place."""
    subject = F.coalesce("discipline", F.lit("General"))
    heads = books.select(subject.alias("s")).distinct().select(F.struct("s", F.lit("").alias("t"), F.lit("").alias("id")).alias("place"), F.concat(F.lit("## "), "s").alias("line"))
    items = books.select(F.struct(subject.alias("s"), F.coalesce("book_title", F.lit("Untitled")).alias("t"), F.coalesce("book_id", F.lit("")).alias("id")).alias("place"), F.concat(F.lit("- "), F.coalesce("book_title", F.lit("Untitled")), F.lit(" ("), F.coalesce("level", F.lit("unknown")), F.lit(")")).alias("line"))
    return heads.unionByName(items)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunk records as JSON lines, one folder per discipline and level."""
    chunks.repartition("discipline", "level").write.mode("overwrite").partitionBy("discipline", "level").json(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """One Parquet table per name."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def dot_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Lines of a DOT graph in order: `ord`, `value`. Nodes: id, title, domain; edges: src, dst, confidence.

    Ids are cut to 50 safe characters, labels to 30; one cluster per domain.
    """
    safe = lambda c: F.substring(F.regexp_replace(F.col(c).cast("string"), r"[^A-Za-z0-9_]", "_"), 1, 50)
    label = F.replace(F.substring("title", 1, 30), F.lit('"'), F.lit("'"))
    clusters = nodes.groupBy("domain").agg(F.array_sort(F.collect_list(F.concat(F.lit("    n"), safe("id"), F.lit(' [label="'), label, F.lit('"];')))).alias("rows"))
    block = clusters.select(F.concat(F.lit("1"), F.coalesce("domain", F.lit(""))).alias("ord"), F.array_join(F.concat(F.array(F.concat(F.lit('  subgraph "cluster_'), F.coalesce("domain", F.lit("general")), F.lit('" {'))), F.col("rows"), F.array(F.lit("  }"))), "\n").alias("value"))
    links = edges.select(F.concat(F.lit("2"), safe("src"), F.lit(" "), safe("dst")).alias("ord"), F.concat(F.lit("  n"), safe("src"), F.lit(" -> n"), safe("dst"), F.lit(' [label="'), F.format_number("confidence", 2), F.lit('"];')).alias("value"))
    ends = nodes.sparkSession.createDataFrame([("0", "digraph prerequisites {"), ("9", "}")], "ord string, value string")
    return ends.unionByName(block).unionByName(links)


def write_dot(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """A DOT graph as one text file; graphs that are drawn are small."""
    dot_lines(nodes, edges).orderBy("ord").select("value").coalesce(1).write.mode("overwrite").text(path)


def nested(paths: list[list[str]]) -> dict:
    """Paths of names as nested objects."""
    out: dict = {}
    for p in paths:
        at = out
        for name in p:
            at = at.setdefault(name, {})
    return out


def hierarchy_json(tree: DataFrame, most: int = 100_000) -> str:
    """A nested JSON document of a path column; a document for people, so its size is checked first."""
    if tree.count() > most:
        raise ValueError(f"more than {most} paths; write the table instead")
    return json.dumps(nested([list(r["path"]) for r in tree.select("path").orderBy("path").collect()]), ensure_ascii=False, indent=1)


def export_names(df: DataFrame, column: str) -> DataFrame:
    """df with a safe file name of a column."""
    return df.withColumn("file_name", file_name(F.col(column)))

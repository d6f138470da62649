"""Queries on languages (p4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.llm import language
from corpusloom.sources.tables import table


def p4_found(spark, d):
    """True languages behind missing or wrong labels, and languages of passages."""
    return language.found(table(spark, d, "documents"), table(spark, d, "book_tocs"), table(spark, d, "chapters"))


def p4_documents(spark, d):
    """Language and confidence of every document."""
    docs = table(spark, d, "documents")
    return language.document_languages(docs, language.fit(docs)).select("doc_id", "language", F.round("confidence", 6).alias("confidence"))


def _passages(spark, d, name, key, text):
    seen = language.analyse(table(spark, d, name), key, text, language.fit(table(spark, d, "documents")))
    return seen.select(F.col("key").alias(key), F.inline("runs")).withColumn("confidence", F.round("confidence", 6))


def p4_passages(spark, d):
    """Stretches of one language in every chapter, with the number of sentences and the confidence of each."""
    return _passages(spark, d, "chapters", "chapter_id", "content")


def p4_document_passages(spark, d):
    """Stretches of one language in every document."""
    return _passages(spark, d, "documents", "doc_id", "text")


def p4_books(spark, d):
    """Language and confidence of every book, from the text of its chapters."""
    chapters = table(spark, d, "chapters")
    rows = chapters.select(F.struct("chapter_id", "book_id").alias("k"), "content")
    seen = language.analyse(rows, "k", "content", language.fit(table(spark, d, "documents"))).select("key.book_id", "scores")
    return language.book_languages(seen).withColumn("confidence", F.round("confidence", 6))


QUERIES = {"p4_books": p4_books, "p4_found": p4_found, "p4_documents": p4_documents, "p4_passages": p4_passages, "p4_document_passages": p4_document_passages}
SQL: dict[str, str] = {}

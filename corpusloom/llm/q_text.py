"""Queries on sentences (p8)."""

from __future__ import annotations

from corpusloom.llm import sentences as sent
from corpusloom.sources.tables import table


def p8_found(spark, d):
    """The end of every sentence of every document."""
    return sent.sentences(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "end_pos")


def p8_sentences(spark, d):
    """Every sentence of every document with its text."""
    return sent.sentences(table(spark, d, "documents"), "doc_id", "text", with_text=True)


QUERIES = {"p8_found": p8_found, "p8_sentences": p8_sentences}
SQL: dict[str, str] = {}

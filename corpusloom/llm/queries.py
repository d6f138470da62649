"""Registered queries of this subpackage and their SQL, by module."""

from __future__ import annotations

from corpusloom.queries import collect

MODULES = ("q_neardup", "q_language", "q_sizes", "q_text")

QUERIES, SQL = collect(MODULES, "corpusloom.llm")

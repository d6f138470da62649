"""Registered queries and their SQL, by module. Each module has QUERIES and SQL."""

from __future__ import annotations

import importlib

MODULES = ("structure", "text", "catalog", "learning", "retrieval", "rules", "levels", "titles", "links", "contents", "alike", "scores", "concepts")


def collect(modules: tuple[str, ...] = MODULES, package: str = "corpusloom.queries") -> tuple[dict, dict]:
    queries: dict = {}
    sql: dict = {}
    for m in modules:
        mod = importlib.import_module(f"{package}.{m}")
        queries |= mod.QUERIES
        sql |= mod.SQL
    return queries, sql

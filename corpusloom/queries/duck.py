"""Helpers that write DuckDB SQL from the same rule tables as the column functions."""

from __future__ import annotations

from corpusloom.functions import lexicons as L


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def chain(expr: str, rules: list[tuple[str, str]]) -> str:
    for pattern, to in rules:
        expr = f"regexp_replace({expr}, {quote(pattern)}, {quote(to.replace('$1', chr(92) + '1'))}, 'g')"
    return expr


def initcap(expr: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({expr}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def count(expr: str, words: list[str]) -> str:
    return "(" + " + ".join(f"contains({expr}, {quote(w)})::INT" for w in words) + ")"


def any_of(expr: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({expr}, {quote(w)})" for w in words) + ")"


def first(expr: str, lexicon: dict[str, list[str]], default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {any_of(expr, ws)} THEN {quote(k)}" for k, ws in lexicon.items()) + f" ELSE {default} END"


def most(expr: str, lexicon: dict[str, list[str]], default: str = "NULL") -> str:
    counts = [count(expr, ws) for ws in lexicon.values()]
    top = f"greatest({', '.join(counts)})"
    return f"CASE WHEN {top} = 0 THEN {default} " + " ".join(f"WHEN {c} = {top} THEN {quote(k)}" for k, c in zip(lexicon, counts)) + " END"


def terms(expr: str) -> str:
    stop = ", ".join(quote(w) for w in L.STOPWORDS)
    return rf"list_filter(regexp_split_to_array(regexp_replace(lower({expr}), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+'), lambda x: length(x) > 2 AND x NOT IN ({stop}))"


def level(expr: str) -> str:
    return "CASE " + " ".join(f"WHEN lower({expr}) IN ({', '.join(map(quote, v))}) THEN {quote(k)}" for k, v in L.LEVELS.items()) + " ELSE 'undergraduate' END"


CURRENT = """cur AS (SELECT * REPLACE (trim(title) AS title) FROM (SELECT *, row_number() OVER (PARTITION BY book_id, entry_id ORDER BY extracted_at DESC NULLS LAST, loaded_at DESC NULLS LAST, row_id DESC) AS _r FROM toc_entries) WHERE _r = 1)"""

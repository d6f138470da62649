"""Queries on stacked hierarchies, step times and repaired answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import graph, levels, topics
from corpusloom.queries import duck as D
from corpusloom.sources.tables import table


def _paths(spark, d):
    return levels.stacked_paths(topics.current_entries(table(spark, d, "toc_entries")), "book_id", "row_id")


def hierarchy_build(spark, d):
    """Path of titles of every entry by its level and its place in the book."""
    return _paths(spark, d).select("book_id", "row_id", F.array_join("path", " > ").alias("path"))


def six_level_paths(spark, d):
    """The same paths with exactly six names."""
    return _paths(spark, d).select("row_id", F.array_join(graph.six_levels(F.col("path")), " > ").alias("path"))


def mean_depth(spark, d):
    """Entries and mean depth of their paths per discipline and level of the book."""
    p = _paths(spark, d).join(table(spark, d, "book_tocs").select("book_id", "discipline", F.col("level").alias("book_level")), "book_id")
    return p.groupBy("discipline", "book_level").agg(F.count("*").alias("entries"), F.round(F.avg(F.size("path")), 2).alias("mean_depth"))


def run_times(spark, d):
    """Seconds of PDF runs by outcome: number, total, least, most and share of all time."""
    s = table(spark, d, "pdf_results").where("processing_time is not null").select(F.when(F.col("success"), "done").otherwise("failed").alias("step"), F.round(F.col("processing_time") * 1000).cast("long").alias("seconds"))
    return levels.step_times(s).select("step", "runs", "total", "least", "most", F.round("percent", 6).alias("percent"))


def repaired_payloads(spark, d):
    """Payloads in a code fence with a trailing comma, repaired; whether each begins and ends as JSON."""
    r = table(spark, d, "raw_records").where("payload is not null")
    fixed = levels.repaired_json(F.concat(F.lit("Here it is:\n```json\n"), F.col("payload"), F.lit("\n```")))
    return r.select("raw_id", F.md5(fixed).alias("fixed_md5"), fixed.isNotNull().alias("is_json"))


QUERIES = {f.__name__: f for f in (hierarchy_build, six_level_paths, mean_depth, run_times, repaired_payloads)}

_LAST = ", ".join(f"last_value(CASE WHEN l = {k} THEN {{'o': row_id, 't': title}} END IGNORE NULLS) OVER w AS p{k}" for k in range(1, 7))


def _open(k: int) -> str:
    closed = " OR ".join(f"coalesce(p{j}.o > p{k}.o, FALSE)" for j in range(1, k)) or "FALSE"
    return f"CASE WHEN l >= {k} AND p{k} IS NOT NULL AND NOT ({closed}) THEN p{k}.t END"


_STACK = f"""WITH {D.CURRENT}, e AS (SELECT book_id, row_id, greatest(1, least(6, level)) AS l, title FROM cur WHERE level IS NOT NULL AND title IS NOT NULL), s AS (SELECT book_id, row_id, l, {_LAST} FROM e WINDOW w AS (PARTITION BY book_id ORDER BY row_id ROWS UNBOUNDED PRECEDING)),
  p AS (SELECT book_id, row_id, list_filter([{', '.join(_open(k) for k in range(1, 7))}], lambda x: x IS NOT NULL) AS path FROM s)"""
SQL = {
    "hierarchy_build": f"{_STACK} SELECT book_id, row_id, array_to_string(path, ' > ') AS path FROM p",
    "six_level_paths": f"{_STACK} SELECT row_id, array_to_string(path || list_transform(range(6 - len(path)), lambda x: 'General Topic'), ' > ') AS path FROM p",
    "mean_depth": f"{_STACK} SELECT discipline, level AS book_level, count(*) AS entries, round(avg(len(path)), 2) AS mean_depth FROM p JOIN book_tocs USING (book_id) GROUP BY ALL",
    "run_times": "WITH s AS (SELECT CASE WHEN success THEN 'done' ELSE 'failed' END AS step, round(processing_time * 1000)::BIGINT AS seconds FROM pdf_results WHERE processing_time IS NOT NULL) SELECT step, count(*) AS runs, sum(seconds)::BIGINT AS total, min(seconds) AS least, max(seconds) AS most, round(100 * sum(seconds) / (SELECT sum(seconds) FROM s), 6) AS percent FROM s GROUP BY step",
    "repaired_payloads": r"""WITH t AS (SELECT raw_id, regexp_extract('Here it is:' || chr(10) || '```json' || chr(10) || payload || chr(10) || '```', '(?s)```(?:json)?\s*(.*?)```', 1) AS x, payload FROM raw_records WHERE payload IS NOT NULL),
      f AS (SELECT raw_id, nullif(regexp_replace(regexp_extract(coalesce(nullif(x, ''), 'Here it is:' || payload), '(?s)([\[{].*[\]}])', 1), ',\s*([\]}])', '\1', 'g'), '') AS f FROM t) SELECT raw_id, md5(f) AS fixed_md5, f IS NOT NULL AS is_json FROM f""",
}

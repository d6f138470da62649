"""Queries on overall scores. Their SQL has constants of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L
from corpusloom.operators import scores
from corpusloom.queries.learning import _U, _u
from corpusloom.sources.tables import table


def _rounded(df):
    return df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in df.columns])


def quality_contents(spark, d):
    """Coverage, order, names, size and progression of the sequence of subtopics."""
    rules = spark.createDataFrame([(k, x) for k, v in L.DOMAIN_PREREQUISITES.items() for x in v], "domain string, needs string")
    return _rounded(scores.contents_quality(_u(spark, d), rules))


def quality_comprehensive(spark, d):
    return _rounded(scores.comprehensive_quality(_u(spark, d)))


def quality_progression(spark, d):
    return _rounded(scores.progression_quality(_u(spark, d)))


def quality_order(spark, d):
    """Scores of the order of units, with the share of PDF runs that succeeded."""
    parsed = table(spark, d, "pdf_results").agg(F.sum(F.col("success").cast("int")).alias("parsed"), F.count("*").alias("runs"))
    return _rounded(scores.order_quality(_u(spark, d), parsed))


QUERIES = {f.__name__: f for f in (quality_contents, quality_comprehensive, quality_progression, quality_order)}

_RULES = ", ".join(f"('{k}', '{x}')" for k, v in L.DOMAIN_PREREQUISITES.items() for x in v)

SQL = {
    "quality_contents": f"""WITH {_U}, r(domain, needs) AS (VALUES {_RULES}), w AS (SELECT count(*) AS w FROM u JOIN r USING (domain) JOIN (SELECT domain AS needs, max(pos) AS last FROM u GROUP BY 1) USING (needs) WHERE last > pos),
s AS (SELECT count(DISTINCT domain) FILTER (WHERE domain IN ('units_measurement', 'vectors', 'kinematics', 'dynamics', 'energy', 'momentum', 'waves', 'thermodynamics', 'electricity', 'magnetism', 'optics')) / 11.0::DOUBLE AS coverage, greatest(0, 1 - (SELECT w FROM w) / count(*)) AS ordering,
 count(*) FILTER (WHERE NOT regexp_matches(lower(title), 'untitled|section|chapter|equations')) / count(*) AS uniqueness, least(1.0::DOUBLE, count(*) / 1000.0::DOUBLE) AS completeness, CASE WHEN count(DISTINCT level) >= 2 THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END AS progression FROM u)
SELECT round(coverage, 6) AS coverage, round(ordering, 6) AS ordering, round(uniqueness, 6) AS uniqueness, round(completeness, 6) AS completeness, round(progression, 6) AS progression, round((coverage + ordering + uniqueness + completeness + progression) / 5, 6) AS overall FROM s""",
    "quality_comprehensive": f"""WITH {_U}, q AS (SELECT pos, unnest(prerequisites) AS name FROM u), f AS (SELECT title AS name, min(pos) AS first FROM u GROUP BY 1),
s AS (SELECT (SELECT 1 - count(*) FILTER (WHERE first IS NULL OR first >= pos) / greatest(1, count(*)) FROM q LEFT JOIN f USING (name)) AS a,
 (SELECT count(*) / 15.0::DOUBLE FROM (SELECT DISTINCT domain, level FROM u WHERE domain IN ('mechanics', 'thermodynamics', 'electromagnetism', 'waves_optics', 'modern_physics'))) AS b,
 (SELECT 1 - count(*) FILTER (WHERE n - difficulty > 2) / greatest(1, count(*)) FROM (SELECT difficulty, lead(difficulty) OVER (ORDER BY pos) AS n FROM u) WHERE n IS NOT NULL) AS c,
 (SELECT CASE WHEN coalesce(min(pos) FILTER (WHERE NOT is_core), 4611686018427387904) > coalesce(max(pos) FILTER (WHERE is_core), 0) THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END FROM u) AS d,
 (SELECT count(*) FILTER (WHERE CASE coalesce(level, 'undergraduate') WHEN 'high_school' THEN difficulty BETWEEN 1 AND 3 WHEN 'undergraduate' THEN difficulty BETWEEN 2 AND 4 WHEN 'graduate' THEN difficulty BETWEEN 3 AND 5 ELSE false END) / greatest(1, count(*)) FROM u) AS e,
 (SELECT greatest(0.0::DOUBLE, 1 - stddev_pop(k) / avg(k)) FROM (SELECT domain, count(*) AS k FROM u GROUP BY 1)) AS g)
SELECT round(a, 6) AS prerequisite_compliance, round(b, 6) AS coverage, round(c, 6) AS progression_smoothness, round(d, 6) AS elective_placement, round(e, 6) AS level_appropriateness, round(g, 6) AS balance, round((a + b + c + d + e + g) / 6, 6) AS overall FROM s""",
    "quality_progression": f"""WITH {_U}, s AS (SELECT count(DISTINCT level) / 3.0::DOUBLE AS a, count(DISTINCT domain) / 17.0::DOUBLE AS b, count(*) FILTER (WHERE len(prerequisites) > 0) / count(*) AS c,
 greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce((avg(pos) FILTER (WHERE NOT is_core) / count(*) - 0.5::DOUBLE) * 2, 1.0::DOUBLE))) AS d FROM u)
SELECT round(a, 6) AS level_coverage, round(b, 6) AS domain_coverage, round(c, 6) AS connectivity, round(d, 6) AS elective_placement, round(a * 0.2::DOUBLE + b * 0.2::DOUBLE + c * 0.2::DOUBLE + 0.3::DOUBLE + d * 0.1::DOUBLE, 6) AS overall FROM s""",
    "quality_order": f"""WITH {_U}, v AS (SELECT *, contains(lower(title), 'astrophysics') OR contains(lower(title), 'cosmology') AS astro, CASE level WHEN 'high_school' THEN 1 WHEN 'graduate' THEN 3 ELSE 2 END AS rk FROM u),
s AS (SELECT (SELECT 1 - count(*) FILTER (WHERE i IS NULL OR i >= pos) / greatest(1, count(*)) FROM u, (SELECT min(pos) AS i FROM u WHERE contains(lower(title), 'introduction') OR contains(lower(title), 'basic')) WHERE contains(lower(title), 'advanced')) AS a,
 (SELECT CASE WHEN max(pos) FILTER (WHERE is_core) >= min(pos) FILTER (WHERE NOT is_core) THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END FROM u) AS b,
 (SELECT 1 - count(*) FILTER (WHERE n < rk - 1) / greatest(1, count(*)) FROM (SELECT rk, lead(rk) OVER (ORDER BY pos) AS n FROM v) WHERE n IS NOT NULL) AS c, (SELECT count(*) FILTER (WHERE success) / greatest(1, count(*)) FROM pdf_results) AS d,
 (SELECT (least(1.0::DOUBLE, count(DISTINCT domain) / 3.0::DOUBLE) + least(1.0::DOUBLE, count(DISTINCT coalesce(level, 'undergraduate')) / 2.0::DOUBLE)) / 2 FROM u) AS e,
 (SELECT CASE WHEN min(pos) FILTER (WHERE astro) <= max(pos) FILTER (WHERE NOT is_core AND NOT astro) THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END FROM v) AS g)
SELECT round(a, 6) AS prerequisites, round(b, 6) AS core_before_electives, round(c, 6) AS level_progression, round(d, 6) AS parsing, round(e, 6) AS variety, round(g, 6) AS astrophysics_last, round(a * 0.25::DOUBLE + b * 0.2::DOUBLE + c * 0.15::DOUBLE + d * 0.15::DOUBLE + e * 0.15::DOUBLE + g * 0.1::DOUBLE, 6) AS overall FROM s""",
}

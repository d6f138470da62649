"""Overall scores of a sequence of units (see sequence.units): one row each, from aggregates and joins on positions.

A unit counts where it stands (pos). Nulls: no domain is no domain, no level is undergraduate, no difficulty is 1. An empty
sequence gives a row of nulls or of the stated defaults.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import contains_any

# Fixed values.
ESSENTIAL = ["units_measurement", "vectors", "kinematics", "dynamics", "energy", "momentum", "waves", "thermodynamics", "electricity", "magnetism", "optics"]
NO_NAMES = ["untitled", "section", "chapter", "equations"]
EXPECTED_DOMAINS = ["mechanics", "thermodynamics", "electromagnetism", "waves_optics", "modern_physics"]
DIFFICULTY_RANGE = {"high_school": (1, 3), "undergraduate": (2, 4), "graduate": (3, 5)}
LEVELS = ["high_school", "undergraduate", "graduate"]
DOMAINS = 17
TARGET = 1000


def _share(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(empty))


def _rank(level: Column) -> Column:
    return F.when(level == "high_school", 1).when(level == "graduate", 3).otherwise(2)


def _row(parts: list[DataFrame]) -> DataFrame:
    """One-row tables side by side."""
    return reduce(lambda a, b: a.crossJoin(b), parts)


def _following(u: DataFrame, column: str) -> DataFrame:
    """Values of a column of neighbours: this, next."""
    return u.select("pos", F.col(column).alias("this")).join(u.select((F.col("pos") - 1).alias("pos"), F.col(column).alias("next")), "pos")


def contents_quality(u: DataFrame, rules: DataFrame) -> DataFrame:
    """Coverage of essential domains, order of domains by rules (domain, needs), names, size and levels; their mean."""
    last = u.groupBy(F.col("domain").alias("needs")).agg(F.max("pos").alias("last"))
    wrong = u.join(F.broadcast(rules), "domain").join(F.broadcast(last.join(F.broadcast(rules.select("needs").distinct()), "needs")), "needs").agg(F.count(F.when(F.col("last") > F.col("pos"), 1)).alias("wrong"))
    one = u.agg(
        F.count("*").alias("n"), (F.countDistinct(F.when(F.col("domain").isin(ESSENTIAL), F.col("domain"))) / len(ESSENTIAL)).alias("coverage"),
        F.count(F.when(~contains_any(F.lower("title"), NO_NAMES), 1)).alias("named"), F.countDistinct("level").alias("levels"),
    )
    s = _row([one, wrong]).select(
        "coverage", F.greatest(F.lit(0.0), 1 - _share(F.col("wrong"), F.col("n"))).alias("ordering"), _share(F.col("named"), F.col("n")).alias("uniqueness"), F.least(F.lit(1.0), F.col("n") / TARGET).alias("completeness"),
        F.when(F.col("levels") >= 2, 1.0).otherwise(0.7).alias("progression"),
    )
    return s.withColumn("overall", sum((F.col(c) for c in s.columns[1:]), F.col(s.columns[0])) / len(s.columns))


def comprehensive_quality(u: DataFrame) -> DataFrame:
    """Prerequisites seen before, coverage of domains by levels, jumps of difficulty, electives last, difficulty fit for the level, balance of domains (1 less the coefficient of variation); their mean."""
    wanted = u.select("pos", F.explode("prerequisites").alias("name"))
    first = u.groupBy(F.col("title").alias("name")).agg(F.min("pos").alias("first"))
    pre = wanted.join(first, "name", "left").agg(F.count("*").alias("checks"), F.count(F.when(F.col("first").isNull() | (F.col("first") >= F.col("pos")), 1)).alias("unmet"))
    cover = u.where(F.col("domain").isin(EXPECTED_DOMAINS)).select("domain", "level").distinct().agg((F.count("*") / (len(EXPECTED_DOMAINS) * len(LEVELS))).alias("coverage"))
    jumps = _following(u, "difficulty").agg(F.count("*").alias("steps"), F.count(F.when(F.col("next") - F.col("this") > 2, 1)).alias("jumps"))
    fit = F.lit(False)
    for level, (lo, hi) in DIFFICULTY_RANGE.items():
        fit = fit | ((F.coalesce("level", F.lit("undergraduate")) == level) & F.col("difficulty").between(lo, hi))
    place = u.agg(F.max(F.when(F.col("is_core"), F.col("pos"))).alias("core"), F.min(F.when(~F.col("is_core"), F.col("pos"))).alias("elective"), F.count("*").alias("n"), F.count(F.when(fit, 1)).alias("fit"))
    spread = u.groupBy("domain").agg(F.count("*").alias("k")).agg(F.avg("k").alias("mean"), F.stddev_pop("k").alias("sd"))
    s = _row([pre, cover, jumps, place, spread]).select(
        (1 - F.col("unmet") / F.greatest(F.lit(1), F.col("checks"))).alias("prerequisite_compliance"), "coverage", (1 - F.col("jumps") / F.greatest(F.lit(1), F.col("steps"))).alias("progression_smoothness"),
        F.when(F.coalesce("elective", F.lit(1 << 62)) > F.coalesce("core", F.lit(0)), 1.0).otherwise(0.5).alias("elective_placement"), (F.col("fit") / F.greatest(F.lit(1), F.col("n"))).alias("level_appropriateness"),
        F.greatest(F.lit(0.0), 1 - _share(F.col("sd"), F.col("mean"), 1.0)).alias("balance"),
    )
    return s.withColumn("overall", sum((F.col(c) for c in s.columns[1:]), F.col(s.columns[0])) / len(s.columns))


def progression_quality(u: DataFrame) -> DataFrame:
    """Shares of levels and domains that occur, of units with prerequisites, and how late electives come; weighted .2, .2, .2, .1, and .3 for what always holds."""
    s = u.agg(
        (F.countDistinct("level") / len(LEVELS)).alias("level_coverage"), (F.countDistinct("domain") / DOMAINS).alias("domain_coverage"), _share(F.count(F.when(F.size("prerequisites") > 0, 1)), F.count("*")).alias("connectivity"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce((F.try_divide(F.avg(F.when(~F.col("is_core"), F.col("pos"))), F.count("*")) - 0.5) * 2, F.lit(1.0)))).alias("elective_placement"),
    )
    return s.withColumn("overall", F.col("level_coverage") * 0.2 + F.col("domain_coverage") * 0.2 + F.col("connectivity") * 0.2 + 0.3 + F.col("elective_placement") * 0.1)


def order_quality(u: DataFrame, parsed: DataFrame) -> DataFrame:
    """Advanced units after introductory ones, electives after core, falls of level, share of parsed runs (one row: parsed, runs), variety, astrophysics last; weighted .25, .2, .15, .15, .15, .1."""
    name = F.lower("title")
    intro = u.where(name.contains("introduction") | name.contains("basic")).agg(F.min("pos").alias("intro"))
    advanced = u.where(name.contains("advanced")).crossJoin(F.broadcast(intro)).agg(F.count("*").alias("checks"), F.count(F.when(F.col("intro").isNull() | (F.col("intro") >= F.col("pos")), 1)).alias("bad"))
    falls = _following(u.withColumn("rank", _rank(F.col("level"))), "rank").agg(F.count("*").alias("steps"), F.count(F.when(F.col("next") < F.col("this") - 1, 1)).alias("falls"))
    astro = name.contains("astrophysics") | name.contains("cosmology")
    one = u.agg(
        F.max(F.when(F.col("is_core"), F.col("pos"))).alias("core"), F.min(F.when(~F.col("is_core"), F.col("pos"))).alias("elective"), F.countDistinct("domain").alias("domains"), F.countDistinct(F.coalesce("level", F.lit("undergraduate"))).alias("levels"),
        F.min(F.when(astro, F.col("pos"))).alias("astro"), F.max(F.when(~F.col("is_core") & ~astro, F.col("pos"))).alias("others"),
    )
    s = _row([advanced, falls, one, parsed]).select(
        (1 - F.col("bad") / F.greatest(F.lit(1), F.col("checks"))).alias("prerequisites"), F.when(F.col("core").isNull() | F.col("elective").isNull() | (F.col("core") < F.col("elective")), 1.0).otherwise(0.5).alias("core_before_electives"),
        (1 - F.col("falls") / F.greatest(F.lit(1), F.col("steps"))).alias("level_progression"), (F.col("parsed") / F.greatest(F.lit(1), F.col("runs"))).alias("parsing"),
        ((F.least(F.lit(1.0), F.col("domains") / 3.0) + F.least(F.lit(1.0), F.col("levels") / 2.0)) / 2).alias("variety"),
        F.when(F.col("astro").isNull() | F.col("others").isNull() | (F.col("astro") > F.col("others")), 1.0).otherwise(0.5).alias("astrophysics_last"),
    )
    weights = (0.25, 0.2, 0.15, 0.15, 0.15, 0.1)
    return s.withColumn("overall", sum((F.col(c) * w for c, w in zip(s.columns[1:], weights[1:])), F.col(s.columns[0]) * weights[0]))

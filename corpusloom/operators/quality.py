"""Quality scores of topic collections: one aggregate row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L
from corpusloom.functions.text import contains_any, count_words, terms

MAJOR = ["high_school", "undergraduate", "graduate"]
COMPLEXITY_WORDS = ["advanced", "quantum", "relativistic", "nuclear", "molecular", "electromagnetic", "thermodynamic", "statistical", "theoretical"]  # fixed values


def level_progression(topics: DataFrame) -> DataFrame:
    """One row: .7 x share of the major levels present + .3 x (1 - standard deviation of the levels' shares)."""
    n = topics.groupBy(F.coalesce("level", F.lit("unknown")).alias("level")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    s = n.crossJoin(F.broadcast(total)).agg(F.count(F.when(F.col("level").isin(MAJOR), 1)).alias("have"), F.stddev_pop(F.col("n") / F.col("total")).alias("spread"))
    return s.select((0.7 * F.col("have") / 3.0 + 0.3 * (1.0 - F.coalesce("spread", F.lit(0.0)))).alias("level_progression"))


def domain_coherence(topics: DataFrame) -> DataFrame:
    """One row: .6 x share of domains covered + .4 x (mean topics per covered domain / 5, at most 1); .5 without any."""
    t = F.lower("title")
    hits = topics.agg(*[F.sum(contains_any(t, ws).cast("int")).alias(f"d{i}") for i, ws in enumerate(L.DOMAINS_FIRST.values())])
    each = F.array(*[F.coalesce(F.col(f"d{i}"), F.lit(0)) for i in range(len(L.DOMAINS_FIRST))])
    total = F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)
    covered = F.size(F.filter(each, lambda x: x > 0))
    return hits.select(F.when(total == 0, 0.5).otherwise(0.6 * covered / float(len(L.DOMAINS_FIRST)) + 0.4 * F.least(F.try_divide(total, covered) / 5.0, F.lit(1.0))).alias("domain_coherence"))


def semantic_coherence(topics: DataFrame, features: int = 100) -> DataFrame:
    """One row: mean cosine of the TF-IDF vectors of all pairs of titles, at least 0.

    The sum over all pairs is the squared length of the sum of all vectors less their own, so no pair is formed. Features
    are the most frequent terms (ties by term); idf = ln((1 + n) / (1 + df)) + 1; vectors have length 1.
    """
    docs = topics.select(F.monotonically_increasing_id().alias("_i"), terms(F.lower("title")).alias("t"), "id").select("id", F.explode("t").alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    n = topics.agg(F.count("*").alias("n"))
    vocab = docs.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df")).orderBy(F.desc("total"), "term").limit(features)
    w = docs.join(F.broadcast(vocab), "term").crossJoin(F.broadcast(n)).select("id", "term", (F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = w.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = w.join(norm, "id").select("id", "term", (F.col("w") / F.col("norm")).alias("u"))
    length = unit.groupBy("term").agg(F.sum("u").alias("s")).agg(F.coalesce(F.sum(F.col("s") * F.col("s")), F.lit(0.0)).alias("square"))
    return length.crossJoin(n).select(F.when(F.col("n") < 2, 1.0).otherwise(F.greatest(F.lit(0.0), F.try_divide(F.col("square") - F.col("n"), F.col("n") * (F.col("n") - 1)))).alias("semantic_coherence"))


def hierarchical_coherence(topics: DataFrame) -> DataFrame:
    """One row: share of steps between neighbouring major levels at which titles do not get simpler; .5 without steps."""
    t = F.lower("title")
    complexity = count_words(t, COMPLEXITY_WORDS) + 0.1 * F.size(F.filter(F.split("title", r"\s+"), lambda x: x != ""))
    means = topics.agg(*[F.avg(F.when(F.col("level") == lv, complexity)).alias(f"c{i}") for i, lv in enumerate(MAJOR)])
    step = lambda a, b: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), (F.col(b) >= F.col(a)).cast("int"))
    s1, s2 = step("c0", "c1"), step("c1", "c2")
    n = s1.isNotNull().cast("int") + s2.isNotNull().cast("int")
    return means.select(F.coalesce(F.try_divide(F.coalesce(s1, F.lit(0)) + F.coalesce(s2, F.lit(0)), n), F.lit(0.5)).alias("hierarchical_coherence"))


def overall(topics: DataFrame) -> DataFrame:
    """One row with all scores of topics (id, title, level, depth, book, pos) and their weighted mean."""
    t = F.lower("title")
    fundamental = contains_any(t, L.FUNDAMENTAL_WORDS)
    advanced = ~fundamental & contains_any(t, L.ADVANCED_WORDS)
    size = F.char_length(F.coalesce("title", F.lit("")))
    full = lambda c: F.avg((F.col(c).isNotNull() & (F.col(c).cast("string") != "")).cast("double"))
    base = topics.agg(
        F.count("*").alias("total_topics"), F.countDistinct(t).alias("unique_topics"), F.avg(F.when(fundamental, F.col("pos"))).alias("pf"), F.avg(F.when(advanced, F.col("pos"))).alias("pa"),
        sum(F.max(contains_any(t, ws).cast("int")) for ws in L.AREAS.values()).alias("areas"), sum(F.max(contains_any(t, ws).cast("int")) for ws in L.CONTENT_TYPES.values()).alias("kinds"), F.countDistinct(F.coalesce("book", F.lit("unknown"))).alias("books"),
        ((full("title") + full("depth") + full("level") + full("book")) / 4.0).alias("complete"), F.stddev_pop(size).alias("sd"), F.avg(size).alias("mean"),
    )
    ordering = F.when(F.col("pf").isNull() | F.col("pa").isNull(), 0.5).when(F.col("pa") > F.col("pf"), 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - (F.col("pf") - F.col("pa")) / F.col("total_topics")))
    j = base.crossJoin(level_progression(topics)).crossJoin(domain_coherence(topics)).crossJoin(semantic_coherence(topics)).crossJoin(hierarchical_coherence(topics))
    s = j.select(
        "total_topics", "unique_topics", (1.0 - F.try_divide(F.col("unique_topics"), F.col("total_topics"))).alias("duplicate_ratio"), "level_progression", (0.4 * F.col("domain_coherence") + 0.3 * F.col("semantic_coherence") + 0.3 * F.col("hierarchical_coherence")).alias("topic_coherence"),
        (F.coalesce("areas", F.lit(0)) / 5.0).alias("coverage_breadth"), ordering.alias("pedagogical_ordering"), (0.7 * F.coalesce("kinds", F.lit(0)) / 5.0 + 0.3 * F.least(F.col("books") / 5.0, F.lit(1.0))).alias("content_diversity"),
        (0.8 * F.coalesce("complete", F.lit(0.0)) + 0.2 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1.0 - F.coalesce(F.try_divide("sd", "mean"), F.lit(0.0))))).alias("structural_consistency"),
    )
    weights = {"level_progression": 0.20, "topic_coherence": 0.25, "coverage_breadth": 0.15, "pedagogical_ordering": 0.20, "content_diversity": 0.10, "structural_consistency": 0.10}
    return s.withColumn("overall", sum(F.col(c) * w for c, w in weights.items()))


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: scores of two collections side by side, the winner and a confidence of twice the difference, at most 1."""
    j = a.select(F.col("overall").alias("a")).crossJoin(b.select(F.col("overall").alias("b")))
    d = F.abs(F.col("a") - F.col("b"))
    return j.select("a", "b", F.when(d < 1e-9, "tie").when(F.col("a") > F.col("b"), "first").otherwise("second").alias("winner"), F.least(2 * d, F.lit(1.0)).alias("confidence"), (100 * F.try_divide(F.col("b") - F.col("a"), F.col("a"))).alias("improvement"))


def toc_quality(entries: DataFrame) -> DataFrame:
    """Per book: .5, up to .2 for many entries, up to .2 for depth and .1 for titles of middling length; at most 1."""
    g = entries.groupBy("book_id").agg(F.count("*").alias("n"), F.max("level").alias("depth"), F.avg(F.char_length("title")).alias("length"))
    count = F.when(F.col("n") >= 20, 0.2).when(F.col("n") >= 10, 0.1).otherwise(0.0)
    deep = F.when(F.col("depth") >= 3, 0.2).when(F.col("depth") >= 2, 0.1).otherwise(0.0)
    return g.select("book_id", F.least(F.lit(1.0), 0.5 + count + deep + F.when(F.col("length").between(10, 50), 0.1).otherwise(0.0)).alias("quality"))


def sequence_quality(u: DataFrame, linked: DataFrame, smooth: DataFrame, inversions: DataFrame) -> DataFrame:
    """One row: prerequisite coverage, smoothness, domain coverage (of 8), cross-level links, preserved order, and .25 .25 .2 .15 .15 of them."""
    base = u.agg(F.avg((F.size("prerequisites") > 0).cast("double")).alias("coverage"), (F.least(F.countDistinct("domain") / 8.0, F.lit(1.0))).alias("domains"), F.count("*").alias("n"))
    links = linked.agg(F.countDistinct("id").alias("linked"))
    kept = inversions.agg(F.sum("inversions").alias("bad"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    j = base.crossJoin(smooth.select("smoothness")).crossJoin(links).crossJoin(kept)
    s = j.select("coverage", "smoothness", "domains", F.try_divide("linked", "n").alias("connectivity"), F.coalesce(1.0 - F.try_divide("bad", "pairs"), F.lit(1.0)).alias("order_kept"))
    return s.withColumn("overall", 0.25 * F.col("coverage") + 0.25 * F.col("smoothness") + 0.2 * F.col("domains") + 0.15 * F.col("connectivity") + 0.15 * F.col("order_kept"))

ESSENTIAL = ["units_measurement", "vectors", "kinematics", "dynamics", "energy", "momentum", "waves", "thermodynamics", "electricity", "magnetism", "optics"]  # fixed values


def curriculum(topics: DataFrame, target: int = 1000) -> DataFrame:
    """One row: coverage of essential domains, share of titles that say something, levels (2 are enough), size, and their mean."""
    named = ~contains_any(F.lower("title"), ["untitled", "section", "equations", "general"])
    s = topics.agg(F.countDistinct(F.when(F.col("domain").isin(ESSENTIAL), F.col("domain"))).alias("have"), F.avg(named.cast("double")).alias("naming"), F.countDistinct("level").alias("levels"), F.count("*").alias("n"))
    out = s.select((F.col("have") / float(len(ESSENTIAL))).alias("coverage"), F.coalesce("naming", F.lit(0.0)).alias("naming"), F.least(F.lit(1.0), F.col("levels") / 2.0).alias("progression"), F.least(F.lit(1.0), F.col("n") / float(target)).alias("quantity"))
    return out.withColumn("overall", (F.col("coverage") + F.col("naming") + F.col("progression") + F.col("quantity")) / 4)


def ordering(topics: DataFrame, rules: DataFrame) -> DataFrame:
    """One row: topics, cases in which a domain that should come before occurs later, and 1 less their share (at least 0).

    topics: domain, pos; rules: domain, needs. Only the last position of each domain is needed, so no pairs are formed.
    """
    last = topics.groupBy(F.col("domain").alias("needs")).agg(F.max("pos").alias("last"))
    broken = topics.join(F.broadcast(rules), "domain").join(last, "needs").where("last > pos").agg(F.count("*").alias("violations"))
    n = topics.agg(F.count("*").alias("topics"))
    return n.crossJoin(broken).withColumn("ordering", F.greatest(F.lit(0.0), 1.0 - F.coalesce(F.try_divide("violations", "topics"), F.lit(0.0))))

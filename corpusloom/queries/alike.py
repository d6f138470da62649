"""Queries on likeness of names and titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.text import terms
from corpusloom.operators import likeness, topics
from corpusloom.queries import duck as D
from corpusloom.sources.tables import table


def _names(spark, d):
    return table(spark, d, "subtopics").where("name is not null").groupBy(F.lower(F.trim("name")).alias("name")).agg(F.min("subtopic_id").alias("id"))


def ngram_pairs(spark, d):
    """Pairs of distinct subtopic names whose TF-IDF of one to three words has a cosine of at least .7."""
    p = likeness.cosine_pairs(likeness.tfidf_ngrams(_names(spark, d), "id", "name"), 0.7)
    return p.select("a", "b", F.round("similarity", 6).alias("similarity"))


def name_groups(spark, d):
    """Subtopic names grouped greedily: every name joins the first leader that is like it."""
    n = _names(spark, d)
    return likeness.greedy_groups(n, likeness.cosine_pairs(likeness.tfidf_ngrams(n, "id", "name"), 0.7))


def group_consensus(spark, d):
    """Groups of at least two names with the mean similarity of their members to the leader."""
    n = _names(spark, d)
    pairs = likeness.cosine_pairs(likeness.tfidf_ngrams(n, "id", "name"), 0.7)
    g = likeness.greedy_groups(n, pairs).where("id <> leader")
    s = g.join(pairs.select(F.col("a").alias("leader"), F.col("b").alias("id"), "similarity"), ["leader", "id"])
    return s.groupBy("leader").agg((F.count("*") + 1).alias("members"), F.round((F.sum("similarity") + 1) / (F.count("*") + 1), 6).alias("consensus"))


def topics_in_contents(spark, d):
    """Subtopic names and titles of entries that share more than 80 % of their words."""
    left = _names(spark, d).select(F.col("id").alias("a"), terms(F.col("name")).alias("words"))
    e = topics.current_entries(table(spark, d, "toc_entries")).where("title <> ''").groupBy(F.lower("title").alias("title")).agg(F.min("row_id").alias("b"))
    return likeness.jaccard_join(left, e.select("b", terms(F.col("title")).alias("words")), 0.8).withColumn("similarity", F.round("similarity", 6))


QUERIES = {f.__name__: f for f in (ngram_pairs, name_groups, group_consensus, topics_in_contents)}

_PAIRS = f"""n AS (SELECT lower(trim(name)) AS name, min(subtopic_id) AS id FROM subtopics WHERE name IS NOT NULL GROUP BY 1), w AS (SELECT id, {D.terms('name')} AS w FROM n),
g AS (SELECT id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS term FROM w WHERE len(w) > 0),
tf AS (SELECT id, term, count(*) AS tf FROM g GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), c AS (SELECT count(DISTINCT id) AS n FROM g),
x AS (SELECT id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN df USING (term), c), l AS (SELECT id, sqrt(sum(w * w)) AS l FROM x GROUP BY 1), u AS (SELECT id, term, w / l AS w FROM x JOIN l USING (id)),
p AS (SELECT a.id AS a, b.id AS b, sum(a.w * b.w) AS s FROM u a JOIN u b ON a.term = b.term AND a.id < b.id GROUP BY ALL HAVING sum(a.w * b.w) >= 0.7 - 1e-9)"""

SQL = {
    "ngram_pairs": f"WITH {_PAIRS} SELECT a, b, round(s, 6) AS similarity FROM p",
    "topics_in_contents": f"""WITH {D.CURRENT}, n AS (SELECT lower(trim(name)) AS name, min(subtopic_id) AS a FROM subtopics WHERE name IS NOT NULL GROUP BY 1), e AS (SELECT lower(title) AS title, min(row_id) AS b FROM cur WHERE title <> '' GROUP BY 1),
l AS (SELECT a, list_distinct({D.terms('name')}) AS w FROM n), r AS (SELECT b, list_distinct({D.terms('title')}) AS w FROM e), m AS (SELECT a, b, count(*) AS k FROM (SELECT a, unnest(w) AS x FROM l) JOIN (SELECT b, unnest(w) AS x FROM r) USING (x) GROUP BY ALL)
SELECT a, b, round(k / (len(l.w) + len(r.w) - k), 6) AS similarity FROM m JOIN l USING (a) JOIN r USING (b) WHERE k / (len(l.w) + len(r.w) - k) > 0.8""",
}

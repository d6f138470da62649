"""Keyword classification: an ordered lexicon over lower-cased text, by substring.

A lexicon is {label: keywords} in order. Three rules cover all classifiers: the first label with a hit, the label with the
highest weighted count (the earlier label wins a tie), and all labels with a hit. Each becomes one column expression inside
whole-stage code generation; the lexicon is part of the plan, so nothing is joined, shuffled or broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L
from corpusloom.functions.text import contains_any, count_words

Lexicon = dict[str, list[str]]


def first_label(text: Column, lexicon: Lexicon, default: str | None = None) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for label, words in lexicon.items():
        out = out.when(contains_any(text, words), label)
    return out.otherwise(F.lit(default))


def scores(text: Column, lexicon: Lexicon, weight: int = 1) -> Column:
    """array<struct<n, rank, label>> of all labels; rank falls in lexicon order, so that the greatest struct wins."""
    return F.array(*[F.struct((count_words(text, words) * weight).alias("n"), F.lit(-i).alias("rank"), F.lit(label).alias("label")) for i, (label, words) in enumerate(lexicon.items())])


def most_label(text: Column, lexicon: Lexicon, default: str | None = None) -> Column:
    best = F.array_max(scores(text, lexicon))
    return F.when(best["n"] > 0, best["label"]).otherwise(F.lit(default))


def all_labels(text: Column, lexicon: Lexicon, default: str | None = None) -> Column:
    """Sorted array of the labels with a hit."""
    hits = F.array_sort(F.filter(F.array(*[F.when(contains_any(text, words), F.lit(label)) for label, words in lexicon.items()]), lambda x: x.isNotNull()))
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(default))) if default else hits


def bloom_level(text: Column) -> Column:
    """The cognitive level with most verbs; Apply for problems without any verb, else Understand."""
    return F.coalesce(most_label(text, L.BLOOM), F.when(contains_any(text, ["problem", "calculation", "solve"]), "Apply").otherwise("Understand"))


def difficulty_class(text: Column, prerequisites: Column, depth: Column) -> Column:
    hard = contains_any(text, L.HARD_WORDS) | (prerequisites > 5) | (depth > 4)
    easy = contains_any(text, L.EASY_WORDS) | (prerequisites == 0) | (depth <= 2)
    return F.when(hard, "Advanced").when(easy, "Introductory").otherwise("Intermediate")


def topic_type(name: Column, levels: Column, frequency: Column) -> Column:
    """elective, foundational, advanced or core, of a name, its distinct levels and the share of books that have it."""
    text = F.lower(name)
    only = (F.size(levels) == 1) & F.get(levels, F.lit(0)).isin("graduate", "professional")
    return (
        F.when(contains_any(text, ["astrophysics", "cosmology", "biophysics", "geophysics", "medical", "applications"]), "elective")
        .when((frequency > 0.7) & F.array_contains(levels, "high_school"), "foundational")
        .when(only, "advanced")
        .otherwise("core")
    )


def elective_by_keywords(title: Column, toc_text: Column) -> tuple[Column, Column, Column]:
    """(class, confidence, domain) of a book: hits in the title count three times those in the contents."""
    per = [F.struct((count_words(title, words) * 3 + count_words(toc_text, words)).alias("n"), F.lit(-i).alias("rank"), F.lit(L.ELECTIVE_DOMAIN[k]).alias("domain")) for i, (k, words) in enumerate(L.ELECTIVE.items())]
    best = F.array_max(F.array(*per))
    hit = best["n"] > 0
    return F.when(hit, "elective").otherwise("core"), F.when(hit, F.least(F.lit(0.9), best["n"] / 10.0)).otherwise(F.lit(0.8)), F.when(hit, best["domain"])


def elective_by_level(title: Column, level: Column) -> tuple[Column, Column]:
    n = count_words(title, L.GRADUATE_WORDS)
    hit = (level == "graduate") & (n > 0)
    return F.when(hit, "elective").otherwise("core"), F.when(hit, F.least(F.lit(0.7), n / 3.0)).otherwise(F.lit(0.6))


def majority(votes: list[tuple[Column, Column]], tie: str = "core") -> tuple[Column, Column]:
    """The label of most of the (label, confidence) votes, with the mean confidence of those who gave it."""
    elective = sum((v == "elective").cast("int") for v, _ in votes)
    label = F.when(elective * 2 > len(votes), "elective").otherwise(tie)
    agree = [(v == label).cast("int") for v, _ in votes]
    return label, sum(F.when(v == label, c).otherwise(F.lit(0.0)) for v, c in votes) / sum(agree)


def discipline_scores(titles: DataFrame, key: str, text: str) -> DataFrame:
    """key, discipline, score, confidence: weighted keyword hits over all titles of a key, from 2 on."""
    lower = F.lower(F.col(text))
    each = F.array(*[F.struct(F.lit(d).alias("discipline"), (count_words(lower, first) * 2 + count_words(lower, second)).alias("n")) for d, (first, second) in L.DISCIPLINES.items()])
    hits = titles.select(F.col(key), F.explode(F.filter(each, lambda x: x["n"] > 0)).alias("h"))
    sums = hits.groupBy(key, F.col("h.discipline").alias("discipline")).agg(F.sum("h.n").alias("score"))
    return sums.where("score >= 2").withColumn("confidence", F.least(F.col("score") / 10.0, F.lit(1.0)))

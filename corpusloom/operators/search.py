"""Inverted index, TF-IDF and ranked search over chapters.

postings are the one shuffle by (book, chapter, term) with partial aggregation; document frequencies follow from them by
a second, smaller one. A search filters the postings by term before anything is joined, and ranks with a top-k per term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions.text import formulas, snippet, terms


def postings(chapters: DataFrame, text: str = "content", book: str = "book_id", chapter: str = "chapter_id") -> DataFrame:
    """book, chapter, term, frequency. Null texts have no terms."""
    exploded = chapters.select(F.col(book).alias("book_id"), F.col(chapter).alias("chapter_id"), F.explode(terms(F.col(text))).alias("term"))
    return exploded.groupBy("book_id", "chapter_id", "term").agg(F.count("*").alias("frequency"))


def tf_idf(index: DataFrame) -> DataFrame:
    """index with tf_idf = frequency * ln(books / books with the term): 0 for a term of all books."""
    books = index.select("book_id").distinct().agg(F.count("*").alias("n_books"))
    have = index.select("book_id", "term").distinct().groupBy("term").agg(F.count("*").alias("n_have"))
    return index.join(have, "term").crossJoin(F.broadcast(books)).withColumn("tf_idf", F.col("frequency") * F.log(F.col("n_books") / F.col("n_have"))).drop("n_books", "n_have")


def top_terms(weighted: DataFrame, k: int = 3, by: tuple[str, ...] = ("book_id", "chapter_id")) -> DataFrame:
    """The k terms of greatest weight of every chapter; ties go by term."""
    ranked = weighted.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("tf_idf"), "term")))
    return ranked.where(F.col("rank") <= k)


def index_stats(index: DataFrame, chapters: DataFrame) -> DataFrame:
    """One row: books, chapters, postings, distinct terms and occurrences."""
    a = chapters.agg(F.countDistinct("book_id").alias("books"), F.count("*").alias("chapters"))
    return a.crossJoin(index.agg(F.count("*").alias("postings"), F.countDistinct("term").alias("distinct_terms"), F.sum("frequency").alias("occurrences")))


def suggest(index: DataFrame, prefix: str, k: int = 10) -> DataFrame:
    """Terms that start with the prefix (2 characters or more), most frequent first."""
    if len(prefix) < 2:
        return index.select("term", F.col("frequency").alias("frequency")).limit(0)
    return index.where(F.col("term").startswith(prefix.lower())).groupBy("term").agg(F.sum("frequency").alias("frequency")).orderBy(F.desc("frequency"), "term").limit(k)


def search_text(weighted: DataFrame, chapters: DataFrame, query: str, k: int) -> DataFrame:
    """Hits of the query's terms within index terms: the k best per query term."""
    words = [w for w in dict.fromkeys(query.strip().lower().split()) if len(w) > 2]
    hits = None
    for w in words:
        one = weighted.where(F.col("term").contains(w)).select("book_id", "chapter_id", F.col("tf_idf").alias("score"), F.lit(w).alias("word"), "term")
        hits = one if hits is None else hits.unionByName(one)
    if hits is None:
        hits = weighted.select("book_id", "chapter_id", F.col("tf_idf").alias("score"), F.lit("").alias("word"), "term").limit(0)
    best = hits.withColumn("rank", F.row_number().over(W.partitionBy("word").orderBy(F.desc("score"), "chapter_id", "term"))).where(F.col("rank") <= k)
    found = best.join(chapters.select("chapter_id", "title", "content"), "chapter_id")
    return found.select("book_id", "chapter_id", "title", snippet(F.col("content"), F.col("word")).alias("snippet"), "score", F.lit("text").alias("match_type"))


def search_titles(books: DataFrame, chapters: DataFrame, query: str) -> DataFrame:
    """Books (score 2) and chapters (score 1.5) whose title contains the query."""
    q = query.strip().lower()
    b = books.where(F.lower("book_title").contains(q)).select("book_id", F.lit(None).cast("long").alias("chapter_id"), F.col("book_title").alias("title"), F.col("book_title").alias("snippet"), F.lit(2.0).alias("score"), F.lit("title").alias("match_type"))
    c = chapters.where(F.lower("title").contains(q)).select("book_id", "chapter_id", "title", F.col("title").alias("snippet"), F.lit(1.5).alias("score"), F.lit("title").alias("match_type"))
    return b.unionByName(c)


def formula_table(chapters: DataFrame) -> DataFrame:
    """book_id, chapter_id, position, content of every formula in chapter texts."""
    return chapters.where(F.col("content").contains("$") | F.col("content").contains("\\begin") | F.col("content").contains("<math")).select("book_id", "chapter_id", F.posexplode(formulas(F.col("content"))).alias("position", "formula"))


def search_formulas(found: DataFrame, query: str) -> DataFrame:
    q = query.strip().lower()
    return found.where(F.lower("formula").contains(q)).select("book_id", "chapter_id", F.col("formula").alias("title"), F.col("formula").alias("snippet"), F.lit(1.0).alias("score"), F.lit("formula").alias("match_type"))


_ORDER = {"text": 0, "formula": 1, "title": 2}


def first_per_key(hits: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; unlike dropDuplicates, not left to chance."""
    return hits.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def search(books: DataFrame, chapters: DataFrame, query: str, k: int = 20) -> DataFrame:
    """Text, formula and title hits together, one per book and chapter (text before formula before title), best first.

    An empty query finds nothing.
    """
    parts = search_text(tf_idf(postings(chapters)), chapters, query, k).unionByName(search_formulas(formula_table(chapters), query)).unionByName(search_titles(books, chapters, query))
    if not query.strip():
        parts = parts.limit(0)
    kind = F.create_map(*[F.lit(x) for kv in _ORDER.items() for x in kv])[F.col("match_type")]
    one = first_per_key(parts, ["book_id", "chapter_id"], [kind, F.desc("score"), F.col("title"), F.col("snippet")])
    return one.orderBy(F.desc("score"), "book_id", "chapter_id").limit(k)

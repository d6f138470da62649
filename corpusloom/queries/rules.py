"""Queries on standards, electives, indicator words and statistics of units."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions import lexicons as L
from corpusloom.functions.text import GROUP_NAME, group_name, title_quality
from corpusloom.operators import standards, topics
from corpusloom.queries import duck as D
from corpusloom.queries.learning import _U
from corpusloom.queries.learning import _u
from corpusloom.sources.tables import table


def standards_map(spark, d):
    s = table(spark, d, "subtopics")
    return standards.mapped(s, "subtopic_id", F.lower(F.concat_ws(" ", "name", "description"))).select("subtopic_id", "standard", "code", F.round("confidence", 6).alias("confidence"))


def _merged(spark, d):
    s = table(spark, d, "subtopics").withColumn("base", group_name(F.col("name"))).where("base <> ''")
    n = table(spark, d, "book_tocs").agg(F.count("*").alias("n"))
    g = s.groupBy("base").agg(F.array_sort(F.collect_set("educational_level")).alias("levels"), F.array_distinct(F.flatten(F.collect_list(F.coalesce("source_books", F.array().cast("array<string>"))))).alias("books"))
    return g.crossJoin(F.broadcast(n)).withColumn("frequency", F.size("books") / F.col("n"))


def elective_score(spark, d):
    m = _merged(spark, d)
    score = standards.elective_score(F.col("base"), F.col("levels"), F.col("frequency"))
    return m.select("base", F.round(score, 6).alias("score"), standards.topic_class(score, F.col("frequency")).alias("topic_class"))


def language_detect(spark, d):
    """Language of documents by indicator words."""
    return standards.language_by_words(table(spark, d, "documents").where("text is not null"), "doc_id", "text")


def title_scores(spark, d):
    return topics.current_entries(table(spark, d, "toc_entries")).where("title is not null").select("row_id", F.round(title_quality(F.col("title")), 6).alias("quality"))


def unit_statistics(spark, d):
    """Units, hours and mean difficulty by domain and level, with totals, in one pass."""
    return _u(spark, d).rollup("domain", "level").agg(F.grouping_id().cast("int").alias("grouping"), F.count("*").alias("units"), F.sum("hours").alias("hours"), F.round(F.avg("difficulty"), 6).alias("difficulty"))


def prerequisite_statistics(spark, d):
    """How many units have how many prerequisites, by level."""
    return _u(spark, d).groupBy("level", F.size("prerequisites").alias("prerequisites")).agg(F.count("*").alias("units"))


def first_chapters(spark, d):
    """The first five chapters of every book, then those of more than 200 characters."""
    w = W.partitionBy("book_id").orderBy("chapter_id")
    c = table(spark, d, "chapters").withColumn("place", F.row_number().over(w)).where("place <= 5")
    return c.where(F.char_length("content") > 200).select("book_id", "chapter_id", "place")


def word_occurrences(spark, d):
    """Occurrences of one word in each chapter, with 20 characters before and after."""
    c = table(spark, d, "chapters").where("content is not null")
    parts = F.split(F.lower("content"), "matrix")
    at = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.aggregate(F.slice("p", 1, i), F.lit(0), lambda a, x: a + F.char_length(x)) + (i - 1) * 6)
    found = c.select("chapter_id", "content", parts.alias("p")).where(F.size("p") > 1).select("chapter_id", "content", F.posexplode(at).alias("number", "start"))
    begin = F.greatest(F.lit(0), F.col("start") - 20)
    return found.select("chapter_id", "number", "start", F.md5(F.substring(F.col("content"), begin + 1, F.col("start") + 26 - begin)).alias("context_md5"))


def grouped_revenue(spark, d):
    """Revenue and orders by region and nation with subtotals, from the joined order tables."""
    o, c, n, r, l = (table(spark, d, x) for x in ("orders", "customer", "nation", "region", "lineitem"))
    lines = l.groupBy("l_orderkey").agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"))
    j = lines.join(o, lines.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return j.rollup("r_name", "n_name").agg(F.count("*").alias("orders"), F.sum("cents").alias("cents"))


QUERIES = {f.__name__: f for f in (standards_map, elective_score, language_detect, title_scores, unit_statistics, prerequisite_statistics, first_chapters, word_occurrences, grouped_revenue)}


def _standards() -> str:
    t = "t"
    out = []
    for code, ws in L.MCAT.items():
        out.append((f"'MCAT'", code, D.count(t, ws), "least(0.9, n / 3.0::DOUBLE)"))
    for level, tb in (("HL", L.IB_HL), ("SL", L.IB_SL)):
        for num, desc in tb.items():
            low = desc.lower()
            stems = [s for s in standards.STEMS if s in low]
            n = f"CASE WHEN {D.any_of(t, stems)} THEN 2 WHEN {D.any_of(t, low.split())} THEN 1 ELSE 0 END" if stems else f"{D.any_of(t, low.split())}::INT"
            out.append((f"'IB_{level}'", f"{level}.{num}", n, "least(0.8, n / 2.0::DOUBLE)"))
    for code, desc in L.A_LEVEL.items():
        out.append(("'A_Level'", code, D.count(t, [w for w in desc.lower().split() if len(w) > 3]), "least(0.8, n / 3.0::DOUBLE)"))
    for num, desc in L.IGCSE.items():
        out.append(("'IGCSE'", f"IGCSE.{num}", f"{D.any_of(t, [w for w in desc.lower().split() if len(w) > 3])}::INT", "0.7"))
    return " UNION ALL ".join(f"SELECT subtopic_id, {s} AS standard, {D.quote(c)} AS code, round({conf}, 6)::DOUBLE AS confidence FROM (SELECT subtopic_id, {n} AS n FROM tx) WHERE n > 0" for s, c, n, conf in out)


_BASE = f"lower({D.chain('name', GROUP_NAME)})"

SQL = {
    "standards_map": f"WITH tx AS (SELECT subtopic_id, lower(concat_ws(' ', name, description)) AS t FROM subtopics) {_standards()}",
    "elective_score": f"""WITH g AS (SELECT {_BASE} AS base, list_sort(list_distinct(list(educational_level))) AS levels, len(list_distinct(flatten(list(coalesce(source_books, []))))) / (SELECT count(*) FROM book_tocs) AS f FROM subtopics GROUP BY 1),
      s AS (SELECT base, f, greatest(0.0, least(1.0, 0.4::DOUBLE * least({D.count('base', L.SPECIAL_AREAS)} / 3.0::DOUBLE, 1.0) + CASE WHEN {D.count('base', L.CORE_TOPICS)} = 0 THEN 0.3::DOUBLE ELSE -0.2::DOUBLE * least({D.count('base', L.CORE_TOPICS)} / 3.0::DOUBLE, 1.0) END
        + CASE WHEN f < 0.3 THEN 0.2::DOUBLE WHEN f > 0.8 THEN -0.1::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN list_contains(levels, 'graduate') THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN len(levels) = 1 AND list_contains(levels, 'undergraduate') THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END)) AS score FROM g WHERE base <> '')
      SELECT base, round(score, 6) AS score, CASE WHEN score > 0.7 THEN 'elective' WHEN score > 0.4 THEN 'specialized' WHEN f < 0.3 THEN 'advanced' ELSE 'core' END AS topic_class FROM s""",
    "language_detect": r"""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')) AS word FROM documents WHERE text IS NOT NULL), lx AS (SELECT * FROM (VALUES """
    + ", ".join(f"({D.quote(w)}, {-i}, {D.quote(k)})" for i, (k, ws) in enumerate(L.LANGUAGE_WORDS.items()) for w in ws)
    + """) x(word, rank, language)), s AS (SELECT doc_id, rank, language, sum(length(word)) AS n FROM w JOIN lx USING (word) GROUP BY ALL), b AS (SELECT doc_id, arg_max(language, (n, rank)) AS language FROM s GROUP BY doc_id)
      SELECT doc_id, coalesce(b.language, 'english') AS language FROM documents LEFT JOIN b USING (doc_id) WHERE text IS NOT NULL""",
    "title_scores": rf"""WITH {D.CURRENT} SELECT row_id, round(least(1.0, greatest(0.0, 0.5::DOUBLE + CASE WHEN length(title) BETWEEN 10 AND 100 THEN 0.2 WHEN length(title) < 5 THEN -0.2 ELSE 0.0 END - CASE WHEN regexp_matches(title, '[^\p{{L}}\p{{N}}\s\-:,.()''&]') THEN 0.1 ELSE 0.0 END
      - CASE WHEN {D.any_of('lower(title)', ['misc', 'other', 'various', 'stuff', 'things'])} THEN 0.2 ELSE 0.0 END)), 6) AS quality FROM cur WHERE title IS NOT NULL""",
    "unit_statistics": f"WITH {_U} SELECT domain, level, grouping_id(domain, level)::INT AS grouping, count(*) AS units, sum(hours)::BIGINT AS hours, round(avg(difficulty), 6) AS difficulty FROM u GROUP BY ROLLUP (domain, level)",
    "prerequisite_statistics": f"WITH {_U} SELECT level, len(prerequisites)::INT AS prerequisites, count(*) AS units FROM u GROUP BY ALL",
    "first_chapters": "SELECT book_id, chapter_id, place FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY chapter_id)::INT AS place FROM chapters) WHERE place <= 5 AND length(content) > 200",
    "word_occurrences": """WITH p AS (SELECT chapter_id, content, string_split(lower(content), 'matrix') AS p FROM chapters WHERE content IS NOT NULL), o AS (SELECT chapter_id, content, unnest(range(1, len(p))) AS i, p FROM p),
      s AS (SELECT chapter_id, content, (i - 1)::INT AS number, (list_sum(list_transform(p[:i], lambda x: length(x))) + (i - 1) * 6)::INT AS start FROM o)
      SELECT chapter_id, number, start, md5(substr(content, greatest(0, start - 20) + 1, start + 26 - greatest(0, start - 20))) AS context_md5 FROM s""",
    "grouped_revenue": "WITH l AS (SELECT l_orderkey, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents FROM lineitem GROUP BY 1) SELECT r_name, n_name, count(*) AS orders, sum(cents)::BIGINT AS cents FROM l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)",
}

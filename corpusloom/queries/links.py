"""Queries on links between entries, topics and books, and reports over them. Their SQL has constants of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L
from corpusloom.functions.text import count_words, level_name, toc_title
from corpusloom.functions.titles import granularity
from corpusloom.operators import graph, hierarchy, sequence, topics
from corpusloom.queries import duck as D
from corpusloom.queries.structure import _LATEST
from corpusloom.sources.documents import detect_format
from corpusloom.sources.tables import table


def _entries(spark, d):
    return topics.current_entries(table(spark, d, "toc_entries")).withColumn("parent_id", F.nullif(F.trim("parent_id"), F.lit("")))


def _resolved(spark, d):
    links = hierarchy.latest_links(table(spark, d, "toc_entries"))
    return hierarchy.resolve(links.withColumn("up", F.col("parent")), keep=("level", "up")).withColumnRenamed("up", "parent")


def hierarchy_edges(spark, d):
    """Parent and sibling edges of all tables of contents."""
    e = graph.hierarchy_edges(_entries(spark, d))
    return e.select("book_id", "source", "target", "kind", F.col("confidence").cast("double").alias("confidence"))


def toc_graph(spark, d):
    """Nodes, edges, weak components, cycles and generations of the links of every book."""
    return graph.forest_properties(_resolved(spark, d)).withColumnRenamed("grp", "book_id")


def broken_cycles(spark, d):
    """The link of every cycle whose removal leaves the links acyclic."""
    return graph.cycle_breaks(_resolved(spark, d)).select(F.col("grp").alias("book_id"), F.col("key").alias("entry_id"), F.col("parent").alias("parent_id"))


def topological_order(spark, d):
    """A topological order of all entries that reach a root: by generation, then book and entry."""
    r = _resolved(spark, d).where("status = 'root'").select(F.col("grp").alias("book_id"), F.col("key").alias("entry_id"), "depth")
    return sequence.global_rank(r, [], [F.col("depth"), F.col("book_id"), F.col("entry_id")]).select("book_id", "entry_id", F.col("pos").cast("long").alias("pos"))


def importance_order(spark, d):
    """Subtopics without repeated names in the order computed from core flag, domain, level and name."""
    return sequence.by_importance(table(spark, d, "subtopics")).select("subtopic_id", F.col("position").cast("long").alias("position"))


def domain_chain(spark, d):
    """Links from the first topic of each domain to that of the next."""
    t = table(spark, d, "subtopics").select(F.col("subtopic_id").alias("id"), "domain", F.coalesce("pedagogical_order", F.lit(0)).alias("pos"))
    return graph.domain_chain(t, sorted(["biology", "chemistry", "physics", "mathematics", "optics", "mechanics", "thermodynamics", "waves", "energy", "electricity", "magnetism", "kinematics", "dynamics"]))


def domain_steps(spark, d):
    """Every subtopic's step in its domain, by level and stored order."""
    t = table(spark, d, "subtopics").where("domain is not null")
    order = [F.col("domain"), sequence.level_rank(F.col("educational_level")), F.col("pedagogical_order").asc_nulls_first(), F.col("subtopic_id")]
    ranked = sequence.global_rank(t.select("subtopic_id", "domain", "educational_level", "pedagogical_order"), [], order)
    first = ranked.groupBy("domain").agg(F.min("pos").alias("first"))
    return ranked.join(first, "domain").select("subtopic_id", "domain", (F.col("pos") - F.col("first") + 1).cast("long").alias("step"))


def merged_paths(spark, d):
    """Chapter and section paths of subtopics after synonyms are merged."""
    s = table(spark, d, "subtopics").select(F.filter(F.array("educational_level", "domain", "chapter_title"), lambda x: x.isNotNull()).alias("path"))
    return graph.with_synonyms(s, "path", {"undergraduate": "university", "graduate": "university"}).select(F.array_join("path", " / ").alias("path"))


def tracked_files(spark, d):
    """PDF runs already known by book, by path or by an earlier run of the same file."""
    p = table(spark, d, "pdf_results")
    b = table(spark, d, "book_tocs")
    earlier = p.groupBy("file_hash").agg(F.min("pdf_id").alias("first"))
    by = [p.join(b, "book_id", "left_semi").select("pdf_id"), p.join(b, "file_path", "left_semi").select("pdf_id"), p.join(earlier, "file_hash").where("pdf_id > first").select("pdf_id")]
    return by[0].unionByName(by[1]).unionByName(by[2]).distinct()


def combined_topics(spark, d):
    """Subtopics and entries side by side in common columns."""
    s = table(spark, d, "subtopics").select(F.concat(F.lit("s"), F.col("subtopic_id")).alias("topic_id"), F.col("name").alias("title"), "educational_level", "difficulty")
    e = _entries(spark, d).select(F.concat(F.lit("e"), F.col("row_id")).alias("topic_id"), "title", F.col("level").alias("depth"))
    return s.unionByName(e, allowMissingColumns=True)


def edges_with_ends(spark, d):
    """Parent links whose both ends are entries of the book."""
    e = _entries(spark, d)
    return e.where("parent_id is not null").select("book_id", "entry_id", "parent_id").join(e.select("book_id", F.col("entry_id").alias("parent_id")), ["book_id", "parent_id"], "left_semi").select("book_id", "entry_id", "parent_id")


def discovery_metrics(spark, d):
    """Books by level, and the share of the three levels that occur."""
    b = table(spark, d, "book_tocs").select(level_name(F.col("level")).alias("level"), "extraction_method")
    n = b.agg((F.countDistinct(F.when(F.col("level").isin("high_school", "undergraduate", "graduate"), F.col("level"))) / 3.0).alias("coverage"))
    return b.groupBy("level", "extraction_method").agg(F.count("*").alias("books")).crossJoin(F.broadcast(n)).withColumn("coverage", F.round("coverage", 6))


def toc_disciplines(spark, d):
    """Disciplines of at least five entries: entries, books and confidence, combined with those that titles of books give."""
    hits = lambda c: F.filter(F.array(*[F.when(count_words(F.lower(c), first + second) > 0, F.lit(n)) for n, (first, second) in L.DISCIPLINES.items()]), lambda x: x.isNotNull())
    e = _entries(spark, d).where("title is not null").select("book_id", F.explode(hits(F.col("title"))).alias("discipline"))
    toc = e.groupBy("discipline").agg(F.count("*").alias("entries"), F.countDistinct("book_id").alias("books")).where("entries >= 5").withColumn("from_toc", F.least(F.col("entries") / 50.0, F.lit(1.0)))
    b = table(spark, d, "book_tocs").where("book_title is not null").select(F.explode(hits(F.col("book_title"))).alias("discipline"))
    titles = b.groupBy("discipline").agg(F.least(F.count("*") / 10.0, F.lit(1.0)).alias("from_titles"))
    both = toc.join(titles, "discipline", "full").withColumn("confidence", F.coalesce((F.col("from_toc") + F.col("from_titles")) / 2, "from_toc", "from_titles"))
    return both.where("confidence >= 0.3").select("discipline", "entries", "books", F.round("confidence", 6).alias("confidence"))


def book_topic_shares(spark, d):
    """The share of every discipline in the entries of a book."""
    e = _entries(spark, d).where("title is not null")
    hits = F.filter(F.array(*[F.when(count_words(F.lower("title"), first + second) > 0, F.lit(n)) for n, (first, second) in L.DISCIPLINES.items()]), lambda x: x.isNotNull())
    n = e.groupBy("book_id").agg(F.count("*").alias("n"))
    return e.select("book_id", F.explode(hits).alias("discipline")).groupBy("book_id", "discipline").agg(F.count("*").alias("entries")).join(n, "book_id").select("book_id", "discipline", "entries", F.round(F.col("entries") / F.col("n"), 6).alias("share"))


def source_statistics(spark, d):
    """Books, entries and languages by discipline and level, with totals, in one pass of grouping sets."""
    b = table(spark, d, "book_tocs").select("discipline", "level", "language", "total_entries")
    return b.cube("discipline", "level").agg(F.grouping_id().cast("int").alias("grouping"), F.count("*").alias("books"), F.sum("total_entries").alias("entries"), F.countDistinct("language").alias("languages"))


def language_collection(spark, d):
    """Books and their earliest and latest extraction by label of language and folder."""
    return table(spark, d, "book_tocs").groupBy(F.lower(F.trim("language")).alias("label")).agg(F.count("*").alias("books"), F.min("book_id").alias("first_book"), F.max("extracted_at").alias("last"))


def chunks_per_level(spark, d):
    return table(spark, d, "documents").groupBy(level_name(F.col("level")).alias("level"), "chunk_type").agg(F.count("*").alias("chunks"))


def size_by_format(spark, d):
    """Files, bytes and pages of PDF runs and their format."""
    p = table(spark, d, "pdf_results").select(detect_format(F.col("file_path")).alias("format"), F.explode_outer("chunks_metadata").alias("c"), "pdf_id")
    return p.groupBy("format").agg(F.countDistinct("pdf_id").alias("files"), F.sum(F.col("c.chunk_size_bytes").cast("long")).alias("bytes"))


def extraction_report(spark, d):
    """Runs by outcome and message with their share of all runs."""
    p = table(spark, d, "pdf_results")
    n = p.agg(F.count("*").alias("runs"))
    outcome = F.when(F.col("success"), "ok").otherwise(F.coalesce("error_message", F.lit("unknown")))
    return p.groupBy(outcome.alias("outcome"), F.col("full_text").isNull().alias("without_text")).agg(F.count("*").alias("of")).crossJoin(F.broadcast(n)).select("outcome", "without_text", "of", F.round(F.col("of") / F.col("runs"), 6).alias("share"))


def integrated_metrics(spark, d):
    """Names on several levels, entries, depth and roots, and the mean of entries per book with any."""
    r = _resolved(spark, d)
    per = r.groupBy("grp").agg(F.count("*").alias("n"), F.count(F.when(F.col("status") == "root", F.when(F.col("depth") == 1, 1))).alias("roots"), F.max("depth").alias("deepest"), F.sum("depth").alias("depths"), F.count("depth").alias("with_depth"))
    names = table(spark, d, "subtopics").groupBy(F.lower(F.trim("name")).alias("k")).agg(F.countDistinct("educational_level").alias("levels")).agg(F.count(F.when((F.col("levels") > 1) & F.col("k").isNotNull(), 1)).alias("cross_level"))
    return per.agg(F.count("*").alias("books"), F.sum("n").alias("entries"), F.sum("roots").alias("roots"), F.max("deepest").alias("deepest"), F.round(F.sum("depths") / F.sum("with_depth"), 6).alias("mean_depth"), F.round(F.avg("n"), 6).alias("mean_entries")).crossJoin(names)


def best_of_group(spark, d):
    """The best subtopic of those with the same normalised title, by richness, level and granularity."""
    t = table(spark, d, "subtopics").where("name is not null")
    n = lambda c: F.greatest(F.size(c), F.lit(0))
    bonus = F.when(F.col("educational_level") == "high_school", 5).when(F.col("educational_level") == "undergraduate", 10).when(F.col("educational_level") == "graduate", 15).otherwise(0)
    score = n("prerequisites") * 20 + F.char_length("name") + n("learning_objectives") * 30 + F.coalesce("duration_hours", F.lit(0)) * 5 + F.when(granularity(F.col("name")) == "granular", 50).otherwise(0) + bonus * 10
    return t.groupBy(toc_title(F.col("name")).alias("topic")).agg(F.max_by(F.struct("subtopic_id", score.alias("score")), F.struct(score, -F.col("subtopic_id"))).alias("b"), F.count("*").alias("members")).select("topic", "b.subtopic_id", "b.score", "members")


def merged_clusters(spark, d):
    """Entries of one normalised title over all books: spellings, levels, mean depth, difficulty, frequency and quality."""
    b = table(spark, d, "book_tocs").select("book_id", level_name(F.col("level")).alias("book_level"))
    e = _entries(spark, d).select("book_id", "title", toc_title(F.col("title")).alias("topic"), F.coalesce("level", F.lit(1)).alias("depth")).where("topic <> ''").join(b, "book_id")
    per = e.groupBy("topic", "book_level").agg(F.floor(F.avg("depth")).cast("int").alias("depth"))
    base = F.when(F.col("book_level") == "high_school", 1).when(F.col("book_level") == "graduate", 4).otherwise(2)
    all_ = e.groupBy("topic").agg(F.count("*").alias("n"), F.countDistinct("book_id").alias("books"), F.countDistinct("title").alias("spellings"))
    consensus = F.when(F.col("n") > 1, 1.0 / F.col("spellings")).otherwise(0.5)
    frequency = F.when(F.col("n") > 1, F.col("n") / F.col("books")).otherwise(0.3)
    out = per.join(all_, "topic").withColumn("frequency", frequency).withColumn("quality", F.when(F.col("n") > 1, (F.col("frequency") + consensus) / 2).otherwise(0.4))
    return out.select("topic", "book_level", "depth", F.least(F.lit(5), base + F.col("depth") - 1).alias("difficulty"), "n", "books", "spellings", F.round("frequency", 6).alias("frequency"), F.round("quality", 6).alias("quality"))


def normalisation_metrics(spark, d):
    """Raw and normalised topics, reduction, topics on several levels and the distribution of quality."""
    c = merged_clusters(spark, d)
    per = c.groupBy("topic").agg(F.count("*").alias("levels"), F.max("n").alias("n"), F.max("quality").alias("quality"))
    return per.agg(
        F.sum("n").alias("raw"), F.count("*").alias("normalised"), F.round(1 - F.count("*") / F.sum("n"), 6).alias("reduction"), F.count(F.when(F.col("levels") > 1, 1)).alias("cross_level"),
        F.count(F.when(F.col("quality") >= 0.8, 1)).alias("high"), F.count(F.when((F.col("quality") >= 0.6) & (F.col("quality") < 0.8), 1)).alias("medium"), F.count(F.when(F.col("quality") < 0.6, 1)).alias("low"),
    )


def valid_topics(spark, d):
    """Normalised topics of some quality and frequency and more than two characters."""
    return merged_clusters(spark, d).where((F.col("quality") >= 0.5) & (F.col("frequency") >= 0.2) & (F.char_length("topic") > 2)).select("topic").distinct()


def unclustered_topics(spark, d):
    """Entries whose normalised title occurs nowhere else."""
    e = _entries(spark, d).select("row_id", toc_title(F.col("title")).alias("topic")).where("topic <> ''")
    return e.join(e.groupBy("topic").count().where("count > 1"), "topic", "left_anti").select("row_id", "topic")


_FUNCTIONS = (
    hierarchy_edges, toc_graph, broken_cycles, topological_order, importance_order, domain_chain, domain_steps, merged_paths, tracked_files, combined_topics, edges_with_ends, discovery_metrics, toc_disciplines, book_topic_shares,
    source_statistics, language_collection, chunks_per_level, size_by_format, extraction_report, integrated_metrics, best_of_group, merged_clusters, normalisation_metrics, valid_topics, unclustered_topics,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_E = "WITH " + D.CURRENT + ", ent AS (SELECT * REPLACE (nullif(trim(parent_id), '') AS parent_id) FROM cur)"
_TOC = D.chain("lower(trim(title))", [])
_CYC = ", cyc AS (SELECT a.book_id, a.entry_id, min(a.anc) AS cycle FROM above a SEMI JOIN loops l ON l.book_id = a.book_id AND l.entry_id = a.entry_id GROUP BY ALL)"
_LEVEL = D.level("level")
_RANK = "CASE educational_level WHEN 'high_school' THEN 0 WHEN 'undergraduate' THEN 1 WHEN 'graduate' THEN 2 ELSE 3 END"


def _disc(c: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {D.any_of(f'lower({c})', a + b)} THEN {D.quote(n)} END" for n, (a, b) in L.DISCIPLINES.items()) + "], lambda x: x IS NOT NULL)"


def _norm(c: str) -> str:
    from corpusloom.functions.text import TOC_TITLE

    return D.chain(f"trim(lower({c}))", TOC_TITLE)


_CLUSTERS = f"""{_E}, m AS (SELECT e.book_id, e.title, {_norm('e.title')} AS topic, coalesce(e.level, 1) AS depth, {D.level('b.level')} AS book_level FROM ent e JOIN book_tocs b USING (book_id)),
k AS (SELECT * FROM m WHERE topic <> ''), per AS (SELECT topic, book_level, floor(avg(depth))::INT AS depth FROM k GROUP BY ALL),
al AS (SELECT topic, count(*) AS n, count(DISTINCT book_id) AS books, count(DISTINCT title) AS spellings FROM k GROUP BY topic),
c AS (SELECT topic, book_level, depth, least(5, CASE book_level WHEN 'high_school' THEN 1 WHEN 'graduate' THEN 4 ELSE 2 END + depth - 1)::INT AS difficulty, n, books, spellings, round(CASE WHEN n > 1 THEN n / books ELSE 0.3::DOUBLE END, 6) AS frequency,
  round(CASE WHEN n > 1 THEN (n / books + 1.0::DOUBLE / spellings) / 2 ELSE 0.4::DOUBLE END, 6) AS quality FROM per JOIN al USING (topic))"""

SQL = {
    "hierarchy_edges": f"""{_E}, b AS (SELECT c.*, first_value(c.entry_id) OVER (PARTITION BY c.book_id, c.parent_id ORDER BY c.row_id) AS source FROM ent c SEMI JOIN ent p ON p.book_id = c.book_id AND p.entry_id = c.parent_id)
SELECT book_id, parent_id AS source, entry_id AS target, 'parent' AS kind, 0.9::DOUBLE AS confidence FROM b UNION ALL SELECT book_id, source, entry_id, 'sibling', 0.7::DOUBLE FROM b WHERE source <> entry_id""",
    "toc_graph": "WITH RECURSIVE" + _LATEST + _CYC + """
SELECT book_id, count(*) AS nodes, count(*) - count(top) AS edges, count(top) + (SELECT count(DISTINCT cycle) FROM cyc WHERE cyc.book_id = x.book_id) AS components, (SELECT count(*) FROM loops WHERE loops.book_id = x.book_id) AS on_cycles,
  (SELECT count(*) FROM loops WHERE loops.book_id = x.book_id) = 0 AS acyclic, (SELECT max(depth) FROM reach WHERE reach.book_id = x.book_id) AS generations
FROM (SELECT c.book_id, c.entry_id, t.top FROM cur c LEFT JOIN tops t ON t.book_id = c.book_id AND t.entry_id = c.entry_id) x GROUP BY book_id""",
    "broken_cycles": "WITH RECURSIVE" + _LATEST + _CYC + " SELECT c.book_id, c.entry_id, c.parent_id FROM cyc y JOIN cur c ON c.book_id = y.book_id AND c.entry_id = y.entry_id WHERE y.entry_id = y.cycle",
    "topological_order": "WITH RECURSIVE" + _LATEST + "SELECT book_id, entry_id, row_number() OVER (ORDER BY depth, book_id, entry_id) - 1 AS pos FROM reach WHERE top = 'root'",
    "importance_order": """SELECT subtopic_id, row_number() OVER (ORDER BY c, r, l, name, subtopic_id) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY c, r, l, subtopic_id) AS k FROM (
    SELECT subtopic_id, name, CASE WHEN coalesce(is_core, true) THEN 0 ELSE 1 END AS c, coalesce(educational_level, 'undergraduate') AS l, CASE coalesce(domain, 'general') WHEN 'units_measurement' THEN 1 WHEN 'vectors' THEN 2 WHEN 'kinematics' THEN 3 WHEN 'dynamics' THEN 4
      WHEN 'energy' THEN 5 WHEN 'momentum' THEN 6 WHEN 'rotation' THEN 7 WHEN 'gravitation' THEN 8 WHEN 'oscillations' THEN 9 WHEN 'waves' THEN 10 WHEN 'thermodynamics' THEN 11 WHEN 'electricity' THEN 12 WHEN 'magnetism' THEN 13 WHEN 'circuits' THEN 14
      WHEN 'optics' THEN 15 WHEN 'modern_physics' THEN 16 WHEN 'astrophysics' THEN 17 ELSE 99 END AS r FROM subtopics WHERE name <> '')) WHERE k = 1""",
    "domain_chain": """SELECT src, dst, domain FROM (SELECT domain, id AS src, lead(id) OVER (ORDER BY domain) AS dst FROM (SELECT domain, arg_min(subtopic_id, (coalesce(pedagogical_order, 0), subtopic_id)) AS id FROM subtopics
  WHERE domain IN ('biology', 'chemistry', 'physics', 'mathematics', 'optics', 'mechanics', 'thermodynamics', 'waves', 'energy', 'electricity', 'magnetism', 'kinematics', 'dynamics') GROUP BY domain)) WHERE dst IS NOT NULL""",
    "domain_steps": f"SELECT subtopic_id, domain, row_number() OVER (PARTITION BY domain ORDER BY {_RANK}, pedagogical_order NULLS FIRST, subtopic_id) AS step FROM subtopics WHERE domain IS NOT NULL",
    "merged_paths": "SELECT DISTINCT concat_ws(' / ', CASE WHEN educational_level IN ('undergraduate', 'graduate') THEN 'university' ELSE educational_level END, CASE WHEN domain IN ('undergraduate', 'graduate') THEN 'university' ELSE domain END, CASE WHEN chapter_title IN ('undergraduate', 'graduate') THEN 'university' ELSE chapter_title END) AS path FROM subtopics",
    "tracked_files": "SELECT pdf_id FROM pdf_results p WHERE book_id IN (SELECT book_id FROM book_tocs) OR file_path IN (SELECT file_path FROM book_tocs) OR EXISTS (SELECT 1 FROM pdf_results q WHERE q.file_hash = p.file_hash AND q.pdf_id < p.pdf_id)",
    "combined_topics": f"{_E} SELECT 's' || subtopic_id AS topic_id, name AS title, educational_level, difficulty, NULL::INT AS depth FROM subtopics UNION ALL SELECT 'e' || row_id, title, NULL, NULL, level FROM ent",
    "edges_with_ends": f"{_E} SELECT c.book_id, c.entry_id, c.parent_id FROM ent c WHERE EXISTS (SELECT 1 FROM ent p WHERE p.book_id = c.book_id AND p.entry_id = c.parent_id)",
    "discovery_metrics": f"""WITH b AS (SELECT {_LEVEL} AS level, extraction_method FROM book_tocs)
SELECT level, extraction_method, count(*) AS books, round((SELECT count(DISTINCT level) FROM b WHERE level IN ('high_school', 'undergraduate', 'graduate')) / 3.0::DOUBLE, 6) AS coverage FROM b GROUP BY ALL""",
    "toc_disciplines": f"""{_E}, h AS (SELECT book_id, unnest({_disc('title')}) AS discipline FROM ent WHERE title IS NOT NULL), t AS (SELECT discipline, count(*) AS entries, count(DISTINCT book_id) AS books, least(count(*) / 50.0::DOUBLE, 1) AS c FROM h GROUP BY 1 HAVING count(*) >= 5),
b AS (SELECT discipline, least(count(*) / 10.0::DOUBLE, 1) AS c FROM (SELECT unnest({_disc('book_title')}) AS discipline FROM book_tocs WHERE book_title IS NOT NULL) GROUP BY 1)
SELECT discipline, entries, books, round(x, 6) AS confidence FROM (SELECT discipline, entries, books, CASE WHEN t.c IS NULL THEN b.c WHEN b.c IS NULL THEN t.c ELSE (t.c + b.c) / 2 END AS x FROM t FULL JOIN b USING (discipline)) WHERE x >= 0.3""",
    "book_topic_shares": f"""{_E}, t AS (SELECT * FROM ent WHERE title IS NOT NULL), n AS (SELECT book_id, count(*) AS n FROM t GROUP BY 1), h AS (SELECT book_id, unnest({_disc('title')}) AS discipline FROM t)
SELECT book_id, discipline, count(*) AS entries, round(count(*) / any_value(n), 6) AS share FROM h JOIN n USING (book_id) GROUP BY book_id, discipline""",
    "source_statistics": "SELECT discipline, level, grouping(discipline, level)::INT AS grouping, count(*) AS books, sum(total_entries)::BIGINT AS entries, count(DISTINCT language) AS languages FROM book_tocs GROUP BY CUBE (discipline, level)",
    "language_collection": "SELECT lower(trim(language)) AS label, count(*) AS books, min(book_id) AS first_book, max(extracted_at) AS last FROM book_tocs GROUP BY 1",
    "chunks_per_level": f"SELECT {_LEVEL} AS level, chunk_type, count(*) AS chunks FROM documents GROUP BY ALL",
    "size_by_format": "SELECT CASE WHEN lower(file_path) LIKE '%.pdf' THEN 'pdf' WHEN lower(file_path) LIKE '%.epub' THEN 'epub' ELSE 'unknown' END AS format, count(*) AS files, sum(list_sum(list_transform(chunks_metadata, lambda x: x.chunk_size_bytes)))::BIGINT AS bytes FROM pdf_results GROUP BY 1",
    "extraction_report": "SELECT CASE WHEN success THEN 'ok' ELSE coalesce(error_message, 'unknown') END AS outcome, full_text IS NULL AS without_text, count(*) AS of, round(count(*) / (SELECT count(*) FROM pdf_results), 6) AS share FROM pdf_results GROUP BY ALL",
    "integrated_metrics": "WITH RECURSIVE" + _LATEST + """, n AS (SELECT book_id, count(*) AS n FROM cur GROUP BY 1)
SELECT (SELECT count(*) FROM n) AS books, (SELECT sum(n) FROM n)::BIGINT AS entries, count(*) FILTER (WHERE top = 'root' AND depth = 1) AS roots, max(depth) AS deepest, round(avg(depth), 6) AS mean_depth, round((SELECT avg(n) FROM n), 6) AS mean_entries,
  (SELECT count(*) FROM (SELECT lower(trim(name)) AS k FROM subtopics WHERE name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT educational_level) > 1)) AS cross_level FROM reach""",
    "merged_clusters": _CLUSTERS + " SELECT * FROM c",
    "normalisation_metrics": _CLUSTERS + """, p AS (SELECT topic, count(*) AS levels, max(n) AS n, max(quality) AS quality FROM c GROUP BY topic)
SELECT sum(n)::BIGINT AS raw, count(*) AS normalised, round(1 - count(*) / sum(n), 6) AS reduction, count(*) FILTER (WHERE levels > 1) AS cross_level, count(*) FILTER (WHERE quality >= 0.8) AS high, count(*) FILTER (WHERE quality >= 0.6 AND quality < 0.8) AS medium, count(*) FILTER (WHERE quality < 0.6) AS low FROM p""",
    "valid_topics": _CLUSTERS + " SELECT DISTINCT topic FROM c WHERE quality >= 0.5 AND frequency >= 0.2 AND length(topic) > 2",
    "unclustered_topics": f"{_E}, n AS (SELECT row_id, {_norm('title')} AS topic FROM ent) SELECT row_id, topic FROM n WHERE topic <> '' AND topic IN (SELECT topic FROM n GROUP BY topic HAVING count(*) = 1)",
    "best_of_group": f"""SELECT topic, arg_max(subtopic_id, (score, -subtopic_id)) AS subtopic_id, max(score)::INT AS score, count(*) AS members FROM (SELECT subtopic_id, {_norm('name')} AS topic,
  coalesce(len(prerequisites), 0) * 20 + length(name) + coalesce(len(learning_objectives), 0) * 30 + coalesce(duration_hours, 0) * 5 + CASE educational_level WHEN 'high_school' THEN 50 WHEN 'undergraduate' THEN 100 WHEN 'graduate' THEN 150 ELSE 0 END
  + CASE WHEN regexp_matches(lower(name), 'law|equation|formula|principle|theorem|effect|oscillation|wave|particle|field|force|energy|momentum|calculation|solve|derive|compute|measure|circuit|lens|magnet|resistor|capacitor|inductor|problem|example|exercise|application') THEN 50
         WHEN regexp_matches(lower(name), '^introduction\\s+to|^basics\\s+of|^overview\\s+of|^fundamentals\\s+of|general\\s+|broad\\s+') THEN 0 WHEN length(name) > 40 OR len(list_filter(regexp_split_to_array(name, '\\s+'), lambda w: w <> '')) > 5 THEN 50 ELSE 0 END AS score
  FROM subtopics WHERE name IS NOT NULL) GROUP BY topic""",
}

"""Queries on headings, chunks, vectors and references."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import similarity, toc, topics, vector_index
from corpusloom.queries import duck as D
from corpusloom.queries.learning import _u
from corpusloom.sources.tables import table


def _chapters(spark, d):
    return table(spark, d, "chapters").where("content is not null")


def markdown_headings(spark, d):
    """Headings of the TOC written as Markdown, read back."""
    e = topics.current_entries(table(spark, d, "toc_entries")).where("title <> '' and level between 1 and 6")
    text = e.select("row_id", F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), F.regexp_replace("title", r"\s+", " ")).alias("text"))
    return toc.markdown_headings(text, "row_id", "text").select("row_id", "level", "title")


def latex_headings(spark, d):
    """Subtopic names as LaTeX sections, read back in order."""
    s = table(spark, d, "subtopics").select("subtopic_id", F.concat(F.lit("\\section{"), F.col("name"), F.lit("}\ntext\n\\subsection*{"), F.coalesce("section_title", F.lit("none")), F.lit("}")).alias("text"))
    return toc.latex_headings(s, "subtopic_id", "text").select("subtopic_id", F.col("pos").alias("position"), "level", "title")


def chunk_fold(spark, d):
    """Chunks of all chapters by packing paragraphs."""
    return toc.chunks(_chapters(spark, d), "chapter_id", "content").select("chapter_id", "section_index", "total_sections", "chunk_type", F.md5("chunk").alias("chunk_md5"))


def vector_topk(spark, d):
    """The three nearest vectors of every twentieth vector."""
    e = table(spark, d, "embeddings")
    return similarity.vector_topk(e.where("vec_id % 20 = 0"), e).select("query_id", "vec_id", "rank", F.round("similarity", 6).alias("similarity"))


def vector_topk_indexed(spark, d):
    """The three nearest vectors of every twentieth vector, through cells of an index; as many cells as a recall of .95 takes."""
    e = table(spark, d, "embeddings")
    centres, probes = vector_index.fit(e, "vec_id", "embedding")
    found = vector_index.topk(e.where("vec_id % 20 = 0"), e, centres, probes=probes)
    return found.select("query_id", "vec_id", "rank", F.round("similarity", 6).alias("similarity"))


def label_centroids(spark, d):
    """Mean norm and coherence of the vectors of each label: length of the mean vector."""
    e = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    m = e.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return m.groupBy("label").agg(F.round(F.sqrt(F.sum(F.col("m") * F.col("m"))), 6).alias("coherence"))


def cross_references(spark, d):
    t = _u(spark, d).select(F.col("unit_id").alias("id"), F.col("title").alias("name"), "domain", "pos")
    r = similarity.cross_references(t)
    return r.select("id", F.array_join(F.col("related").cast("array<string>"), ",").alias("related"))


def context_topk(spark, d):
    """Documents that share most terms with every twentieth subtopic."""
    q = table(spark, d, "subtopics").where("subtopic_id % 20 = 0").select(F.col("subtopic_id").alias("query_id"), F.concat_ws(" ", "name", "description").alias("text"))
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    c = similarity.context_topk(q, docs)
    return c.select("query_id", F.array_join(F.col("doc_ids").cast("array<string>"), ",").alias("doc_ids"), F.md5("context").alias("context_md5"))


def similar_titles(spark, d):
    """Pairs of book titles whose similarity by matching blocks reaches 0.8."""
    return similarity.similar_titles(table(spark, d, "book_tocs").select(F.col("book_id").alias("id"), F.col("book_title").alias("title")))


def _folders_above(files, key):
    """key, folder: every folder above a file_path."""
    parts = F.split("file_path", "/")
    above = F.transform(F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: k > 0), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    own = F.array(F.regexp_replace("file_path", "/[^/]+$", ""))
    return files.where("file_path is not null").select(key, F.explode(F.array_distinct(F.concat(own, above))).alias("folder"))


def nested_paths(spark, d):
    """Pairs of files of which one lies below the other's folder."""
    folders = _folders_above(table(spark, d, "pdf_results").select(F.col("pdf_id").alias("inner_id"), "file_path"), "inner_id")
    outer = table(spark, d, "book_tocs").select("book_id", F.regexp_replace("file_path", "/[^/]+$", "").alias("folder")).where("folder is not null")
    return folders.join(outer, "folder").select("inner_id", "book_id", "folder")


def folder_sizes(spark, d):
    """Files of books and PDF runs below every folder, however deep."""
    files = table(spark, d, "book_tocs").select(F.lit("book").alias("kind"), "file_path").unionByName(table(spark, d, "pdf_results").select(F.lit("pdf").alias("kind"), "file_path"))
    return _folders_above(files, "kind").groupBy("folder", "kind").agg(F.count("*").alias("files"))


def events_by_day(spark, d):
    """Events, users and summed value by day and type."""
    e = table(spark, d, "events")
    return e.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("value_cents"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"))


QUERIES = {f.__name__: f for f in (markdown_headings, latex_headings, chunk_fold, vector_topk, vector_topk_indexed, label_centroids, cross_references, context_topk, similar_titles, nested_paths, folder_sizes, events_by_day)}

_LINES = r"ln AS (SELECT chapter_id, (unnest(range(len(l))))::INT AS pos, regexp_replace(unnest(l), '^\s+|\s+$', '', 'g') AS line FROM (SELECT chapter_id, regexp_split_to_array(content, '\r?\n') AS l FROM chapters WHERE content IS NOT NULL))"
SQL = {
    "markdown_headings": rf"WITH {D.CURRENT} SELECT row_id, level, trim(regexp_replace(title, '\s+', ' ', 'g')) AS title FROM cur WHERE title <> '' AND level BETWEEN 1 AND 6",
    "latex_headings": r"""SELECT subtopic_id, 0 AS position, 3 AS level, trim(name) AS title FROM subtopics WHERE NOT contains(name, '}') UNION ALL SELECT subtopic_id, 1, 4, trim(coalesce(section_title, 'none')) FROM subtopics WHERE coalesce(section_title, 'none') <> ''""",
    "vector_topk": "SELECT query_id, vec_id, rank, round(s, 6) AS similarity FROM (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS s, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) DESC, v.vec_id)::INT AS rank FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 3",
    "label_centroids": "SELECT label, round(sqrt(sum(m * m)), 6) AS coherence FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL) GROUP BY label",
    "folder_sizes": "SELECT folder, kind, count(*) AS files FROM (SELECT kind, array_to_string(parts[1:k], '/') AS folder FROM (SELECT kind, parts, unnest(range(1, len(parts))) AS k FROM (SELECT 'book' AS kind, string_split(file_path, '/') AS parts FROM book_tocs WHERE file_path IS NOT NULL UNION ALL SELECT 'pdf', string_split(file_path, '/') FROM pdf_results WHERE file_path IS NOT NULL))) GROUP BY ALL",
    "nested_paths": "SELECT pdf_id AS inner_id, book_id, p.folder FROM (SELECT pdf_id, regexp_replace(file_path, '/[^/]+$', '') AS folder FROM pdf_results) p JOIN (SELECT book_id, regexp_replace(file_path, '/[^/]+$', '') AS folder FROM book_tocs) b ON p.folder = b.folder",
    "events_by_day": "SELECT ts::DATE AS day, event_type, count(*) AS events, count(DISTINCT user_id) AS users, sum(round(value * 100)::BIGINT)::BIGINT AS value_cents, sum((props->>'$.k')::BIGINT)::BIGINT AS k FROM events GROUP BY ALL",
    "context_topk": f"""WITH q AS (SELECT subtopic_id AS query_id, unnest(list_distinct({D.terms("concat_ws(' ', name, description)")})) AS term FROM subtopics WHERE subtopic_id % 20 = 0), dd AS (SELECT doc_id, unnest(list_distinct({D.terms('text')})) AS term FROM documents WHERE text IS NOT NULL),
      s AS (SELECT query_id, doc_id, count(*) AS score FROM q JOIN dd USING (term) GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS r FROM s)
      SELECT query_id, string_agg(doc_id::VARCHAR, ',' ORDER BY r) AS doc_ids, md5(substr(string_agg(substr(text, 1, 800), E'\\n\\n' ORDER BY r), 1, 2000)) AS context_md5 FROM b JOIN documents USING (doc_id) WHERE r <= 3 GROUP BY query_id""",
}
from corpusloom.queries.learning import _U  # noqa: E402

SQL["cross_references"] = rf"""WITH {_U}, w AS (SELECT DISTINCT unit_id, pos, domain, word FROM (SELECT unit_id, pos, domain, unnest(regexp_split_to_array(lower(title), '\s+')) AS word FROM u) WHERE word <> ''),
  p AS (SELECT DISTINCT a.unit_id AS id, b.unit_id AS other, b.pos FROM w a JOIN w b ON a.domain = b.domain AND a.word = b.word AND a.unit_id <> b.unit_id), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM p)
  SELECT w0.unit_id AS id, coalesce((SELECT string_agg(other::VARCHAR, ',' ORDER BY pos) FROM r WHERE r.id = w0.unit_id AND k <= 5), '') AS related FROM (SELECT DISTINCT unit_id FROM w) w0"""

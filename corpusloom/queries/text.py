"""Queries on string functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L
from corpusloom.functions import text as T
from corpusloom.queries import duck as D
from corpusloom.sources.tables import table


def _titles(fn, name):
    def run(spark, d):
        return table(spark, d, "toc_entries").where("title is not null").select("row_id", fn(F.col("title")).alias(name))

    run.__doc__ = f"{name} of every TOC title."
    return run


def _subtopic(fn, name):
    def run(spark, d):
        return table(spark, d, "subtopics").select("subtopic_id", fn(F.col("name")).alias(name))

    run.__doc__ = f"{name} of every subtopic name."
    return run


def content_hashes(spark, d):
    """Content hash, short hash and URL-style hash of every document."""
    return table(spark, d, "documents").select("doc_id", F.md5("text").alias("content_hash"), F.substring(F.md5("text"), 1, 8).alias("short_hash"), F.substring(F.sha2("text", 256), 1, 16).alias("sha_prefix"))


def snippets(spark, d):
    """Surroundings of the word vector in every chapter."""
    return table(spark, d, "chapters").where("content is not null").select("chapter_id", T.snippet(F.col("content"), "vector").alias("snippet"))


def formulas(spark, d):
    """Formulas of all chapters, in order of their kind."""
    return table(spark, d, "chapters").where("content is not null").select("chapter_id", F.posexplode(T.formulas(F.col("content"))).alias("position", "formula"))


def markup_text(spark, d):
    """Chapter texts without Markdown signs and tags, whitespace collapsed."""
    c = F.col("content")
    return table(spark, d, "chapters").where("content is not null").select("chapter_id", F.md5(T.apply_chain(c, T.MARKDOWN)).alias("markdown_md5"), F.md5(T.apply_chain(c, T.HTML)).alias("html_md5"), F.md5(T.apply_chain(c, T.LATEX)).alias("latex_md5"))


def document_terms(spark, d):
    """Number of index terms and distinct index terms of every document."""
    t = T.terms(F.col("text"))
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.size(t).alias("n_terms"), F.size(F.array_distinct(t)).alias("n_distinct"))


def title_keywords(spark, d):
    """The first ten words of a title longer than 2 characters and no stopwords."""
    return table(spark, d, "toc_entries").where("title is not null").select("row_id", F.array_join(F.slice(T.terms(F.col("title")), 1, 10), " ").alias("keywords"))


def line_numbers(spark, d):
    """Section number at the start and page number at the end of a chapter's first line."""
    line = F.trim(F.element_at(F.split("content", r"\r?\n"), 1))
    section = F.regexp_extract(line, r"^(\d+(?:\.\d+)*)", 1)
    page = F.regexp_extract(line, r"(\d+)$", 1)
    return table(spark, d, "chapters").where("content is not null").select("chapter_id", section.alias("section_number"), page.alias("page_number"), F.when(section == "", 0).otherwise(F.size(F.split(section, r"\."))).alias("number_depth"))


def first_sentences(spark, d):
    """Description of a subtopic: its first sentence of more than 20 characters, cut at 200."""
    parts = F.filter(F.split("description", r"\. "), lambda s: F.char_length(s) > 20)
    return table(spark, d, "subtopics").select("subtopic_id", F.substring(F.get(parts, F.lit(0)), 1, 200).alias("description"))


def durations(spark, d):
    """Hours by length of content (500, 1500, 3000 characters), and by number of chapters of the book."""
    n = F.char_length(F.coalesce("content", F.lit("")))
    ch = table(spark, d, "chapters")
    hours = F.when(n < 500, 2).when(n < 1500, 4).when(n < 3000, 6).otherwise(8)
    per = ch.groupBy("book_id").agg(F.least(F.lit(6), F.greatest(F.lit(2), F.floor(F.count("*") / 2))).cast("int").alias("book_hours"))
    return ch.join(per, "book_id").select("chapter_id", hours.alias("hours"), "book_hours")


def priorities(spark, d):
    """Composite priority min(1, .7 s + .3 min(n/100, 1)) of subtopics and its severity."""
    p = F.least(F.lit(1.0), 0.7 * F.col("difficulty") / 5.0 + 0.3 * F.least(F.col("pedagogical_order") / 100.0, F.lit(1.0)))
    sev = F.when(p >= 0.8, "critical").when(p >= 0.6, "high").when(p >= 0.4, "medium").otherwise("low")
    return table(spark, d, "subtopics").select("subtopic_id", F.round(p, 6).alias("priority"), F.when(p.isNotNull(), sev).alias("severity"))


def objectives(spark, d):
    """A learning objective per subtopic and level: the level's verb and the name."""
    verb = F.coalesce(F.create_map(*[F.lit(x) for kv in L.OBJECTIVE_VERB.items() for x in kv])[F.col("educational_level")], F.lit("Understand"))
    return table(spark, d, "subtopics").select("subtopic_id", F.concat_ws(" ", verb, F.lower("name")).alias("objective"))


QUERIES = {
    "clean_title": _titles(T.clean_title, "cleaned"),
    "toc_normalize": _titles(T.toc_title, "normalized"),
    "hierarchy_title": _titles(T.hierarchy_title, "title"),
    "subject_title": _titles(T.subject_title, "title"),
    "group_name": _subtopic(T.group_name, "base"),
    "topic_name": _subtopic(T.topic_name, "cleaned"),
    "concept_name": _subtopic(T.concept, "concept"),
    "safe_file_name": _subtopic(T.file_name, "file_name"),
    "slug": _subtopic(T.slug, "slug"),
    "content_hashes": content_hashes,
    "snippets": snippets,
    "formulas": formulas,
    "markup_text": markup_text,
    "document_terms": document_terms,
    "title_keywords": title_keywords,
    "line_numbers": line_numbers,
    "first_sentences": first_sentences,
    "durations": durations,
    "priorities": priorities,
    "objectives": objectives,
}

_clean = f"trim({D.chain('trim(title)', T.CLEAN_TITLE)})"
_topic = D.chain("name", T.TOPIC_NAME)
_concept = "replace(replace(lower(name), '''', ''), '-', '_')"
_formula = [r"\$\$([^$]+)\$\$", r"\$([^$]+)\$", r"(?s)\\begin\{equation\}(.*?)\\end\{equation\}", r"(?s)\\begin\{align\}(.*?)\\end\{align\}", r"(?s)\\begin\{math\}(.*?)\\end\{math\}", r"(?s)<math[^>]*>(.*?)</math>"]
_found = " || ".join(f"regexp_extract_all(content, {D.quote(k)}, 1)" for k in _formula)
SQL = {
    "clean_title": f"SELECT row_id, CASE WHEN lower(c) <> c AND upper(c) <> c THEN c ELSE {D.initcap('c')} END AS cleaned FROM (SELECT row_id, {_clean} AS c FROM toc_entries WHERE title IS NOT NULL)",
    "toc_normalize": f"SELECT row_id, {D.chain('trim(lower(title))', T.TOC_TITLE)} AS normalized FROM toc_entries WHERE title IS NOT NULL",
    "hierarchy_title": f"SELECT row_id, {D.initcap('c')} AS title FROM (SELECT row_id, {D.chain('trim(title)', T.HIERARCHY_TITLE)} AS c FROM toc_entries WHERE title IS NOT NULL)",
    "subject_title": f"SELECT row_id, {D.chain('trim(lower(title))', T.SUBJECT_TITLE)} AS title FROM toc_entries WHERE title IS NOT NULL",
    "group_name": f"SELECT subtopic_id, lower({D.chain('name', T.GROUP_NAME)}) AS base FROM subtopics",
    "topic_name": f"SELECT subtopic_id, CASE WHEN upper(x[1]) = x[1] AND lower(x[1]) <> x[1] THEN x ELSE upper(x[1]) || lower(x[2:]) END AS cleaned FROM (SELECT subtopic_id, {_topic} AS x FROM subtopics)",
    "concept_name": "SELECT subtopic_id, CASE " + " ".join(f"WHEN contains(x, {D.quote(w)}) THEN {D.quote(v)}" for w, v in L.CONCEPTS.items()) + f" ELSE replace(x, ' ', '_') END AS concept FROM (SELECT subtopic_id, {_concept} AS x FROM subtopics)",
    "safe_file_name": r"""SELECT subtopic_id, substr(regexp_replace(regexp_replace(trim(name), '[<>:"/\\|?*]', '', 'g'), '\s+', '_', 'g'), 1, 100) AS file_name FROM subtopics""",
    "slug": r"SELECT subtopic_id, regexp_replace(regexp_replace(lower(trim(name)), '[^\p{L}\p{N}]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM subtopics",
    "content_hashes": "SELECT doc_id, md5(text) AS content_hash, md5(text)[:8] AS short_hash, sha256(text)[:16] AS sha_prefix FROM documents",
    "snippets": """SELECT chapter_id, CASE WHEN hit = 0 THEN substr(content, 1, 200) || '...' ELSE trim(CASE WHEN s > 0 THEN '...' ELSE '' END || substr(content, s + 1, e - s) || CASE WHEN e < length(content) THEN '...' ELSE '' END) END AS snippet
      FROM (SELECT *, greatest(0, hit - 1 - 100) AS s, least(length(content), hit - 1 + 6 + 100) AS e FROM (SELECT chapter_id, content, instr(lower(content), 'vector') AS hit FROM chapters WHERE content IS NOT NULL))""",
    "formulas": f"SELECT chapter_id, (unnest(range(len(f))))::INT AS position, unnest(f) AS formula FROM (SELECT chapter_id, list_filter(list_transform({_found}, lambda x: trim(x)), lambda x: x <> '') AS f FROM chapters WHERE content IS NOT NULL)",
    "markup_text": f"SELECT chapter_id, md5({D.chain('content', T.MARKDOWN)}) AS markdown_md5, md5({D.chain('content', T.HTML)}) AS html_md5, md5({D.chain('content', T.LATEX)}) AS latex_md5 FROM chapters WHERE content IS NOT NULL",
    "document_terms": f"SELECT doc_id, len(t)::INT AS n_terms, len(list_distinct(t))::INT AS n_distinct FROM (SELECT doc_id, {D.terms('text')} AS t FROM documents WHERE text IS NOT NULL)",
    "title_keywords": f"SELECT row_id, array_to_string({D.terms('title')}[:10], ' ') AS keywords FROM toc_entries WHERE title IS NOT NULL",
    "line_numbers": r"""SELECT chapter_id, section_number, page_number, CASE WHEN section_number = '' THEN 0 ELSE len(string_split(section_number, '.')) END::INT AS number_depth FROM (
      SELECT chapter_id, regexp_extract(line, '^(\d+(?:\.\d+)*)', 1) AS section_number, regexp_extract(line, '(\d+)$', 1) AS page_number FROM (SELECT chapter_id, trim(regexp_split_to_array(content, '\r?\n')[1]) AS line FROM chapters WHERE content IS NOT NULL))""",
    "first_sentences": "SELECT subtopic_id, substr(list_filter(string_split(description, '. '), lambda s: length(s) > 20)[1], 1, 200) AS description FROM subtopics",
    "durations": """SELECT chapter_id, CASE WHEN n < 500 THEN 2 WHEN n < 1500 THEN 4 WHEN n < 3000 THEN 6 ELSE 8 END AS hours, least(6, greatest(2, floor(count(*) OVER (PARTITION BY book_id) / 2)))::INT AS book_hours
      FROM (SELECT *, length(coalesce(content, '')) AS n FROM chapters)""",
    "priorities": """SELECT subtopic_id, round(p, 6) AS priority, CASE WHEN p IS NULL THEN NULL WHEN p >= 0.8 THEN 'critical' WHEN p >= 0.6 THEN 'high' WHEN p >= 0.4 THEN 'medium' ELSE 'low' END AS severity
      FROM (SELECT subtopic_id, CASE WHEN difficulty IS NOT NULL AND pedagogical_order IS NOT NULL THEN least(1.0, 0.7::DOUBLE * difficulty / 5.0::DOUBLE + 0.3::DOUBLE * least(pedagogical_order / 100.0::DOUBLE, 1.0)) END AS p FROM subtopics)""",
    "objectives": "SELECT subtopic_id, concat_ws(' ', coalesce(CASE educational_level " + " ".join(f"WHEN {D.quote(k)} THEN {D.quote(v)}" for k, v in L.OBJECTIVE_VERB.items()) + " END, 'Understand'), lower(name)) AS objective FROM subtopics",
}

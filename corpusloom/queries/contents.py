"""Queries on headings and entries found in texts. Their SQL has constants of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import sequence, toc
from corpusloom.sources.tables import table


def _chapters(spark, d):
    return table(spark, d, "chapters").where("content is not null")


def heading_lines(spark, d):
    """Lines of chapters that look like headings."""
    return toc.heading_lines(_chapters(spark, d), "chapter_id", "content")


def section_entries(spark, d):
    """Entries that chapters give where no table of contents does: objectives, headers and key terms."""
    text = F.concat_ws("\n", "title", "content")
    return toc.section_entries(_chapters(spark, d).select("chapter_id", text.alias("text")), "chapter_id", "text").select("chapter_id", "level", "pos", F.md5("title").alias("title_md5"))


def planted_sections(spark, d):
    """Entries of sections put together from subtopics: objectives, a header and key terms."""
    goals = F.concat_ws("\n", F.transform("learning_objectives", lambda x: F.concat(F.lit("• "), x)))
    text = F.concat(F.lit("Section Learning Objectives By the end of this section, you will be able to do the following:\n"), goals, F.lit("\nSection Key Terms "), F.col("name"), F.lit("\n\nThe body of the section\n"))
    s = table(spark, d, "subtopics").where("size(learning_objectives) > 0 and name is not null").select("subtopic_id", text.alias("text"))
    return toc.section_entries(s, "subtopic_id", "text").select("subtopic_id", "level", "pos", "title")


def listed_entries(spark, d):
    """Lines of PDF texts read as a table of contents."""
    return toc.listed_entries(table(spark, d, "pdf_results"), "pdf_id", "full_text").select("pdf_id", "pos", "level", F.md5("title").alias("title_md5"), "page_number")


def word_contexts(spark, d):
    """The first five places of a word in every chapter with 100 characters on both sides."""
    o = toc.occurrences(_chapters(spark, d), "chapter_id", "content", "matrix")
    return o.select("chapter_id", "pos", F.md5("context").alias("context_md5"))


def toc_depth_first(spark, d):
    """The order in which entries are read: depth first, siblings in the order of their rows."""
    e = toc.depth_first(table(spark, d, "toc_entries"))
    ranked = sequence.global_rank(e, [], [F.col("book_id"), F.col("place")])
    first = ranked.groupBy("book_id").agg(F.min("pos").alias("first"))
    return ranked.join(first, "book_id").select("book_id", "entry_id", "depth", (F.col("pos") - F.col("first") + 1).cast("long").alias("position"))


def numbered_lines(spark, d):
    """Lines of chapters that begin with a section number or end with a page number."""
    line = F.col("line")
    section, page = F.regexp_extract(line, r"^(\d+(?:\.\d+)*)", 1), F.regexp_extract(line, r"(\d+)$", 1)
    rows = toc.lines(_chapters(spark, d), "chapter_id", "content").select("chapter_id", "pos", section.alias("section_number"), page.alias("page_number"))
    return rows.where("section_number <> '' or page_number <> ''").withColumn("depth", F.when(F.col("section_number") == "", 0).otherwise(F.size(F.split("section_number", r"\."))))


QUERIES = {f.__name__: f for f in (heading_lines, section_entries, planted_sections, listed_entries, word_contexts, toc_depth_first, numbered_lines)}

_LINES = r"ln AS (SELECT chapter_id, (unnest(range(len(l))))::INT AS pos, regexp_replace(unnest(l), '^\s+|\s+$', '', 'g') AS line FROM (SELECT chapter_id, regexp_split_to_array(content, '\r?\n') AS l FROM chapters WHERE content IS NOT NULL))"
_FORMS = [
    r"^(?:Chapter\s+)?(\d+)[.:\s]+(.+?)(?:\s+\d+\s*)?$", r"^(Chapter\s+\d+[.:\s]+.+?)(?:\s+\d+\s*)?$", r"^(\d+\.\s+.+?)(?:\s+\d+\s*)?$", r"^(\d+\.\d+\s+.+?)(?:\s+\d+\s*)?$", r"^(\d+\.\d+\.\d+\s+.+?)(?:\s+\d+\s*)?$",
    r"^(Part\s+[IVX]+[.:\s]+.+?)(?:\s+\d+\s*)?$", r"^(Unit\s+\d+[.:\s]+.+?)(?:\s+\d+\s*)?$", r"^(Appendix\s+[A-Z][.:\s]+.+?)(?:\s+\d+\s*)?$", r"^([a-z][a-z\s&\-]{3,50})(?:\s+\d+\s*)?$", r"^([a-z][a-z]+(?:\s+[a-z][a-z]+){1,8})(?:\s+\d+\s*)?$",
]
_FORM = "CASE " + " ".join(f"WHEN regexp_matches(line, '(?i){p}') THEN {i}" for i, p in enumerate(_FORMS)) + " END"
_TITLE = "CASE form " + " ".join(f"WHEN {i} THEN " + (f"regexp_extract(line, '(?i){p}', 1)" if i else f"regexp_extract(line, '(?i){p}', 1) || ' ' || regexp_extract(line, '(?i){p}', 2)") for i, p in enumerate(_FORMS)) + " END"
_ENTRIES = r"""
SELECT {key}, level, pos, {title} FROM (
  SELECT {key}, 2 AS level, (unnest(range(len(l))))::INT AS pos, unnest(l) AS t FROM (SELECT {key}, list_transform(list_filter(list_transform(regexp_split_to_array(regexp_extract(text, '(?is)Section Learning Objectives[:\s]*By the end of this section[,\s]*you will be able to do the following:(.*?)(?:Teacher Support|Section Key Terms|\n\n|$)', 1), '(?:^|\n)\s*[•·\-*]?\s*'),
    lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 10), lambda x: CASE WHEN length(x) > 100 THEN x[1:100] || '...' ELSE x END) AS l FROM src)
  UNION ALL SELECT {key}, 3, (unnest(range(len(l))))::INT, unnest(l) FROM (SELECT {key}, list_transform(list_filter(regexp_extract_all(text, '(?m)^([A-Z][^:\n]{{10,80}})(?:\s|$)', 1)[1:5], lambda x: NOT regexp_matches(lower(x), 'teacher support|section learning|key terms')), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS l FROM src)
  UNION ALL SELECT {key}, 4, (unnest(range(len(l))))::INT, unnest(l) FROM (SELECT {key}, list_transform(list_filter(regexp_split_to_array(regexp_replace(regexp_extract(text, '(?is)Section Key Terms[:\s]*(.*?)(?:Teacher Support|\n\n|$)', 1), '^\s+|\s+$', '', 'g'), '\s+'), lambda x: length(x) > 3 AND lower(x) NOT IN ('the', 'and', 'for', 'with', 'this', 'that'))[1:10], lambda x: 'Key Term: ' || x) AS l FROM src))"""

SQL = {
    "heading_lines": rf"""WITH {_LINES}, h AS (SELECT chapter_id, pos, line, {_FORM} AS form FROM ln WHERE length(line) BETWEEN 5 AND 150 AND NOT regexp_matches(lower(line), 'page|continued|see also|figure|table|index')),
t AS (SELECT *, regexp_replace({_TITLE}, '^\s+|\s+$', '', 'g') AS title FROM h WHERE form IS NOT NULL)
SELECT chapter_id, pos, form, CASE WHEN form BETWEEN 3 AND 4 THEN CASE WHEN length(title) - length(replace(title, '.', '')) >= 2 THEN 3 ELSE 2 END WHEN form >= 8 THEN CASE WHEN regexp_matches(lower(title), 'chapter|part|unit') THEN 1 ELSE 2 END ELSE 1 END AS level, title,
  try_cast(nullif(regexp_extract(line, '(?:^|[^\p{{L}}\p{{N}}_])(\d+)\s*$', 1), '') AS INT) AS page_number FROM t""",
    "section_entries": "WITH src AS (SELECT chapter_id, concat_ws(chr(10), title, content) AS text FROM chapters WHERE content IS NOT NULL)" + _ENTRIES.format(key="chapter_id", title="md5(t) AS title_md5"),
    "planted_sections": "WITH src AS (SELECT subtopic_id, 'Section Learning Objectives By the end of this section, you will be able to do the following:' || chr(10) || array_to_string(list_transform(learning_objectives, lambda x: '• ' || x), chr(10)) || chr(10) || 'Section Key Terms ' || name || chr(10) || chr(10) || 'The body of the section' || chr(10) AS text FROM subtopics WHERE len(learning_objectives) > 0 AND name IS NOT NULL)"
    + _ENTRIES.format(key="subtopic_id", title="t AS title"),
    "listed_entries": r"""SELECT pdf_id, pos, CASE WHEN length(regexp_extract(line, '^(\s*)', 1)) >= 8 THEN 3 WHEN length(regexp_extract(line, '^(\s*)', 1)) >= 4 THEN 2 ELSE 1 END AS level, md5(title) AS title_md5, try_cast(nullif(regexp_extract(body, '(?:^|[^\p{L}\p{N}_])(\d+)$', 1), '') AS INT) AS page_number FROM (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(body, '(?i)^(chapter|section|part|unit)\s*\d+[:\-.]?\s*', ''), '[.\s]*\d+$', ''), '^\s+|\s+$', '', 'g') AS title FROM (
    SELECT pdf_id, pos, line, regexp_replace(line, '^\s+|\s+$', '', 'g') AS body FROM (SELECT pdf_id, (unnest(range(len(l))))::INT AS pos, unnest(l) AS line FROM (SELECT pdf_id, regexp_split_to_array(full_text, '\r\n|\n|\r') AS l FROM pdf_results WHERE full_text IS NOT NULL)))) WHERE length(title) > 3""",
    "word_contexts": "SELECT chapter_id, pos::INT AS pos, md5(substr(content, greatest(1, pos - 100), pos - greatest(1, pos - 100) + 106)) AS context_md5 FROM (SELECT chapter_id, content, unnest(list_filter(range(1, length(content) + 1), lambda i: lower(substr(content, i, 6)) = 'matrix')[1:5]) AS pos FROM chapters WHERE contains(lower(content), 'matrix'))",
    "toc_depth_first": r"""WITH RECURSIVE l AS (SELECT trim(book_id, ' ' || chr(9)) AS book_id, trim(entry_id, ' ' || chr(9)) AS entry_id, nullif(trim(parent_id, ' ' || chr(9)), '') AS parent_id, row_id, extracted_at FROM toc_entries),
c AS (SELECT book_id, entry_id, any_value(parent_id) AS parent_id, max(row_id) AS row_id FROM (SELECT *, rank() OVER (PARTITION BY book_id, entry_id ORDER BY extracted_at DESC NULLS LAST) AS r FROM l) WHERE r = 1 GROUP BY ALL),
w AS (SELECT book_id, entry_id, 1 AS depth, [row_id] AS place FROM c WHERE parent_id IS NULL UNION ALL SELECT c.book_id, c.entry_id, w.depth + 1, list_append(w.place, c.row_id) FROM w JOIN c ON c.book_id = w.book_id AND c.parent_id = w.entry_id)
SELECT book_id, entry_id, depth, row_number() OVER (PARTITION BY book_id ORDER BY place) AS position FROM w""",
    "numbered_lines": rf"""WITH {_LINES} SELECT chapter_id, pos, section_number, page_number, CASE WHEN section_number = '' THEN 0 ELSE len(string_split(section_number, '.')) END::INT AS depth
FROM (SELECT chapter_id, pos, regexp_extract(line, '^(\d+(?:\.\d+)*)', 1) AS section_number, regexp_extract(line, '(\d+)$', 1) AS page_number FROM ln) WHERE section_number <> '' OR page_number <> ''""",
}

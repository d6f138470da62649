"""Queries on the rules of titles and lines. Their SQL has constants of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import titles as R
from corpusloom.functions.text import formulas
from corpusloom.sources.tables import table


def _titles(spark, d):
    return table(spark, d, "toc_entries").where("title is not null").select("row_id", "title")


def title_kinds(spark, d):
    """What every TOC title is: administrative, granular, of which level and complexity."""
    c = F.col("title")
    return _titles(spark, d).select("row_id", R.administrative(c).alias("administrative"), R.granularity(c).alias("granularity"), F.round(R.complexity(c), 6).alias("complexity"), R.level_of_title(c).alias("title_level"), R.level_of_indent(c).alias("indent_level"))


def comparison_names(spark, d):
    """Subtopic names in the four forms used for comparison across levels."""
    c = F.col("name")
    return table(spark, d, "subtopics").select("subtopic_id", R.matching_title(c).alias("matching"), R.concept_name(c).alias("concept"), R.level_free_name(c).alias("level_free"), R.base_topic(c).alias("base"))


def book_levels(spark, d):
    """Level, electives, subdiscipline and kind of every book from its title and folder."""
    b = table(spark, d, "book_tocs")
    t, g = F.col("book_title"), F.col("discipline")
    return b.select("book_id", R.educational_level(t, F.col("file_path")).alias("educational_level"), R.elective(t, g).alias("is_elective"), R.subdiscipline(t, g).alias("subdiscipline"), R.repository_type(t).alias("repository_type"), R.plain_name(F.regexp_extract("file_path", r"([^/.]+)(?:\.[A-Za-z]+)?$", 1)).alias("plain_name"))


def topic_difficulty(spark, d):
    """Difficulty by content, difficulty by level and domain, confidence of prerequisites, and core by rules, of every subtopic."""
    s = table(spark, d, "subtopics")
    n = lambda c: F.greatest(F.size(c), F.lit(0))
    return s.select(
        "subtopic_id", R.content_difficulty(F.col("description"), F.col("educational_level")).alias("content_difficulty"), R.level_difficulty(F.col("educational_level"), F.col("domain")).alias("level_difficulty"),
        F.round(R.prerequisite_confidence(F.col("educational_level").isNotNull().cast("int"), n("source_books"), n("prerequisites")), 6).alias("confidence"),
        R.core_by_rules(F.col("is_core"), n("source_books"), F.col("domain"), F.col("educational_level")).alias("core"),
    )


def chapter_titles(spark, d):
    """The title that a chapter's own text begins with."""
    return table(spark, d, "chapters").where("content is not null").select("chapter_id", F.md5(R.chapter_title(F.col("content"))).alias("title_md5"), F.char_length(R.chapter_title(F.col("content"))).alias("n"))


def formula_contexts(spark, d):
    """Every formula of a chapter with its surroundings and number."""
    f = table(spark, d, "chapters").where("content is not null").select("chapter_id", "content", F.posexplode(formulas(F.col("content"))).alias("i", "formula"))
    return f.select("chapter_id", F.concat(F.lit("math_"), F.col("i")).alias("formula_id"), "formula", F.md5(R.formula_context(F.col("content"), F.col("formula"))).alias("context_md5"))


def file_scores(spark, d):
    """Quality of source files by size, format and title."""
    p = table(spark, d, "pdf_results")
    size = F.aggregate(F.coalesce(F.transform("chunks_metadata", lambda x: x["chunk_size_bytes"].cast("long")), F.array().cast("array<long>")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    name = F.regexp_extract("file_path", r"([^/]+)$", 1)
    return p.select("pdf_id", F.round(R.file_quality(F.col("file_path"), size, name), 6).alias("quality"))


def textbook_books(spark, d):
    """Books that pass the filter for textbook repositories."""
    strong, subjects, educational, exclude = ["open"], ["physics", "biology", "mathematics", "chemistry", "course"], ["university", "college", "introduction"], ["archive", "test"]
    keep = R.textbook_repository(F.col("book_title"), F.col("discipline"), F.col("extraction_method"), F.col("total_entries"), F.lit(False), strong, subjects, educational, exclude, ["pdf"])
    return table(spark, d, "book_tocs").where(keep).select("book_id")


def standard_domains(spark, d):
    """Domains of subtopics in standard terms."""
    return table(spark, d, "subtopics").select("subtopic_id", R.standard_term(F.col("name"), {"optic": "Optics", "therm": "Thermodynamics", "magnet": "Magnetism", "quant": "Quantum Physics"}).alias("term"))


QUERIES = {f.__name__: f for f in (title_kinds, comparison_names, book_levels, topic_difficulty, chapter_titles, formula_contexts, file_scores, textbook_books, standard_domains)}

_HAS = lambda x, words: "(" + " OR ".join(f"contains({x}, '{w}')" for w in words.split("|")) + ")"
_TRIM = r"regexp_replace(%s, '^\s+|\s+$', '', 'g')"

SQL = {
    "title_kinds": rf"""SELECT row_id,
  regexp_matches(x, '^(college|university|high school)?\s*physics\s*(for\s*ap|2e|volume|\([\p{{L}}\p{{N}}_]+\))*\s*$') OR regexp_matches(x, '^connection\s+for\s+ap.*courses?$') OR regexp_matches(x, '^physics\s*,?\s*$')
  OR regexp_matches(x, '^[\p{{L}}\p{{N}}_]+\s+2e\s*$') OR regexp_matches(x, '^volume\s+\d+') OR regexp_matches(x, '^chapter\s+\d+\s*$') OR regexp_matches(x, '^section\s+\d+') OR regexp_matches(x, '^part\s+[ivx]+')
  OR starts_with(x, 'appendix') OR regexp_matches(x, '^table\s+of\s+contents') OR x IN ('index', 'glossary', 'bibliography', 'references', 'preface', 'foreword', 'physics', 'introduction', 'summary', 'review', 'conclusion', 'overview') OR length(x) < 3 AS administrative,
  CASE WHEN regexp_matches(lower(title), 'law|equation|formula|principle|theorem|effect|oscillation|wave|particle|field|force|energy|momentum|calculation|solve|derive|compute|measure|circuit|lens|magnet|resistor|capacitor|inductor|problem|example|exercise|application') THEN 'granular'
       WHEN regexp_matches(lower(title), '^(introduction|basics|overview|fundamentals)\s+') AND regexp_matches(lower(title), '^(introduction\s+to|basics\s+of|overview\s+of|fundamentals\s+of)') OR regexp_matches(lower(title), '(general|broad)\s+') THEN 'high_level'
       WHEN length(title) > 40 OR len(list_filter(regexp_split_to_array(title, '\s+'), lambda w: w <> '')) > 5 THEN 'granular' ELSE 'high_level' END AS granularity,
  round(least(1.0, greatest(0.0, 0.5::DOUBLE + (CASE WHEN contains(y, 'basic') THEN -0.2 ELSE 0 END)::DOUBLE + (CASE WHEN contains(y, 'introduction') THEN -0.2 ELSE 0 END)::DOUBLE + (CASE WHEN contains(y, 'elementary') THEN -0.2 ELSE 0 END)::DOUBLE
    + (CASE WHEN contains(y, 'fundamental') THEN -0.1 ELSE 0 END)::DOUBLE + (CASE WHEN contains(y, 'advanced') THEN 0.3 ELSE 0 END)::DOUBLE + (CASE WHEN contains(y, 'specialized') THEN 0.3 ELSE 0 END)::DOUBLE + (CASE WHEN contains(y, 'graduate') THEN 0.4 ELSE 0 END)::DOUBLE
    + (CASE WHEN contains(y, 'research') THEN 0.5 ELSE 0 END)::DOUBLE + (CASE WHEN contains(y, 'theory') THEN 0.2 ELSE 0 END)::DOUBLE + (CASE WHEN contains(y, 'theoretical') THEN 0.2 ELSE 0 END)::DOUBLE + (CASE WHEN contains(y, 'mathematical') THEN 0.2 ELSE 0 END)::DOUBLE
    + (CASE WHEN contains(y, 'quantum') THEN 0.3 ELSE 0 END)::DOUBLE)), 6) AS complexity,
  CASE WHEN {_HAS('y', 'chapter|part|unit')} THEN 1 WHEN {_HAS('y', 'section|lesson')} THEN 2 WHEN {_HAS('y', 'subsection|topic')} THEN 3 ELSE 1 END AS title_level,
  CASE WHEN indent >= 8 THEN 3 WHEN indent >= 4 THEN 2 ELSE 1 END AS indent_level
  FROM (SELECT row_id, title, lower(title) AS y, lower(trim(title)) AS x, length(regexp_extract(title, '^(\s*)', 1)) AS indent FROM toc_entries WHERE title IS NOT NULL)""",
    "comparison_names": r"""SELECT subtopic_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '^(introduction to|intro to|basic|advanced)\s+', ''), '\s+(i|ii|iii|1|2|3)$', ''), '\s+', ' ', 'g')) AS matching,
  trim(regexp_replace(regexp_replace(lower(name), '\b(introduction to|advanced|basic|fundamental)\b', '', 'g'), '\s+', ' ', 'g')) AS concept,
  trim(regexp_replace(regexp_replace(lower(name), 'introductory|basic|advanced|graduate|undergraduate', '', 'g'), '\s+', ' ', 'g')) AS level_free,
  trim(regexp_replace(regexp_replace(regexp_replace(name, '\b(advanced|intermediate|basic|introductory)\b', '', 'gi'), '\b(I|II|III|1|2|3)\b', '', 'g'), '\s+', ' ', 'g')) AS base FROM subtopics""",
    "book_levels": rf"""SELECT book_id, CASE WHEN {_HAS('t', 'high school|high-school|highschool|hs |ap course|ap physics|ap biology|ap chemistry|ap®|ap |for ap courses|advanced placement|pre-algebra|prealgebra|basic music theory|introductory physics|fundamentals of')} THEN 'high_school'
   WHEN {_HAS('t', 'graduate|phd|doctoral|advanced research|signal processing|machine learning|research methods')} THEN 'graduate' WHEN {_HAS('t', 'college physics|university physics')} THEN 'undergraduate' WHEN contains(f, 'high') THEN 'high_school' ELSE 'undergraduate' END AS educational_level,
  lower(discipline) = 'physics' AND {_HAS('lower(book_title)', 'astronomy|astrophysics|cosmology|nuclear physics|particle physics|biophysics|geophysics|history of physics')} AS is_elective,
  CASE WHEN lower(discipline) <> 'physics' OR discipline IS NULL THEN 'general' WHEN {_HAS('lower(book_title)', 'mechanics|dynamics|kinematics')} THEN 'mechanics' WHEN {_HAS('lower(book_title)', 'thermodynamics|thermal')} THEN 'thermodynamics'
   WHEN {_HAS('lower(book_title)', 'electromagnetism|electricity|magnetism')} THEN 'electromagnetism' WHEN {_HAS('lower(book_title)', 'quantum|atomic')} THEN 'quantum' WHEN {_HAS('lower(book_title)', 'optics|light')} THEN 'optics' WHEN {_HAS('lower(book_title)', 'astronomy|astrophysics')} THEN 'astronomy' ELSE 'general' END AS subdiscipline,
  CASE WHEN lower(book_title) LIKE 'cnxbook-%' THEN 'CNX Book' WHEN lower(book_title) LIKE 'osbooks-%' THEN 'OpenStax Book' WHEN lower(book_title) LIKE 'derived-from-osbooks-%' THEN 'OpenStax Derived' WHEN contains(lower(book_title), 'university-physics') THEN 'University Physics' ELSE 'Other Repository' END AS repository_type,
  array_to_string(list_transform(string_split(trim(regexp_replace(lower(regexp_extract(file_path, '([^/.]+)(?:\.[A-Za-z]+)?$', 1)), '[-_\s]+', ' ', 'g')), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS plain_name
  FROM (SELECT *, lower(coalesce(file_path, '')) AS f, concat_ws(' ', lower(book_title), lower(coalesce(file_path, ''))) AS t FROM book_tocs)""",
    "topic_difficulty": rf"""SELECT subtopic_id, least(5, CASE WHEN educational_level = 'high_school' THEN 2 ELSE 3 END + {_HAS("lower(coalesce(description, ''))", 'quantum|relativity|differential|tensor|lagrangian|hamiltonian')}::INT + {_HAS("coalesce(description, '')", '∂|∫|∑|dx|dy|dz')}::INT)::INT AS content_difficulty,
  least(5, CASE educational_level WHEN 'high_school' THEN 1 WHEN 'undergraduate' THEN 2 WHEN 'graduate' THEN 4 ELSE 2 END + coalesce(domain IN ('modern_physics', 'astrophysics'), false)::INT)::INT AS level_difficulty,
  round(least(1.0::DOUBLE, 0.5::DOUBLE + 0.1::DOUBLE * (educational_level IS NOT NULL)::INT + CASE WHEN coalesce(len(source_books), 0) > 0 THEN 0.2::DOUBLE ELSE 0 END + least(0.1::DOUBLE * coalesce(len(prerequisites), 0), 0.3::DOUBLE)), 6) AS confidence,
  coalesce(is_core, false) AND coalesce(len(source_books), 0) > 1 OR coalesce(domain IN ('kinematics', 'dynamics', 'energy', 'electricity', 'magnetism', 'waves'), false) OR coalesce(educational_level IN ('high_school', 'undergraduate'), false) AND coalesce(len(source_books), 0) > 1 AS core FROM subtopics""",
    "chapter_titles": rf"""WITH l AS (SELECT chapter_id, list_transform(string_split(content, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS ls FROM chapters WHERE content IS NOT NULL),
e AS (SELECT chapter_id, unnest(range(1, least(11, len(ls) + 1))) AS i, ls FROM l),
p AS (SELECT chapter_id, i, k, {_TRIM % "regexp_extract(ls[i], r, 1)"} AS t FROM e, (VALUES (1, '(?i)Chapter\s+\d+[:\s]+(.+)'), (2, '(?i)^([A-Z][^.!?]*[.!?]?)\s*$'), (3, '(?i)Section\s+[\d.]+[:\s]+(.+)'), (4, '^(.{{10,80}})\s*$')) v(k, r) WHERE length(ls[i]) >= 5),
f AS (SELECT chapter_id, arg_min(t, i * 10 + k) AS t FROM p WHERE length(t) BETWEEN 6 AND 99 AND NOT {_HAS('lower(t)', 'teacher support|learning objectives|by the end')} GROUP BY chapter_id),
r AS (SELECT l.chapter_id, coalesce(f.t, list_filter(ls[1:5], lambda x: length(x) BETWEEN 11 AND 99)[1], 'Content Section') AS t FROM l LEFT JOIN f USING (chapter_id))
SELECT chapter_id, md5(t) AS title_md5, length(t)::INT AS n FROM r""",
    "file_scores": r"""SELECT pdf_id, round(least(1.0::DOUBLE, 0.5::DOUBLE + CASE WHEN coalesce(list_sum(list_transform(chunks_metadata, lambda x: x.chunk_size_bytes)), 0) > 1048576 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN lower(file_path) LIKE '%.pdf' THEN 0.2::DOUBLE ELSE 0 END
  + CASE WHEN length(regexp_extract(file_path, '([^/]+)$', 1)) > 10 THEN 0.1::DOUBLE ELSE 0 END), 6) AS quality FROM pdf_results""",
    "textbook_books": rf"""SELECT book_id FROM (SELECT book_id, lower(coalesce(book_title, '')) AS n, lower(coalesce(discipline, '')) AS t, lower(coalesce(extraction_method, '')) AS o, total_entries FROM book_tocs)
  WHERE NOT ({_HAS('n', 'archive|test')} OR {_HAS('t', 'archive|test')}) AND (contains(n, 'open') OR ({_HAS('n', 'physics|biology|mathematics|chemistry|course|university|college|introduction')} OR {_HAS('t', 'physics|biology|mathematics|chemistry|course|university|college|introduction')}) AND (o = 'pdf' OR coalesce(total_entries > 50, false)))""",
    "standard_domains": """SELECT subtopic_id, CASE WHEN contains(lower(name), 'optic') THEN 'Optics' WHEN contains(lower(name), 'therm') THEN 'Thermodynamics' WHEN contains(lower(name), 'magnet') THEN 'Magnetism' WHEN contains(lower(name), 'quant') THEN 'Quantum Physics'
  ELSE array_to_string(list_transform(string_split(lower(name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') END AS term FROM subtopics""",
}
SQL["formula_contexts"] = r"""WITH f AS (SELECT chapter_id, content, list_filter(list_transform(list_concat(regexp_extract_all(content, '\$\$([^$]+)\$\$', 1), regexp_extract_all(content, '\$([^$]+)\$', 1), regexp_extract_all(content, '(?s)\\begin\{equation\}(.*?)\\end\{equation\}', 1),
  regexp_extract_all(content, '(?s)\\begin\{align\}(.*?)\\end\{align\}', 1), regexp_extract_all(content, '(?s)\\begin\{math\}(.*?)\\end\{math\}', 1), regexp_extract_all(content, '(?s)<math[^>]*>(.*?)</math>', 1)), lambda x: trim(x)), lambda x: x <> '') AS l FROM chapters WHERE content IS NOT NULL),
e AS (SELECT chapter_id, content, unnest(range(len(l))) AS i, unnest(l) AS formula FROM f)
SELECT chapter_id, 'math_' || i AS formula_id, formula, md5(CASE WHEN strpos(content, formula) > 0 THEN trim(substr(content, greatest(1, strpos(content, formula) - 100), strpos(content, formula) - greatest(1, strpos(content, formula) - 100) + length(formula) + 100)) ELSE '' END) AS context_md5 FROM e"""

"""Queries on the index, topics across books and classification."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions import lexicons as L
from corpusloom.functions.text import CLEAN_TITLE, GROUP_NAME, TOC_TITLE, clean_title, level_name
from corpusloom.operators import lexicon, search, topics
from corpusloom.queries import duck as D
from corpusloom.sources.tables import table


def _chapters(spark, d):
    return table(spark, d, "chapters").where("content is not null")


def _entries(spark, d):
    return topics.current_entries(table(spark, d, "toc_entries"))


def tfidf_search(spark, d):
    """The three terms of greatest weight of every chapter."""
    top = search.top_terms(search.tf_idf(search.postings(_chapters(spark, d))))
    return top.select("chapter_id", "rank", "term", "frequency", F.round("tf_idf", 6).alias("tf_idf"))


def index_stats(spark, d):
    return search.index_stats(search.postings(_chapters(spark, d)), _chapters(spark, d))


def suggest_prefix(spark, d):
    return search.suggest(search.postings(_chapters(spark, d)), "mo")


def search_all(spark, d):
    """Text, formula and title hits for one query."""
    hits = search.search(table(spark, d, "book_tocs"), _chapters(spark, d), "vector")
    return hits.select("book_id", "chapter_id", "title", "match_type", F.round("score", 6).alias("score"), F.md5("snippet").alias("snippet_md5"))


def title_search(spark, d):
    return search.search_titles(table(spark, d, "book_tocs"), _chapters(spark, d), "th").select("book_id", "chapter_id", "title", "score")


def formula_search(spark, d):
    return search.search_formulas(search.formula_table(_chapters(spark, d)), "=").select("book_id", "chapter_id", "snippet", "score")


def topic_frequency(spark, d):
    return topics.topic_frequency(_entries(spark, d))


def toc_overlap(spark, d):
    return topics.toc_overlap(_entries(spark, d))


def topic_alignment(spark, d):
    return topics.alignment(_entries(spark, d), table(spark, d, "book_tocs")).select("topic", "books", F.array_join("levels", ",").alias("levels"), "spellings")


def book_pair_jaccard(spark, d):
    """Pairs of books with at least three common titles."""
    return topics.book_pairs(_entries(spark, d), 3)


def topics_by_dimension(spark, d):
    return topics.by_dimensions(table(spark, d, "subtopics")).select("dimension", "educational_level", "domain", "is_core", "topics")


def curriculum_statistics(spark, d):
    return topics.statistics(table(spark, d, "subtopics"))


def duplicate_documents(spark, d):
    """Documents whose text occurs more than once; the earliest added is the primary."""
    rows = topics.duplicate_groups(table(spark, d, "documents").where("text is not null"), F.md5("text"), [F.col("added_at").asc_nulls_last(), F.col("doc_id")], "content_hash")
    return rows.select("doc_id", "content_hash", "copies", "is_primary")


def duplicate_names(spark, d):
    """Books whose title without hyphens, underscores and case occurs more than once."""
    rows = topics.duplicate_groups(table(spark, d, "book_tocs"), F.translate(F.lower("book_title"), "-_", ""), [F.col("extracted_at").asc_nulls_last(), F.col("book_id")], "name_key")
    return rows.select("book_id", "name_key", "copies", "is_primary")


def merge_topics(spark, d):
    m = topics.merge_levels(table(spark, d, "subtopics"))
    return m.select("base", "name", F.array_join("levels", ",").alias("levels"), "members", F.array_join("prerequisites", "|").alias("prerequisites"), "depth", "hours", "is_core", "domain")


def new_topic_entries(spark, d):
    """Entries whose title is new when books are taken in order."""
    e = topics.new_entries(_entries(spark, d), ["book_id", "row_id"])
    return e.select("row_id", "book_id", "title")


def foundational_books(spark, d):
    return topics.foundational_book(_entries(spark, d), table(spark, d, "book_tocs")).select("discipline", "book_id", "level_std", "entries")


def extraction_metrics(spark, d):
    e = _entries(spark, d).groupBy("book_id").agg(F.count("*").alias("entries"))
    return topics.extraction_metrics(table(spark, d, "book_tocs"), e)


def raw_topics(spark, d):
    """Cleaned titles longer than two characters with their domain and standard level."""
    c = clean_title(F.col("title"))
    e = _entries(spark, d).where("title is not null").join(table(spark, d, "book_tocs").select("book_id", level_name(F.col("level")).alias("book_level")), "book_id")
    return e.withColumn("topic", c).where(F.length("topic") > 2).select("row_id", "topic", "book_level", lexicon.first_label(F.lower("topic"), L.DOMAINS_FIRST, "general").alias("domain"))


def domain_first(spark, d):
    return table(spark, d, "subtopics").select("subtopic_id", lexicon.first_label(F.lower("description"), L.DOMAINS_FIRST, "general").alias("domain"))


def domain_most(spark, d):
    return table(spark, d, "subtopics").select("subtopic_id", lexicon.most_label(F.lower("description"), L.DOMAINS_MOST, "general").alias("domain"))


def _all_text():
    return F.lower(F.concat_ws(" ", "name", F.array_join(F.coalesce("learning_objectives", F.array().cast("array<string>")), " ")))


def bloom_level(spark, d):
    return table(spark, d, "subtopics").select("subtopic_id", lexicon.bloom_level(_all_text()).alias("bloom_level"))


def difficulty_class(spark, d):
    n = F.when(F.col("prerequisites").isNull(), 0).otherwise(F.size("prerequisites"))
    return table(spark, d, "subtopics").select("subtopic_id", lexicon.difficulty_class(F.lower("name"), n, F.coalesce("depth_level", F.lit(0))).alias("difficulty_class"))


def application_domains(spark, d):
    return table(spark, d, "subtopics").select("subtopic_id", F.array_join(lexicon.all_labels(F.lower(F.concat_ws(" ", "name", "description")), L.APPLICATIONS, "Education"), ",").alias("domains"))


def _books_with_text(spark, d):
    toc = _entries(spark, d).where("title is not null").groupBy("book_id").agg(F.array_join(F.array_sort(F.collect_set(F.lower("title"))), " ").alias("toc_text"))
    return table(spark, d, "book_tocs").select("book_id", F.lower(F.coalesce("book_title", F.lit(""))).alias("title"), level_name(F.col("level")).alias("level")).join(toc, "book_id", "left").withColumn("toc_text", F.coalesce("toc_text", F.lit("")))


def _rare(spark, d):
    e = _entries(spark, d).where("title <> ''").select("book_id", F.lower("title").alias("topic"))
    n = table(spark, d, "book_tocs").agg(F.count("*").alias("n_books"))
    freq = e.groupBy("topic").agg(F.count("*").alias("f"))
    ratio = e.join(freq, "topic").crossJoin(F.broadcast(n)).groupBy("book_id").agg(F.avg((F.col("f") / F.col("n_books") < 0.2).cast("double")).alias("rare"))
    rare = F.col("rare")
    return ratio.select("book_id", "rare", F.when(rare > 0.3, "elective").otherwise("core").alias("by_frequency"), F.when(rare > 0.3, F.least(F.lit(0.8), rare)).otherwise(F.lit(0.7)).alias("frequency_confidence"))


def rare_topic_class(spark, d):
    """Books as core or elective by their share of rare topics."""
    return _rare(spark, d).select("book_id", F.round("rare", 6).alias("rare"), "by_frequency", F.round("frequency_confidence", 6).alias("frequency_confidence"))


def vote_classify(spark, d):
    """Core or elective by keywords, rare topics and level, and by the majority of the three."""
    books = _books_with_text(spark, d).join(_rare(spark, d), "book_id", "left")
    k, kc, domain = lexicon.elective_by_keywords(F.col("title"), F.col("toc_text"))
    lv, lc = lexicon.elective_by_level(F.col("title"), F.col("level"))
    votes = books.select("book_id", k.alias("by_keywords"), kc.alias("kc"), domain.alias("domain"), F.coalesce("by_frequency", F.lit("core")).alias("by_frequency"), F.coalesce("frequency_confidence", F.lit(0.5)).alias("fc"), lv.alias("by_level"), lc.alias("lc"))
    label, confidence = lexicon.majority([(F.col("by_keywords"), F.col("kc")), (F.col("by_frequency"), F.col("fc")), (F.col("by_level"), F.col("lc"))])
    return votes.select("book_id", "by_keywords", "by_frequency", "by_level", "domain", label.alias("classification"), F.round(confidence, 6).alias("confidence"))


def discipline_scores(spark, d):
    s = lexicon.discipline_scores(_entries(spark, d).where("title is not null"), "book_id", "title")
    return s.select("book_id", "discipline", "score", F.round("confidence", 6).alias("confidence"))


def level_map(spark, d):
    return table(spark, d, "book_tocs").groupBy("level", level_name(F.col("level")).alias("standard")).agg(F.count("*").alias("books"))


def source_catalog(spark, d):
    """Documents per cleaned source: number, characters, first and last date and the kinds of chunk."""
    s = F.lower(F.trim("source"))
    return table(spark, d, "documents").groupBy(s.alias("source")).agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"), F.min("added_at").alias("first_added"), F.max("added_at").alias("last_added"), F.countDistinct("chunk_type").alias("chunk_types"))


def pdf_status(spark, d):
    """One row of counts over PDF runs; the last successful run of a file counts."""
    p = table(spark, d, "pdf_results")
    last = F.row_number().over(W.partitionBy("file_hash").orderBy(F.desc("success"), F.desc_nulls_last("processed_date"), F.desc("pdf_id")))
    return p.withColumn("r", last).agg(F.count("*").alias("runs"), F.sum(F.col("success").cast("int")).alias("successful"), F.countDistinct("file_hash").alias("files"), F.sum(((F.col("r") == 1) & F.col("success")).cast("int")).alias("files_done"), F.round(F.avg("processing_time"), 6).alias("mean_seconds"), F.sum(F.when(F.col("r") == 1, F.col("processed_pages"))).alias("pages"))


QUERIES = {f.__name__: f for f in (tfidf_search, index_stats, suggest_prefix, search_all, title_search, formula_search, topic_frequency, toc_overlap, topic_alignment, book_pair_jaccard, topics_by_dimension, curriculum_statistics, duplicate_documents, duplicate_names, merge_topics, new_topic_entries, foundational_books, extraction_metrics, raw_topics, domain_first, domain_most, bloom_level, difficulty_class, application_domains, rare_topic_class, vote_classify, discipline_scores, level_map, source_catalog, pdf_status)}

_POST = f"post AS (SELECT book_id, chapter_id, term, count(*) AS frequency FROM (SELECT book_id, chapter_id, unnest({D.terms('content')}) AS term FROM chapters WHERE content IS NOT NULL) GROUP BY ALL)"
_TFIDF = _POST + ", have AS (SELECT term, count(DISTINCT book_id) AS n_have FROM post GROUP BY term), w AS (SELECT p.*, frequency * ln((SELECT count(DISTINCT book_id) FROM post) / n_have) AS tf_idf FROM post p JOIN have USING (term))"
_FORMULA = [r"\$\$([^$]+)\$\$", r"\$([^$]+)\$", r"(?s)\\begin\{equation\}(.*?)\\end\{equation\}", r"(?s)\\begin\{align\}(.*?)\\end\{align\}", r"(?s)\\begin\{math\}(.*?)\\end\{math\}", r"(?s)<math[^>]*>(.*?)</math>"]
_FORM = "form AS (SELECT book_id, chapter_id, unnest(list_filter(list_transform(" + " || ".join(f"regexp_extract_all(content, {D.quote(k)}, 1)" for k in _FORMULA) + ", lambda x: trim(x)), lambda x: x <> '')) AS formula FROM chapters WHERE content IS NOT NULL)"
_SNIP = """CASE WHEN instr(lower(content), 'vector') = 0 THEN substr(content, 1, 200) || '...' ELSE trim(CASE WHEN greatest(0, instr(lower(content), 'vector') - 101) > 0 THEN '...' ELSE '' END
  || substr(content, greatest(0, instr(lower(content), 'vector') - 101) + 1, least(length(content), instr(lower(content), 'vector') + 105) - greatest(0, instr(lower(content), 'vector') - 101))
  || CASE WHEN least(length(content), instr(lower(content), 'vector') + 105) < length(content) THEN '...' ELSE '' END) END"""
_TITLES = "SELECT book_id, NULL::BIGINT AS chapter_id, book_title AS title, book_title AS snippet, 2.0::DOUBLE AS score, 'title' AS match_type FROM book_tocs WHERE contains(lower(book_title), '{q}') UNION ALL SELECT book_id, chapter_id, title, title, 1.5, 'title' FROM chapters WHERE content IS NOT NULL AND contains(lower(title), '{q}')"
_NORM = f"norm AS (SELECT book_id, title, {D.chain('trim(lower(title))', TOC_TITLE)} AS norm FROM cur)"
_BASE = f"lower({D.chain('name', GROUP_NAME)})"
_CLEAN = f"trim({D.chain('trim(title)', CLEAN_TITLE)})"
_OBJ = "lower(concat_ws(' ', name, array_to_string(coalesce(learning_objectives, []), ' ')))"
_TOCTEXT = "toc AS (SELECT book_id, array_to_string(list_sort(list_distinct(list(lower(title)))), ' ') AS toc_text FROM cur WHERE title IS NOT NULL GROUP BY book_id), bk AS (SELECT b.book_id, lower(coalesce(book_title, '')) AS title, " + D.level("b.level") + " AS level, coalesce(toc_text, '') AS toc_text FROM book_tocs b LEFT JOIN toc USING (book_id))"
_RARE = "freq AS (SELECT lower(title) AS topic, count(*) AS f FROM cur WHERE title <> '' GROUP BY 1), rare AS (SELECT book_id, avg((f / (SELECT count(*) FROM book_tocs) < 0.2)::INT::DOUBLE) AS rare FROM cur JOIN freq ON lower(title) = topic GROUP BY book_id)"
_EL = {k: f"({D.count('title', ws)} * 3 + {D.count('toc_text', ws)})" for k, ws in L.ELECTIVE.items()}
_ELTOP = f"greatest({', '.join(_EL.values())})"
_DISC = " UNION ALL ".join(f"SELECT book_id, {D.quote(k)} AS discipline, {D.count('lower(title)', a)} * 2 + {D.count('lower(title)', b)} AS n FROM cur WHERE title IS NOT NULL" for k, (a, b) in L.DISCIPLINES.items())
SQL = {
    "tfidf_search": f"WITH {_TFIDF} SELECT chapter_id, rank, term, frequency, round(tf_idf, 6) AS tf_idf FROM (SELECT *, row_number() OVER (PARTITION BY book_id, chapter_id ORDER BY tf_idf DESC, term)::INT AS rank FROM w) WHERE rank <= 3",
    "index_stats": f"WITH {_POST} SELECT (SELECT count(DISTINCT book_id) FROM chapters WHERE content IS NOT NULL) AS books, (SELECT count(*) FROM chapters WHERE content IS NOT NULL) AS chapters, count(*) AS postings, count(DISTINCT term) AS distinct_terms, sum(frequency)::BIGINT AS occurrences FROM post",
    "suggest_prefix": f"WITH {_POST} SELECT term, sum(frequency)::BIGINT AS frequency FROM post WHERE starts_with(term, 'mo') GROUP BY term ORDER BY 2 DESC, 1 LIMIT 10",
    "search_all": f"""WITH {_TFIDF}, {_FORM}, txt AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY tf_idf DESC, chapter_id, term) AS r FROM w WHERE contains(term, 'vector')) WHERE r <= 20),
      hits AS (SELECT t.book_id, t.chapter_id, c.title, {_SNIP} AS snippet, tf_idf AS score, 'text' AS match_type, 0 AS o FROM txt t JOIN chapters c USING (chapter_id)
        UNION ALL SELECT book_id, chapter_id, formula, formula, 1.0, 'formula', 1 FROM form WHERE contains(lower(formula), 'vector')
        UNION ALL SELECT *, 2 FROM ({_TITLES.format(q='vector')}))
      SELECT book_id, chapter_id, title, match_type, round(score, 6) AS score, md5(snippet) AS snippet_md5 FROM (SELECT *, row_number() OVER (PARTITION BY book_id, chapter_id ORDER BY o, score DESC, title NULLS FIRST, snippet NULLS FIRST) AS k FROM hits) WHERE k = 1 ORDER BY hits.score DESC, book_id, chapter_id NULLS FIRST LIMIT 20""".replace("ORDER BY hits.score DESC", "ORDER BY score DESC"),
    "title_search": f"SELECT book_id, chapter_id, title, score FROM ({_TITLES.format(q='th')})",
    "formula_search": f"WITH {_FORM} SELECT book_id, chapter_id, formula AS snippet, 1.0::DOUBLE AS score FROM form WHERE contains(lower(formula), '=')",
    "topic_frequency": f"WITH {D.CURRENT} SELECT lower(title) AS topic, count(*) AS entries, count(DISTINCT book_id) AS books FROM cur WHERE title <> '' GROUP BY 1",
    "toc_overlap": f"""WITH {D.CURRENT}, {_NORM}, n AS (SELECT * FROM norm WHERE norm <> ''), homes AS (SELECT norm, count(DISTINCT book_id) AS homes FROM n GROUP BY norm)
      SELECT book_id, count(*) AS entries, count(CASE WHEN homes > 1 THEN 1 END) AS overlapping, round(count(CASE WHEN homes > 1 THEN 1 END) / count(*), 6) AS share, max(homes) - 1 AS widest FROM n JOIN homes USING (norm) GROUP BY book_id""",
    "topic_alignment": f"""WITH {D.CURRENT}, {_NORM}, j AS (SELECT n.*, {D.level('b.level')} AS lv FROM norm n JOIN book_tocs b USING (book_id) WHERE norm <> '')
      SELECT norm AS topic, count(DISTINCT book_id) AS books, array_to_string(list_sort(list_distinct(list(lv))), ',') AS levels, count(DISTINCT title) AS spellings FROM j GROUP BY norm HAVING count(DISTINCT lv) > 1""",
    "book_pair_jaccard": f"""WITH {D.CURRENT}, {_NORM}, n AS (SELECT DISTINCT book_id, norm FROM norm WHERE norm <> ''), sz AS (SELECT book_id, count(*) AS k FROM n GROUP BY 1),
      p AS (SELECT a.book_id AS a, b.book_id AS b, count(*) AS common FROM n a JOIN n b ON a.norm = b.norm AND a.book_id < b.book_id GROUP BY 1, 2 HAVING count(*) >= 3)
      SELECT a, b, common, round(common / (x.k + y.k - common), 6) AS jaccard FROM p JOIN sz x ON x.book_id = a JOIN sz y ON y.book_id = b""",
    "topics_by_dimension": "SELECT CASE WHEN grouping(educational_level) = 0 THEN 'level' WHEN grouping(domain) = 0 THEN 'domain' ELSE 'core' END AS dimension, educational_level, domain, is_core, count(*) AS topics FROM subtopics GROUP BY GROUPING SETS ((educational_level), (domain), (is_core))",
    "curriculum_statistics": "SELECT count(*) AS topics, sum(is_core::INT)::BIGINT AS core, sum(duration_hours)::BIGINT AS hours, round(avg(difficulty), 6) AS mean_difficulty, max(depth_level) AS deepest, count(DISTINCT domain) AS domains, sum((len(coalesce(prerequisites, [])) > 0)::INT)::BIGINT AS with_prerequisites FROM subtopics",
    "duplicate_documents": "SELECT doc_id, content_hash, copies, is_primary FROM (SELECT doc_id, md5(text) AS content_hash, count(*) OVER (PARTITION BY md5(text)) AS copies, row_number() OVER (PARTITION BY md5(text) ORDER BY added_at NULLS LAST, doc_id) = 1 AS is_primary FROM documents WHERE text IS NOT NULL) WHERE copies > 1",
    "duplicate_names": "SELECT book_id, name_key, copies, is_primary FROM (SELECT book_id, k AS name_key, count(*) OVER (PARTITION BY k) AS copies, row_number() OVER (PARTITION BY k ORDER BY extracted_at NULLS LAST, book_id) = 1 AS is_primary FROM (SELECT *, replace(replace(lower(book_title), '-', ''), '_', '') AS k FROM book_tocs)) WHERE copies > 1",
    "merge_topics": f"""WITH t AS (SELECT *, {_BASE} AS base FROM subtopics), u AS (SELECT * FROM t WHERE base <> ''), dom AS (SELECT base, arg_max(domain, (n, domain)) AS domain FROM (SELECT base, domain, count(*) AS n FROM u WHERE domain IS NOT NULL GROUP BY ALL) GROUP BY base)
      SELECT base, arg_max(name, (length(name), name)) AS name, array_to_string(list_sort(list_distinct(list(educational_level))), ',') AS levels, count(*) AS members, array_to_string(list_sort(list_distinct(flatten(list(coalesce(prerequisites, []))))), '|') AS prerequisites,
        max(depth_level) AS depth, greatest(1, floor(avg(duration_hours))::INT) AS hours, avg(is_core::INT) > 0.5 AS is_core, any_value(dom.domain) AS domain FROM u LEFT JOIN dom USING (base) GROUP BY base""",
    "new_topic_entries": f"WITH {D.CURRENT} SELECT row_id, book_id, title FROM (SELECT *, row_number() OVER (PARTITION BY lower(title) ORDER BY book_id, row_id) AS k FROM cur WHERE title <> '') WHERE k = 1",
    "foundational_books": f"""WITH {D.CURRENT}, s AS (SELECT b.book_id, discipline, {D.level('b.level')} AS level_std, n AS entries FROM (SELECT book_id, count(*) AS n FROM cur GROUP BY 1) JOIN book_tocs b USING (book_id) WHERE discipline IS NOT NULL)
      SELECT discipline, book_id, level_std, entries FROM (SELECT *, row_number() OVER (PARTITION BY discipline ORDER BY CASE level_std WHEN 'high_school' THEN 0 WHEN 'undergraduate' THEN 1 ELSE 2 END, entries DESC, book_id) AS k FROM s) WHERE k = 1""",
    "extraction_metrics": f"WITH {D.CURRENT}, n AS (SELECT book_id, count(*) AS entries FROM cur GROUP BY 1) SELECT count(*) AS books, count(entries) AS successful, sum(coalesce(entries, 0))::BIGINT AS entries, round(count(entries) / count(*), 6) AS success_rate, round(sum(entries) / count(entries), 6) AS mean_entries FROM book_tocs LEFT JOIN n USING (book_id)",
    "raw_topics": f"""WITH {D.CURRENT}, c AS (SELECT row_id, {_CLEAN} AS c, {D.level('b.level')} AS book_level FROM cur JOIN book_tocs b USING (book_id) WHERE cur.title IS NOT NULL), t AS (SELECT row_id, book_level, CASE WHEN lower(c) <> c AND upper(c) <> c THEN c ELSE {D.initcap('c')} END AS topic FROM c)
      SELECT row_id, topic, book_level, {D.first('lower(topic)', L.DOMAINS_FIRST, "'general'")} AS domain FROM t WHERE length(topic) > 2""",
    "domain_first": f"SELECT subtopic_id, {D.first('lower(description)', L.DOMAINS_FIRST, chr(39) + 'general' + chr(39))} AS domain FROM subtopics",
    "domain_most": f"SELECT subtopic_id, {D.most('lower(description)', L.DOMAINS_MOST, chr(39) + 'general' + chr(39))} AS domain FROM subtopics",
    "bloom_level": f"SELECT subtopic_id, coalesce({D.most('t', L.BLOOM)}, CASE WHEN {D.any_of('t', ['problem', 'calculation', 'solve'])} THEN 'Apply' ELSE 'Understand' END) AS bloom_level FROM (SELECT subtopic_id, {_OBJ} AS t FROM subtopics)",
    "difficulty_class": f"SELECT subtopic_id, CASE WHEN {D.any_of('t', L.HARD_WORDS)} OR n > 5 OR dep > 4 THEN 'Advanced' WHEN {D.any_of('t', L.EASY_WORDS)} OR n = 0 OR dep <= 2 THEN 'Introductory' ELSE 'Intermediate' END AS difficulty_class FROM (SELECT subtopic_id, lower(name) AS t, coalesce(len(prerequisites), 0) AS n, coalesce(depth_level, 0) AS dep FROM subtopics)",
    "application_domains": "SELECT subtopic_id, CASE WHEN len(l) > 0 THEN array_to_string(l, ',') ELSE 'Education' END AS domains FROM (SELECT subtopic_id, list_sort(list_filter([" + ", ".join(f"CASE WHEN {D.any_of('t', ws)} THEN {D.quote(k)} END" for k, ws in L.APPLICATIONS.items()) + "], lambda x: x IS NOT NULL)) AS l FROM (SELECT subtopic_id, lower(concat_ws(' ', name, description)) AS t FROM subtopics))",
    "rare_topic_class": f"WITH {D.CURRENT}, {_RARE} SELECT book_id, round(rare, 6) AS rare, CASE WHEN rare > 0.3 THEN 'elective' ELSE 'core' END AS by_frequency, round(CASE WHEN rare > 0.3 THEN least(0.8, rare) ELSE 0.7 END, 6) AS frequency_confidence FROM rare",
    "vote_classify": f"""WITH {D.CURRENT}, {_TOCTEXT}, {_RARE}, v AS (SELECT bk.book_id, CASE WHEN {_ELTOP} > 0 THEN 'elective' ELSE 'core' END AS by_keywords, CASE WHEN {_ELTOP} > 0 THEN least(0.9, {_ELTOP} / 10.0::DOUBLE) ELSE 0.8 END AS kc,
        CASE WHEN {_ELTOP} = 0 THEN NULL {' '.join(f"WHEN {c} = {_ELTOP} THEN {D.quote(L.ELECTIVE_DOMAIN[k])}" for k, c in _EL.items())} END AS domain,
        CASE WHEN rare > 0.3 THEN 'elective' ELSE 'core' END AS by_frequency, CASE WHEN rare IS NULL THEN 0.5 WHEN rare > 0.3 THEN least(0.8, rare) ELSE 0.7 END AS fc,
        CASE WHEN level = 'graduate' AND {D.count('title', L.GRADUATE_WORDS)} > 0 THEN 'elective' ELSE 'core' END AS by_level, CASE WHEN level = 'graduate' AND {D.count('title', L.GRADUATE_WORDS)} > 0 THEN least(0.7, {D.count('title', L.GRADUATE_WORDS)} / 3.0::DOUBLE) ELSE 0.6 END AS lc
        FROM bk LEFT JOIN rare USING (book_id)),
      m AS (SELECT *, CASE WHEN (by_keywords = 'elective')::INT + (by_frequency = 'elective')::INT + (by_level = 'elective')::INT >= 2 THEN 'elective' ELSE 'core' END AS classification FROM v)
      SELECT book_id, by_keywords, by_frequency, by_level, domain, classification, round((CASE WHEN by_keywords = classification THEN kc ELSE 0 END + CASE WHEN by_frequency = classification THEN fc ELSE 0 END + CASE WHEN by_level = classification THEN lc ELSE 0 END)
        / ((by_keywords = classification)::INT + (by_frequency = classification)::INT + (by_level = classification)::INT), 6) AS confidence FROM m""",
    "discipline_scores": f"WITH {D.CURRENT} SELECT book_id, discipline, sum(n)::BIGINT AS score, round(least(sum(n) / 10.0::DOUBLE, 1.0), 6) AS confidence FROM ({_DISC}) GROUP BY ALL HAVING sum(n) >= 2",
    "level_map": f"SELECT level, {D.level('level')} AS standard, count(*) AS books FROM book_tocs GROUP BY ALL",
    "source_catalog": "SELECT lower(trim(source)) AS source, count(*) AS documents, sum(n_chars)::BIGINT AS chars, min(added_at) AS first_added, max(added_at) AS last_added, count(DISTINCT chunk_type) AS chunk_types FROM documents GROUP BY 1",
    "pdf_status": "SELECT count(*) AS runs, sum(success::INT)::BIGINT AS successful, count(DISTINCT file_hash) AS files, sum((r = 1 AND success)::INT)::BIGINT AS files_done, round(avg(processing_time), 6) AS mean_seconds, sum(CASE WHEN r = 1 THEN processed_pages END)::BIGINT AS pages FROM (SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY success DESC NULLS LAST, processed_date DESC NULLS LAST, pdf_id DESC) AS r FROM pdf_results)",
}

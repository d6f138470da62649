"""Headings and chunks from texts: Markdown, reStructuredText and LaTeX headings, heading lines of plain text, TOC sections."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import hierarchy

LINE_BREAK = r"\r?\n"


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos (from 0), line (trimmed) of every line."""
    return df.select(F.col(key), F.posexplode(F.split(text, LINE_BREAK)).alias("pos", "line")).withColumn("line", F.regexp_replace("line", r"^\s+|\s+$", ""))


def markdown_headings(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, level, title of lines that begin with 1 to 6 number signs."""
    level = F.char_length(F.regexp_extract("line", r"^(#{1,6})\s+(.+)$", 1))
    return lines(df, key, text).where(F.col("line").rlike(r"^#{1,6}\s+.+$")).select(key, "pos", level.alias("level"), F.trim(F.regexp_extract("line", r"^(#{1,6})\s+(.+)$", 2)).alias("title"))


RST_LEVELS = {"=": 1, "-": 2, "~": 3, "^": 4, '"': 5}  # fixed values


def rst_headings(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, level, title of lines underlined by a run of one mark at least as long as the line."""
    all_lines = F.split(text, LINE_BREAK)
    pairs = F.transform(F.arrays_zip(F.slice("l", 1, F.size("l") - 1).alias("title"), F.slice("l", 2, F.size("l")).alias("under")), lambda x: x)
    e = df.select(F.col(key), all_lines.alias("l")).where(F.size("l") > 1).select(key, F.posexplode(pairs).alias("pos", "p"))
    title, under = F.trim(F.col("p.title")), F.rtrim(F.col("p.under"))
    mark = F.substring(under, 1, 1)
    level = F.create_map(*[F.lit(x) for kv in RST_LEVELS.items() for x in kv])[mark]
    ok = (title != "") & under.rlike(r'^(=+|-+|~+|\^+|"+)$') & (F.char_length(under) >= F.char_length(title)) & ~title.rlike(r'^(=+|-+|~+|\^+|"+)$')
    return e.where(ok).select(key, "pos", level.alias("level"), title.alias("title"))


LATEX_LEVELS = {"part": 1, "chapter": 2, "section": 3, "subsection": 4, "subsubsection": 5, "paragraph": 6, "subparagraph": 7}  # fixed values


def latex_headings(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, level, title of sectioning commands in the order of the text."""
    pattern = r"\\(part|chapter|section|subsection|subsubsection|paragraph|subparagraph)\*?\{([^}]+)\}"
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("kind"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("title"))
    level = F.create_map(*[F.lit(x) for kv in LATEX_LEVELS.items() for x in kv])
    return df.select(F.col(key), F.posexplode(both).alias("pos", "h")).select(key, "pos", level[F.col("h.kind")].alias("level"), F.trim("h.title").alias("title"))


#: Forms of heading lines in their order, the first that matches wins; without regard to case.
HEADING_FORMS = [
    r"^(?:Chapter\s+)?(\d+)[\.\:\s]+(.+?)(?:\s+\d+\s*)?$",
    r"^(Chapter\s+\d+[\.\:\s]+.+?)(?:\s+\d+\s*)?$",
    r"^(\d+\.\s+.+?)(?:\s+\d+\s*)?$",
    r"^(\d+\.\d+\s+.+?)(?:\s+\d+\s*)?$",
    r"^(\d+\.\d+\.\d+\s+.+?)(?:\s+\d+\s*)?$",
    r"^(Part\s+[IVX]+[\.\:\s]+.+?)(?:\s+\d+\s*)?$",
    r"^(Unit\s+\d+[\.\:\s]+.+?)(?:\s+\d+\s*)?$",
    r"^(Appendix\s+[A-Z][\.\:\s]+.+?)(?:\s+\d+\s*)?$",
    r"^([A-Z][A-Z\s&\-]{3,50})(?:\s+\d+\s*)?$",
    r"^([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,8})(?:\s+\d+\s*)?$",
]
SKIP_WORDS = ["page", "continued", "see also", "figure", "table", "index"]  # fixed values
UNIT_WORDS = ["chapter", "part", "unit"]  # fixed values


def heading_lines(df: DataFrame, key: str, text: str, least: int = 5, most: int = 150) -> DataFrame:
    """key, pos, form, level, title, page_number of lines that look like headings; lines with a skip word are none.

    The title keeps its number. Numbered sections of three parts are of level 3, of two of level 2; general headings are of
    level 2 unless they name a chapter, part or unit; all else is of level 1.
    """
    line = F.col("line")
    ok = F.char_length(line).between(least, most) & ~F.lower(line).rlike("|".join(SKIP_WORDS))
    form, title = F.when(F.lit(False), 0), F.when(F.lit(False), "")
    for i, pattern in enumerate(HEADING_FORMS):
        hit = line.rlike("(?i)" + pattern)
        first = F.regexp_extract(line, "(?i)" + pattern, 1)
        form = form.when(hit, i)
        title = title.when(hit, _strip(first if i else F.concat(first, F.lit(" "), F.regexp_extract(line, "(?i)" + pattern, 2))))
    page = F.regexp_extract(line, r"(?:^|[^\p{L}\p{N}_])(\d+)\s*$", 1)
    found = lines(df, key, text).where(ok).select(key, "pos", form.alias("form"), title.alias("title"), page.alias("page"))
    dots = F.char_length("title") - F.char_length(F.replace(F.col("title"), F.lit("."), F.lit("")))
    general = F.lower("title").rlike("|".join(UNIT_WORDS))
    level = F.when(F.col("form").between(3, 4), F.when(dots >= 2, 3).otherwise(2)).when(F.col("form") >= 8, F.when(general, 1).otherwise(2)).otherwise(1)
    return found.where("form is not null").select(key, "pos", "form", level.alias("level"), "title", F.expr("try_cast(nullif(page, '') as int)").alias("page_number"))


XML_KINDS = {"title": 1, "chapter": 1, "section": 2, "subsection": 3, "h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6}  # fixed values


def xml_headings(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, level, title of the elements of an XML text that hold titles: kind by kind, each title once, the first wins.

    Texts that are not well formed have none; name spaces do not count.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, xml in zip(pdf["key"], pdf["text"]):
                try:
                    root = ElementTree.fromstring(xml)
                except ElementTree.ParseError:
                    continue
                by: dict[str, list[str]] = {}
                for e in root.iter():
                    if e is not root and e.text and e.text.strip():
                        by.setdefault(e.tag.rsplit("}", 1)[-1], []).append(e.text.strip())
                seen: dict[str, int] = {}
                for name, level in XML_KINDS.items():
                    for title in by.get(name, ()):
                        seen.setdefault(title, level)
                rows += [(k, i, level, title) for i, (title, level) in enumerate(seen.items())]
            yield pd.DataFrame(rows, columns=["key", "pos", "level", "title"])

    base = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    return base.mapInPandas(run, f"key {kind}, pos int, level int, title string").withColumnRenamed("key", key)


def headings(found: DataFrame) -> DataFrame:
    """path, pos, level, title of files (path, format, content) by their format: Markdown, reStructuredText, LaTeX, XML.

    Formats without a reader give no rows.
    """
    text = found.select("path", "format", F.decode("content", "UTF-8").alias("text"))
    of = lambda fmt, fn: fn(text.where(F.col("format") == fmt), "path", "text").select("path", "pos", "level", "title")
    return of("markdown", markdown_headings).unionByName(of("rst", rst_headings)).unionByName(of("latex", latex_headings)).unionByName(of("xml", xml_headings))


OBJECTIVES = r"(?is)Section Learning Objectives[:\s]*By the end of this section[,\s]*you will be able to do the following:(.*?)(?:Teacher Support|Section Key Terms|\n\n|$)"  # fixed values
KEY_TERMS = r"(?is)Section Key Terms[:\s]*(.*?)(?:Teacher Support|\n\n|$)"
HEADER = r"(?m)^([A-Z][^:\n]{10,80})(?:\s|$)"
NO_HEADERS = ["teacher support", "section learning", "key terms"]
COMMON_TERMS = ["the", "and", "for", "with", "this", "that"]


def section_entries(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, level, pos, title that the text of a section gives where no table of contents does.

    Objectives of more than 10 characters, cut at 100, are of level 2; of the first five header lines those without skip
    words of level 3; the first ten key terms of more than 3 characters of level 4.
    """
    c = F.col(text)
    points = F.transform(F.split(F.regexp_extract(c, OBJECTIVES, 1), r"(?:^|\n)\s*[•·\-*]?\s*"), _strip)
    goals = F.transform(F.filter(points, lambda x: F.char_length(x) > 10), lambda x: F.when(F.char_length(x) > 100, F.concat(F.substring(x, 1, 100), F.lit("..."))).otherwise(x))
    heads = F.filter(F.slice(F.regexp_extract_all(c, F.lit(HEADER), F.lit(1)), 1, 5), lambda x: ~F.lower(x).rlike("|".join(NO_HEADERS)))
    words = F.slice(F.filter(F.split(_strip(F.regexp_extract(c, KEY_TERMS, 1)), r"\s+"), lambda x: (F.char_length(x) > 3) & ~F.lower(x).isin(COMMON_TERMS)), 1, 10)
    kinds = [(2, goals), (3, F.transform(heads, _strip)), (4, F.transform(words, lambda x: F.concat(F.lit("Key Term: "), x)))]
    tagged = lambda n: lambda x, i: F.struct(F.lit(n).alias("level"), i.alias("pos"), x.alias("title"))
    rows = F.concat(*[F.transform(a, tagged(n)) for n, a in kinds])
    return df.where(c.isNotNull()).select(F.col(key), F.inline(rows))


def listed_entries(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, level, title, page_number of a table of contents given as plain lines: level by indentation, without prefixes and page numbers.

    Titles of fewer than 4 characters do not count.
    """
    e = df.where(F.col(text).isNotNull()).select(F.col(key), F.posexplode(F.split(text, r"\r\n|\n|\r")).alias("pos", "line"))
    body = _strip(F.col("line"))
    title = _strip(F.regexp_replace(F.regexp_replace(body, r"(?i)^(chapter|section|part|unit)\s*\d+[:\-.]?\s*", ""), r"[.\s]*\d+$", ""))
    indent = F.char_length(F.regexp_extract("line", r"^(\s*)", 1))
    page = F.regexp_extract(body, r"(?:^|[^\p{L}\p{N}_])(\d+)$", 1)
    out = e.select(key, "pos", F.when(indent >= 8, 3).when(indent >= 4, 2).otherwise(1).alias("level"), title.alias("title"), page.alias("p"))
    return out.where(F.char_length("title") > 3).select(key, "pos", "level", "title", F.expr("try_cast(nullif(p, '') as int)").alias("page_number"))


def occurrences(df: DataFrame, key: str, text: str, word: str, most: int = 5, around: int = 100) -> DataFrame:
    """key, pos (from 1), context of the first places of a word, overlapping ones too, without regard to case."""
    w = word.lower().replace("\\", "\\\\").replace("'", "\\'")
    nxt = f"locate('{w}', lower(t), coalesce(element_at(a, -1), 0) + 1)"
    at = F.expr(f"aggregate(sequence(1, {most}), cast(array() as array<int>), (a, x) -> if(size(a) = x - 1 and {nxt} > 0, concat(a, array({nxt})), a))".replace("element_at(a, -1)", "try_element_at(a, -1)"))
    hits = df.select(F.col(key), F.col(text).alias("t")).where(F.lower("t").contains(word.lower())).select(key, "t", F.explode(at).alias("pos"))
    start = F.greatest(F.lit(1), F.col("pos") - around)
    return hits.select(key, "pos", F.substring(F.col("t"), start, F.col("pos") - start + len(word) + around).alias("context"))


def depth_first(rows: DataFrame, order: str = "row_id") -> DataFrame:
    """book_id, entry_id, depth, place: the sort key that puts entries depth first, siblings in the order of a column.

    place is the array of the orders on the way from the root; arrays sort as entries are read. Only entries that reach a root.
    """
    links = hierarchy.latest_links(rows, keep=(order,))
    r = hierarchy.resolve(links, keep=(order,), paths=True).where("status = 'root'")
    own = r.select("grp", F.col("key").alias("step"), F.col(order).alias("o"))
    steps = r.select("grp", "key", "depth", F.posexplode("path").alias("i", "step")).join(own, ["grp", "step"])
    way = F.transform(F.array_sort(F.collect_list(F.struct("i", "o"))), lambda x: x["o"])  # as long as the depth of the entry
    return steps.groupBy("grp", "key").agg(F.max("depth").alias("depth"), way.alias("place")).select(F.col("grp").alias("book_id"), F.col("key").alias("entry_id"), "depth", "place")


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def chunks(df: DataFrame, key: str, text: str, longest: int = 1000, overlap: int = 100) -> DataFrame:
    """key, section_index, total_sections, chunk_type, chunk: paragraphs packed greedily up to `longest` characters.

    A text within the limit is one full_chapter chunk. A chunk after the first begins with the last `overlap` characters
    of the one before and a blank line. The separator does not count, and a single longer paragraph stays whole; see the
    splitting operator for hard limits. Blank texts have no chunks.
    """
    paragraphs = F.filter(F.transform(F.split(text, "\n\n"), _strip), lambda p: p != "")
    start = F.struct(F.lit("").alias("cur"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, p: Column) -> Column:
        cur, out = acc["cur"], acc["out"]
        full = (cur != "") & (F.char_length(cur) + F.char_length(p) > longest)
        tail = F.when((F.lit(overlap) > 0) & (F.char_length(cur) > overlap), F.concat(F.substring(cur, -overlap, overlap), F.lit("\n\n"), p)).otherwise(p)
        new = F.when(full, tail).when(cur != "", F.concat(cur, F.lit("\n\n"), p)).otherwise(p)
        return F.struct(new.alias("cur"), F.when(full, F.concat(out, F.array(_strip(cur)))).otherwise(out).alias("out"))

    packed = F.aggregate(paragraphs, start, add, lambda acc: F.concat(acc["out"], F.filter(F.array(_strip(acc["cur"])), lambda c: c != "")))
    base = df.where(F.col(text).isNotNull() & (_strip(F.col(text)) != ""))
    whole = F.char_length(text) <= longest
    parts = base.select(F.col(key), F.when(whole, F.array(F.col(text))).otherwise(packed).alias("parts"), F.when(whole, "full_chapter").otherwise("chapter_section").alias("chunk_type"))
    return parts.select(key, "chunk_type", F.size("parts").alias("total_sections"), F.posexplode("parts").alias("section_index", "chunk"))


CONTENTS = r"(?i)(^|[^\p{L}\p{N}_])(table\s+of\s+)?contents?([^\p{L}\p{N}_]|$)"
AFTER = ["preface", "introduction", "chapter 1", "part i", "acknowledgments"]  # fixed values


def contents_section(df: DataFrame, key: str, text: str, most: int = 20) -> DataFrame:
    """key, pos, line of the lines after a contents heading, up to a line that begins the book or `most` lines.

    Lines shorter than 5 characters do not count.
    """
    all_lines = F.transform(F.split(text, LINE_BREAK), _strip)
    begin = F.array_min(F.filter(F.transform("l", lambda x, i: F.when(x.rlike(CONTENTS), i)), lambda x: x.isNotNull()))
    after = F.filter(F.slice("l", F.col("b") + 2, F.size("l")), lambda x: (F.char_length(x) >= 5) & ~x.rlike(CONTENTS))
    stop = F.array_min(F.filter(F.transform("a", lambda x, i: F.when(F.lower(x).rlike("|".join(AFTER)), i)), lambda x: x.isNotNull()))
    base = df.select(F.col(key), all_lines.alias("l")).select(key, "l", begin.alias("b")).where("b is not null").select(key, after.alias("a"))
    return base.select(key, F.posexplode(F.slice("a", 1, F.least(F.lit(most), F.coalesce(stop, F.lit(most))))).alias("pos", "line"))

"""Books and chapters from files: format detection, text of each format, chunk files and folder scans.

Readers are binaryFile or text scans with column expressions; XML and EPUB packages, which Spark SQL cannot open, are parsed
file by file in Arrow batches.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T

FORMATS = {"pdf": ["pdf"], "epub": ["epub"], "xml": ["xml", "cnxml"], "latex": ["tex", "latex"], "markdown": ["md", "markdown"], "html": ["html", "htm", "xhtml"], "rst": ["rst"], "json": ["json", "jsonl"]}


def detect_format(path: Column) -> Column:
    """The format of a file by its extension; unknown where it says nothing."""
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z]+)$", 1))
    out = F.when(F.lit(False), F.lit(""))
    for name, kinds in FORMATS.items():
        out = out.when(ext.isin(kinds), name)
    return out.otherwise("unknown")


def is_pdf(content: Column) -> Column:
    """Whether bytes can be a PDF: at least 1 KB that begin with its magic."""
    return (F.octet_length(content) >= 1024) & (F.substring(content, 1, 5) == F.lit(bytearray(b"%PDF-")))


def files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, format, content, size of all files below a folder."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return raw.select("path", detect_format(F.col("path")).alias("format"), "content", F.col("length").alias("size"))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _squeeze(s: str) -> str:
    return re.sub(r"\s+", " ", s).strip()


def xml_chapters(data: bytes) -> list[tuple[str, str]]:
    """(title, text) of the chapters or modules of an XML document, else of the whole document; none if it is not well formed."""
    try:
        root = ElementTree.fromstring(data)
    except ElementTree.ParseError:
        return []
    found = [e for e in root.iter() if _local(e.tag) in ("chapter", "module", "section") and not any(_local(x.tag) in ("chapter", "module") for x in e.iter() if x is not e)]
    out = []
    for e in found or [root]:
        title = next((_squeeze("".join(x.itertext())) for x in e.iter() if _local(x.tag) == "title"), "Content")
        out.append((title, _squeeze(" ".join(e.itertext()))))
    return out


def epub_chapters(data: bytes) -> list[tuple[str, str]]:
    """(title, text) of every document of an EPUB package, in the order of names."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            pages = [(n, z.read(n).decode("utf-8", "replace")) for n in sorted(z.namelist()) if n.lower().endswith((".html", ".xhtml", ".htm"))]
    except zipfile.BadZipFile:
        return []
    out = []
    for name, page in pages:
        title = re.search(r"(?is)<(?:title|h1)[^>]*>(.*?)</(?:title|h1)>", page)
        body = re.sub(r"(?is)<(script|style|title)\b.*?</\1>", " ", page)
        out.append((_squeeze(re.sub(r"<[^>]+>", "", title[1])) if title else name, _squeeze(re.sub(r"<[^>]+>", " ", body))))
    return out


def chapters_of(found: DataFrame) -> DataFrame:
    """path, format, number, title, content of the chapters of files(): text formats by expressions, packages by parsing.

    Markdown, HTML and LaTeX files are one chapter each. Formats that need a reader of their own (PDF) give no rows here.
    """
    text = F.decode("content", "UTF-8")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    chain = {"markdown": T.MARKDOWN, "html": T.HTML, "latex": T.LATEX}
    plain = None
    for kind, rules in chain.items():
        one = found.where(F.col("format") == kind).select("path", "format", F.lit("1").alias("number"), name.alias("title"), T.apply_chain(text, rules).alias("content"))
        plain = one if plain is None else plain.unionByName(one)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, kind, data in zip(pdf["path"], pdf["format"], pdf["content"]):
                chapters = xml_chapters(bytes(data)) if kind == "xml" else epub_chapters(bytes(data))
                rows += [(path, kind, str(i + 1), t, c) for i, (t, c) in enumerate(chapters)]
            yield pd.DataFrame(rows, columns=["path", "format", "number", "title", "content"])

    packed = found.where(F.col("format").isin("xml", "epub")).select("path", "format", "content").mapInPandas(parse, "path string, format string, number string, title string, content string")
    return plain.unionByName(packed)


CHUNK = "discipline string, language string, level string, book_title string, book_format string, source_path string, chunk_id int, chapter_number string, chapter_title string, chunk_type string, text string, formulas array<string>, content_hash string, section_index int, total_sections int"


def chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """Chunk records of JSON lines; malformed lines are left out."""
    return spark.read.schema(CHUNK).option("mode", "DROPMALFORMED").json(path)


def book_folders(spark: SparkSession, folder: str) -> DataFrame:
    """path, language, discipline, level, file of Books/<language>/<discipline>/<level>/..., README files left out."""
    found = files(spark, folder).select("path", "format", "size")
    part = lambda i: F.element_at(F.split("path", "/"), i)
    tail = F.split(F.regexp_extract("path", r"/Books/(.*)$", 1), "/")
    return found.where(F.size(tail) >= 4).where(~F.lower(part(-1)).startswith("readme")).select("path", "format", "size", F.get(tail, F.lit(0)).alias("language"), F.get(tail, F.lit(1)).alias("discipline"), T.level_name(F.get(tail, F.lit(2))).alias("level"), part(-1).alias("file"))


def page_ranges(pdfs: DataFrame, pages: int) -> DataFrame:
    """Fixed page ranges of documents: pdf_id, chunk_index, start_page, end_page (both counted from 1)."""
    starts = F.sequence(F.lit(0), F.greatest(F.col("total_pages") - 1, F.lit(0)), F.lit(pages))
    each = pdfs.where("total_pages > 0").select("pdf_id", "total_pages", F.posexplode(starts).alias("chunk_index", "start"))
    return each.select("pdf_id", "chunk_index", (F.col("start") + 1).alias("start_page"), F.least(F.col("start") + pages, F.col("total_pages")).alias("end_page"))

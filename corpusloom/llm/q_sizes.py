"""Queries on splitting (p2), packing (p6) and mixing (p7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.llm import mixing, packing, split
from corpusloom.sources.tables import table


def _texts(spark, d, **options):
    """Pieces of chapters and PDFs with their kind's limits."""
    limits = table(spark, d, "split_limits")
    out = []
    for kind, name, key, text in (("chapter", "chapters", "chapter_id", "content"), ("pdf", "pdf_results", "pdf_id", "full_text")):
        own = F.broadcast(limits.where(F.col("record_kind") == kind))  # two rows in all
        rows = table(spark, d, name).select(F.col(key).alias("record_id"), F.col(text).alias("full")).join(own)
        out.append(split.split(rows, "record_id", "full", "max_chars", "overlap_chars", **options).select(F.lit(kind).alias("record_kind"), "*"))
    return out[0].unionByName(out[1])


def p2_found(spark, d):
    """The coarsest boundary that cuts each oversized text."""
    pieces = _texts(spark, d, with_text=False, oversized_only=True)
    return pieces.where("piece = 0").select("record_kind", "record_id", "coarsest_cut")


def p2_pieces(spark, d):
    """All pieces of all texts."""
    return _texts(spark, d)


def _items(spark, d):
    return table(spark, d, "documents").select("doc_id", packing.token_count("text").alias("size"))


def p6_found(spark, d):
    """Documents that a kind of container cannot hold whole: those that the packing cut."""
    placed = packing.place(_items(spark, d), table(spark, d, "containers"), size="size")
    return placed.where("piece = 1").select("container_kind", "doc_id")


def p6_placed(spark, d):
    """The container of every document and piece."""
    return packing.place(_items(spark, d), table(spark, d, "containers"), size="size")


def p6_fill(spark, d):
    """Containers, tokens and fill per kind."""
    containers = table(spark, d, "containers")
    return packing.report(packing.place(_items(spark, d), containers, size="size"), containers)


def _mix(spark, d):
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_found(spark, d):
    """Sources that cannot fill their share of a mix."""
    return _mix(spark, d)[1].where("short").select("mix_id", "source")


def p7_shares(spark, d):
    """Wanted and actual shares of all sources in all mixes."""
    return _mix(spark, d)[1].select("mix_id", "source", "target_share", "available_tokens", "taken_tokens", F.round("actual_share", 9).alias("actual_share"))


def p7_mixes(spark, d):
    """Every use of a document in a mix."""
    return _mix(spark, d)[0].select("mix_id", "doc_id", "source", "pass", "tokens")


QUERIES = {"p2_found": p2_found, "p2_pieces": p2_pieces, "p6_found": p6_found, "p6_placed": p6_placed, "p6_fill": p6_fill, "p7_found": p7_found, "p7_shares": p7_shares, "p7_mixes": p7_mixes}

_STRETCH = r"list_max(list_transform(regexp_split_to_array(t, '{}'), lambda s: length(regexp_replace(s, '^[ \t\r\n\f]+|[ \t\r\n\f]+$', '', 'g'))))"

_MIX = r"""
docs AS (SELECT doc_id, lower(regexp_replace(source, '^\s+|\s+$', '', 'g')) AS source, strlen(text) + 1 AS tokens FROM documents),
tgt AS (SELECT mix_id, lower(regexp_replace(source, '^\s+|\s+$', '', 'g')) AS source, target_share, max_repeats, size_factor FROM mix_targets),
total AS (SELECT sum(tokens) AS total FROM docs),
per AS (SELECT source, sum(tokens) AS src_tokens FROM docs GROUP BY source),
q AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY md5('7-' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) AS cum FROM docs WHERE source IN (SELECT source FROM tgt)),
uses AS (SELECT t.mix_id, q.doc_id, q.source, u.pass, q.tokens, ((u.pass - 1) * p.src_tokens + q.cum) / t.target_share AS finish, t.size_factor * total AS budget
         FROM tgt t JOIN per p USING (source) JOIN q USING (source) CROSS JOIN total, LATERAL (SELECT unnest(range(1, t.max_repeats + 1)) AS pass) u),
ran AS (SELECT *, sum(tokens) OVER (PARTITION BY mix_id ORDER BY finish, source, doc_id ROWS UNBOUNDED PRECEDING) AS running FROM uses),
mixes AS (SELECT * FROM ran WHERE running <= budget),
shares AS (SELECT t.mix_id, t.source, t.target_share, coalesce(p.src_tokens * t.max_repeats, 0) AS available_tokens,
                  coalesce((SELECT sum(tokens) FROM mixes m WHERE m.mix_id = t.mix_id AND m.source = t.source), 0) AS taken_tokens, t.target_share * t.size_factor * total AS wanted
           FROM tgt t LEFT JOIN per p USING (source) CROSS JOIN total)
"""

SQL = {
    "p2_found": f"""
WITH raw AS (SELECT 'chapter' AS record_kind, chapter_id AS record_id, content AS t FROM chapters UNION ALL SELECT 'pdf', pdf_id, full_text FROM pdf_results),
big AS (SELECT r.*, max_chars FROM raw r JOIN split_limits USING (record_kind) WHERE length(t) > max_chars)
SELECT record_kind, record_id, CASE WHEN {_STRETCH.format(r'\r?\n([ \t\f]*\r?\n)+')} <= max_chars THEN 'paragraph'
  WHEN {_STRETCH.format(r'\r?\n')} <= max_chars THEN 'line' WHEN {_STRETCH.format(r'([ \t\f]|\r?\n)+')} <= max_chars THEN 'word' ELSE 'none' END AS coarsest_cut FROM big""",
    "p6_found": "SELECT container_kind, doc_id FROM documents, containers WHERE strlen(text) + 1 > capacity_tokens",
    "p7_found": "WITH" + _MIX + "SELECT mix_id, source FROM shares WHERE available_tokens < wanted",
    "p7_shares": "WITH" + _MIX + "SELECT mix_id, source, target_share, CAST(available_tokens AS BIGINT) AS available_tokens, CAST(taken_tokens AS BIGINT) AS taken_tokens, round(taken_tokens / nullif(sum(taken_tokens) OVER (PARTITION BY mix_id), 0), 9) AS actual_share FROM shares",
    "p7_mixes": "WITH" + _MIX + "SELECT mix_id, doc_id, source, pass, tokens FROM mixes",
}

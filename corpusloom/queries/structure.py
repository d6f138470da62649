"""Queries on hierarchies (p3) and nested records (p5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import hierarchy, shred
from corpusloom.sources.tables import table


def p3_found(spark, d):
    return hierarchy.findings(table(spark, d, "toc_entries"))


def p3_paths(spark, d):
    """Root, depth, path and number of descendants of every entry."""
    done = hierarchy.resolve(hierarchy.latest_links(table(spark, d, "toc_entries")), paths=True)
    return done.select(F.col("grp").alias("book_id"), F.col("key").alias("entry_id"), "status", "root_key", "depth", "descendants", F.array_join("path", "/").alias("path"))


def p3_descendants(spark, d):
    """Every entry with every entry below it, and how many steps are between."""
    done = hierarchy.resolve(hierarchy.latest_links(table(spark, d, "toc_entries")), paths=True)
    return hierarchy.descendants(done).withColumnRenamed("grp", "book_id")


def p5_found(spark, d):
    return shred.found(table(spark, d, "raw_records"))


def _p5_table(kind, leaves):
    def run(spark, d):
        columns = shred.shred(table(spark, d, "raw_records"), "raw_id", "payload")
        return shred.table(columns, kind, leaves).withColumnRenamed("key", "raw_id")

    run.__doc__ = f"The flat table of {kind} rows with their fields."
    return run


_TABLES = {
    "entries": ("entry", {"entry_id": "string", "title": "string", "level": "int", "page_number": "string", "section_number": "string"}),
    "pathways": ("pathway", {"pathway_id": "string", "name": "string", "learning_style": "string", "target_audience": "string", "estimated_duration_weeks": "double"}),
    "topics": ("topic", {}),
    "checkpoints": ("checkpoint", {"title": "string", "position": "int"}),
    "branches": ("branch", {}),
    "assessments": ("assessment", {"type": "string", "weight": "double"}),
}

QUERIES = {
    "p3_found": p3_found,
    "p3_paths": p3_paths,
    "p5_found": p5_found,
    "p3_descendants": p3_descendants,
    **{f"p5_{name}": _p5_table(kind, leaves) for name, (kind, leaves) in _TABLES.items()},
}

_LATEST = r"""
latest AS (
  SELECT coalesce(regexp_replace(book_id, '^[ \t]+|[ \t]+$', '', 'g'), '') AS book_id,
         coalesce(regexp_replace(entry_id, '^[ \t]+|[ \t]+$', '', 'g'), '') AS entry_id,
         nullif(regexp_replace(parent_id, '^[ \t]+|[ \t]+$', '', 'g'), '') AS parent_id, level, extracted_at
  FROM toc_entries),
cur AS (SELECT book_id, entry_id, any_value(parent_id) AS parent_id, any_value(level) AS level FROM (
          SELECT *, rank() OVER (PARTITION BY book_id, entry_id ORDER BY extracted_at DESC NULLS LAST) AS r FROM latest) WHERE r = 1
        GROUP BY ALL),
tops AS (SELECT c.*, CASE WHEN c.parent_id IS NULL THEN 'root' ELSE 'orphan' END AS top
         FROM cur c LEFT JOIN cur p ON p.book_id = c.book_id AND p.entry_id = c.parent_id
         WHERE c.parent_id IS NULL OR p.entry_id IS NULL),
reach AS (SELECT book_id, entry_id, level, 1 AS depth, top, entry_id AS root_key, entry_id AS path FROM tops
          UNION ALL
          SELECT c.book_id, c.entry_id, c.level, r.depth + 1, CASE r.top WHEN 'orphan' THEN 'under_orphan' ELSE r.top END, r.root_key, r.path || '/' || c.entry_id
          FROM reach r JOIN cur c ON c.book_id = r.book_id AND c.parent_id = r.entry_id),
stuck AS (SELECT c.* FROM cur c ANTI JOIN reach r ON r.book_id = c.book_id AND r.entry_id = c.entry_id),
above AS (SELECT book_id, entry_id, parent_id AS anc FROM stuck
          UNION
          SELECT a.book_id, a.entry_id, s.parent_id FROM above a JOIN stuck s ON s.book_id = a.book_id AND s.entry_id = a.anc),
loops AS (SELECT DISTINCT book_id, entry_id FROM above WHERE anc = entry_id)
"""

SQL = {
    "p3_found": "WITH RECURSIVE" + _LATEST + """
SELECT book_id, entry_id, 'on_cycle' AS finding FROM loops
UNION ALL SELECT s.book_id, s.entry_id, 'under_cycle' FROM stuck s ANTI JOIN loops l ON l.book_id = s.book_id AND l.entry_id = s.entry_id
UNION ALL SELECT book_id, entry_id, 'orphan' FROM tops WHERE top = 'orphan'
UNION ALL SELECT book_id, entry_id, 'wrong_level' FROM reach WHERE top = 'root' AND level IS NOT NULL AND level <> depth""",
    "p3_paths": "WITH RECURSIVE" + _LATEST + """,
pairs AS (SELECT book_id, entry_id, unnest(string_split(path, '/')) AS anc FROM reach),
loopless AS (SELECT s.* FROM stuck s ANTI JOIN loops l ON l.book_id = s.book_id AND l.entry_id = s.entry_id),
counts AS (SELECT book_id, anc AS entry_id, count(*) - 1 AS n FROM pairs GROUP BY ALL
           UNION ALL
           SELECT book_id, anc, count(*) FROM above SEMI JOIN loopless l ON l.book_id = above.book_id AND l.entry_id = above.anc GROUP BY ALL)
SELECT r.book_id, r.entry_id, r.top AS status, r.root_key, r.depth, c.n AS descendants, r.path FROM reach r JOIN counts c USING (book_id, entry_id)
UNION ALL
SELECT s.book_id, s.entry_id, 'on_cycle', NULL, NULL, NULL, NULL FROM loops s
UNION ALL
SELECT s.book_id, s.entry_id, 'under_cycle', NULL, NULL, coalesce(c.n, 0), NULL FROM loopless s LEFT JOIN counts c USING (book_id, entry_id)""",
}

def _els(v: str) -> str:
    """SQL for the elements of what stands for an array: parsed strings, lone elements, nothing for nulls and blanks."""
    n = rf"(CASE WHEN json_type({v}) = 'VARCHAR' AND regexp_matches({v}->>'$', '^\s*[\[{{]') AND json_valid({v}->>'$') THEN ({v}->>'$')::JSON WHEN json_type({v}) = 'VARCHAR' AND trim({v}->>'$') = '' THEN NULL ELSE {v} END)"
    return f"(CASE json_type({n}) WHEN 'ARRAY' THEN json_extract({n}, '$[*]') WHEN 'NULL' THEN []::JSON[] ELSE CASE WHEN {n} IS NULL THEN []::JSON[] ELSE [{n}] END END)"


_ELEMENTS = """
WITH RECURSIVE
doc AS (SELECT raw_id, CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM raw_records),
env AS (
  SELECT raw_id, j, 0 AS lv FROM doc WHERE json_type(j) = 'OBJECT'
  UNION ALL
  SELECT e.raw_id, v.value, e.lv + 1 FROM env e, json_each(e.j) v
  WHERE json_type(v.value) = 'OBJECT' AND NOT json_exists(e.j, '$.entries') AND NOT json_exists(e.j, '$.learning_pathways')),
rec AS (SELECT raw_id, arg_min(j, lv) AS j FROM env WHERE json_exists(j, '$.entries') OR json_exists(j, '$.learning_pathways') GROUP BY raw_id),
top AS (SELECT raw_id, 'entry' AS kind, '' AS parent_pos, j->'$.entries' AS v FROM rec UNION ALL SELECT raw_id, 'pathway', '', j->'$.learning_pathways' FROM rec),
tree AS (
  SELECT raw_id, kind, CAST(i AS VARCHAR) AS pos, parent_pos, x FROM (
    SELECT raw_id, kind, parent_pos, unnest(range(len(l))) AS i, unnest(l) AS x FROM (SELECT raw_id, kind, parent_pos, @V@ AS l FROM top))
  UNION ALL
  SELECT raw_id, kind, pos, parent_pos, x FROM (
    SELECT raw_id, kind, parent_pos || '.' || key || CAST(i AS VARCHAR) AS pos, parent_pos, x FROM (
      SELECT raw_id, kind, parent_pos, key, unnest(range(len(l))) AS i, unnest(l) AS x FROM (
        SELECT t.raw_id, c.kind, t.pos AS parent_pos, c.key, @C@ AS l FROM tree t, LATERAL (
          SELECT 'entry' AS kind, '' AS key, t.x->'$.children' AS v WHERE t.kind = 'entry' AND json_type(t.x) = 'OBJECT'
          UNION ALL SELECT 'topic', '', t.x->'$.topic_sequence' WHERE t.kind = 'pathway' AND json_type(t.x) = 'OBJECT'
          UNION ALL SELECT 'checkpoint', '', t.x->'$.checkpoints' WHERE t.kind = 'pathway' AND json_type(t.x) = 'OBJECT'
          UNION ALL SELECT 'assessment', '', t.x->'$.assessments' WHERE t.kind = 'checkpoint' AND json_type(t.x) = 'OBJECT'
          UNION ALL SELECT 'branch', u.k || '.', json_extract(t.x, '$.adaptive_branching."' || u.k || '"') FROM (SELECT unnest(json_keys(t.x->'$.adaptive_branching')) AS k WHERE t.kind = 'pathway' AND json_type(t.x->'$.adaptive_branching') = 'OBJECT') u) c)))
)
SELECT raw_id, kind, pos, parent_pos FROM tree WHERE json_type(x) <> 'NULL'
"""

SQL["p5_found"] = _ELEMENTS.replace("@V@", _els("v")).replace("@C@", _els("c.v"))

SQL["p3_descendants"] = "WITH RECURSIVE" + _LATEST + """
SELECT book_id, ancestor, entry_id AS descendant, depth - i AS distance FROM (
  SELECT book_id, entry_id, depth, unnest(string_split(path, '/')) AS ancestor, unnest(range(1, depth + 1)) AS i FROM reach)
WHERE i < depth"""

for _name, (_kind, _leaves) in _TABLES.items():
    _fields = "".join(f", try_cast(CASE WHEN json_type(x) = 'OBJECT' THEN x->>'$.{leaf}' END AS {kind.replace('string', 'VARCHAR')}) AS {leaf}" for leaf, kind in _leaves.items())
    SQL[f"p5_{_name}"] = SQL["p5_found"].replace("SELECT raw_id, kind, pos, parent_pos FROM tree", f"SELECT raw_id, pos, parent_pos, CASE WHEN json_type(x) <> 'OBJECT' THEN x->>'$' END AS value{_fields} FROM tree") + f" AND kind = '{_kind}'"

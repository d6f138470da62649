"""Queries on sequences, graphs and quality."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions import lexicons as L
from corpusloom.functions.text import GROUP_NAME, group_name
from corpusloom.operators import graph, quality, sequence, topics
from corpusloom.queries import duck as D
from corpusloom.sources.tables import table


def _u(spark, d):
    return sequence.units(table(spark, d, "subtopics"))


def _entries(spark, d):
    return topics.current_entries(table(spark, d, "toc_entries")).withColumn("parent_id", F.nullif(F.trim("parent_id"), F.lit("")))


def pedagogical_position(spark, d):
    return _u(spark, d).select("unit_id", F.col("pos").cast("long").alias("pos"))


def lag_prerequisites(spark, d):
    return sequence.previous_in_book(_entries(spark, d)).select("book_id", "entry_id", "position", "prerequisite")


def level_progression(spark, d):
    return sequence.progression(table(spark, d, "subtopics"), group_name(F.col("name")))


def transition_smoothness(spark, d):
    return sequence.smoothness(_u(spark, d))


def prerequisite_depth(spark, d):
    u = _u(spark, d)
    return sequence.prerequisite_depth(u, sequence.resolved_prerequisites(u)).select("unit_id", F.col("depth").cast("long").alias("depth"))


def prerequisite_violations(spark, d):
    """Prerequisites that come after the unit that needs them."""
    r = sequence.resolved_prerequisites(_u(spark, d))
    return r.where("prerequisite_pos > unit_pos").select("unit_id", "prerequisite_id")


def level_inversions(spark, d):
    """Pairs of entries of a book in which a deeper level comes before a higher one."""
    e = _entries(spark, d).where("level is not null")
    ordered = e.withColumn("o", F.row_number().over(W.partitionBy("book_id").orderBy("row_id")))
    return sequence.inversions(ordered, "book_id", "o", "level")


def elective_placement(spark, d):
    return sequence.elective_placement(_u(spark, d))


def checkpoints(spark, d):
    return sequence.checkpoints(_u(spark, d), 20).select(F.col("checkpoint").cast("long").alias("checkpoint"), F.col("position").cast("long").alias("position"), "units", "hours", "remedial")


def branching(spark, d):
    return sequence.branches(_u(spark, d)).select("unit_id", F.array_join(F.col("branches").cast("array<string>"), ",").alias("branches"))


def interleave(spark, d):
    return sequence.interleaved(_u(spark, d)).select("unit_id", "visual", F.col("place").cast("long").alias("place"))


def systematic_sample(spark, d):
    return sequence.systematic_sample(_u(spark, d), 100).select("unit_id", F.col("pos").cast("long").alias("pos"))


def stratified_sample(spark, d):
    return sequence.stratified_sample(_u(spark, d), 3)


def exam_pathway(spark, d):
    return sequence.exam_units(_u(spark, d)).select("unit_id", F.col("place").cast("long").alias("place"))


def accelerated_pathway(spark, d):
    return sequence.accelerated_units(_u(spark, d))


def recommendations(spark, d):
    return sequence.recommendations(_u(spark, d))


def pathway_diversity(spark, d):
    """1 less the mean Jaccard similarity of five pathways (all, core, accelerated, exam, visual)."""
    u = _u(spark, d)
    paths = [u.select("unit_id", F.lit("all").alias("p")), u.where("is_core").select("unit_id", F.lit("core").alias("p")), sequence.accelerated_units(u).select("unit_id", F.lit("accelerated").alias("p")), sequence.exam_units(u).select("unit_id", F.lit("exam").alias("p")), sequence.interleaved(u).where("visual").select("unit_id", F.lit("visual").alias("p"))]
    every = paths[0]
    for p in paths[1:]:
        every = every.unionByName(p)
    member = every.groupBy("unit_id").agg(F.collect_set("p").alias("in"))
    names = ["all", "core", "accelerated", "exam", "visual"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    both = [F.sum((F.array_contains("in", a) & F.array_contains("in", b)).cast("int")) / F.nullif(F.sum((F.array_contains("in", a) | F.array_contains("in", b)).cast("int")), F.lit(0)) for a, b in pairs]
    return member.agg((1 - sum(F.coalesce(x, F.lit(0.0)) for x in both) / len(pairs)).alias("x")).select(F.round("x", 6).alias("diversity"))


def sibling_edges(spark, d):
    return sequence.sibling_edges(_entries(spark, d))


def sibling_chain(spark, d):
    return sequence.sibling_edges(_entries(spark, d), first=False)


def _edges(spark, d):
    u = _u(spark, d)
    r = sequence.resolved_prerequisites(u)
    e = r.select(F.col("prerequisite_id").alias("src"), F.col("unit_id").alias("dst"), F.lit("explicit").alias("kind"), F.when(F.col("prerequisite_pos") < F.col("unit_pos"), 0.9).otherwise(0.6).alias("confidence"))
    return u, e


def prerequisite_edges(spark, d):
    return graph.last_wins(_edges(spark, d)[1], [F.col("confidence"), F.col("kind")])


def edge_statistics(spark, d):
    return graph.statistics(_edges(spark, d)[1])


def graph_properties(spark, d):
    u, e = _edges(spark, d)
    return graph.properties(u.select(F.col("unit_id").alias("id")), e)


def _planted(spark, d):
    """The prerequisite graph with the reverse of every edge whose source is divisible by 3, so that there are cycles."""
    u, e = _edges(spark, d)
    back = e.where("src % 3 = 0").select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit("planted").alias("kind"), F.lit(0.3).alias("confidence"))
    return u, e.unionByName(back)


def cyclic_core(spark, d):
    """Edges of the prerequisite graph with planted cycles that lie between or on cycles."""
    return graph.cyclic_core(_planted(spark, d)[1])


def acyclic_edges(spark, d):
    """The prerequisite graph with planted cycles, without the edges of its core that go back in the order of units."""
    u, e = _planted(spark, d)
    return graph.acyclic(e, u.select(F.col("unit_id").alias("id"), "pos")).select("src", "dst")


def topo_generations(spark, d):
    u, e = _edges(spark, d)
    dag = graph.acyclic(e, u.select(F.col("unit_id").alias("id"), "pos"))
    return graph.generations(u.select(F.col("unit_id").alias("id")), dag)


def most_referenced(spark, d):
    return graph.most_referenced(_edges(spark, d)[1])


def _domain_rules(spark, d):
    rules = spark.createDataFrame([(k, n) for k, v in L.DOMAIN_PREREQUISITES.items() for n in v], "domain string, needs string")
    from corpusloom.operators.lexicon import most_label

    t = _u(spark, d).select(F.col("unit_id").alias("id"), most_label(F.lower("title"), L.DOMAINS_MOST).alias("domain"), "pos").where("domain is not null")
    return t, rules


def domain_rule_edges(spark, d):
    return graph.rule_edges(*_domain_rules(spark, d)).select("src", "dst", "kind", "confidence")


def domain_rule_links(spark, d):
    """All prerequisites by domain rules, a row per topic and required domain with its number of edges."""
    return graph.rule_links(*_domain_rules(spark, d))


def domain_rule_members(spark, d):
    """The topics of every domain: with domain_rule_links, the edges from each topic of a required domain."""
    return _domain_rules(spark, d)[0].select("domain", "id", "pos")


def hierarchy_paths(spark, d):
    """Region, nation, segment and customer as paths of exactly six names."""
    r, n, c = table(spark, d, "region"), table(spark, d, "nation"), table(spark, d, "customer")
    p = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return p.select("c_custkey", F.array_join(graph.six_levels(F.array("r_name", "n_name", "c_mktsegment", "c_name")), " > ").alias("path"))


def hierarchy_stats(spark, d):
    """Nodes per region and depth of the paths of regions, nations, segments and customers."""
    r, n, c = table(spark, d, "region"), table(spark, d, "nation"), table(spark, d, "customer")
    p = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(F.array("r_name", "n_name", "c_mktsegment", "c_name").alias("full"))
    nodes = p.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: F.slice("full", 1, k))).alias("path")).distinct()
    return graph.level_stats(nodes.withColumn("top", F.get("path", F.lit(0))))


def _quality_topics(spark, d):
    t = table(spark, d, "subtopics")
    u = _u(spark, d).select(F.col("unit_id").alias("id"), "pos")
    return t.select(F.col("subtopic_id").alias("id"), F.col("name").alias("title"), F.col("educational_level").alias("level"), F.col("depth_level").alias("depth"), F.get("source_books", F.lit(0)).alias("book")).join(u, "id")


def quality_overall(spark, d):
    q = quality.overall(_quality_topics(spark, d))
    return q.select("total_topics", "unique_topics", *[F.round(c, 6).alias(c) for c in q.columns[2:]])


def quality_compare(spark, d):
    """Core topics against all topics."""
    t = _quality_topics(spark, d)
    core = t.join(table(spark, d, "subtopics").where("is_core").select(F.col("subtopic_id").alias("id")), "id", "left_semi")
    q = quality.compare(quality.overall(t), quality.overall(core))
    return q.select(*[F.round(c, 6).alias(c) if c != "winner" else F.col(c) for c in q.columns])


def toc_quality(spark, d):
    return quality.toc_quality(_entries(spark, d)).select("book_id", F.round("quality", 6).alias("quality"))


def sequence_quality(spark, d):
    u = _u(spark, d)
    linked = sequence.progression(table(spark, d, "subtopics"), group_name(F.col("name"))).where("previous is not null").select(F.col("subtopic_id").alias("id"))
    q = quality.sequence_quality(u, linked, sequence.smoothness(u), level_inversions(spark, d))
    return q.select(*[F.round(c, 6).alias(c) for c in q.columns])


def curriculum_quality(spark, d):
    q = quality.curriculum(_u(spark, d))
    return q.select(*[F.round(c, 6).alias(c) for c in q.columns])


def domain_ordering(spark, d):
    """How far units keep the order of domains that rules ask for."""
    rules = spark.createDataFrame([("energy", "dynamics"), ("optics", "energy"), ("acids", "energy"), ("optics", "acids")], "domain string, needs string")
    q = quality.ordering(_u(spark, d), rules)
    return q.withColumn("ordering", F.round("ordering", 6))


QUERIES = {f.__name__: f for f in (curriculum_quality, domain_ordering, pedagogical_position, lag_prerequisites, level_progression, transition_smoothness, prerequisite_depth, prerequisite_violations, level_inversions, elective_placement, checkpoints, branching, interleave, systematic_sample, stratified_sample, exam_pathway, accelerated_pathway, recommendations, pathway_diversity, sibling_edges, sibling_chain, prerequisite_edges, edge_statistics, graph_properties, cyclic_core, acyclic_edges, topo_generations, most_referenced, domain_rule_edges, domain_rule_links, domain_rule_members, hierarchy_paths, hierarchy_stats, quality_overall, quality_compare, toc_quality, sequence_quality)}

_RANK = "CASE {c} WHEN 'high_school' THEN 0 WHEN 'undergraduate' THEN 1 WHEN 'graduate' THEN 2 ELSE 3 END"
_U = f"""u AS (SELECT subtopic_id AS unit_id, name AS title, educational_level AS level, coalesce(domain, 'general') AS domain, coalesce(prerequisites, []) AS prerequisites, coalesce(learning_objectives, []) AS objectives, coalesce(difficulty, 1) AS difficulty,
  coalesce(duration_hours, 1) AS hours, coalesce(is_core, TRUE) AS is_core, row_number() OVER (ORDER BY {_RANK.format(c='educational_level')}, pedagogical_order NULLS FIRST, subtopic_id) - 1 AS pos FROM subtopics)"""
_ENT = D.CURRENT + ", ent AS (SELECT * REPLACE (nullif(trim(parent_id), '') AS parent_id) FROM cur)"
_RES = _U + """, nm AS (SELECT lower(trim(title)) AS key, min(pos) AS pos, arg_min(unit_id, pos) AS pid FROM u GROUP BY 1), wn AS (SELECT DISTINCT unit_id, pos, lower(trim(x)) AS key FROM (SELECT unit_id, pos, unnest(prerequisites) AS x FROM u)),
  res AS (SELECT DISTINCT w.unit_id, n.pid AS prerequisite_id, w.pos AS unit_pos, n.pos AS prerequisite_pos FROM wn w JOIN nm n USING (key) WHERE n.pid <> w.unit_id)"""
_EDGE = _RES + ", e AS (SELECT prerequisite_id AS src, unit_id AS dst, 'explicit' AS kind, CASE WHEN prerequisite_pos < unit_pos THEN 0.9 ELSE 0.6 END::DOUBLE AS confidence, prerequisite_pos AS p, unit_pos AS q FROM res)"
_PLANTED = _EDGE.replace(", e AS (", ", e0 AS (") + ", e AS (SELECT * FROM e0 UNION ALL SELECT dst, src, 'planted', 0.3::DOUBLE, q, p FROM e0 WHERE src % 3 = 0)"
_BASE = f"lower({D.chain('name', GROUP_NAME)})"
_PROG = f"""pr AS (SELECT subtopic_id, base, row_number() OVER w AS step, lag(subtopic_id) OVER w AS previous, count(*) OVER (PARTITION BY base) AS n, name FROM (SELECT *, {_BASE} AS base FROM subtopics) WHERE base <> '' WINDOW w AS (PARTITION BY base ORDER BY {_RANK.format(c='educational_level')}, subtopic_id))"""
_VIS = "lower(domain) IN (" + ", ".join(map(D.quote, sequence.VISUAL)) + ")"
_EXAM = "is_core OR lower(domain) IN (" + ", ".join(map(D.quote, sequence.HIGH_YIELD)) + ") OR len(objectives) >= 3"
_INTER = f"vi AS (SELECT unit_id, {_VIS} AS visual, pos, row_number() OVER (PARTITION BY {_VIS} ORDER BY pos) - 1 AS own FROM u), il AS (SELECT unit_id, visual, row_number() OVER (ORDER BY CASE WHEN visual THEN (own // 2) * 3 + own % 2 ELSE own * 3 + 2 END) - 1 AS place FROM vi)"
_EX = f"ex AS (SELECT unit_id, pos, row_number() OVER (ORDER BY pos) - 1 AS place FROM u WHERE {_EXAM}), exam AS (SELECT unit_id, place FROM ex WHERE place < floor((SELECT count(*) FROM u) * 0.6))"
_INV = "iv AS (SELECT book_id, level, row_number() OVER (PARTITION BY book_id ORDER BY row_id) AS o FROM ent WHERE level IS NOT NULL), ivn AS (SELECT book_id, count(*) AS n FROM iv GROUP BY 1), ivp AS (SELECT a.book_id, count(*) AS k FROM iv a JOIN iv b ON a.book_id = b.book_id AND a.o < b.o AND a.level > b.level GROUP BY 1), inv AS (SELECT n.book_id, n.n, coalesce(k, 0) AS inversions FROM ivn n LEFT JOIN ivp USING (book_id))"
_SM = f"sm AS (SELECT a.r AS rank, b.r AS next FROM (SELECT pos, {_RANK.format(c='level')} AS r FROM u) a JOIN (SELECT pos, {_RANK.format(c='level')} AS r FROM u) b ON b.pos = a.pos + 1 WHERE a.r <> b.r), smooth AS (SELECT count(*) AS changes, count(CASE WHEN next > rank THEN 1 END) AS rising, CASE WHEN count(*) = 0 THEN 1.0 ELSE round(count(CASE WHEN next > rank THEN 1 END) / count(*), 6) END AS smoothness FROM sm)"
# The core: edges on a walk from a cycle to a cycle; nodes that reach themselves by the transitive closure, then what lies between.
_CORE = """clo AS (SELECT src, dst FROM e WHERE src <> dst UNION SELECT c.src, e.dst FROM clo c JOIN e ON e.src = c.dst WHERE e.src <> e.dst), cyc AS (SELECT DISTINCT src AS v FROM clo WHERE src = dst),
  after AS (SELECT v FROM cyc UNION SELECT DISTINCT dst FROM clo WHERE src IN (SELECT v FROM cyc)), before AS (SELECT v FROM cyc UNION SELECT DISTINCT src FROM clo WHERE dst IN (SELECT v FROM cyc)),
  core AS (SELECT DISTINCT src, dst FROM e WHERE src IN (SELECT v FROM after) AND dst IN (SELECT v FROM before)), dag AS (SELECT e.src, e.dst FROM e LEFT JOIN core c ON c.src = e.src AND c.dst = e.dst WHERE c.src IS NULL OR e.p < e.q)"""


def _overall(name: str, source: str) -> str:
    """CTEs that end in one row `name` of all scores of the topics in `source`."""
    x = name
    t = "lower(title)"
    dom = [f"sum({D.any_of(t, ws)}::INT)" for ws in L.DOMAINS_FIRST.values()]
    return f"""{x}lv AS (SELECT coalesce(level, 'unknown') AS level, count(*) AS n FROM {source} GROUP BY 1),
  {x}lp AS (SELECT 0.7::DOUBLE * count(CASE WHEN level IN ('high_school', 'undergraduate', 'graduate') THEN 1 END) / 3.0::DOUBLE + 0.3::DOUBLE * (1 - coalesce(stddev_pop(n / (SELECT sum(n) FROM {x}lv)), 0)) AS level_progression FROM {x}lv),
  {x}dh AS (SELECT [{', '.join(dom)}] AS h FROM {source}), {x}dc AS (SELECT CASE WHEN list_sum(h) = 0 THEN 0.5 ELSE 0.6::DOUBLE * len(list_filter(h, lambda y: y > 0)) / {len(dom)}.0::DOUBLE + 0.4::DOUBLE * least(list_sum(h)::DOUBLE / len(list_filter(h, lambda y: y > 0)) / 5.0, 1.0) END AS dc FROM {x}dh),
  {x}tk AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({D.terms(t)}) AS term FROM {source}) GROUP BY ALL), {x}n AS (SELECT count(*) AS n FROM {source}), {x}vo AS (SELECT term, sum(tf) AS total, count(*) AS df FROM {x}tk GROUP BY term ORDER BY 2 DESC, 1 LIMIT 100),
  {x}w AS (SELECT id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM {x}tk JOIN {x}vo USING (term), {x}n), {x}no AS (SELECT id, sqrt(sum(w * w)) AS norm FROM {x}w GROUP BY id), {x}un AS (SELECT term, sum(w / norm) AS s FROM {x}w JOIN {x}no USING (id) GROUP BY term),
  {x}sc AS (SELECT greatest(0, ((SELECT coalesce(sum(s * s), 0) FROM {x}un) - n) / (n * (n - 1))) AS sc FROM {x}n),
  {x}cx AS (SELECT level, avg({D.count(t, quality.COMPLEXITY_WORDS)} + 0.1::DOUBLE * len(list_filter(regexp_split_to_array(title, '\\s+'), lambda y: y <> ''))) AS c FROM {source} GROUP BY 1),
  {x}hc AS (SELECT coalesce((coalesce((b >= a)::INT, 0) + coalesce((c >= b)::INT, 0)) / nullif((a IS NOT NULL AND b IS NOT NULL)::INT + (b IS NOT NULL AND c IS NOT NULL)::INT, 0), 0.5) AS hc FROM (SELECT (SELECT c FROM {x}cx WHERE level = 'high_school') AS a, (SELECT c FROM {x}cx WHERE level = 'undergraduate') AS b, (SELECT c FROM {x}cx WHERE level = 'graduate') AS c)),
  {x}b AS (SELECT count(*) AS total_topics, count(DISTINCT {t}) AS unique_topics, avg(CASE WHEN {D.any_of(t, L.FUNDAMENTAL_WORDS)} THEN pos END) AS pf, avg(CASE WHEN NOT {D.any_of(t, L.FUNDAMENTAL_WORDS)} AND {D.any_of(t, L.ADVANCED_WORDS)} THEN pos END) AS pa,
    {' + '.join(f'max({D.any_of(t, ws)}::INT)' for ws in L.AREAS.values())} AS areas, {' + '.join(f'max({D.any_of(t, ws)}::INT)' for ws in L.CONTENT_TYPES.values())} AS kinds, count(DISTINCT coalesce(book, 'unknown')) AS books,
    (avg((title IS NOT NULL AND title <> '')::INT) + avg((depth IS NOT NULL)::INT) + avg((level IS NOT NULL AND level <> '')::INT) + avg((book IS NOT NULL AND book <> '')::INT)) / 4 AS complete, stddev_pop(length(coalesce(title, ''))) AS sd, avg(length(coalesce(title, ''))) AS mean FROM {source}),
  {x}s AS (SELECT total_topics, unique_topics, 1 - unique_topics / total_topics AS duplicate_ratio, level_progression, 0.4::DOUBLE * dc + 0.3::DOUBLE * sc + 0.3::DOUBLE * hc AS topic_coherence, areas / 5.0::DOUBLE AS coverage_breadth,
    CASE WHEN pf IS NULL OR pa IS NULL THEN 0.5 WHEN pa > pf THEN 1.0 ELSE greatest(0.0, 1 - (pf - pa) / total_topics) END AS pedagogical_ordering, 0.7::DOUBLE * kinds / 5 + 0.3::DOUBLE * least(books / 5.0::DOUBLE, 1.0) AS content_diversity,
    0.8::DOUBLE * complete + 0.2::DOUBLE * least(1.0, greatest(0.0, 1 - sd / mean)) AS structural_consistency FROM {x}b, {x}lp, {x}dc, {x}sc, {x}hc),
  {x} AS (SELECT *, 0.2::DOUBLE * level_progression + 0.25::DOUBLE * topic_coherence + 0.15::DOUBLE * coverage_breadth + 0.2::DOUBLE * pedagogical_ordering + 0.1::DOUBLE * content_diversity + 0.1::DOUBLE * structural_consistency AS overall FROM {x}s)"""


_QT = _U + ", qt AS (SELECT subtopic_id AS id, name AS title, educational_level AS level, depth_level AS depth, source_books[1] AS book, u.pos, subtopics.is_core FROM subtopics JOIN u ON u.unit_id = subtopic_id), qc AS (SELECT * FROM qt WHERE is_core)"
_SCORES = ["duplicate_ratio", "level_progression", "topic_coherence", "coverage_breadth", "pedagogical_ordering", "content_diversity", "structural_consistency", "overall"]
_PN = ["all", "core", "accelerated", "exam", "visual"]
SQL = {
    "pedagogical_position": f"WITH {_U} SELECT unit_id, pos FROM u",
    "lag_prerequisites": f"WITH {_ENT} SELECT book_id, entry_id, row_number() OVER w AS position, lag(entry_id) OVER w AS prerequisite FROM ent WINDOW w AS (PARTITION BY book_id ORDER BY row_id)",
    "level_progression": f"WITH {_PROG} SELECT subtopic_id, base, step, previous, name || CASE WHEN n = 1 THEN '' WHEN step = 1 THEN ' (Introductory)' WHEN step = n THEN ' (Advanced)' ELSE ' (Intermediate)' END AS title FROM pr",
    "transition_smoothness": f"WITH {_U}, {_SM} SELECT * FROM smooth",
    "prerequisite_depth": f"WITH {_RES} SELECT unit_id, coalesce((SELECT max(prerequisite_pos) + 1 FROM res r WHERE r.unit_id = u.unit_id), 0) AS depth FROM u",
    "prerequisite_violations": f"WITH {_RES} SELECT unit_id, prerequisite_id FROM res WHERE prerequisite_pos > unit_pos",
    "level_inversions": f"WITH {_ENT}, {_INV} SELECT book_id, n, inversions FROM inv",
    "elective_placement": f"WITH {_U}, p AS (SELECT *, pos / greatest((SELECT count(*) FROM u) - 1, 1) AS rel FROM u) SELECT round(avg(CASE WHEN is_core THEN rel END), 6) AS core_mean, round(avg(CASE WHEN NOT is_core THEN rel END), 6) AS elective_mean, min(CASE WHEN NOT is_core THEN pos END) > max(CASE WHEN is_core THEN pos END) AS separated FROM p",
    "checkpoints": f"WITH {_U} SELECT pos // greatest(1, (SELECT count(*) FROM u) // 20) + 1 AS checkpoint, min(pos) AS position, count(*) AS units, sum(hours)::BIGINT AS hours, sum((difficulty >= 3 OR len(prerequisites) >= 2)::INT)::BIGINT AS remedial FROM u GROUP BY 1",
    "branching": f"""WITH {_U}, r3 AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY pos) AS r FROM u), f AS (SELECT domain, list(unit_id ORDER BY pos) AS firsts FROM r3 WHERE r <= 3 GROUP BY 1),
      b AS (SELECT u.unit_id, CASE WHEN u.pos = 1 THEN b1.unit_id ELSE b2.unit_id END AS back, a.unit_id AS ahead, list_filter(firsts, lambda x: x <> u.unit_id)[:2] AS rel FROM u JOIN f USING (domain) LEFT JOIN u b1 ON b1.pos = u.pos - 1 LEFT JOIN u b2 ON b2.pos = u.pos - 2 LEFT JOIN u a ON a.pos = u.pos + 2)
      SELECT unit_id, array_to_string(list_sort(list_distinct(list_filter([back, ahead] || rel, lambda x: x IS NOT NULL))), ',') AS branches FROM b""",
    "interleave": f"WITH {_U}, {_INTER} SELECT unit_id, visual, place FROM il",
    "systematic_sample": f"WITH {_U}, s AS (SELECT greatest(1, count(*) // 100) AS step FROM u) SELECT unit_id, pos FROM u, s WHERE pos % step = 0 AND pos // step < 100",
    "stratified_sample": f"WITH {_U} SELECT unit_id, domain, level, place FROM (SELECT *, row_number() OVER (PARTITION BY domain, level ORDER BY pos) AS place FROM u) WHERE place <= 3",
    "exam_pathway": f"WITH {_U}, {_EX} SELECT unit_id, place FROM exam",
    "accelerated_pathway": f"WITH {_U} SELECT unit_id FROM u WHERE is_core OR len(prerequisites) >= 2 OR difficulty >= 3",
    "recommendations": f"WITH {_U} SELECT unit_id, 'prerequisite' AS kind, 0.9::DOUBLE AS confidence FROM u WHERE len(prerequisites) > 0 UNION ALL SELECT unit_id, 'remediation', 0.8 FROM u WHERE difficulty >= 4 UNION ALL SELECT unit_id, 'acceleration', 0.7 FROM u WHERE difficulty <= 2 UNION ALL SELECT unit_id, 'enrichment', 0.6 FROM u WHERE is_core",
    "pathway_diversity": f"""WITH {_U}, {_INTER}, {_EX}, m AS (SELECT unit_id, TRUE AS p_all, is_core AS p_core, is_core OR len(prerequisites) >= 2 OR difficulty >= 3 AS p_accelerated, unit_id IN (SELECT unit_id FROM exam) AS p_exam, unit_id IN (SELECT unit_id FROM il WHERE visual) AS p_visual FROM u)
      SELECT round(1 - ({' + '.join(f"coalesce(sum((p_{a} AND p_{b})::INT) / nullif(sum((p_{a} OR p_{b})::INT), 0), 0)" for i, a in enumerate(_PN) for b in _PN[i + 1:])}) / 10, 6) AS diversity FROM m""",
    "sibling_edges": f"WITH {_ENT} SELECT book_id, source, entry_id AS target, 0.7::DOUBLE AS confidence FROM (SELECT *, first_value(entry_id) OVER (PARTITION BY book_id, parent_id ORDER BY row_id) AS source FROM ent WHERE parent_id IS NOT NULL) WHERE source <> entry_id",
    "sibling_chain": f"WITH {_ENT} SELECT book_id, source, entry_id AS target, 0.7::DOUBLE AS confidence FROM (SELECT *, lag(entry_id) OVER (PARTITION BY book_id, parent_id ORDER BY row_id) AS source FROM ent WHERE parent_id IS NOT NULL) WHERE source <> entry_id",
    "prerequisite_edges": f"WITH {_EDGE} SELECT src, dst, kind, confidence FROM e",
    "edge_statistics": f"WITH {_EDGE} SELECT kind, count(*) AS edges, round(avg(confidence), 6) AS mean_confidence, min(confidence) AS least, max(confidence) AS most FROM e GROUP BY kind",
    "graph_properties": f"""WITH {_EDGE}, dg AS (SELECT unit_id, unit_id IN (SELECT dst FROM e) AS has_in, unit_id IN (SELECT src FROM e) AS has_out FROM u)
      SELECT count(*) AS nodes, (SELECT count(*) FROM e) AS edges, count(CASE WHEN NOT has_in THEN 1 END) AS sources, count(CASE WHEN NOT has_out THEN 1 END) AS sinks, count(CASE WHEN NOT has_in AND NOT has_out THEN 1 END) AS isolated, round((SELECT count(*) FROM e) / (count(*) * (count(*) - 1)), 9) AS density FROM dg""",
    "cyclic_core": f"WITH RECURSIVE {_PLANTED}, {_CORE} SELECT src, dst FROM core",
    "acyclic_edges": f"WITH RECURSIVE {_PLANTED}, {_CORE} SELECT src, dst FROM dag",
    "topo_generations": f"WITH RECURSIVE {_EDGE}, {_CORE}, g AS (SELECT unit_id AS id, 0 AS generation FROM u UNION SELECT d.dst, g.generation + 1 FROM g JOIN dag d ON d.src = g.id) SELECT id, max(generation)::INT AS generation FROM g GROUP BY id",
    "most_referenced": f"WITH {_EDGE} SELECT src, count(*) AS \"references\" FROM e GROUP BY src ORDER BY 2 DESC, 1 LIMIT 10",
    "domain_rule_edges": f"""WITH {_U}, t AS (SELECT unit_id AS id, {D.most('lower(title)', L.DOMAINS_MOST)} AS domain, pos FROM u), rl AS (SELECT * FROM (VALUES {', '.join(f"({D.quote(k)}, {D.quote(n)})" for k, v in L.DOMAIN_PREREQUISITES.items() for n in v)}) r(domain, needs)),
      f AS (SELECT domain AS needs, arg_min(id, pos) AS src FROM t WHERE domain IS NOT NULL GROUP BY 1) SELECT src, id AS dst, 'domain' AS kind, 0.8::DOUBLE AS confidence FROM t JOIN rl USING (domain) JOIN f USING (needs) WHERE src <> id""",
    "hierarchy_paths": "SELECT c_custkey, r_name || ' > ' || n_name || ' > ' || c_mktsegment || ' > ' || c_name || ' > General Topic > General Topic' AS path FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "hierarchy_stats": "WITH p AS (SELECT r_name, n_name, c_mktsegment, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) SELECT r_name AS top, 1 AS depth, count(DISTINCT r_name) AS nodes FROM p GROUP BY 1 UNION ALL SELECT r_name, 2, count(DISTINCT n_name) FROM p GROUP BY 1 UNION ALL SELECT r_name, 3, count(DISTINCT (n_name, c_mktsegment)) FROM p GROUP BY 1 UNION ALL SELECT r_name, 4, count(DISTINCT (n_name, c_mktsegment, c_name)) FROM p GROUP BY 1",
    "quality_overall": f"WITH {_QT}, {_overall('qa', 'qt')} SELECT total_topics, unique_topics, {', '.join(f'round({c}, 6) AS {c}' for c in _SCORES)} FROM qa",
    "quality_compare": f"WITH {_QT}, {_overall('qa', 'qt')}, {_overall('qb', 'qc')} SELECT round(a.overall, 6) AS a, round(b.overall, 6) AS b, CASE WHEN abs(a.overall - b.overall) < 1e-9 THEN 'tie' WHEN a.overall > b.overall THEN 'first' ELSE 'second' END AS winner, round(least(2 * abs(a.overall - b.overall), 1), 6) AS confidence, round(100 * (b.overall - a.overall) / a.overall, 6) AS improvement FROM qa a, qb b",
    "toc_quality": f"WITH {_ENT} SELECT book_id, round(least(1.0, 0.5::DOUBLE + CASE WHEN n >= 20 THEN 0.2 WHEN n >= 10 THEN 0.1 ELSE 0 END + CASE WHEN dep >= 3 THEN 0.2 WHEN dep >= 2 THEN 0.1 ELSE 0 END + CASE WHEN len BETWEEN 10 AND 50 THEN 0.1 ELSE 0 END), 6) AS quality FROM (SELECT book_id, count(*) AS n, max(level) AS dep, avg(length(title)) AS len FROM ent GROUP BY 1)",
    "sequence_quality": f"""WITH {_ENT}, {_U}, {_SM}, {_INV}, {_PROG}, s AS (SELECT avg((len(prerequisites) > 0)::INT) AS coverage, (SELECT smoothness FROM smooth) AS smoothness, least(count(DISTINCT domain) / 8.0::DOUBLE, 1.0) AS domains, (SELECT count(DISTINCT subtopic_id) FROM pr WHERE previous IS NOT NULL) / count(*) AS connectivity,
      coalesce(1 - (SELECT sum(inversions) / sum(n * (n - 1) / 2) FROM inv), 1.0) AS order_kept FROM u) SELECT round(coverage, 6) AS coverage, round(smoothness, 6) AS smoothness, round(domains, 6) AS domains, round(connectivity, 6) AS connectivity, round(order_kept, 6) AS order_kept,
      round(0.25::DOUBLE * coverage + 0.25::DOUBLE * smoothness + 0.2::DOUBLE * domains + 0.15::DOUBLE * connectivity + 0.15::DOUBLE * order_kept, 6) AS overall FROM s""",
    "curriculum_quality": f"""WITH {_U}, s AS (SELECT count(DISTINCT CASE WHEN domain IN ({', '.join(map(D.quote, quality.ESSENTIAL))}) THEN domain END) / 11.0::DOUBLE AS coverage, avg((NOT {D.any_of('lower(title)', ['untitled', 'section', 'equations', 'general'])})::INT) AS naming,
      least(1.0, count(DISTINCT level) / 2.0::DOUBLE) AS progression, least(1.0, count(*) / 1000.0::DOUBLE) AS quantity FROM u) SELECT round(coverage, 6) AS coverage, round(naming, 6) AS naming, round(progression, 6) AS progression, round(quantity, 6) AS quantity, round((coverage + naming + progression + quantity) / 4, 6) AS overall FROM s""",
    "domain_ordering": f"""WITH {_U}, rl AS (SELECT * FROM (VALUES ('energy', 'dynamics'), ('optics', 'energy'), ('acids', 'energy'), ('optics', 'acids')) r(domain, needs)), v AS (SELECT count(*) AS violations FROM u JOIN rl USING (domain) WHERE (SELECT max(pos) FROM u x WHERE x.domain = rl.needs) > u.pos)
      SELECT (SELECT count(*) FROM u) AS topics, violations, round(greatest(0.0, 1 - violations / (SELECT count(*) FROM u)), 6) AS ordering FROM v""",
}

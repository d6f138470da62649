"""Prerequisite graphs: edges, properties, cycles, topological generations and level paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.durable import Scratch, with_dense_ids
from corpusloom.operators import hierarchy
from corpusloom.operators.components import components


def last_wins(edges: DataFrame, order: list[Column]) -> DataFrame:
    """One edge per (src, dst): the last in the given order."""
    key = F.struct(*[c for c in order])
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    best = edges.groupBy("src", "dst").agg(F.max_by(F.struct(*rest), key).alias("e"))
    return best.select("src", "dst", *[F.col(f"e.{c}").alias(c) for c in rest])


def statistics(edges: DataFrame) -> DataFrame:
    return edges.groupBy("kind").agg(F.count("*").alias("edges"), F.round(F.avg("confidence"), 6).alias("mean_confidence"), F.min("confidence").alias("least"), F.max("confidence").alias("most"))


def properties(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, density m / (n (n - 1)), sources, sinks and isolated nodes."""
    n = nodes.agg(F.count("*").alias("nodes"))
    m = edges.agg(F.count("*").alias("edges"))
    degree = nodes.select("id").join(edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("ins")), "id", "left").join(edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("outs")), "id", "left")
    d = degree.agg(F.count(F.when(F.col("ins").isNull(), 1)).alias("sources"), F.count(F.when(F.col("outs").isNull(), 1)).alias("sinks"), F.count(F.when(F.col("ins").isNull() & F.col("outs").isNull(), 1)).alias("isolated"))
    return n.crossJoin(m).crossJoin(d).withColumn("density", F.round(F.coalesce(F.try_divide(F.col("edges"), F.col("nodes") * (F.col("nodes") - 1)), F.lit(0.0)), 9))


def cyclic_core(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The edges (src, dst) that remain when nodes without predecessors or successors are removed again and again.

    They hold all cycles and the paths between cycles; none remain if and only if the graph is acyclic. Each round is two
    semi-joins on what is left; there are as many rounds as the longest path outside the core.
    """
    scratch = scratch or Scratch(edges.sparkSession, "core")
    now = scratch.cut(edges.select("src", "dst").where("src <> dst").distinct())
    loops = edges.select("src", "dst").where("src = dst").distinct()
    count = now.count()
    while count:
        trimmed = now.join(now.select(F.col("dst").alias("src")).distinct(), "src", "left_semi")
        trimmed = scratch.cut(trimmed.join(trimmed.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst"))
        left = trimmed.count()
        now = trimmed
        if left == count:
            break
        count = left
    return now.unionByName(loops)


def acyclic(edges: DataFrame, positions: DataFrame) -> DataFrame:
    """Edges without those of the cyclic core that go back in the given order (id, pos): acyclic, and forward elsewhere unchanged."""
    core = cyclic_core(edges)
    at = lambda c, name: positions.select(F.col("id").alias(c), F.col("pos").alias(name))
    back = core.join(at("src", "p"), "src").join(at("dst", "q"), "dst").where("p >= q").select("src", "dst")
    return edges.join(back, ["src", "dst"], "left_anti")


def generations(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, generation: 0 without predecessors, else 1 + the highest of the predecessors. The graph must be acyclic.

    Chains (nodes with one predecessor that has no other successor) are first contracted to their heads, in a logarithmic
    number of rounds whatever their length; what is left goes by Kahn's algorithm with chain lengths as weights, a round
    for each chain on the longest way. A round removes all heads without open predecessors and updates only the open
    counts and generations of their successors; tables of past rounds are dropped. Edges with an end that is no node do not
    count.
    """
    scratch = Scratch(nodes.sparkSession, "generations")
    ids = scratch.cut(nodes.select("id").distinct())
    ends = edges.select("src", "dst").distinct().join(ids.select(F.col("id").alias("src")), "src", "left_semi").join(ids.select(F.col("id").alias("dst")), "dst", "left_semi")
    e = scratch.cut(ends.select("src", "dst"))
    outs = e.groupBy("src").agg(F.count("*").alias("outs")).where("outs = 1").select("src")
    one_in = e.groupBy("dst").agg(F.count("*").alias("ins"), F.min("src").alias("src")).where("ins = 1").select("src", "dst")
    link = scratch.cut(one_in.join(outs, "src", "left_semi").select("src", "dst"))
    chains = ids.join(link.select(F.col("dst").alias("id"), F.col("src").alias("up")), "id", "left").select(F.lit("").alias("grp"), F.col("id").alias("key"), F.col("up").alias("parent"))
    placed = scratch.cut(hierarchy.resolve(chains, keep=()).select(F.col("key").alias("id"), F.col("root_key").alias("head"), (F.col("depth") - 1).alias("at")))
    if not placed.where("head is null").isEmpty():
        raise ValueError("the graph has a cycle; see acyclic()")
    length = placed.groupBy("head").agg((F.max("at") + 1).cast("long").alias("length"))
    # An edge that is no link leaves from the end of a chain and goes to the head of another.
    across = e.join(link, ["src", "dst"], "left_anti").join(placed.select(F.col("id").alias("src"), "head"), "src").select(F.col("head").alias("src"), "dst").distinct()
    across = scratch.cut(across.join(length.select(F.col("head").alias("src"), "length"), "src").select("src", "dst", "length"))
    ins = across.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("open"))
    path = scratch.put(length.select(F.col("head").alias("id")).join(ins, "id", "left").select("id", F.coalesce("open", F.lit(0)).cast("long").alias("open"), F.lit(0).cast("long").alias("g")))
    done = scratch.new_path()
    while True:
        state = scratch.get(path)
        state.where("open = 0").select("id", "g").write.mode("append").parquet(done)
        freed = across.join(state.where("open = 0").select(F.col("id").alias("src"), "g"), "src").groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("freed"), F.max(F.col("g") + F.col("length")).alias("g2"))
        new = state.where("open > 0").join(freed, "id", "left").select("id", (F.col("open") - F.coalesce("freed", F.lit(0))).alias("open"), F.greatest("g", F.coalesce("g2", F.lit(0))).alias("g"))
        new_path = scratch.put(new)
        scratch.drop(path)
        path = new_path
        left = scratch.get(path).agg(F.count("*").alias("n"), F.count(F.when(F.col("open") == 0, 1)).alias("ready")).first()
        if not left["n"]:
            break
        if not left["ready"]:
            raise ValueError("the graph has a cycle; see acyclic()")
    heads = scratch.get(done).select(F.col("id").alias("head"), "g")
    return placed.join(heads, "head").select("id", (F.col("g") + F.col("at")).cast("int").alias("generation"))


def most_referenced(edges: DataFrame, k: int = 10) -> DataFrame:
    return edges.groupBy("src").agg(F.count("*").alias("references")).orderBy(F.desc("references"), "src").limit(k)


def rule_edges(topics: DataFrame, rules: DataFrame) -> DataFrame:
    """Edges from the first topic (lowest position) of a required domain to every topic of the domain that needs it.

    topics: id, domain, pos; rules: domain, needs. One edge per topic and rule instead of all pairs of two domains; the whole
    set of pairs, factored, is that of rule_links.
    """
    first = topics.groupBy("domain").agg(F.min_by("id", F.struct("pos", "id")).alias("src")).withColumnRenamed("domain", "needs")
    return topics.join(F.broadcast(rules), "domain").join(first, "needs").where("src <> id").select("src", F.col("id").alias("dst"), F.lit("domain").alias("kind"), F.lit(0.8).alias("confidence"))


def rule_links(topics: DataFrame, rules: DataFrame) -> DataFrame:
    """All prerequisites by rule, factored: dst, domain, needs, links, prior.

    topics: id, domain, pos; rules: domain, needs. A row stands for an edge to dst from every other topic of the domain
    `needs` (links of them); those from topics before dst are as many as prior. Joined with topics on domain = needs it
    gives the edges, of which there are as many as all pairs of two domains.
    """
    at = topics.select("domain", "pos").groupBy("domain", "pos").agg(F.count("*").alias("n"))
    pairs = topics.join(F.broadcast(rules.distinct()), "domain").select(F.col("id").alias("dst"), "domain", "needs", "pos")
    size = topics.groupBy(F.col("domain").alias("needs")).agg(F.count("*").alias("size"))
    asked = pairs.select(F.col("needs").alias("domain"), "pos").distinct()
    marks = at.unionByName(asked.withColumn("n", F.lit(0).cast("long"))).groupBy("domain", "pos").agg(F.sum("n").alias("n"))
    before = marks.select(F.col("domain").alias("needs"), "pos", F.coalesce(F.sum("n").over(W.partitionBy("domain").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("prior"))
    return (
        pairs.join(size, "needs").join(before, ["needs", "pos"])
        .select("dst", "domain", "needs", (F.col("size") - F.when(F.col("domain") == F.col("needs"), 1).otherwise(0)).alias("links"), "prior")
        .where("links > 0")
    )


LEVELS = 6
PAD = "General Topic"


def six_levels(path: Column) -> Column:
    """A path with exactly six names: padded, or with the rest joined into the sixth."""
    long = F.concat(F.slice(path, 1, LEVELS - 1), F.array(F.array_join(F.slice(path, LEVELS, 1000), " / ")))
    return F.when(F.size(path) > LEVELS, long).otherwise(F.concat(path, F.array_repeat(F.lit(PAD), F.greatest(F.lit(0), F.lit(LEVELS) - F.size(path)))))


def level_stats(paths: DataFrame, top: str = "top") -> DataFrame:
    """Nodes per top node and depth."""
    return paths.groupBy(top, F.size("path").alias("depth")).agg(F.count("*").alias("nodes"))


def hierarchy_edges(entries: DataFrame) -> DataFrame:
    """Edges of a table of contents: from every parent to its children (.9), and from the first of siblings to the others (.7).

    entries: book_id, entry_id, parent_id (null at the top), row_id. Parents that are no entry of the book give no edge. The
    first sibling comes from an aggregate, so a parent with very many children is no group of one task.
    """
    parents = entries.select("book_id", F.col("entry_id").alias("parent_id")).distinct()
    below = entries.where("parent_id is not null").join(parents, ["book_id", "parent_id"], "left_semi")
    first = below.groupBy("book_id", "parent_id").agg(F.min_by("entry_id", F.struct("row_id", "entry_id")).alias("source"))
    siblings = below.join(first, ["book_id", "parent_id"]).where("source <> entry_id").select("book_id", "source", F.col("entry_id").alias("target"), F.lit("sibling").alias("kind"), F.lit(0.7).alias("confidence"))
    return below.select("book_id", F.col("parent_id").alias("source"), F.col("entry_id").alias("target"), F.lit("parent").alias("kind"), F.lit(0.9).alias("confidence")).unionByName(siblings)


def forest_properties(resolved: DataFrame) -> DataFrame:
    """Per group of a result of hierarchy.resolve: nodes, edges, weak components, nodes on cycles, whether acyclic, generations.

    Every node has one parent at most, so a weak component holds one root, one orphan or one cycle.
    """
    cyc = cycles(resolved).groupBy("grp").agg(F.countDistinct("cycle").alias("n_cycles"))
    top = F.col("status").isin("root", "orphan") & (F.col("depth") == 1)
    per = resolved.groupBy("grp").agg(F.count("*").alias("nodes"), F.count(F.when(~top, 1)).alias("edges"), F.count(F.when(top, 1)).alias("tops"), F.count(F.when(F.col("status") == "on_cycle", 1)).alias("on_cycles"), F.max("depth").alias("generations"))
    return per.join(cyc, "grp", "left").select("grp", "nodes", "edges", (F.col("tops") + F.coalesce("n_cycles", F.lit(0))).alias("components"), "on_cycles", (F.col("on_cycles") == 0).alias("acyclic"), "generations")


def cycles(resolved: DataFrame) -> DataFrame:
    """(grp, key, parent, cycle) of the nodes on cycles; cycle is the least key of theirs. Components are found in logarithmic rounds.

    resolved: a result of hierarchy.resolve that keeps the column parent.
    """
    spark = resolved.sparkSession
    scratch = Scratch(spark, "cycles")
    on = with_dense_ids(scratch, resolved.where("status = 'on_cycle'").select("grp", "key", "parent"))
    edges = on.select("grp", F.col("parent").alias("key"), F.col("id").alias("b")).join(on.select("grp", "key", F.col("id").alias("a")), ["grp", "key"]).select("a", "b")
    label = components(edges, scratch)
    member = on.join(label, F.col("id") == F.col("node"), "left").select("grp", "key", "parent", F.coalesce("root", "id").alias("root"))
    least = member.groupBy("root").agg(F.min("key").alias("cycle"))
    return member.join(least, "root").select("grp", "key", "parent", "cycle")


def cycle_breaks(resolved: DataFrame) -> DataFrame:
    """One link (grp, key, parent) of every cycle, that of its least key: without them the links are acyclic."""
    return cycles(resolved).where("key = cycle").select("grp", "key", "parent")


def domain_chain(topics: DataFrame, order: list[str]) -> DataFrame:
    """Edges from the first topic (lowest pos, then id) of every domain to that of the next domain in `order` that has topics."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("domain"))
    first = topics.where(F.col("domain").isin(order)).groupBy("domain").agg(F.min_by("id", F.struct("pos", "id")).alias("id")).withColumn("rank", rank)
    nxt = F.lead("id").over(W.orderBy("rank"))  # one row per domain of a fixed list
    return first.select(F.col("id").alias("src"), nxt.alias("dst"), F.col("domain")).where("dst is not null")


def with_synonyms(paths: DataFrame, path: str, synonyms: dict[str, str]) -> DataFrame:
    """Distinct paths after every step is replaced by its synonym: hierarchies merged under the map."""
    table = F.create_map(*[F.lit(x) for kv in synonyms.items() for x in kv])
    return paths.select(F.transform(path, lambda s: F.coalesce(table[s], s)).alias(path)).distinct()

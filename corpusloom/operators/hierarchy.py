"""Parent-child links of unknown depth to roots, depths, paths and descendants, by parallel tree contraction.

The links form a forest plus, where data are bad, components that run into a cycle. Contraction alternates

* raking: every leaf is removed and recorded with its parent as anchor;
* compression: an independent set of nodes with exactly one child is spliced out of its chains and recorded with its
  parent as anchor and its child as witness.

Each removes a constant share of what is left, so the number of phases grows with the logarithm of the number of nodes,
whatever the depth. Roots end as bare roots. What never ends is a core of cycles, each contracted to one node that is
its own parent. Replaying the records backwards gives every node its root, depth, path and subtree size from its anchor.

One phase is one shuffle: state rows and messages to neighbours are united and aggregated by node id, with partial
aggregation before the shuffle, so that a parent of a third of all rows gets one partial sum per map task. Nothing is
collected; tables between phases lie in the shared checkpoint folder.

Once a rake leaves at most `tail_rows` nodes (a checked bound, under a MB), one task finishes them in memory; that saves
the tiny jobs in which long chains and cycles would otherwise end. The result is the same for any tail_rows, also for 0.
If only contracted cycles are left, however many, one narrow projection names them; no task gathers them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.durable import Scratch, with_dense_ids

#: Blanks and tabs do not count around ids.
_EDGE_BLANKS = "^[ \\t]+|[ \\t]+$"


def trim_id(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_BLANKS, "")


def latest_links(rows: DataFrame, group: str = "book_id", key: str = "entry_id", parent: str = "parent_id", version: str = "extracted_at", keep: tuple[str, ...] = ("level",)) -> DataFrame:
    """The latest row per (group, key): columns grp, key, parent and those of keep.

    Null group or key count as the empty string. A parent that is null or empty after trimming is null, that is, a root.
    Rows without a version are older than all others; among rows that tie the greatest values win, in any order of input.
    """
    newest = F.max(F.struct(F.col(version).alias("v"), F.nullif(trim_id(F.col(parent)), F.lit("")).alias("parent"), *[F.col(k).alias(k) for k in keep]))
    return (
        rows.groupBy(F.coalesce(trim_id(F.col(group)), F.lit("")).alias("grp"), F.coalesce(trim_id(F.col(key)), F.lit("")).alias("key"))
        .agg(newest.alias("n"))
        .select("grp", "key", "n.parent", *[f"n.{k}" for k in keep])
    )


def _priority(c: str, phase: int) -> Column:
    return F.xxhash64(F.col(c), F.lit(phase))


def _finish(parts: Iterator[pd.DataFrame], paths: bool) -> Iterator[pd.DataFrame]:
    """Resolves contracted nodes whose parents are all among them; for the bounded tail."""
    parts = [p for p in parts if len(p)]
    if not parts:
        return
    df = pd.concat(parts, ignore_index=True)
    ids = df["id"].tolist()
    row = {v: i for i, v in enumerate(ids)}
    up = [None if pd.isna(p) else row[int(p)] for p in df["p"]]
    w, own, carry, orphan = df["w"].tolist(), df["acc"].tolist(), df["carry"].tolist(), df["orphan"].tolist()
    n = len(ids)
    status: list = [None] * n
    root: list = [None] * n
    depth: list = [None] * n
    order: list[int] = []  # every node after its parent, cycles apart
    for start in range(n):
        walk, at, place = [], start, {}
        while at is not None and status[at] is None and at not in place:
            place[at] = len(walk)
            walk.append(at)
            at = up[at]
        if at is not None and at in place:
            for v in walk[place[at] :]:
                status[v] = "on_cycle"
            walk = walk[: place[at]]
        for v in reversed(walk):
            p = up[v]
            if p is None:
                status[v], root[v], depth[v] = ("orphan" if orphan[v] else "root"), ids[v], 1
            else:
                status[v] = {"on_cycle": "under_cycle", "orphan": "under_orphan"}.get(status[p], status[p])
                root[v], depth[v] = root[p], None if depth[p] is None else depth[p] + w[v]
            order.append(v)
    size = list(own)
    for v in reversed(order):
        if up[v] is not None and status[up[v]] != "on_cycle":
            size[up[v]] += size[v] + carry[v]
    out = {"id": ids, "root": pd.array(root, dtype="Int64"), "depth": pd.array(depth, dtype="Int64"), "status": status, "size": pd.array([None if s == "on_cycle" else x for s, x in zip(status, size)], dtype="Int64")}
    if paths:
        seg, way = df["seg"].tolist(), [None] * n
        for v in order:
            p = up[v]
            if p is None:
                way[v] = [ids[v]]
            elif way[p] is not None:
                way[v] = [*way[p], *seg[v], ids[v]]
        out["path"] = way
    yield pd.DataFrame(out)


def resolve(links: DataFrame, keep: tuple[str, ...] = ("level",), paths: bool = False, tail_rows: int = 4096) -> DataFrame:
    """Resolve every node of `links` (grp, key, parent and the columns of keep; one row per grp and key).

    Gives grp, key, the columns of keep and
      status       root (reaches a root), orphan (its parent is no node of the group), under_orphan, on_cycle, under_cycle
      root_key     key of the root or orphan that it hangs from; null with cycles
      depth        1 at the root or orphan; null with cycles
      descendants  number of nodes below; null on a cycle
      path         with paths=True: keys from the root or orphan to the node; null with cycles
    An empty table gives an empty result. The size of `path` is the sum of all depths.
    """
    spark = links.sparkSession
    scratch = Scratch(spark, "hierarchy")
    nodes = with_dense_ids(scratch, links.select("grp", "key", "parent", *keep))
    up = nodes.select("grp", F.col("key").alias("parent"), F.col("id").alias("p"))
    linked = nodes.select("id", "grp", "parent").join(up, ["grp", "parent"], "left")
    orphan = F.col("parent").isNotNull() & F.col("p").isNull()
    seg0 = [F.array().cast("array<bigint>").alias("seg")] if paths else []
    no_seg = [F.lit(None).cast("array<bigint>").alias("seg")] if paths else []
    pre0 = [F.lit(None).cast("array<bigint>").alias("pre")] if paths else []

    def message(df: DataFrame, to: str, nch="0", cx="0L", acc="0L", ccarry="0L", carry="0L", w="0L", new_p="null", pre=None) -> DataFrame:
        return df.select(
            F.col(to).alias("id"), F.lit(False).alias("orphan"), F.lit(None).cast("long").alias("p"), F.expr(new_p).cast("long").alias("new_p"), F.expr(w).cast("long").alias("w"), F.expr(acc).cast("long").alias("acc"),
            F.expr(carry).cast("long").alias("carry"), F.expr(ccarry).cast("long").alias("ccarry"), F.expr(nch).cast("int").alias("nch"), F.expr(cx).cast("long").alias("cx"), *no_seg, *([pre.alias("pre")] if paths and pre is not None else pre0),
        )

    def state_rows(df: DataFrame) -> DataFrame:
        return df.select("id", "orphan", "p", F.lit(None).cast("long").alias("new_p"), "w", "acc", "carry", "ccarry", "nch", "cx", *(["seg"] if paths else []), *pre0)

    def settle(df: DataFrame) -> DataFrame:
        """Messages applied to the states."""
        out = df.groupBy("id").agg(
            F.max("orphan").alias("orphan"), F.coalesce(F.max("new_p"), F.max("p")).alias("p"), F.sum("w").alias("w"), F.sum("acc").alias("acc"), F.sum("carry").alias("carry"), F.sum("ccarry").alias("ccarry"),
            F.sum("nch").cast("int").alias("nch"), F.bit_xor("cx").alias("cx"), *([F.max("seg").alias("seg"), F.max("pre").alias("pre")] if paths else []),
        )
        return out.withColumn("seg", F.when(F.col("pre").isNotNull(), F.concat("pre", "seg")).otherwise(F.col("seg"))).drop("pre") if paths else out

    path = scratch.put(linked.select("id", "p", orphan.alias("orphan")))
    written = scratch.get(path)
    first = written.select(
        "id", "orphan", "p", F.lit(None).cast("long").alias("new_p"), F.lit(1).cast("long").alias("w"), F.lit(1).cast("long").alias("acc"), F.lit(0).cast("long").alias("carry"), F.lit(0).cast("long").alias("ccarry"), F.lit(0).alias("nch"), F.lit(0).cast("long").alias("cx"), *seg0, *pre0
    )
    state = settle(first.unionByName(message(written.where("p is not null").select("id", "p"), "p", nch="1", cx="id")))

    # Contraction. A record is (id, anchor, w, kind, witness, size) with kind r(oot), l(eaf) or c(hain).
    records: list[DataFrame] = []
    previous, phase = path, 0
    while True:
        rake = phase % 2 == 0
        leaf = F.col("nch") == 0
        if rake:
            gone = leaf
        else:
            chain = (F.col("nch") == 1) & F.col("p").isNotNull() & (F.col("p") != F.col("id"))
            gone = chain & (_priority("id", phase) > _priority("p", phase)) & (_priority("id", phase) > _priority("cx", phase))
        here = scratch.put(state.withColumn("gone", F.coalesce(gone, F.lit(False))), partition_by="gone")
        schema = state.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
        table = scratch.get(here, f"{schema}, gone boolean")
        removed, left = table.where("gone").drop("gone"), table.where("not gone").drop("gone")
        records.append(removed)
        if previous:
            scratch.drop(previous)
            previous = None
        if rake:
            out = removed.where("p is not null")
            news = message(out, "p", nch="-1", cx="id", acc="acc + carry", ccarry="-carry")
        else:
            news = message(removed, "cx", new_p="p", w="w", carry="acc + carry", pre=F.concat("seg", F.array("id")) if paths else None).unionByName(message(removed, "p", cx="id ^ cx", ccarry="ccarry + acc"))
        state = settle(state_rows(left).unionByName(news))
        # Only nodes that are their own parent can stay for good.
        if rake:
            few = left.count() <= tail_rows
            if few or left.where("p is null or p <> id or nch > 1").isEmpty():
                break
        phase += 1

    # Expansion, last phase first.
    cols = ["id", "root", "depth", "status", "size"] + (["path"] if paths else [])
    kinds = "id long, root long, depth long, status string, size long" + (", path array<long>" if paths else "")
    if few:
        done = scratch.cut(state.coalesce(1).mapInPandas(lambda parts: _finish(parts, paths), kinds))
    else:
        none = [F.lit(None).cast("array<long>").alias("path")] if paths else []
        nothing = F.lit(None).cast("long")
        done = scratch.cut(state.select("id", nothing.alias("root"), nothing.alias("depth"), F.lit("on_cycle").alias("status"), nothing.alias("size"), *none))
    for k in range(len(records) - 1, -1, -1):
        rec = records[k]
        known = done.select(F.col("id").alias("p"), F.col("root").alias("a_root"), F.col("depth").alias("a_depth"), F.col("status").alias("a_status"), *([F.col("path").alias("a_path")] if paths else []))
        below = F.when(F.col("a_status") == "on_cycle", "under_cycle").when(F.col("a_status") == "orphan", "under_orphan").otherwise(F.col("a_status"))
        full = [F.concat("a_path", "seg", F.array("id")).alias("path")] if paths else []
        if k % 2 == 0:
            roots = rec.where("p is null").select("id", F.col("id").alias("root"), F.lit(1).cast("long").alias("depth"), F.when(F.col("orphan"), "orphan").otherwise("root").alias("status"), F.col("acc").alias("size"), *([F.array("id").alias("path")] if paths else []))
            leaves = rec.where("p is not null").join(known, "p").select("id", F.col("a_root").alias("root"), (F.col("a_depth") + F.col("w")).alias("depth"), below.alias("status"), F.col("acc").alias("size"), *full)
            new = roots.unionByName(leaves)
        else:
            witness = done.select(F.col("id").alias("cx"), F.col("status").alias("c_status"), F.col("size").alias("c_size"))
            cyclic = F.col("c_status") == "on_cycle"
            new = (
                rec.join(known, "p").join(witness, "cx")
                .select("id", F.col("a_root").alias("root"), (F.col("a_depth") + F.col("w")).alias("depth"), F.when(cyclic, "on_cycle").otherwise(below).alias("status"), (F.col("acc") + F.col("ccarry") + F.col("c_size")).alias("size"), *full)
            )
        done = done.unionByName(scratch.cut(new.select(*cols)) if k else new.select(*cols))
    if paths:
        names = nodes.select(F.col("id").alias("step"), F.col("key").alias("step_key"))
        steps = done.where("path is not null").select("id", F.posexplode("path").alias("pos", "step")).join(names, "step")
        named = steps.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "step_key"))), lambda s: s["step_key"]).alias("path"))
        done = done.drop("path").join(named, "id", "left")
    root_names = nodes.select(F.col("id").alias("root"), F.col("key").alias("root_key"))
    return (
        nodes.drop("parent").join(done, "id").join(root_names, "root", "left")
        .select("grp", "key", *keep, "status", "root_key", F.col("depth").cast("int").alias("depth"), (F.col("size") - 1).alias("descendants"), *(["path"] if paths else []))
    )


def descendants(resolved: DataFrame) -> DataFrame:
    """All (grp, ancestor, descendant, distance) of a result of resolve(paths=True); cycles have none.

    Its rows are the sum of all depths less the number of nodes, which no form of this result can avoid.
    """
    return (
        resolved.where("path is not null").select("grp", F.col("key").alias("descendant"), "depth", F.posexplode("path").alias("pos", "ancestor"))
        .where("pos < depth - 1")
        .select("grp", "ancestor", "descendant", (F.col("depth") - 1 - F.col("pos")).alias("distance"))
    )


def findings(rows: DataFrame) -> DataFrame:
    """book_id, entry_id, finding of TOC rows: on_cycle, under_cycle, orphan or wrong_level.

    Entries below an orphan are no findings. Null levels are never wrong.
    """
    found = resolve(latest_links(rows).withColumn("level", F.col("level").cast("int")))
    wrong = (F.col("status") == "root") & F.col("level").isNotNull() & (F.col("level") != F.col("depth"))
    finding = F.when(F.col("status").isin("on_cycle", "under_cycle", "orphan"), F.col("status")).when(wrong, "wrong_level")
    return found.select(F.col("grp").alias("book_id"), F.col("key").alias("entry_id"), finding.alias("finding")).where("finding is not null")

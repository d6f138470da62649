"""Learning sequences: positions, neighbours, progressions, checkpoints, branches, samples and pathways.

A position in one order over all rows comes from counts of coarse buckets and ranks inside them; neighbours are joins on
positions. No window runs over the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.durable import Scratch

LEVEL_RANK = {"high_school": 0, "undergraduate": 1, "graduate": 2}


def level_rank(c: Column) -> Column:
    out = F.when(F.lit(False), F.lit(0))
    for name, rank in LEVEL_RANK.items():
        out = out.when(c == name, rank)
    return out.otherwise(len(LEVEL_RANK))


def global_rank(df: DataFrame, buckets: list[Column], order: list[Column], name: str = "pos") -> DataFrame:
    """df with its position, from 0, in the order of (buckets, order), which must leave no ties.

    Rows are range-partitioned and sorted; a position is the place in the partition and the rows of the partitions before.
    Only the counts of partitions pass through one task. The sorted rows are written once, so that places do not change.
    """
    keys = [f"_k{i}" for i in range(len(buckets))]
    by = [F.col(k).asc_nulls_first() for k in keys] + order
    wide = df.select("*", *[b.alias(k) for b, k in zip(buckets, keys)])
    placed = wide.repartitionByRange(*by).sortWithinPartitions(*by).drop(*keys).withColumn("_m", F.monotonically_increasing_id())
    rows = Scratch(df.sparkSession, "rank").cut(placed)
    part = F.shiftright("_m", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # as many rows as there are partitions
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    ranked = rows.withColumn("_part", part).join(F.broadcast(before), "_part")
    return ranked.withColumn(name, F.col("_before") + F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_m", "_part", "_before")


#: Domains in the order in which they are taught.
DOMAIN_ORDER = [
    "units_measurement", "vectors", "kinematics", "dynamics", "energy", "momentum", "rotation", "gravitation", "oscillations", "waves", "thermodynamics", "electricity", "magnetism", "circuits", "optics", "modern_physics", "astrophysics",
]


def by_importance(topics: DataFrame) -> DataFrame:
    """One topic per name with its position, from 1: core topics first, then by domain as taught, level and name.

    Of several topics of a name the first in that order stays (then the least id). Nulls: core, general, undergraduate;
    topics without a name are left out.
    """
    core = F.when(F.coalesce("is_core", F.lit(True)), 0).otherwise(1)
    domain = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(x) for x in DOMAIN_ORDER]), F.coalesce("domain", F.lit("general"))), F.lit(0)), F.lit(99))
    key = F.struct(core.alias("core"), domain.alias("domain_rank"), F.coalesce("educational_level", F.lit("undergraduate")).alias("level"), F.col("name"), F.col("subtopic_id"))
    first = topics.where("name <> ''").groupBy("name").agg(F.min(key).alias("k")).select("k.*")
    order = [F.col("core"), F.col("domain_rank"), F.col("level"), F.col("name"), F.col("subtopic_id")]
    return global_rank(first, [], order, "position").withColumn("position", F.col("position") + 1)


def units(topics: DataFrame) -> DataFrame:
    """Topics as units of one sequence: level, then pedagogical order, then id; defaults for missing fields."""
    none = F.array().cast("array<string>")
    u = topics.select(
        F.col("subtopic_id").alias("unit_id"), F.col("name").alias("title"), F.col("educational_level").alias("level"), F.coalesce("domain", F.lit("general")).alias("domain"), F.coalesce("prerequisites", none).alias("prerequisites"),
        F.coalesce("learning_objectives", none).alias("objectives"), F.coalesce("difficulty", F.lit(1)).alias("difficulty"), F.coalesce("duration_hours", F.lit(1)).alias("hours"), F.coalesce("is_core", F.lit(True)).alias("is_core"), "pedagogical_order",
    )
    step = F.coalesce(F.floor(F.col("pedagogical_order") / 10), F.lit(-1))
    return global_rank(u, [level_rank(F.col("level")), step], [F.col("pedagogical_order").asc_nulls_first(), F.col("unit_id")])


def shifted(u: DataFrame, by: int, name: str, column: str = "unit_id") -> DataFrame:
    """u with the value of `column` at position pos - by (null beyond the ends)."""
    return u.join(u.select((F.col("pos") + by).alias("pos"), F.col(column).alias(name)), "pos", "left")


def previous_in_book(entries: DataFrame) -> DataFrame:
    """Order in the book and the entry before, the sequential prerequisite."""
    w = W.partitionBy("book_id").orderBy("row_id")
    return entries.select("book_id", "entry_id", "row_id", F.row_number().over(w).alias("position"), F.lag("entry_id").over(w).alias("prerequisite"))


def progression(topics: DataFrame, base: Column) -> DataFrame:
    """Members of a name group by level: the member before, and a suffix where there are several."""
    t = topics.withColumn("base", base).where("base <> ''")
    w = W.partitionBy("base").orderBy(level_rank(F.col("educational_level")), "subtopic_id")
    n = F.count("*").over(W.partitionBy("base"))
    rank = F.row_number().over(w)
    suffix = F.when(n == 1, "").when(rank == 1, " (Introductory)").when(rank == n, " (Advanced)").otherwise(" (Intermediate)")
    return t.select("subtopic_id", "base", rank.alias("step"), F.lag("subtopic_id").over(w).alias("previous"), F.concat(F.col("name"), suffix).alias("title"))


def smoothness(u: DataFrame) -> DataFrame:
    """One row: changes of level between neighbours, those that do not fall, and their share (1 without changes)."""
    pairs = u.select("pos", level_rank(F.col("level")).alias("rank"))
    nxt = pairs.select((F.col("pos") - 1).alias("pos"), F.col("rank").alias("next"))
    j = pairs.join(nxt, "pos").where("rank <> next")
    return j.agg(F.count("*").alias("changes"), F.count(F.when(F.col("next") > F.col("rank"), 1)).alias("rising")).withColumn("smoothness", F.when(F.col("changes") == 0, 1.0).otherwise(F.round(F.try_divide("rising", "changes"), 6)))


def resolved_prerequisites(u: DataFrame) -> DataFrame:
    """(unit_id, prerequisite_id, positions of both): names resolved to the earliest unit of that name."""
    names = u.groupBy(F.lower(F.trim("title")).alias("key")).agg(F.min(F.struct("pos", "unit_id")).alias("p"))
    want = u.select("unit_id", F.col("pos").alias("unit_pos"), F.explode("prerequisites").alias("name")).select("unit_id", "unit_pos", F.lower(F.trim("name")).alias("key")).distinct()
    return want.join(names, "key").where("p.unit_id <> unit_id").select("unit_id", F.col("p.unit_id").alias("prerequisite_id"), "unit_pos", F.col("p.pos").alias("prerequisite_pos")).distinct()


def prerequisite_depth(u: DataFrame, resolved: DataFrame) -> DataFrame:
    """1 + the last position of a unit's prerequisites; 0 without any."""
    last = resolved.groupBy("unit_id").agg(F.max("prerequisite_pos").alias("last"))
    return u.select("unit_id").join(last, "unit_id", "left").select("unit_id", F.coalesce(F.col("last") + 1, F.lit(0)).alias("depth"))


BLOCK = 4096
BLOCKS = 512


def inversions(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """group, n, inversions: pairs of rows i before j (by `order`, whole numbers from 0 on) with value_i > value_j.

    Rows are counted in blocks of the order, at most BLOCKS per group, so that a group of a third of all rows is spread out;
    pairs across blocks follow from the counts of values per block. Different values should be few.
    """
    base = rows.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(order).cast("long").alias("o"), F.col(value).cast("long").alias("v"))
    size = base.groupBy("g").agg(F.count("*").alias("n"), F.max("o").alias("top"))
    width = F.greatest(F.lit(BLOCK), F.ceil((F.col("top") + 1) / BLOCKS))
    blocked = base.join(size, "g").select("g", "o", "v", F.floor(F.col("o") / width).alias("block"), (F.col("top") >= width).alias("many"))
    kind = base.schema["g"].dataType.simpleString()

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One total per block, from rows sorted by group, block and order."""
        now, g, seen, total = None, None, {}, 0
        for batch in batches:
            out: list = []
            for key, block, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if (key, block) != now:
                    out.append((g, total))
                    now, g, seen, total = (key, block), key, {}, 0
                total += sum([n for y, n in seen.items() if y > v])
                seen[v] = seen.get(v, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], batch.schema.field(0).type), pa.array([t for _, t in out], pa.int64())], ["g", "k"])
            last = batch.schema.field(0).type
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([g], last), pa.array([total], pa.int64())], ["g", "k"])

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.pivot_table(index="block", columns="v", values="n", fill_value=0, aggfunc="sum").sort_index().sort_index(axis=1).to_numpy()
        before = np.cumsum(table, axis=0) - table
        higher = before.sum(axis=1, keepdims=True) - np.cumsum(before, axis=1)
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "k": [int((table * higher).sum())]})

    own = blocked.repartition("g", "block").sortWithinPartitions("g", "block", "o").select("g", "block", "v").mapInArrow(inside, f"g {kind}, k long").where("k > 0")
    counts = blocked.where("many").groupBy("g", "block", "v").agg(F.count("*").alias("n"))
    sums = own.unionByName(counts.groupBy("g").applyInPandas(across, f"g {kind}, k long")).groupBy("g").agg(F.sum("k").alias("inversions"))
    return size.join(sums, "g", "left").select(F.col("g").alias(group), "n", F.coalesce("inversions", F.lit(0)).alias("inversions"))


def elective_placement(u: DataFrame) -> DataFrame:
    """One row: mean position (0..1) of core and elective units, and whether all electives come after all core units."""
    n = u.agg(F.count("*").alias("n"))
    j = u.crossJoin(F.broadcast(n))
    at = F.col("pos") / F.greatest(F.col("n") - 1, F.lit(1))
    return j.agg(
        F.round(F.avg(F.when(F.col("is_core"), at)), 6).alias("core_mean"), F.round(F.avg(F.when(~F.col("is_core"), at)), 6).alias("elective_mean"),
        (F.min(F.when(~F.col("is_core"), F.col("pos"))) > F.max(F.when(F.col("is_core"), F.col("pos")))).alias("separated"),
    )


def checkpoints(u: DataFrame, number: int) -> DataFrame:
    """Stretches of n // number units (at least one): number of the checkpoint, first position, units, hours and remedial units."""
    n = u.agg(F.greatest(F.lit(1), F.floor(F.count("*") / number)).alias("step"))
    at = F.floor(F.col("pos") / F.col("step"))
    remedial = (F.col("difficulty") >= 3) | (F.size("prerequisites") >= 2)
    return u.crossJoin(F.broadcast(n)).groupBy((at + 1).alias("checkpoint")).agg(F.min("pos").alias("position"), F.count("*").alias("units"), F.sum("hours").alias("hours"), F.sum(remedial.cast("int")).alias("remedial"))


def branches(u: DataFrame) -> DataFrame:
    """Per unit: the unit two before (the first for the second), the unit two after, and the first two others of its domain."""
    last = u.agg(F.max("pos").alias("last"))
    back = shifted(shifted(u, 2, "back2"), 1, "back1")
    both = shifted(back, -2, "ahead").crossJoin(F.broadcast(last))
    review = F.when(F.col("pos") == 1, F.col("back1")).otherwise(F.col("back2"))
    firsts = u.withColumn("r", F.row_number().over(W.partitionBy("domain").orderBy("pos"))).where("r <= 3").groupBy("domain").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "unit_id"))), lambda s: s["unit_id"]).alias("firsts"))
    out = both.join(firsts, "domain").select("unit_id", F.array(review, F.col("ahead")).alias("steps"), F.slice(F.filter("firsts", lambda x: x != F.col("unit_id")), 1, 2).alias("related"))
    return out.select("unit_id", F.array_sort(F.array_distinct(F.filter(F.concat("steps", "related"), lambda x: x.isNotNull()))).alias("branches"))


VISUAL = ["kinematics", "waves", "optics", "electricity", "magnetism", "rotation", "oscillations"]  # fixed values
HIGH_YIELD = ["kinematics", "dynamics", "energy", "electricity", "magnetism", "waves", "optics", "thermodynamics"]  # fixed values


def interleaved(u: DataFrame) -> DataFrame:
    """Two visual units for every other unit, each kind in its own order; the rest follows when one kind ends."""
    kind = F.lower("domain").isin(VISUAL)
    ranked = global_rank(u.withColumn("visual", kind), [~F.col("visual"), F.floor(F.col("pos") / 1000)], [F.col("pos")], "_g")
    n = u.agg(F.sum(kind.cast("int")).alias("nv"))
    own = F.when(F.col("visual"), F.col("_g")).otherwise(F.col("_g") - F.col("nv"))
    key = F.when(F.col("visual"), F.floor(own / 2) * 3 + own % 2).otherwise(own * 3 + 2)
    return global_rank(ranked.crossJoin(F.broadcast(n)).select("unit_id", "visual", key.alias("key")), [F.floor(F.col("key") / 1000)], [F.col("key")], "place").select("unit_id", "visual", "place")


def systematic_sample(u: DataFrame, size: int) -> DataFrame:
    """Every n // size-th unit, the first `size` of them."""
    n = u.agg(F.greatest(F.lit(1), F.floor(F.count("*") / size)).alias("step"))
    return u.crossJoin(F.broadcast(n)).where((F.col("pos") % F.col("step") == 0) & (F.col("pos") / F.col("step") < size)).select("unit_id", "pos")


def stratified_sample(u: DataFrame, quota: int) -> DataFrame:
    """The first `quota` units of every domain and level."""
    return u.withColumn("place", F.row_number().over(W.partitionBy("domain", "level").orderBy("pos"))).where(F.col("place") <= quota).select("unit_id", "domain", "level", "place")


def exam_units(u: DataFrame) -> DataFrame:
    """Core or high-yield units or those with three objectives: the first 60 % of the number of all units."""
    fit = F.col("is_core") | F.lower("domain").isin(HIGH_YIELD) | (F.size("objectives") >= 3)
    n = u.agg(F.floor(F.count("*") * 0.6).alias("most"))
    chosen = global_rank(u.where(fit), [F.floor(F.col("pos") / 1000)], [F.col("pos")], "place")
    return chosen.crossJoin(F.broadcast(n)).where("place < most").select("unit_id", "place")


def accelerated_units(u: DataFrame) -> DataFrame:
    return u.where(F.col("is_core") | (F.size("prerequisites") >= 2) | (F.col("difficulty") >= 3)).select("unit_id")


def recommendations(u: DataFrame) -> DataFrame:
    """Up to four recommendations per unit with their confidence."""
    row = lambda kind, c, when: F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("confidence")))
    rules = [row("prerequisite", 0.9, F.size("prerequisites") > 0), row("remediation", 0.8, F.col("difficulty") >= 4), row("acceleration", 0.7, F.col("difficulty") <= 2), row("enrichment", 0.6, F.col("is_core"))]
    return u.select("unit_id", F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("r")).select("unit_id", "r.kind", "r.confidence")


def sibling_edges(entries: DataFrame, first: bool = True) -> DataFrame:
    """Edges between siblings: from the first sibling to every other, or from each to the next."""
    w = W.partitionBy("book_id", "parent_id").orderBy("row_id")
    source = F.first("entry_id").over(w) if first else F.lag("entry_id").over(w)
    e = entries.where("parent_id is not null").withColumn("source", source).where("source is not null and source <> entry_id")
    return e.select("book_id", "source", F.col("entry_id").alias("target"), F.lit(0.7).alias("confidence"))

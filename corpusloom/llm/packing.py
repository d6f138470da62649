"""Items in containers of fixed capacity, by dominance reduction and best fit on the histogram of sizes.

Sizes are whole numbers up to the capacity, so the whole instance is its histogram: at most `capacity` numbers, however
many items there are. The histogram is what the driver solves, exactly as the items themselves would be: first the
reduction of Martello and Toth (a set of items that dominates every other set holding its largest item is fixed for
good, with as many copies as there are), then best fit in order of falling size for the rest. The solution is a list of
patterns with multiplicities. Items then find their container by their rank among the items of their size; ranks come
from counts of small buckets, so a size that a third of all items share is no hot spot.

An item above the capacity is cut into full containers and a rest; the rest is packed like any other item.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

MAX_CAPACITY = 1 << 20
ROWS_PER_BUCKET = 200_000


def reduce_dominant(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fixed patterns (sizes, how often) and the counts that are left."""
    left = {s: n for s, n in counts.items() if n > 0}
    sizes = sorted(left)
    fixed: list[tuple[tuple[int, ...], int]] = []

    def drop(s: int, n: int) -> None:
        left[s] -= n
        if not left[s]:
            del left[s]
            sizes.pop(bisect_left(sizes, s))

    def largest(limit: int, without: dict[int, int]) -> int | None:
        """The largest size up to limit of which items are left besides those in without."""
        i = bisect_left(sizes, limit + 1) - 1
        while i >= 0 and left[sizes[i]] <= without.get(sizes[i], 0):
            i -= 1
        return sizes[i] if i >= 0 else None

    def smallest(n: int, without: dict[int, int]) -> list[int]:
        out: list[int] = []
        for s in sizes:
            out += [s] * min(n - len(out), left[s] - without.get(s, 0))
            if len(out) >= n:
                break
        return out

    for j in sorted(left, reverse=True):
        while left.get(j, 0):
            own = {j: 1}
            room = capacity - j
            k1 = largest(room, own)
            few = smallest(3, own)
            if k1 is None:
                fixed.append(((j,), left[j]))
                drop(j, left[j])
                continue
            pair_fits = len(few) >= 2 and few[0] + few[1] <= room
            if k1 == room or not pair_fits:
                n = min(left[j], left[k1]) if k1 != j else left[j] // 2
                fixed.append(((j, k1), n))
                if k1 != j:
                    drop(j, n)
                    drop(k1, n)
                else:
                    drop(j, 2 * n)
                continue
            if len(few) >= 3 and sum(few) <= room:
                break
            used = {j: 1}
            used[k1] = used.get(k1, 0) + 1
            b = largest(room - k1, used)
            half = largest(room // 2, own)
            if b is None or (half is not None and b < half):
                break
            need: dict[int, int] = {}
            for s in (j, k1, b):
                need[s] = need.get(s, 0) + 1
            n = min(left[s] // c for s, c in need.items())
            fixed.append(((j, k1, b), n))
            for s, c in need.items():
                drop(s, n * c)
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ((size, number), ...) and how often, by best fit in order of falling size."""
    open_: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    rooms: list[int] = []
    done: list[tuple[tuple[tuple[int, int], ...], int]] = []
    least = min(counts, default=0)

    def put(room: int, pattern, n: int) -> None:
        if room < least:
            done.append((pattern, n))
        elif n:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((pattern, n))

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            i = bisect_left(rooms, s)
            if i == len(rooms):
                room, group, have = capacity, (), n
            else:
                room = rooms[i]
                group, have = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
            k = room // s  # a container that is open stays the best fit until it is full
            full = min(have, n // k)
            if full:
                put(room - k * s, (*group, (s, k)), full)
                n -= full * k
            if group:
                rest = have - full
                if rest and 0 < n < k:
                    put(room - n * s, (*group, (s, n)), 1)
                    n, rest = 0, rest - 1
                if rest:
                    put(room, group, rest)
            elif 0 < n < k:
                put(room - n * s, ((s, n),), 1)
                n = 0
    for room in rooms:
        done += open_[room]
    return done


def solve(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns {size: number} and how often; together they hold exactly the items of counts."""
    fixed, left = reduce_dominant(counts, capacity)
    out: list[tuple[dict[int, int], int]] = []
    for sizes, n in fixed:
        if n:
            p: dict[int, int] = {}
            for s in sizes:
                p[s] = p.get(s, 0) + 1
            out.append((p, n))
    for pattern, n in best_fit(left, capacity):
        p = {}
        for s, k in pattern:
            p[s] = p.get(s, 0) + k
        out.append((p, n))
    return out


def token_count(text: str):
    """Tokens of the public ByT5 byte tokenizer: one per UTF-8 byte and one at the end."""
    return F.octet_length(text).cast("long") + 1


def place(items: DataFrame, containers: DataFrame, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """container_kind, key, piece, start_token, end_token, container of every item for every kind of container.

    items        key (unique) and size, whole and positive; rows without a size are no items
    containers   container_kind and capacity_tokens, few rows
    Pieces count from 0; an item within the capacity is piece 0. Containers are numbered from 0 within their kind: first
    the packed ones, then, under negative numbers, the full ones of cut items, whose number follows from item and piece.
    """
    spark = items.sparkSession
    kinds = containers.where("capacity_tokens > 0").select("container_kind", F.col("capacity_tokens").cast("long").alias("cap")).distinct()
    caps = {r[0]: int(r[1]) for r in kinds.collect()}
    if any(c > MAX_CAPACITY for c in caps.values()):
        raise ValueError(f"capacities above {MAX_CAPACITY} are not solved on their histogram")
    each = items.where(F.col(size) > 0).select(F.col(key).alias("key"), F.col(size).cast("long").alias("size")).crossJoin(F.broadcast(kinds))
    # An exact multiple of the capacity has no rest.
    rest = F.when(F.col("size") > F.col("cap"), F.pmod("size", F.col("cap"))).otherwise(F.col("size"))
    packed = each.withColumn("rest", rest).where("rest > 0")
    histogram = packed.groupBy("container_kind", "rest").count()
    counts: dict[str, dict[int, int]] = {k: {} for k in caps}
    for r in histogram.collect():  # at most one row per kind and size up to its capacity
        counts[r["container_kind"]][int(r["rest"])] = int(r["count"])
    spans, buckets = [], []
    for kind, cap in caps.items():
        base, seen = 0, dict.fromkeys(counts[kind], 0)
        for pattern, n in solve(counts[kind], cap):
            for s, k in pattern.items():
                spans.append((kind, s, seen[s], seen[s] + n * k, k, base))
                seen[s] += n * k
            base += n
        buckets += [(kind, s, -(-n // ROWS_PER_BUCKET)) for s, n in counts[kind].items()]
    span = spark.createDataFrame(spans or [("", 0, 0, 0, 1, 0)], "container_kind string, rest long, lo long, hi long, per long, base long")
    share = spark.createDataFrame(buckets or [("", 0, 1)], "container_kind string, rest long, buckets long")
    bucketed = packed.join(F.broadcast(share), ["container_kind", "rest"]).withColumn("bucket", F.pmod(F.xxhash64("key"), F.col("buckets")))
    group = ["container_kind", "rest", "bucket"]
    sums = bucketed.groupBy(*group).count()
    before = sums.select(*group, (F.sum("count").over(W.partitionBy("container_kind", "rest").orderBy("bucket")) - F.col("count")).alias("before"))
    ranked = bucketed.join(before, group).withColumn("rank", F.col("before") + F.row_number().over(W.partitionBy(*group).orderBy("key")) - 1)
    found = ranked.join(F.broadcast(span), ["container_kind", "rest"]).where("rank >= lo and rank < hi")
    last = F.floor((F.col("size") - F.col("rest")) / F.col("cap")).cast("int")
    rests = found.select("container_kind", "key", last.alias("piece"), (F.col("size") - F.col("rest")).alias("start_token"), F.col("size").alias("end_token"), (F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("per"))).alias("container"))
    cut = each.where("size > cap").select("container_kind", "key", "cap", F.explode(F.sequence(F.lit(0), (F.floor(F.col("size") / F.col("cap")) - 1).cast("int"))).alias("piece"))
    full = cut.select("container_kind", "key", "piece", (F.col("piece") * F.col("cap")).alias("start_token"), ((F.col("piece") + 1) * F.col("cap")).alias("end_token"), F.lit(-1).cast("long").alias("container"))
    return rests.unionByName(full).withColumnRenamed("key", key)


def report(placed: DataFrame, containers: DataFrame) -> DataFrame:
    """container_kind, capacity_tokens, n_containers, tokens, fill (tokens over room) of every kind."""
    one = placed.groupBy("container_kind", "container").agg(F.count("*").alias("n"), F.sum(F.col("end_token") - F.col("start_token")).alias("t"))
    per = one.groupBy("container_kind").agg(F.sum(F.when(F.col("container") >= 0, 1).otherwise(F.col("n"))).alias("n_containers"), F.sum("t").alias("tokens"))
    return per.join(F.broadcast(containers), "container_kind").select("container_kind", "capacity_tokens", "n_containers", "tokens", (F.col("tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill"))

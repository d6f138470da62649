"""Near-duplicate records by BagMinHash signatures, banding and exact verification.

1. words     Every text becomes its set of distinct words, as 40-bit hashes, and a 64-bit key of the set. Texts with the
             same key are copies and one node from here on.
2. weights   Document frequencies of all words over all rows go into a count sketch of fixed size; a word's weight falls
             with its share of all rows and is discretised to powers of two, so that two texts are found as surely in
             a large table as in a small one. A word that occurs once cannot be shared and weighs nothing; very frequent
             words weigh next to nothing, so that what two unrelated texts of one language share makes few candidates.
             Weights steer the candidate search only, never the verdict.
3. sign      BagMinHash: the weight axis is cut into dyadic intervals, and each (word, interval) owns a Poisson process
             over time with a signature slot per point and a rate in proportion to the interval. A word takes part with
             all intervals below its weight. The first point in a slot over all words of a text is the slot's signature;
             two texts agree in a slot with the probability of their weighted Jaccard similarity. Points come in blocks
             of growing size; only texts with undecided slots draw further blocks.
4. band      Slots are hashed in bands, some bands a pass: each pass has slots of its own, and its shuffle is deleted
             before the next. In a map task, a band value with many texts is first reduced to a star around one leader,
             so no bucket grows with a hot group; buckets above `star_above` become stars as well.
5. verify    Candidates must pass a bound that loses nothing (parity bits of both word sets differ in no more places than
             the sets have words apart), and what passes is held against the exact similarity of the word sets.
6. refine    Texts of starred buckets that are not yet in one component get new signatures with all words weighing the
             same and longer bands, inside their bucket, until no starred bucket is left with more than one component.
7. group     Links give components (large and small stars); copies join their node again.

Nulls count as empty texts; texts without words are in no group, except that they are no copies of each other either.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.durable import Scratch
from corpusloom.operators.components import components

_WORD = re.compile(r"[^\W_]+")
BYTES = 5  # of a word's hash
MASK = (1 << 8 * BYTES) - 1
DEPTH = 12  # the least weight is 2 ** -DEPTH
PART = 2_000_000  # band values that one task holds
RARE = 16  # words of at most so many rows weigh 1,
SHARE = 1 / 2000  # and words of at most so large a share of all rows,
KNEE = 1 / 240  # words of at most this share weigh 1 / 2, more frequent ones KNEE / share / 2
MISS = 0.003  # probability that refining misses a link at the threshold
NONE = DEPTH + 1  # level of a word that weighs nothing


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unpack(blobs) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of the blobs after each other, and the number of each."""
    sizes = np.array([len(b) // BYTES for b in blobs], dtype=np.int64)
    raw = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, BYTES)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :BYTES] = raw
    return out.view("<u8").ravel(), sizes


class _Hashes(dict):
    """Hashes of words, kept."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word) & MASK
        return h


def words_table(df: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """id, skey, words of every row that has a word; of the copies in one map task only the first keeps its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        seen: set[int] = set()
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, sizes, flat = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = _WORD.findall(text.lower())
                if not found:
                    continue
                flat += map(known.__getitem__, found)
                ids.append(i)
                sizes.append(len(found))
            if len(known) > 2_000_000:
                known.clear()
            # Sorted by text and hash in one key, each once; a batch has fewer than 2 ** 24 rows.
            both = np.sort(np.array(flat, dtype="<u8") | np.repeat(np.arange(len(sizes), dtype="<u8") << np.uint64(8 * BYTES), sizes))
            hashes = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
            sizes = np.bincount((hashes >> np.uint64(8 * BYTES)).astype(np.int64), minlength=len(sizes))
            packed = hashes.view(np.uint8).reshape(-1, 8)[:, :BYTES].tobytes()
            ends = np.cumsum(sizes) * BYTES
            blobs = [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())] if len(sizes) else []
            keys = [digest(b) - (1 << 63) for b in blobs]
            for i, k in enumerate(keys):
                if k in seen:
                    blobs[i] = None
                seen.add(k)
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["id", "skey", "words"])

    text = F.concat_ws(" ", *[F.coalesce(F.col(t), F.lit("")) for t in texts])
    return df.select(F.col(key).alias("id"), text.alias("text")).mapInArrow(run, f"id {df.schema[key].dataType.simpleString()}, skey long, words binary")


def frequency_sketch(words: DataFrame, bits: int) -> np.ndarray:
    """2**bits saturating counts of the texts that hold a word (copies in one map task count once). Its size does not depend on the data."""
    piece = 16  # bits of a slot within a piece

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            hashes, _ = _unpack(batch.column(0).to_pylist())
            slots, n = np.unique((hashes & np.uint64((1 << bits) - 1)).astype(np.int64), return_counts=True)
            total[slots] += n
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], ["slot", "n"])

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(1 << piece, dtype=np.uint32)
        part[pdf["slot"].to_numpy() & ((1 << piece) - 1)] = np.minimum(pdf["n"].to_numpy(), 0xFFFFFFFF)
        return pd.DataFrame({"piece": [int(pdf["slot"].iloc[0]) >> piece], "counts": [part.tobytes()]})

    sums = words.where("words is not null").select("words").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << bits, dtype=np.uint32)
    for row in sums.groupBy(F.expr(f"slot >> {piece}")).applyInPandas(gather, "piece long, counts binary").toLocalIterator():
        out[row["piece"] << piece : (row["piece"] + 1) << piece] = np.frombuffer(row["counts"], dtype=np.uint32)
    return out


def levels(df: np.ndarray, n_rows: int) -> np.ndarray:
    """Levels of document frequencies in n_rows rows: a word of level e weighs 2 ** -e, one of level NONE nothing."""
    beyond = 1 + np.ceil(np.log2(np.maximum(df / (KNEE * max(n_rows, 1)), 1.0))).clip(0, DEPTH - 1).astype(np.int64)
    return np.where(df < 2, NONE, np.where(df <= max(RARE, SHARE * n_rows), 0, beyond))


def _points(words: np.ndarray, level: np.ndarray, slots: int, block: int, time: np.ndarray, salt: int) -> np.ndarray:
    """First arrivals per slot (inf where none) in the block-th points of each word; moves time (word x interval) on."""
    first = np.full((len(words), slots), np.inf, dtype=np.float32)
    for j in range(DEPTH + 1):
        rows = np.flatnonzero(level <= j)
        if not len(rows):
            continue
        rate = slots * 2.0 ** -(j + (j < DEPTH))  # interval j is the upper half of [0, 2**-j), the last one is [0, 2**-DEPTH)
        n = (int(rate) + 3) << block
        at = np.uint64((salt << 50) + (j << 40)) + np.uint64((int(rate) + 3) * ((1 << block) - 1)) + np.arange(n, dtype=np.uint64)
        h = _mix(words[rows, None] * np.uint64(0xD1342543DE82EF95) + at[None, :])
        gap = np.log((((h >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24))).astype(np.float64) / -rate
        when = time[rows, j, None] + np.cumsum(gap, axis=1)
        slot = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(first.reshape(-1), (rows[:, None] * slots + slot).ravel(), when.ravel().astype(np.float32))
        time[rows, j] = when[:, -1]
    return first


def sign(hashes: np.ndarray, sizes: np.ndarray, level_of, slots: int, salt: int = 0) -> np.ndarray:
    """Signatures, one row of slots per set of word hashes; rows whose words all weigh nothing are inf. Each salt has processes of its own."""
    vocab, inverse = np.unique(hashes, return_inverse=True)
    level = level_of(vocab)
    out = np.full((len(sizes), slots), np.inf, dtype=np.float32)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    use = level[inverse] < NONE
    inverse, owner = inverse[use], owner[use]
    time = np.zeros((len(vocab), DEPTH + 1))
    time[np.arange(DEPTH + 1)[None, :] < level[:, None]] = np.inf  # intervals above the weight
    block = 0
    while len(owner):
        used = np.flatnonzero(np.bincount(inverse, minlength=len(vocab)))
        rank = np.empty(len(vocab), dtype=np.int64)
        rank[used] = np.arange(len(used))
        local = rank[inverse]
        first = np.empty((len(used), slots), dtype=np.float32)
        for s in range(0, len(used), 2048):
            w = used[s : s + 2048]
            t = time[w]
            first[s : s + 2048] = _points(vocab[w], level[w], slots, block, t, salt)
            time[w] = t
        begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        docs = owner[begins]
        ends = np.r_[begins[1:], len(owner)]
        reached = np.minimum.reduceat(time.min(axis=1)[inverse], begins)
        step = 128  # so that what is gathered stays in the cache
        for s in range(0, len(docs), step):
            b, e = begins[s], ends[min(s + step, len(docs)) - 1]
            got = np.minimum.reduceat(first[local[b:e]], begins[s : s + step] - b, axis=0)
            d = docs[s : s + step]
            out[d] = np.minimum(out[d], got)
        # A slot is decided once no word can still reach it earlier.
        keep = np.zeros(len(sizes), dtype=bool)
        keep[docs[(out[docs] > reached[:, None]).any(axis=1)]] = True
        inverse, owner = inverse[keep[owner]], owner[keep[owner]]
        block += 1
    return out


def _band_rows(keys: np.ndarray, within: np.ndarray, sig: np.ndarray, bands: int, width: int, star_above: int, salt: int):
    """(band value, node, leader, whether there is a leader) of one batch; a band value with many nodes has a leader."""
    by_node = np.argsort(keys, kind="stable")
    keys = keys[by_node]
    bits = sig[by_node].view(np.uint32).astype(np.uint64)
    value = np.repeat(_mix(within[by_node] + np.uint64(salt))[:, None], bands, axis=1)
    for k in range(width):
        value = _mix(value ^ bits[:, k * bands : (k + 1) * bands])
    value = _mix(value + np.arange(bands, dtype=np.uint64)[None, :])
    v = value.ravel().view(np.int64)
    node = np.repeat(keys, bands)
    order = np.argsort(v, kind="stable")
    v, node = v[order], node[order]
    begin = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    size = np.diff(np.r_[begin, len(v)])
    lead = np.repeat(node[begin], size)
    hot = np.repeat(size > star_above, size)
    return v, node, np.where(hot, lead, 0), hot


def band_rows(texts: DataFrame, sketch: Broadcast | None, n_rows: int, parts: int, bands: int, width: int, star_above: int, threshold: float, salt: int = 0) -> DataFrame:
    """The band values of texts (within, skey, words), packed: (part, free, tied) with the rows of one batch whose band value falls on the part.

    free   (value, node, 0 or 1 for a leader) of nodes that still look for partners
    tied   (value, node, leader) of nodes which the map task has tied to the leader of their band value
    Only texts with the same `within` can share a band value. Without a sketch all words weigh the same.
    """
    slots = bands * width
    step = max(256, 32_768 * 54 // slots)  # so that a batch of signatures stays small however long they are

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None if sketch is None else sketch.value
        mask = np.uint64(0 if counts is None else len(counts) - 1)

        def level_of(h):
            return np.zeros(len(h), dtype=np.int64) if counts is None else levels(counts[(h & mask).astype(np.int64)].astype(np.float64), n_rows)

        for within, keys, blobs in _rebatched(batches, step):
            hashes, sizes = _unpack(blobs)
            inside, k = np.array(within, dtype=np.int64).view(np.uint64), np.array(keys, dtype=np.int64)
            if counts is not None:
                # A text of which too few words occur elsewhere cannot be similar to any other.
                owner = np.repeat(np.arange(len(sizes)), sizes)
                shareable = np.bincount(owner, weights=counts[(hashes & mask).astype(np.int64)] > 1, minlength=len(sizes))
                can = shareable >= threshold * sizes
                hashes, sizes, inside, k = hashes[np.repeat(can, sizes)], sizes[can], inside[can], k[can]
            if not len(k):
                continue
            sig = np.ascontiguousarray(sign(hashes, sizes, level_of, slots, salt))
            v, node, lead, hot = _band_rows(k, inside, sig, bands, width, star_above, salt)
            tied = hot & (lead != node)
            # Nodes that are tied already need no bucket and are spread over all parts.
            part = np.where(tied, _mix(node.view(np.uint64)), v.view(np.uint64)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
            out: list[list] = [[], [], []]
            for p in range(parts):
                at = order[cut[p] : cut[p + 1]]
                if len(at):
                    t = at[tied[at]]
                    f = at[~tied[at]]
                    out[0].append(p)
                    out[1].append(np.concatenate([v[f], node[f], hot[f].astype(np.int64)]).tobytes() if hot[f].any() else np.concatenate([v[f], node[f]]).tobytes() + b"-")
                    out[2].append(np.concatenate([v[t], node[t], lead[t]]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["part", "free", "tied"])

    return texts.select("within", "skey", "words").mapInArrow(run, "part int, free binary, tied binary")


def _pairs_of(v: np.ndarray, node: np.ndarray, led: np.ndarray, star_above: int):
    """Pairs (a, b, band value, whether of a star) of the nodes that share a band value. A value with a leader or with many nodes makes a star."""
    order = np.argsort(v)
    same = v[order][1:] == v[order][:-1]
    order = order[np.r_[False, same] | np.r_[same, False]] if len(v) else order  # most values stand alone
    order = order[np.lexsort((node[order], led[order] == 0, v[order]))]
    v, node, led = v[order], node[order], led[order]
    keep = np.r_[True, (v[1:] != v[:-1]) | (node[1:] != node[:-1])] if len(v) else np.zeros(0, dtype=bool)
    v, node, led = v[keep], node[keep], led[keep]
    begin = np.flatnonzero(np.r_[True, v[1:] != v[:-1]]) if len(v) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.r_[begin, len(v)])
    star = (led[begin] == 1) | (size > star_above)
    # A star ties all others to the first; in a small bucket each is paired with all that follow.
    after = np.repeat(begin + size, size) - np.arange(len(v)) - 1
    first = np.zeros(len(v), dtype=bool)
    first[begin] = True
    n = np.where(np.repeat(star, size) & ~first, 0, after)
    a = np.repeat(np.arange(len(v)), n)
    b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
    return node[a], node[b], v[a], np.repeat(star, size)[a]


def candidates(rows: DataFrame, parts: int, star_above: int) -> DataFrame:
    """Candidate pairs (a, b, hot), with repeats; hot: a starred band value that the pair comes from, else null.

    The pairs of a starred band value tie all its nodes to one another, directly or through the leaders of map tasks.
    A task holds the packed values of one part, 16 bytes each, of which `parts` makes about PART.
    """

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free: list[np.ndarray] = []

        def show(a, b, h, star):
            at = np.flatnonzero(a != b)
            for s in range(0, len(at), 500_000):
                x = at[s : s + 500_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a[x], b[x])), pa.array(np.maximum(a[x], b[x])), pa.array(h[x], mask=~star[x])], ["a", "b", "hot"])

        for batch in batches:
            for f, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if f[-1:] == b"-" and len(f) % 8 == 1:
                    x = np.frombuffer(f[:-1], dtype=np.int64).reshape(2, -1)
                    free.append(np.stack([x[0], x[1], np.zeros(x.shape[1], dtype=np.int64)]))
                elif f:
                    free.append(np.frombuffer(f, dtype=np.int64).reshape(3, -1))
                if t:
                    v, node, lead = np.frombuffer(t, dtype=np.int64).reshape(3, -1)
                    yield from show(lead, node, v, np.ones(len(v), dtype=bool))
        if free:
            yield from show(*_pairs_of(*np.concatenate(free, axis=1), star_above))

    return rows.repartitionById(parts, F.col("part")).mapInArrow(pair, "a long, b long, hot long")


def _rebatched(batches: Iterator[pa.RecordBatch], least: int):
    """Lists of the columns, `least` rows at a time."""
    parts: list[list] = []
    for batch in batches:
        for s in range(0, batch.num_rows, least):
            new = [c.to_pylist() for c in batch.slice(s, least).columns]
            parts = [a + b for a, b in zip(parts, new)] if parts else new
            if len(parts[0]) >= least:
                yield parts
                parts = []
    if parts and parts[0]:
        yield parts


def similarity(a_words, b_words) -> np.ndarray:
    """Exact Jaccard similarity of pairs of sets of word hashes."""
    out = np.empty(len(a_words))
    for s in range(0, len(a_words), 8192):
        ha, na = _unpack(a_words[s : s + 8192])
        hb, nb = _unpack(b_words[s : s + 8192])
        pa_, pb = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
        both = np.concatenate([pa_, pb]).astype(np.uint64)
        h = np.concatenate([ha, hb])
        order = np.lexsort((h, both))
        h, both = h[order], both[order]
        same = (h[1:] == h[:-1]) & (both[1:] == both[:-1])
        inter = np.bincount(both[1:][same].astype(np.int64), minlength=len(na))
        out[s : s + 8192] = inter / (na + nb - inter)
    return out


def parity_bits(words: DataFrame) -> DataFrame:
    """(skey, n, p0..p3) of every node: its number of words, and 256 bits, each telling if an odd number of words fall on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes, sizes = _unpack(batch.column(1).to_pylist())
            at = (_mix(hashes) >> np.uint64(56)).astype(np.int64)
            bit = np.uint64(1) << (at & 63).astype(np.uint64)
            begin = np.r_[0, np.cumsum(sizes)[:-1]]
            lanes = [np.bitwise_xor.reduceat(np.where(at >> 6 == k, bit, np.uint64(0)), begin).view(np.int64) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), *map(pa.array, lanes)], ["skey", "n", "p0", "p1", "p2", "p3"])

    bits = words.where("words is not null").select("skey", "words").mapInArrow(run, "skey long, n long, p0 long, p1 long, p2 long, p3 long")
    return bits.groupBy("skey").agg(*[F.max(c).alias(c) for c in ("n", "p0", "p1", "p2", "p3")])


def possible(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that the numbers and parity bits of their words do not rule out: none that reaches the threshold is lost."""
    bits = parity_bits(words)
    ren = lambda side: bits.select(F.col("skey").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "p0", "p1", "p2", "p3")])
    apart = sum((F.bit_count(F.col(f"p{k}_a").bitwiseXOR(F.col(f"p{k}_b"))) for k in range(1, 4)), F.bit_count(F.col("p0_a").bitwiseXOR(F.col("p0_b"))))
    may = (apart <= (F.col("n_a") + F.col("n_b")) * ((1 - threshold) / (1 + threshold)) + 1e-9) & (F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-9)
    return pairs.select("a", "b").join(ren("a"), "a").join(ren("b"), "b").where(may).select("a", "b")


def verify(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose word sets reach the threshold."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sim = similarity(batch.column(2).to_pylist(), batch.column(3).to_pylist())
                yield batch.select([0, 1]).filter(pa.array(sim >= threshold - 1e-12))

    one = words.where("words is not null").groupBy("skey").agg(F.first("words").alias("words"))
    full = pairs.select("a", "b").join(one.select(F.col("skey").alias("a"), F.col("words").alias("wa")), "a").join(one.select(F.col("skey").alias("b"), F.col("words").alias("wb")), "b")
    return full.select("a", "b", "wa", "wb").mapInArrow(exact, "a long, b long")


def links_of(pairs: DataFrame, words: DataFrame, threshold: float, scratch: Scratch, per_key: int = 4096) -> DataFrame:
    """The candidate pairs that reach the threshold, cut.

    The text of many pairs (the leader of a star) is the join key of all of them: it is copied, once for each `per_key` of
    its pairs, and the pairs are spread over the copies.
    """
    left = scratch.cut(possible(pairs.distinct(), words, threshold))
    busy = left.groupBy("a").count().where(F.col("count") > per_key).select(F.col("a").alias("skey"), F.ceil(F.col("count") / per_key).alias("copies"))
    busy = scratch.cut(busy)
    if busy.isEmpty():
        return scratch.cut(verify(left, words, threshold))
    calm = verify(left.join(busy.select(F.col("skey").alias("a")), "a", "left_anti"), words, threshold)
    # A copy of a busy text has a key of its own, by which the pairs find it.
    copy = F.xxhash64("skey", "copy")
    copies = words.join(busy, "skey").select("skey", "words", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))).alias("copy")).select(copy.alias("skey"), "words")
    hot = left.join(busy.withColumnRenamed("skey", "a"), "a").select(F.col("a").alias("skey"), "b", F.pmod(F.xxhash64("b"), "copies").cast("int").alias("copy")).select("skey", "b", copy.alias("a"))
    names = hot.select("skey", "a").distinct()
    found = verify(hot, words.select("skey", "words").unionByName(copies), threshold)
    return scratch.cut(calm.unionByName(found.join(names, "a").select(F.col("skey").alias("a"), "b")))


def classes(df: DataFrame, key: str, texts: list[str], threshold: float = 0.6, bands: int = 40, width: int = 3, passes: int = 1, star_above: int = 256, sketch_bits: int = 22) -> DataFrame:
    """(id, class) of every row that has a word: class is the least node key of its group of near duplicates.

    threshold     least Jaccard similarity of distinct words of two linked records
    bands, width  shape of the candidate search; bands * width slots make a signature
    passes        number of parts in which the bands are made; with more of them less is on disk at once, for more work
    star_above    texts of one band value from which on pairs are formed with a leader first
    sketch_bits   log2 of the counts in the frequency sketch (4 bytes each)
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "neardup")
    words = scratch.cut(words_table(df, key, texts))
    nodes = words.where("words is not null").select(F.lit(0).cast("long").alias("within"), "skey", "words")
    sketch, n_rows = spark.sparkContext.broadcast(frequency_sketch(words, sketch_bits)), words.count()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = None
    for p in range(passes):
        share = bands * (p + 1) // passes - bands * p // passes
        parts = max(least, n_rows * share // PART + 1)
        part = scratch.cut(candidates(band_rows(nodes, sketch, n_rows, parts, share, width, star_above, threshold, p), parts, star_above))
        pairs = part if pairs is None else pairs.unionByName(part)
    links = links_of(pairs.select("a", "b"), words, threshold, scratch)
    groups = scratch.cut(components(links, scratch))
    starred, salt = pairs.where("hot is not null"), passes
    while not starred.isEmpty():
        # What the stars left in different components, together with all other texts of such a bucket.
        at = starred.select(F.col("hot").alias("band"), F.explode(F.array("a", "b")).alias("node")).distinct().join(groups, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
        at = scratch.cut(at)
        open_ = at.groupBy("band").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("band")
        texts_ = words.where("words is not null").select(F.col("skey").alias("node"), "words")
        again = scratch.cut(at.join(open_, "band").select("band", "node").join(texts_, "node").groupBy("band", "node").agg(F.first("words").alias("words")).select(F.col("band").alias("within"), F.col("node").alias("skey"), "words"))
        n_again = again.count()
        if not n_again:
            break
        width += 1
        # So many bands that a pair at the threshold is missed with probability MISS at most.
        more = int(np.ceil(np.log(MISS) / np.log1p(-(threshold**width))))
        parts = max(least, n_again * more // PART + 1)
        found = scratch.cut(candidates(band_rows(again, None, n_rows, parts, more, width, star_above, threshold, salt), parts, star_above))
        label = groups.select(F.col("node").alias("a"), F.col("root").alias("ra")), groups.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        apart = found.select("a", "b").distinct().join(label[0], "a", "left").join(label[1], "b", "left").select("a", "b", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb")).where("ra <> rb")
        apart = scratch.cut(apart)
        extra = links_of(apart.select("a", "b"), again.select("skey", "words"), threshold, scratch)
        starred, salt = found.where("hot is not null"), salt + 1
        if not extra.isEmpty():
            # Only roots are joined; what hangs on them follows.
            joined = components(extra.join(apart, ["a", "b"]).select(F.col("ra").alias("a"), F.col("rb").alias("b")), scratch)
            over = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
            alone = joined.select("node").join(groups, "node", "left_anti").select("node", F.col("node").alias("root"))
            groups = scratch.cut(groups.unionByName(alone).join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root")))
    ids = words.select("id", "skey")
    return ids.join(groups.select(F.col("node").alias("skey"), "root"), "skey", "left").select("id", F.coalesce("root", "skey").alias("class"))


def pairs_in_classes(members: DataFrame, block: int = 1024) -> DataFrame:
    """All pairs (a, b; a < b) of rows in the same class, where the result asks for them.

    A class of more than `block` rows is cut into blocks by a hash of the id; every pair of blocks is a join key of its own,
    so no task holds a whole class.
    """
    busy = members.groupBy("class").count().where("count > 1").select("class", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    inside = members.join(busy, "class").withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = inside.select("class", F.col("id").alias("a"), F.col("own").alias("x"), other.alias("y"))
    right = inside.select("class", F.col("id").alias("b"), F.col("own").alias("y"), other.alias("x"))
    return left.join(right, ["class", "x", "y"]).where("a < b").select("a", "b")

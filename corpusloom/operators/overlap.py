"""Numbers of common tokens of all pairs of two blocks of rows, and the best partners by that number.

A block is kept as postings by token. Of a token that many rows of both blocks hold, every pair of rows is counted by a
matrix product; of all others only the pairs that hold it are. No pair of rows is left out, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROWS = 2048  # rows of a block
DENSE = 400  # a matrix product takes about as long for so many pairs as adding up single ones takes for one
PAIRS = 1 << 21  # single pairs at once


class Postings:
    """Rows 0 to n - 1 by token number; a token that a row has several times weighs as much."""

    def __init__(self, row: np.ndarray, token: np.ndarray, n: int):
        key, weight = np.unique(token.astype(np.int64) * max(n, 1) + row, return_counts=True)
        self.n, self.row, self.weight = n, key % max(n, 1), weight.astype(np.float32)
        token = key // max(n, 1)
        self.tokens, self.start, self.size = np.unique(token, return_index=True, return_counts=True)

    def some(self, rows: np.ndarray) -> Postings:
        """These rows only, renumbered in their order."""
        at = np.full(self.n, -1)
        at[rows] = np.arange(len(rows))
        new, token = at[self.row], np.repeat(self.tokens, self.size)
        kept = new >= 0
        out = object.__new__(Postings)
        out.n, out.row, out.weight = len(rows), new[kept], self.weight[kept]
        out.tokens, out.start, out.size = np.unique(token[kept], return_index=True, return_counts=True)
        return out

    def most(self, tokens: np.ndarray) -> np.ndarray:
        """Per row, how many of these tokens (sorted) it has."""
        entry = np.repeat(np.isin(self.tokens, tokens, assume_unique=True), self.size)
        return np.bincount(self.row[entry], self.weight[entry], self.n)


def _entries(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions from each start, as many as its size."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def common(a: Postings, b: Postings) -> np.ndarray:
    """The sum of products of weights of common tokens, for every row of a and every row of b."""
    _, ia, ib = np.intersect1d(a.tokens, b.tokens, assume_unique=True, return_indices=True)
    pairs = a.size[ia] * b.size[ib]
    dense = pairs * DENSE >= a.n * b.n

    def matrix(p: Postings, i: np.ndarray) -> np.ndarray:
        out = np.zeros((p.n, len(i)), dtype=np.float32)
        at = _entries(p.start[i], p.size[i])
        out[p.row[at], np.repeat(np.arange(len(i)), p.size[i])] = p.weight[at]
        return out

    out = matrix(a, ia[dense]) @ matrix(b, ib[dense]).T
    ia, ib, pairs = ia[~dense], ib[~dense], pairs[~dense]
    part = np.cumsum(pairs) // PAIRS
    for k in np.unique(part):
        i, j = ia[part == k], ib[part == k]
        left = _entries(a.start[i], a.size[i])  # every entry of a with all entries of b of its token
        times, first = np.repeat(b.size[j], a.size[i]), np.repeat(b.start[j], a.size[i])
        right, left = _entries(first, times), np.repeat(left, times)
        np.add.at(out.reshape(-1), a.row[left] * b.n + b.row[right], a.weight[left] * b.weight[right])
    return out


class Queries:
    """Lists of words as blocks of postings. Lists of the same most frequent word stand together, so that a block has few words."""

    def __init__(self, lists: list[list[str]]):
        number: dict[str, int] = {}
        token = np.array([number.setdefault(w, len(number)) for words in lists for w in words], dtype=np.int64)
        row = np.repeat(np.arange(len(lists)), [len(words) for words in lists])
        often = np.bincount(token, minlength=1)
        lead = np.full(len(lists), -1)
        np.maximum.at(lead, row, np.argsort(np.argsort(often, kind="stable"))[token] if len(token) else lead[:0])
        self.words, self.order = list(number), np.argsort(lead, kind="stable")
        place = np.argsort(self.order)[row]
        self.blocks = []
        for k in range(0, len(lists), ROWS):
            own = (place >= k) & (place < k + ROWS)
            self.blocks.append(Postings(place[own] - k, token[own], min(ROWS, len(lists) - k)))

    def best(self, batches: Iterator[pa.RecordBatch], k: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(list, key, score) of the k best rows for every list; rows (key, words) come in the order in which ties go."""
        score = [np.zeros((b.n, k), dtype=np.float32) for b in self.blocks]
        place = [np.zeros((b.n, k), dtype=np.int64) for b in self.blocks]
        keys: list = []
        seen = 0
        words = pa.array(self.words, pa.string())
        for batch in batches:
            for cut in range(0, batch.num_rows, ROWS):
                rows = batch.slice(cut, ROWS)
                lists = rows.column(1)
                found = pc.index_in(lists.flatten(), value_set=words.cast(lists.type.value_type)).fill_null(-1).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(rows.num_rows), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
                there = Postings(row[found >= 0], found[found >= 0], rows.num_rows)
                for block, s, p in zip(self.blocks, score, place):
                    # A row that comes later must be better than the last of the k; none can be better than all its words allow.
                    able = np.flatnonzero(there.most(block.tokens) * block.weight.max(initial=0) > s[:, -1].min())
                    if not len(able):
                        continue
                    counts = common(block, there.some(able))
                    better = np.flatnonzero(counts.max(axis=1) > s[:, -1])
                    if not len(better):
                        continue
                    rank = counts[better].astype(np.int64) * len(able) + np.arange(len(able))[::-1]
                    most = min(k, len(able))
                    top = np.argpartition(-rank, most - 1, axis=1)[:, :most]
                    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(rank, top, axis=1), axis=1), axis=1)
                    new = np.concatenate([s[better], np.take_along_axis(counts[better], top, axis=1)], axis=1)
                    at = np.concatenate([p[better], seen + able[top]], axis=1)
                    order = np.argsort(-new, axis=1, kind="stable")[:, :k]
                    s[better], p[better] = np.take_along_axis(new, order, axis=1), np.take_along_axis(at, order, axis=1)
                keys.append(rows.column(0))
                seen += rows.num_rows
        s, p = (np.concatenate(x) if x else np.zeros((0, k), dtype=np.int64) for x in (score, place))
        q, j = np.nonzero(s)
        return self.order[q], (pa.concat_arrays(keys).take(pa.array(p[q, j])) if keys else None), s[q, j].astype(np.int64)

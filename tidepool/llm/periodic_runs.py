"""Runs of words that repeat with a period, found from the suffixes of each text.

A run is a stretch of consecutive words with a smallest period q, at least ``min_exponent``
times q and ``min_length`` words long, that no neighbouring word extends with that period.

The suffixes of a text are sorted by prefix doubling, which also gives the longest common
prefix (LCP) of neighbours. Kruskal's algorithm takes the neighbours by descending LCP and
unites their classes; a class keeps its positions in order. When two classes unite at LCP l,
positions i < j that become adjacent agree in exactly l words, so the l + (j - i) words from i
have period j - i, and it is their smallest: with a smaller one q <= l, position i + q would
have been in i's class before and lie between. Adjacent positions at a distance within their
LCP are therefore the seeds of runs; a seed whose left neighbours differ is where its run
begins, so each run is found once. Merging the smaller class into the larger one makes
O(n log n) insertions.

A run of the wanted length has seeds of an LCP that ``least_lcp`` bounds from below, so unions
end there, and suffixes whose first words stand nowhere else in their text take no part.
Words are compared by 64-bit hashes. Memory follows the longest text: under 30 numbers per
word that repeats.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import SPACED, mix, pieces, runs, text_bytes, words

MIN_LENGTH = 6
MIN_EXPONENT = 4
# Positions in a block of a large class.
_BLOCK = 1000


def least_lcp(min_length: int, min_exponent: int) -> int:
    """The least LCP of the two seed positions of a wanted run, over all periods."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, max(min_length, 2)))


class Positions:
    """An ordered set of positions, in blocks so that an insertion moves few of them."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, position: int):
        self.blocks = [[position]]
        self.firsts = [position]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def _block(self, position: int) -> int:
        return max(bisect_left(self.firsts, position) - 1, 0) if len(self.blocks) > 1 else 0

    def around(self, position: int) -> tuple[int | None, int | None]:
        """The neighbours that a new position would have."""
        k = self._block(position)
        block = self.blocks[k]
        at = bisect_left(block, position)
        before = block[at - 1] if at else None
        if at < len(block):
            return before, block[at]
        return before, self.blocks[k + 1][0] if k + 1 < len(self.blocks) else None

    def add(self, position: int) -> None:
        k = self._block(position)
        block = self.blocks[k]
        insort(block, position)
        self.size += 1
        if len(block) > 2 * _BLOCK:
            self.blocks[k : k + 1] = [block[:_BLOCK], block[_BLOCK:]]
            self.firsts.insert(k + 1, block[_BLOCK])
        self.firsts[k] = self.blocks[k][0]

    def unite(self, other: Positions) -> list[tuple[int, int]]:
        """Takes in a set; gives the pairs, one of each set, that are adjacent now."""
        pairs = []
        gap, last = None, None  # the gap in which the last new position lies
        for position in other:
            before, after = self.around(position)
            if gap is None or before != gap[0]:
                if gap is not None and gap[1] is not None:
                    pairs.append((last, gap[1]))
                if before is not None:
                    pairs.append((before, position))
                gap = (before, after)
            last = position
        if gap is not None and gap[1] is not None:
            pairs.append((last, gap[1]))
        for position in other:
            self.add(position)
        return pairs


def _suffixes(codes: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, of those that share ``shortest`` words with another, and LCPs.

    The LCP at k is that of suffixes k and k + 1; it is below ``shortest`` where they don't
    belong together.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = codes[order[1:]] != codes[order[:-1]]
    places = np.arange(n)
    rank = np.full(n + 1, -1, dtype=np.int64)  # of a suffix by its first words; -1 beyond the end
    rank[order] = np.maximum.accumulate(np.where(new, places, 0))
    levels, length = [rank], 1
    active = order[~(new & np.r_[new[1:], True])]
    candidates = active
    while len(active):
        key = rank[active] * (n + 1) + rank[active + length] + 1
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        old = rank[active]
        places = np.arange(len(active))
        new = np.ones(len(active), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        group = np.ones(len(active), dtype=bool)
        group[1:] = old[1:] != old[:-1]
        head = np.maximum.accumulate(np.where(new, places, 0))
        base = np.maximum.accumulate(np.where(group, places, 0))
        rank = rank.copy()
        rank[active] = old + head - base
        levels.append(rank)
        active = active[~(new & np.r_[new[1:], True])]
        length *= 2
        if length <= shortest:
            candidates = active
    order = candidates[np.argsort(rank[candidates], kind="stable")]
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(len(a), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        same = np.flatnonzero(levels[level][a] == levels[level][b])
        a[same] += 1 << level
        b[same] += 1 << level
        lcp[same] += 1 << level
    return order, lcp


def find_runs(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of integers, by start, then period."""
    shortest = least_lcp(min_length, min_exponent)
    if len(codes) <= shortest:
        return []
    order, lcp = _suffixes(codes, shortest)
    parent = list(range(len(order)))
    classes: list[Positions | None] = [Positions(p) for p in order.tolist()]

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    ties = np.flatnonzero(lcp >= shortest)
    for k in ties[np.argsort(-lcp[ties], kind="stable")].tolist():
        common = int(lcp[k])
        small, large = find(k), find(k + 1)
        if classes[small].size > classes[large].size:
            small, large = large, small
        for i, j in classes[large].unite(classes[small]):
            period = j - i
            if period * (min_exponent - 1) > common or common + period < min_length:
                continue
            if i == 0 or codes[i - 1] != codes[j - 1]:
                found.append((i, common + period, period))
        parent[small], classes[small] = large, None
    return sorted(found, key=lambda r: (r[0], r[2]))


def _candidates(hashes: np.ndarray, first: np.ndarray, shortest: int) -> np.ndarray:
    """The texts in which some ``shortest`` consecutive words stand twice."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keys = runs(hashes, shortest)
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    inside = np.flatnonzero(text[: len(keys)] == text[shortest - 1 :])
    text = text[inside]
    keys = mix(keys[inside] + mix(text.astype(np.uint64) + np.uint64(1)))
    by = np.argsort(keys, kind="stable")
    return np.unique(text[by[1:][keys[by[1:]] == keys[by[:-1]]]])


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each text, joined by a space, and where each text begins."""
    size = np.where(kept, ends - starts + 1, 0)
    sums = np.r_[0, np.cumsum(size)]
    offsets = sums[first]
    spaces = np.diff(offsets) > 0  # a text with words loses its last space
    shift = np.r_[0, np.cumsum(spaces)]
    out = np.full(offsets[-1], 0x20, dtype=np.uint8)
    at = np.flatnonzero(kept)
    step = 1 << 15
    for k in range(0, len(at), step):
        some = at[k : k + step]
        n = ends[some] - starts[some]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(sums[some], n) + inner] = data[np.repeat(starts[some], n) + inner]
    drop = offsets[1:][spaces] - 1
    return np.delete(out, drop), offsets - shift


def _strings(data: list[np.ndarray], offsets: list[np.ndarray]) -> pa.Array:
    """A string column from the pieces' bytes and offsets."""
    ends, total = [np.zeros(1, dtype=np.int64)], 0
    for part in offsets:
        ends.append(part[1:] + total)
        total += int(part[-1])
    ends, data = np.concatenate(ends), np.concatenate(data) if data else np.zeros(0, dtype=np.uint8)
    column = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data))
    return column.cast(pa.string())


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
# The texts of a part of a batch; bounds what a task holds beside its batch.
_PART_TEXTS = 500


def _find(batches: Iterator[pa.RecordBatch], min_length: int, min_exponent: int) -> Iterator[pa.RecordBatch]:
    shortest = least_lcp(min_length, min_exponent)
    for whole in batches:
        for start in range(0, whole.num_rows, _PART_TEXTS):
            batch = whole.slice(start, _PART_TEXTS)
            data, offsets = text_bytes(batch.column(1))
            counts, found, bytes_, ends = [], [[] for _ in range(batch.num_rows)], [], []
            for low, high in pieces(offsets):
                part = data[offsets[low] : offsets[high]]
                w = words(part, offsets[low : high + 1], SPACED)
                kept = np.ones(len(w.hashes), dtype=bool)
                for text in _candidates(w.hashes, w.first, shortest).tolist():
                    begin, end = int(w.first[text]), int(w.first[text + 1])
                    found[low + text] = find_runs(w.hashes[begin:end].view(np.int64), min_length, min_exponent)
                    for at, length, period in found[low + text]:
                        kept[begin + at + period : begin + at + length] = False
                counts.append(w.per_text)
                text_data, text_ends = _joined(part, w.starts, w.ends, kept, w.first)
                bytes_.append(text_data)
                ends.append(text_ends)
            listed = [[dict(zip(("start", "length", "period"), r)) for r in rows] for rows in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                    pa.array(listed, pa.list_(_RUN)),
                    _strings(bytes_, ends),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Runs of every row of ``docs`` (doc_id, text, ...).

    Gives doc_id, n_words, runs (array of start, length and period in words, by start, then
    period) and collapsed: the words joined by single spaces, less those that some run holds
    after its first period. Words are what white space separates. A null or empty text has
    no words and an empty ``collapsed``; a null doc_id stays. Repeated rows are searched
    each; other columns are ignored. ``min_exponent`` is 2 or more.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 or more")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _find(batches, min_length, min_exponent),
        f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def strongest(runs: Column) -> Column:
    """The run of the greatest length over period; of equal ones the first in the list."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(
        runs,
        none,
        lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
        ).otherwise(best),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a periodic tail in every tenth text, by a hash of its doc_id.

    With h the crc32 of the decimal doc_id and g = floor(h / 10), texts with h % 10 = 0 that
    have words repeat p of them from word a on, where a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and those without an id, stay.
    """
    cells = "_" * (1 + max(map(len, docs.columns)))  # no column's name
    h = F.crc32(F.col("doc_id").cast("string"))
    split = F.array_remove(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), "")
    g, n = F.floor(h / 10), F.size(cells)
    a = F.when(n > 0, g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (3 + g % 8))).cast("int")
    planted = F.transform(cells, lambda w, i: F.when(i < a, w).otherwise(F.get(cells, a + (i - a) % p)))
    text = F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text"))
    chosen = docs.withColumn(cells, F.when(h % 10 == 0, split))
    return chosen.select([text.alias("text") if c == "text" else F.col(c) for c in docs.columns])

"""Hashed words and structure statistics of texts, as numpy arrays per piece of a batch."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .text import ALNUM, FOLD, Words, pieces, text_bytes, words

_LINE = np.ones(256, dtype=bool)
_LINE[0x0A] = False


def _marked(characters: str) -> np.ndarray:
    marks = np.zeros(256, dtype=np.int64)
    marks[[ord(c) for c in characters]] = 1
    return marks


_COUNTED = [
    _marked("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    _marked("0123456789"),
    _marked("#*$%&|<>"),
    _marked("!"),
    _marked(".,;:?()\"'-"),
    _marked(" \t\n\r"),
    (np.arange(256) >= 0x80).astype(np.int64),
]
N_STATISTICS = len(_COUNTED) + 7


@dataclass
class Bags:
    """Sparse rows: the hashed words of consecutive texts with their counts."""

    first: np.ndarray
    buckets: np.ndarray
    counts: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.first) - 1


def bags(w: Words, bits: int) -> Bags:
    texts = len(w.first) - 1
    text = np.repeat(np.arange(texts, dtype=np.uint64), w.per_text)
    keys, counts = np.unique(text << np.uint64(bits) | w.hashes >> np.uint64(64 - bits), return_counts=True)
    first = np.searchsorted(keys, np.arange(texts + 1, dtype=np.uint64) << np.uint64(bits))
    return Bags(first, (keys & np.uint64((1 << bits) - 1)).astype(np.int64), counts)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches; an empty stretch gives 0."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), dtype=np.float64)
    filled = np.flatnonzero(np.diff(first))
    if len(filled):
        out[filled] = np.add.reduceat(values, first[filled], axis=0)
    return out


def _statistics(data: np.ndarray, offsets: np.ndarray, w: Words, bag: Bags) -> np.ndarray:
    """Shares of kinds of bytes, lengths, and how much repeats; one row per text."""
    size = np.diff(offsets).astype(np.float64)
    n = w.per_text.astype(np.float64)
    some, any_word = np.maximum(size, 1), np.maximum(n, 1)
    columns = [row_sums(marks[data], offsets) / some for marks in _COUNTED]
    lines = words(data, offsets, _LINE)
    n_lines = np.maximum(lines.per_text, 1)
    line_bag = bags(lines, 40)
    columns.append(np.log1p(size))
    columns.append(np.log1p(n))
    columns.append(row_sums((w.ends - w.starts).astype(np.float64), w.first) / any_word)
    columns.append(np.diff(bag.first) / any_word)
    columns.append(row_sums(bag.counts.astype(np.float64) ** 2, bag.first) / any_word**2)
    columns.append(1 - np.diff(line_bag.first) / n_lines)
    columns.append(n_lines / any_word)
    return np.stack(columns, axis=1)


def featured(column: pa.Array, bits: int) -> Iterator[tuple[int, int, Bags, np.ndarray]]:
    """(first text, end, hashed words, statistics) for pieces of a string column."""
    data, offsets = text_bytes(column)
    for first, last in pieces(offsets):
        part = data[offsets[first] : offsets[last]]
        starts = offsets[first : last + 1] - offsets[first]
        w = words(FOLD[part], starts, ALNUM)
        bag = bags(w, bits)
        yield first, last, bag, _statistics(part, starts, w, bag)


def bag_lists(bag: Bags) -> tuple[pa.Array, pa.Array]:
    """Two list columns, buckets and counts, to carry sparse rows in a DataFrame."""
    first = pa.array(bag.first.astype(np.int32))
    return (
        pa.ListArray.from_arrays(first, pa.array(bag.buckets.astype(np.int32))),
        pa.ListArray.from_arrays(first, pa.array(bag.counts.astype(np.int32))),
    )


def gathered(table: pa.Table) -> Bags:
    """Sparse rows from collected ``buckets`` and ``counts`` columns."""
    lists = table["buckets"].combine_chunks()
    sizes = np.array([len(x) if x is not None else 0 for x in lists], dtype=np.int64)
    counts = table["counts"].combine_chunks()
    return Bags(np.r_[0, np.cumsum(sizes)], lists.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy())

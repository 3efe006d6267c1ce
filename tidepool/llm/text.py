"""Words and their hashes, for whole Arrow batches of texts at once.

Everything works on the UTF-8 bytes of a string column with numpy: no Python object per
word. Hashes depend on nothing but the bytes, so they agree between tasks and machines.
A 64-bit hash stands for a word or a run of words; two different ones agree with a
probability of 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# How many bytes of text are hashed at a time; bounds the temporary arrays.
PIECE = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, 2 * PIECE)
_INVERSE_POWERS = _powers(_BASE_INVERSE, 2 * PIECE)

# Words between white space, as in [^\x20\x09-\x0D]+.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
# Words of letters and digits, and of all that is not ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
# after folding.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
# Letters alone, after folding.
LETTERS = ALNUM.copy()
LETTERS[0x30:0x3A] = False

# A-Z to a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text begins; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; a longer text comes alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """The words of consecutive texts: byte positions, hashes, and where each text begins."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, first: np.ndarray):
        self.starts, self.ends, self.hashes, self.first = starts, ends, hashes, first

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)


def _hash_piece(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(data)
    if n <= len(_POWERS):
        powers, inverse = _POWERS, _INVERSE_POWERS
    else:  # one word longer than a piece
        powers, inverse = _powers(_BASE, n), _powers(_BASE_INVERSE, n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers[:n], out=sums[1:])
    polynomial = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(polynomial + (ends - starts).astype(np.uint64) * _STEP)


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """The maximal runs of bytes that ``is_word`` marks, within each text."""
    offsets = offsets - offsets[0]
    inside = is_word[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    cuts = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    cuts = cuts[inside[cuts] & inside[cuts - 1]]  # words that meet where two texts meet
    edges = [change, cuts, cuts]
    if len(data) and inside[0]:
        edges.append(np.zeros(1, dtype=np.int64))
    if len(data) and inside[-1]:
        edges.append(np.full(1, len(data), dtype=np.int64))
    edges = np.sort(np.concatenate(edges), kind="stable")
    starts, ends = edges[0::2], edges[1::2]
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):  # pieces end between words
        low = starts[at]
        to = max(int(np.searchsorted(ends, low + PIECE, side="right")), at + 1)
        high = ends[to - 1]
        hashes[at:to] = _hash_piece(data[low:high], starts[at:to] - low, ends[at:to] - low)
        at = to
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def batch_words(column: pa.Array, is_word: np.ndarray, fold: bool) -> Iterator[tuple[int, int, Words]]:
    """(first text, end of texts, their words) for pieces of a string column."""
    data, offsets = text_bytes(column)
    for first, last in pieces(offsets):
        part = data[offsets[first] : offsets[last]]
        yield first, last, words(FOLD[part] if fold else part, offsets[first : last + 1], is_word)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` consecutive words; empty when there are fewer."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        total = total * _STEP + hashes[k : k + n]
    return mix(total + np.uint64(length))


def shingles(hashes: np.ndarray, length: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word runs; a short text is one run."""
    if len(hashes) == 0:
        return hashes
    return np.unique(runs(hashes, min(length, len(hashes))))

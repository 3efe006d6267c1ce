"""Adaptive context mixing of token ids, and a range coder, over many lanes at once.

A block of n ids is cut into lanes of equal length, and numpy codes the t-th id of every lane
in one step. The lanes of a block share one model and each has its own range coder.

The model mixes three predictions of the next id: order 0, the ids counted so far in the
block; order 1, the id that last followed the previous one; order 2, the id that last
followed the previous two. Orders 1 and 2 each put a share of the probability on one id, by
how often that prediction has held when its context looked alike. The mixture is

    [ order 0 | extra share at the order 1 id | extra share at the order 2 id ]

in whole numbers that add up to 2**TOTAL_BITS, so encoder and decoder agree exactly. Model
updates use ids that both sides know, after each step.
"""

from __future__ import annotations

import numpy as np

TOTAL_BITS = 26
LANE_IDS = 512
MAX_LANES = 4096
# Order 0 counts are folded into the distribution after so many steps.
REFRESH = 32
_SLOTS = 1 << 18  # of the order 2 table
_ZERO_BITS = 21  # order 0 spreads 2**21 or a multiple, the shares of orders 1 and 2 the rest
_EXTRA = (1 << TOTAL_BITS) - (1 << _ZERO_BITS)
_CLASSES = 4  # how often in a row a context's prediction has held, up to 3
_U64 = np.uint64
_LOW32 = _U64(0xFFFFFFFF)


def lanes_of(n: int) -> tuple[int, int]:
    """(lanes, ids per lane) of a block of n ids."""
    lanes = max(1, min(MAX_LANES, -(-n // LANE_IDS)))
    return lanes, -(-n // lanes)


class _Model:
    def __init__(self, vocabulary: int, lanes: int):
        self.counts = np.ones(vocabulary, dtype=np.int64)
        self.recent: list[np.ndarray] = []
        self.next1 = np.zeros(vocabulary, dtype=np.int32)
        self.held1 = np.zeros(vocabulary, dtype=np.int8)
        self.next2 = np.zeros(_SLOTS, dtype=np.int32)
        self.held2 = np.zeros(_SLOTS, dtype=np.int8)
        self.previous = np.zeros(lanes, dtype=np.int64)
        self.before = np.zeros(lanes, dtype=np.int64)
        # tries and hits of both predictions by their classes
        self.tries = np.full((_CLASSES, _CLASSES), 8, dtype=np.int64)
        self.hits1 = np.full((_CLASSES, _CLASSES), 2, dtype=np.int64)
        self.hits2 = np.full((_CLASSES, _CLASSES), 2, dtype=np.int64)
        self._refresh()

    def _refresh(self) -> None:
        if self.recent:
            ids = np.concatenate(self.recent)
            self.counts += 24 * np.bincount(ids, minlength=len(self.counts))
            self.recent = []
        scale = (1 << _ZERO_BITS) - len(self.counts)
        share = self.counts * scale // int(self.counts.sum()) + 1
        share[0] += (1 << _ZERO_BITS) - int(share.sum())
        self.zero = np.zeros(len(share) + 1, dtype=np.int64)
        np.cumsum(share, out=self.zero[1:])
        self._weigh()

    def _weigh(self) -> None:
        self.share1 = _EXTRA * self.hits1 // (self.tries + self.tries // 16 + 1)
        self.share2 = _EXTRA * self.hits2 // (self.tries + self.tries // 16 + 1)

    def predict(self) -> None:
        """Sets the two predicted ids of each lane, the lower first, and their shares."""
        self.slot = (self.before * 40503 + self.previous * 2654435761) >> 7 & (_SLOTS - 1)
        self.one, self.two = self.next1[self.previous], self.next2[self.slot]
        self.class1, self.class2 = self.held1[self.previous], self.held2[self.slot]
        share1, share2 = self.share1[self.class1, self.class2], self.share2[self.class1, self.class2]
        same = self.one == self.two
        share2 = np.where(same, np.maximum(share1, share2), share2)
        share1 = np.where(same, 0, np.minimum(share1, _EXTRA - share2))
        swap = self.one > self.two
        self.a, self.b = np.where(swap, self.two, self.one), np.where(swap, self.one, self.two)
        self.share_a, self.share_b = np.where(swap, share2, share1), np.where(swap, share1, share2)
        # what neither gets goes to order 0, by whole multiples
        self.times = ((1 << TOTAL_BITS) - share1 - share2) >> _ZERO_BITS

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each lane's id begins in the mixture, and its share."""
        begin, end = self.zero[ids], self.zero[ids + 1]
        low = begin * self.times + self.share_a * (self.a < ids) + self.share_b * (self.b < ids)
        size = (end - begin) * self.times + self.share_a * (self.a == ids) + self.share_b * (self.b == ids)
        return low, size

    def find(self, value: np.ndarray) -> np.ndarray:
        """The id whose interval holds the value, in each lane."""
        low_a, size_a = self.interval(self.a)
        low_b, size_b = self.interval(self.b)
        # the first id whose end lies above the value, with the extra shares taken off
        below = value - self.share_a * (value >= low_a + size_a) - self.share_b * (value >= low_b + size_b)
        ids = np.searchsorted(self.zero, below // self.times, side="right") - 1
        ids = np.where((value >= low_a) & (value < low_a + size_a), self.a, ids)
        return np.where((value >= low_b) & (value < low_b + size_b), self.b, ids)

    def update(self, ids: np.ndarray, step: int) -> None:
        hit1, hit2 = ids == self.one, ids == self.two
        if step % 4 == 0:  # a sample of the steps is enough for the shares
            pair = self.class1.astype(np.int64) * _CLASSES + self.class2
            n = _CLASSES * _CLASSES
            shape = (_CLASSES, _CLASSES)
            self.tries += np.bincount(pair, minlength=n).reshape(shape)
            self.hits1 += np.bincount(pair[hit1], minlength=n).reshape(shape)
            self.hits2 += np.bincount(pair[hit2], minlength=n).reshape(shape)
        # of lanes with one context the last counts: numpy assigns in order
        self.held1[self.previous] = np.where(hit1, np.minimum(self.class1 + 1, _CLASSES - 1), 0)
        self.next1[self.previous] = ids
        self.held2[self.slot] = np.where(hit2, np.minimum(self.class2 + 1, _CLASSES - 1), 0)
        self.next2[self.slot] = ids
        self.before, self.previous = self.previous, ids
        self.recent.append(ids)
        if step % REFRESH == REFRESH - 1 or step < 4:
            self._refresh()


def _settle(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Lanes that are to move 32 bits on; their range is cut where it crosses such a step."""
    small = np.flatnonzero(size <= _LOW32)
    crosses = ((low[small] ^ (low[small] + size[small] - _U64(1))) >> _U64(32)) != 0
    cut = small[crosses]
    size[cut] = (~low[cut] & _LOW32) + _U64(1)
    return small


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    """The lanes of a block of ids below ``vocabulary``: their lengths, then their words."""
    lanes, steps = lanes_of(len(ids))
    table = np.zeros(lanes * steps, dtype=np.int64)
    table[: len(ids)] = ids
    table = np.ascontiguousarray(table.reshape(lanes, steps).T)
    model = _Model(vocabulary, lanes)
    low = np.zeros(lanes, dtype=np.uint64)
    size = np.full(lanes, _U64(0xFFFFFFFFFFFFFFFF))
    out = np.zeros((lanes, steps + 2), dtype=np.uint32)
    sent = np.zeros(lanes, dtype=np.int64)
    for t in range(steps):
        model.predict()
        begin, share = model.interval(table[t])
        unit = size >> _U64(TOTAL_BITS)
        low += unit * begin.astype(np.uint64)
        size = unit * share.astype(np.uint64)
        moving = _settle(low, size)
        out[moving, sent[moving]] = low[moving] >> _U64(32)
        sent[moving] += 1
        low[moving] <<= _U64(32)
        size[moving] <<= _U64(32)
        model.update(table[t], t)
    every = np.arange(lanes)
    for _ in range(2):
        out[every, sent] = low >> _U64(32)
        sent += 1
        low <<= _U64(32)
    used = np.arange(steps + 2) < sent[:, None]
    return sent.astype("<u4").tobytes() + out[used].astype("<u4").tobytes()


def decode(payload: bytes, n: int, vocabulary: int) -> np.ndarray:
    """The n ids that ``encode`` was given."""
    lanes, steps = lanes_of(n)
    words = np.frombuffer(payload, dtype="<u4")
    ends = np.cumsum(words[:lanes].astype(np.int64)) + lanes
    at = ends - words[:lanes]
    words = np.r_[words, np.zeros(2, dtype=np.uint32)].astype(np.uint64)
    model = _Model(vocabulary, lanes)
    low = np.zeros(lanes, dtype=np.uint64)
    size = np.full(lanes, _U64(0xFFFFFFFFFFFFFFFF))
    code = words[at] << _U64(32) | words[at + 1]
    at = at + 2
    table = np.zeros((steps, lanes), dtype=np.int64)
    top = (1 << TOTAL_BITS) - 1
    for t in range(steps):
        model.predict()
        unit = size >> _U64(TOTAL_BITS)
        value = np.minimum((code - low) // unit, _U64(top)).astype(np.int64)
        ids = model.find(value)
        begin, share = model.interval(ids)
        low += unit * begin.astype(np.uint64)
        size = unit * share.astype(np.uint64)
        moving = _settle(low, size)
        code[moving] = code[moving] << _U64(32) | words[np.minimum(at[moving], len(words) - 1)]
        at[moving] += 1
        low[moving] <<= _U64(32)
        size[moving] <<= _U64(32)
        model.update(ids, t)
        table[t] = ids
    return table.T.reshape(-1)[:n]

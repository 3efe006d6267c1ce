"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

    z = bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

The pairwise sum is half of |sum_i v_i x_i|^2 - sum_i |v_i x_i|^2, so a text is scored in
time linear in its words. Inputs are the text's words, hashed to 2**BITS buckets and scaled
to length 1, shares of kinds of characters, lengths and repetition, and the length that the
table states. It is fitted on the driver to a bounded sample of labelled rows, and applied
to all rows by the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import N_STATISTICS, Bags, bag_lists, featured, gathered, row_sums
from .tables import joined

BITS = 14
FACTORS = 6
# About so many labelled documents are used, chosen by a hash of the id.
TRAIN_DOCS = 8_000
_EPOCHS, _BATCH, _RATE = 12, 128, 0.02
_DECAY_WORDS, _DECAY_STATISTICS = 2e-2, 1e-4


@dataclass
class Machine:
    bias: np.ndarray  # 1
    w: np.ndarray  # statistics, then buckets
    v: np.ndarray  # the same, by factor
    centre: np.ndarray
    spread: np.ndarray

    def dense(self, statistics: np.ndarray) -> np.ndarray:
        return np.clip((statistics - self.centre) / self.spread, -5, 5)

    def logits(self, dense: np.ndarray, bag: Bags, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(z, sum_i v_i x_i) of each row; ``dense`` is standardised."""
        s = dense.shape[1]
        at = bag.buckets + s
        z = self.bias[0] + dense @ self.w[:s] + row_sums(self.w[at] * x, bag.first)
        parts = self.v[at] * x[:, None]
        total = dense @ self.v[:s] + row_sums(parts, bag.first)
        squares = dense**2 @ self.v[:s] ** 2 + row_sums(parts**2, bag.first)
        return z + 0.5 * (total**2 - squares).sum(axis=1), total


def _values(bag: Bags) -> np.ndarray:
    """Inputs of the hashed words: square roots of their shares, so a row has length 1."""
    n = row_sums(bag.counts.astype(np.float64), bag.first)
    return np.sqrt(bag.counts / np.repeat(n, np.diff(bag.first)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _rows(bag: Bags, x: np.ndarray, rows: np.ndarray) -> tuple[Bags, np.ndarray]:
    sizes = np.diff(bag.first)[rows]
    first = np.r_[0, np.cumsum(sizes)]
    at = np.arange(first[-1]) + np.repeat(bag.first[rows] - first[:-1], sizes)
    return Bags(first, bag.buckets[at], bag.counts[at]), x[at]


def fit(statistics: np.ndarray, bag: Bags, label: np.ndarray, bits: int = BITS, seed: int = 7) -> Machine | None:
    """A machine for P(label = 1), by Adam on the logistic loss; None without rows."""
    if len(label) == 0:
        return None
    random = np.random.default_rng(seed)
    s = statistics.shape[1]
    size = s + (1 << bits)
    m = Machine(
        np.zeros(1),
        np.zeros(size),
        random.normal(0, 0.01, (size, FACTORS)),
        statistics.mean(axis=0),
        np.maximum(statistics.std(axis=0), 1e-6),
    )
    share = min(max(label.mean(), 1e-3), 1 - 1e-3)
    m.bias[0] = np.log(share / (1 - share))
    decay = np.full(size, _DECAY_WORDS)
    decay[:s] = _DECAY_STATISTICS
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (m.bias, m.w, m.v)]
    dense, x, t = m.dense(statistics), _values(bag), 0
    for _ in range(_EPOCHS):
        order = random.permutation(len(label))
        for start in range(0, len(order), _BATCH):
            rows = order[start : start + _BATCH]
            part, px = _rows(bag, x, rows)
            z, total = m.logits(dense[rows], part, px)
            g = (_sigmoid(z) - label[rows]) / len(rows)
            gw = decay * m.w
            gw[:s] += g @ dense[rows]
            at, spread = part.buckets + s, np.repeat(g, np.diff(part.first)) * px
            gw += np.bincount(at, spread, minlength=size)
            gv = decay[:, None] * m.v
            gv[:s] += dense[rows].T @ (g[:, None] * total) - (g @ dense[rows] ** 2)[:, None] * m.v[:s]
            pull = np.repeat(total, np.diff(part.first), axis=0) - m.v[at] * px[:, None]
            for f in range(FACTORS):
                gv[:, f] += np.bincount(at, spread * pull[:, f], minlength=size)
            t += 1
            for p, grad, (m1, m2) in zip((m.bias, m.w, m.v), (np.array([g.sum()]), gw, gv), moments):
                m1 += 0.1 * (grad - m1)
                m2 += 0.01 * (grad**2 - m2)
                p -= _RATE * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
    return m


def _inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, bag, statistics in featured(batch.column(1), BITS):
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), *bag_lists(bag), pa.array(list(_with_length(statistics, part)))],
                names=["doc_id", "label", "buckets", "counts", "statistics"],
            )


def _with_length(statistics: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    """Statistics and the stated length, the batch's last column; a null counts as 0."""
    stated = batch.column(batch.num_columns - 1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    return np.c_[statistics, np.log1p(np.maximum(stated, 0))]


def _stated_length(docs: DataFrame):
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")


def train(docs: DataFrame, labels: DataFrame, target: str, train_docs: int = TRAIN_DOCS) -> Machine | None:
    """Fits to ``labels`` (doc_id, target 0/1) of ``docs``; rows of null are left out.

    A document with labels that disagree counts once with each. The text, the stated length
    and nothing else are inputs.
    """
    known = labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(target).cast("int").alias("label")
    )
    n = max(known.count(), 1)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(draw < min(1.0, train_docs / n)).distinct()
    rows = joined(docs.select("doc_id", "text", _stated_length(docs).alias("stated")), chosen, "doc_id", "inner", train_docs)
    sample = rows.select("doc_id", "text", "label", "stated").mapInArrow(
        _inputs, "doc_id long, label int, buckets array<int>, counts array<int>, statistics array<double>"
    ).toArrow()
    if sample.num_rows == 0:
        return None
    sample = sample.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    statistics = sample["statistics"].combine_chunks().flatten().to_numpy().reshape(-1, N_STATISTICS + 1)
    return fit(statistics, gathered(sample), sample["label"].to_numpy().astype(np.float64))


def _score(batches: Iterator[pa.RecordBatch], machine: Machine | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = np.full(batch.num_rows, 0.5)
        for first, last, bag, statistics in featured(batch.column(1), BITS) if machine else ():
            dense = machine.dense(_with_length(statistics, batch.slice(first, last - first)))
            scores[first:last] = _sigmoid(machine.logits(dense, bag, _values(bag))[0])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs`` (doc_id, text, n_chars if any).

    A null or empty text is scored like any other, by its lengths of 0; without a machine
    every score is 0.5. Repeated rows are scored each; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(machine)
    out = docs.select("doc_id", "text", _stated_length(docs).alias("stated")).mapInArrow(
        lambda b: _score(b, held.value), "doc_id long, score double"
    )
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

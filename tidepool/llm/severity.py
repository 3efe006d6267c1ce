"""Toxicity severity by cumulative-link ordinal regression.

Grades 0 < 1 < ... < K share one weight per word: P(grade > k) = sigmoid(z - threshold_k)
with z the weighted sum of a text's hashed words and thresholds in ascending order. The
expected severity is the sum of these probabilities. Only words whose presence goes with a
grade above 0 in the sample beyond chance get a weight, so long clean texts stay at 0.

The model is fitted on the driver to a bounded sample of graded rows and applied to all
rows by the executors. Where labels only say toxic or not, ``grades_from_flags`` grades the
toxic ones by how many words of the learned vocabulary they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import Bags, bag_lists, bags, gathered, row_sums
from .tables import joined
from .text import ALNUM, batch_words

BITS = 18
# About so many labelled documents are used, chosen by a hash of the id.
TRAIN_DOCS = 12_000
# A word counts up to so often in one text.
REPEATS = 4
# Words need that many sampled toxic texts, and that many standard errors of log odds.
MIN_TEXTS, MIN_Z = 5, 3.0
# A toxic text is of grade 1, and of one more for each of these numbers of toxic words.
GRADE_WORDS = (3, 6)
_STEPS, _RATE, _DECAY = 400, 0.05, 1e-4


@dataclass
class Severity:
    buckets: np.ndarray  # sorted
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, bag: Bags) -> np.ndarray:
        """P(grade > k) of each row, a column for each k."""
        at = np.minimum(np.searchsorted(self.buckets, bag.buckets), max(len(self.buckets) - 1, 0))
        if len(self.buckets):
            weight = np.where(self.buckets[at] == bag.buckets, self.weights[at], 0.0)
        else:
            weight = np.zeros(len(bag.buckets))
        z = row_sums(weight * np.minimum(bag.counts, REPEATS), bag.first)
        return _sigmoid(z[:, None] - self.thresholds)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def toxic_buckets(bag: Bags, toxic: np.ndarray) -> np.ndarray:
    """Buckets that stand in toxic rows more often than chance would have it."""
    row = np.repeat(toxic, np.diff(bag.first))
    n = 1 << BITS
    yes = np.bincount(bag.buckets[row], minlength=n)
    no = np.bincount(bag.buckets[~row], minlength=n)
    all_yes, all_no = int(toxic.sum()), int((~toxic).sum())
    odds = np.log((yes + 0.5) / (all_yes - yes + 0.5)) - np.log((no + 0.5) / (all_no - no + 0.5))
    error = np.sqrt(1 / (yes + 0.5) + 1 / (all_yes - yes + 0.5) + 1 / (no + 0.5) + 1 / (all_no - no + 0.5))
    return np.flatnonzero((yes >= MIN_TEXTS) & (odds > MIN_Z * error))


def grades_from_flags(bag: Bags, toxic: np.ndarray) -> np.ndarray:
    """0 for rows that aren't toxic, else 1 and one more for each of GRADE_WORDS reached."""
    known = np.zeros(1 << BITS, dtype=bool)
    known[toxic_buckets(bag, toxic)] = True
    found = row_sums(np.where(known[bag.buckets], bag.counts, 0).astype(np.float64), bag.first)
    return np.where(toxic, 1 + sum((found >= g).astype(np.int64) for g in GRADE_WORDS), 0)


def fit(bag: Bags, grade: np.ndarray) -> Severity | None:
    """Maximum likelihood by Adam, for grades 0, 1, ..., K; None without rows."""
    if len(grade) == 0:
        return None
    top = max(int(grade.max()), 1)
    buckets = toxic_buckets(bag, grade > 0)
    keep = np.isin(bag.buckets, buckets)
    column = np.searchsorted(buckets, bag.buckets[keep])
    row = np.repeat(np.arange(len(grade)), np.diff(bag.first))[keep]
    x = np.minimum(bag.counts[keep], REPEATS).astype(np.float64)
    above = np.array([(grade > k).mean() for k in range(top)])
    above = np.clip(above, 1e-4, 1 - 1e-4)
    w, theta = np.zeros(len(buckets)), np.log((1 - above) / above)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(theta), np.zeros_like(theta)]
    n, every = len(grade), np.arange(len(grade))
    for t in range(1, _STEPS + 1):
        z = np.bincount(row, w[column] * x, minlength=n)
        f = np.c_[np.ones(n), _sigmoid(z[:, None] - theta), np.zeros(n)]  # P(grade > k - 1)
        slope = f * (1 - f)
        high, low = slope[every, grade], slope[every, grade + 1]
        p = np.maximum(f[every, grade] - f[every, grade + 1], 1e-9)
        gw = -np.bincount(column, ((high - low) / p)[row] * x, minlength=len(w)) / n + _DECAY * w
        gt = np.array([((high / p)[grade == k + 1].sum() - (low / p)[grade == k].sum()) / n for k in range(top)])
        for param, g, m1, m2 in ((w, gw, *moments[:2]), (theta, gt, *moments[2:])):
            m1 += 0.1 * (g - m1)
            m2 += 0.001 * (g**2 - m2)
            param -= _RATE * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        np.maximum.accumulate(theta, out=theta)
    return Severity(buckets, w, theta)


def _inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, w in batch_words(batch.column(1), ALNUM, fold=True):
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), *bag_lists(bags(w, BITS))],
                names=["doc_id", "label", "buckets", "counts"],
            )


def train(docs: DataFrame, labels: DataFrame, target: str, flags: bool, train_docs: int = TRAIN_DOCS) -> Severity | None:
    """Fits to ``labels`` (doc_id, target) of ``docs`` (doc_id, text).

    The target is a grade from 0 up, or with ``flags`` 0 or 1. Rows of null or negative
    targets are left out; a document with labels that disagree counts once with each.
    """
    known = labels.where((F.col(target) >= 0) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(target).cast("int").alias("label")
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(draw < min(1.0, train_docs / max(known.count(), 1))).distinct()
    rows = joined(docs.select("doc_id", "text"), chosen, "doc_id", "inner", train_docs)
    sample = rows.select("doc_id", "text", "label").mapInArrow(
        _inputs, "doc_id long, label int, buckets array<int>, counts array<int>"
    ).toArrow()
    if sample.num_rows == 0:
        return None
    sample = sample.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    bag, label = gathered(sample), sample["label"].to_numpy().astype(np.int64)
    return fit(bag, grades_from_flags(bag, label > 0) if flags else label)


def _score(batches: Iterator[pa.RecordBatch], model: Severity | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        expected, toxic, grade = (np.zeros(batch.num_rows) for _ in range(3))
        for first, last, w in batch_words(batch.column(1), ALNUM, fold=True) if model else ():
            above = model.above(bags(w, BITS))
            expected[first:last] = above.sum(axis=1)
            toxic[first:last] = above[:, 0]
            grade[first:last] = (above >= 0.5).sum(axis=1)  # the median grade
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(expected),
                pa.array(toxic),
                pa.array(grade.astype(np.int32)),
                pa.array(grade > 0),
            ],
            names=["doc_id", "expected_severity", "p_toxic", "grade", "toxic"],
        )


def score(docs: DataFrame, model: Severity | None) -> DataFrame:
    """(doc_id, expected_severity, p_toxic, grade, toxic) of every row (doc_id, text, ...).

    A null, empty or wordless text has the severity of a text without any known word;
    without a model every text has 0. Repeated rows are scored each; other columns are
    ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(
        lambda b: _score(b, held.value),
        "doc_id long, expected_severity double, p_toxic double, grade int, toxic boolean",
    )

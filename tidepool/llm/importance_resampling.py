"""Importance resampling of documents towards a target corpus, by hashed word runs.

Texts are taken in batches: they are joined with a separator between any two, one pass of a
regular expression finds the words of all, ``searchsorted`` in the texts' offsets tells whose
they are and masks runs that reach into another text, and ``bincount`` adds up their buckets.

A run of up to ``max_run`` words is a feature; its bucket is a crc32 of its bytes. A bucket's
gain is the logarithm of its share in the target over its share in the documents, both
smoothed by one. A document's weight is the mean gain of its features; a Gumbel number from a
hash of its id is added, so taking the highest scores draws documents without replacement
in proportion to exp(weight / 1000).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import numbered
from ..sources.scratch import written
from .text import pieces, text_bytes

BUCKETS = 10_000
MAX_RUN = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

# Fixed value: words of letters and digits, and of all that is not ASCII, after folding.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SEPARATOR = b"\n"
# Bytes of texts that are joined, words found at a time, and features that a task remembers.
_JOINED, _WORDS, _REMEMBERED = 1 << 20, 1 << 16, 200_000


class _Buckets(dict):
    """Features to their buckets, worked out once each."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        self[feature] = bucket = crc32(feature) % self.buckets
        return bucket


def _found(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(words, number of each one's text) over the joined texts, some words at a time."""
    offsets = np.cumsum([0, *(len(t) + len(_SEPARATOR) for t in texts)])
    matches = _WORD.finditer(_SEPARATOR.join(texts).lower())  # folds A-Z alone
    while some := list(islice(matches, _WORDS)):
        starts = np.fromiter((m.start() for m in some), dtype=np.int64, count=len(some))
        yield [m[0] for m in some], np.searchsorted(offsets, starts, side="right") - 1


def _features(texts: list[bytes], max_run: int, bucket_of: _Buckets) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(run length, text of each feature, its bucket)."""
    tail, tail_of = [], np.zeros(0, dtype=np.int64)  # the last words, whose runs go on
    for new, new_of in _found(texts):
        found, of = tail + new, np.r_[tail_of, new_of]
        for length in range(1, max_run + 1):
            first = max(len(tail) - length + 1, 0)
            ends = of[first + length - 1 :]
            whole = np.flatnonzero(of[first : first + len(ends)] == ends) + first
            if length == 1:
                buckets = np.fromiter(map(bucket_of.__getitem__, new), dtype=np.int64, count=len(new))
            else:
                joined = (b" ".join(found[i : i + length]) for i in whole.tolist())
                buckets = np.fromiter(map(bucket_of.__getitem__, joined), dtype=np.int64, count=len(whole))
            yield length, of[whole], buckets
        if max_run > 1:
            tail, tail_of = found[1 - max_run :], of[1 - max_run :]
        if len(bucket_of) > _REMEMBERED:
            bucket_of.clear()


def _parts(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, end, texts) of some texts of a column at a time; a null is empty."""
    _, offsets = text_bytes(column)
    for low, high in pieces(offsets, _JOINED):
        part = column.slice(low, high - low).cast(pa.large_binary()).fill_null(b"")
        yield low, high, part.to_pylist()


def _count(batches: Iterator[pa.RecordBatch], max_run: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total, bucket_of = np.zeros(buckets, dtype=np.int64), _Buckets(buckets)
    for batch in batches:
        for _, _, texts in _parts(batch.column(0)):
            for _, _, found in _features(texts, max_run, bucket_of):
                total += np.bincount(found, minlength=buckets)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all texts by bucket; buckets without any have no row."""
    found = texts.select("text").mapInArrow(lambda b: _count(b, max_run, buckets), "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain in thousandths; a number per bucket, whatever the corpora's size."""
    s, t = (np.zeros(buckets, dtype=np.int64) for _ in range(2))
    for counts, texts in ((s, docs), (t, target)):
        for bucket, n in bucket_counts(texts, max_run, buckets).collect():
            counts[bucket] = n
    shares = ((t + 1.0) * (s.sum() + float(buckets))) / ((s + 1.0) * (t.sum() + float(buckets)))
    return np.floor(1000 * np.log(shares)).astype(np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], max_run: int, gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    bucket_of = _Buckets(len(gains))
    for batch in batches:
        n_words, n, total = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
        for low, high, texts in _parts(batch.column(1)):
            many = high - low
            for length, of, buckets in _features(texts, max_run, bucket_of):
                counts = np.bincount(of, minlength=many)
                n[low:high] += counts
                # sums of integers far below 2**53 are exact
                total[low:high] += np.bincount(of, gains[buckets], many).astype(np.int64)
                if length == 1:
                    n_words[low:high] += counts
        weight = total // np.maximum(n, 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x) for x in (n_words, n, weight))],
            names=["doc_id", "n_words", "n_features", "weight"],
        )


def weights(docs: DataFrame, gains: np.ndarray, max_run: int = MAX_RUN) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row: its mean gain, rounded down, or 0."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _weigh(batches, max_run, gains),
        f"doc_id {kind}, n_words long, n_features long, weight long",
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    max_run: int = MAX_RUN,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, ...) with its weight, score and rank in the draw.

    Gives doc_id, n_words, n_features, weight, score and rank. Of the N documents with at least
    ``min_words`` words, floor(percent * N / 100) of the highest scores are drawn and ranked
    from 1; ties go to the smaller doc_id, null ids last. Other ranks are null. A null or empty
    text has no features and weight 0. Repeated rows are drawn each; rows without an id share
    one random number. Other columns are ignored; no rows give none.
    """
    gains = bucket_gains(docs, target, max_run, buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = written(weights(docs, gains, max_run).withColumn("score", F.col("weight") + gumbel))

    # Scores are whole thousandths of logarithms: under 100,000 different ones, so their counts
    # may come to the driver, where they give the least score that is drawn.
    able = F.col("n_words") >= min_words
    counts = scored.where(able).groupBy("score").count().collect()
    drawn = percent * sum(r["count"] for r in counts) // 100
    least, total = None, 0
    for score, n in sorted(counts, reverse=True):
        if total >= drawn:
            break
        least, total = score, total + n
    none = F.lit(None).cast("long")
    if least is None:
        return scored.withColumn("rank", none)
    high = F.coalesce(able & (F.col("score") >= least), F.lit(False))
    ranked = numbered(scored.where(high), [F.desc("score"), F.asc_nulls_last("doc_id")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return scored.where(~high).withColumn("rank", none).unionByName(ranked)

"""Parity-sketch join: groups of documents whose word shingles overlap.

Two sets of sizes p and q have a Jaccard similarity of at least 3/4 exactly when they differ
in at most (p + q) / 7 elements. A parity sketch makes that cheap to see. Each shingle's hash
is XORed into one of K segments, so a shingle that only one of two documents has changes one
segment: the number of differing segments is at most the number of differing shingles. Of any
d + 1 segments of two documents that differ in d shingles at least one is equal.

Documents meet in size bands, each with its own K. A document puts its d + 1 first segments,
in an order that depends only on the segments' contents, into an equality join; the order
starts with segments that hold a rare shingle, so passages which many documents share seldom
bring documents together. Further sketches of 512 parity bits, and of 4,096 for large sets,
whose Hamming distance bounds the difference from below too, reject most candidates that are
left; the others are compared by their whole shingle sets.

Groups may hold any share of the corpus. First rounds link documents to a few others that
share one of their four first segments; documents in one group then carry one label. The full
join only has to look at segments that two different labels share, first with such rounds
and at last at all pairs of different labels, so no group's pairs are listed. Documents that
share a passage share many segments; segments that the very same documents hold give the same
pairs, so one of them stands for all.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .components import components
from .tables import in_arrow, joined, long_lists
from .text import SPACED, batch_words, mix, shingles

WORDS = 5
# Similarity: 100 * intersection >= 75 * union, so the difference is at most (p + q) / 7.
SHARE = 75
SKETCH_WORDS = 8  # of 64 parity bits
# Sets from this size up, whose difference 512 bits bound too weakly, have a wider sketch.
WIDE_FROM, WIDE_WORDS = 200, 64
FIRST_KEYS = 4
# Rounds of merging at most, by first segments and by all, and the documents that each one
# tries per round.
FIRST_ROUNDS, ROUNDS, BEST_PIVOTS = 1, 2, 3
# A shingle is frequent when that many documents of one batch hold it; the list of frequent
# ones only orders segments, and its size is bounded.
FREQUENT_IN_BATCH = 4
FREQUENT_KEPT = 200_000
# Pairs compared against one document by one task.
PIVOT_ROWS = 512
# Least keys of a document that tell at which of their keys two documents are listed.
LEAST_KEYS = 16

_SKETCH = [f"c{i}" for i in range(SKETCH_WORDS)]
_SETS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]
    + [("first", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))]
    + [("wide", pa.list_(pa.int64()))]
    + [(c, pa.int64()) for c in _SKETCH]
)
_SETS_DDL = (
    "doc_id long, n long, digest binary, first array<long>, keys array<long>, wide array<long>, "
    + ", ".join(f"{c} long" for c in _SKETCH)
)


def _largest_difference(n: int, m: int) -> int:
    return (n + m) // 7


def _segment_keys(hashes: np.ndarray, frequent: np.ndarray, band: int, count: int) -> np.ndarray:
    """The first ``count`` of the document's segments in one band, as join keys."""
    k = 2 << (2 * band)  # half the largest size in the band
    segment = (hashes >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)  # rises with the hash
    begins = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    parity = np.bitwise_xor.reduceat(mix(hashes), begins)
    rare = np.logical_or.reduceat(~frequent, begins)
    filled = segment[begins]
    salt = np.uint64(band << 40)
    keys = mix(parity ^ mix(filled + salt))
    order = np.lexsort((keys, ~rare))
    keys = keys[order]
    if len(keys) < count:  # the rest are empty segments, in the order of their hashes
        empty = np.setdiff1d(np.arange(k, dtype=np.uint64), filled)
        keys = np.r_[keys, np.sort(mix(mix(empty + salt)))]
    return keys[:count]


def _document(hashes: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys of the document's own band, keys of the band below that it reaches into)."""
    n = len(hashes)
    band = (n.bit_length() - 1) // 2  # sizes of 4**band to 4**(band + 1) - 1
    own = _segment_keys(hashes, frequent, band, _largest_difference(n, 4 * n // 3) + 1)
    below = np.zeros(0, dtype=np.uint64)
    floor = 4**band
    if band and 3 * n <= 4 * (floor - 1):
        below = _segment_keys(hashes, frequent, band - 1, _largest_difference(n, floor - 1) + 1)
    return own, below


def _is_frequent(hashes: np.ndarray, frequent: np.ndarray, bits: np.ndarray) -> np.ndarray:
    found = bits[(hashes >> np.uint64(44)).astype(np.int64)]
    at = np.flatnonzero(found)
    if len(at):
        where = np.searchsorted(frequent, hashes[at])
        found[at] = frequent[np.minimum(where, len(frequent) - 1)] == hashes[at]
    return found


def _sketch(hashes: np.ndarray, words: int) -> np.ndarray:
    bit = mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(64 * words)
    odd = (np.bincount(bit.astype(np.int64), minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << 20, dtype=bool)
    bits[(frequent >> np.uint64(44)).astype(np.int64)] = True
    nothing = np.zeros(0, dtype=np.uint64)
    for batch in batches:
        ids = batch.column(0)
        for low, high, w in batch_words(batch.column(1), SPACED, fold=True):
            sizes, digests, first, keys, wide, sketches = [], [], [], [], [], []
            for a, b in zip(w.first[:-1], w.first[1:]):
                own = shingles(w.hashes[a:b], WORDS)
                sizes.append(len(own))
                if len(own):
                    mine, below = _document(own, _is_frequent(own, frequent, bits))
                    digests.append(blake2b(own.tobytes(), digest_size=16).digest())
                else:
                    mine, below = nothing, nothing
                    digests.append(None)
                first.append(mine[:FIRST_KEYS])
                keys.append(np.r_[mine, below])
                wide.append(_sketch(own, WIDE_WORDS) if len(own) >= WIDE_FROM else nothing.view(np.int64))
                sketches.append(_sketch(own, SKETCH_WORDS))
            columns = [ids.slice(low, high - low), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
            columns += [long_lists(first), long_lists(keys), long_lists(wide)]
            columns += [pa.array(c) for c in np.stack(sketches, axis=1)]
            yield pa.RecordBatch.from_arrays(columns, schema=_SETS)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that several documents of a batch hold, with how many do."""
    for batch in batches:
        for held in _held(batch.column(1)):
            held.sort()
            begins = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
            counts = np.diff(np.r_[begins, len(held)])
            many = counts >= FREQUENT_IN_BATCH
            yield pa.RecordBatch.from_arrays(
                [pa.array(held[begins[many]].view(np.int64)), pa.array(counts[many].astype(np.int64))],
                names=["hash", "docs"],
            )


def _held(column: pa.Array, limit: int = 4_000_000) -> Iterator[np.ndarray]:
    """The shingles of a batch's documents, each once per document, in bounded portions."""
    portion, size = [], 0
    for _, _, w in batch_words(column, SPACED, fold=True):
        for a, b in zip(w.first[:-1], w.first[1:]):
            portion.append(shingles(w.hashes[a:b], WORDS))
            size += len(portion[-1])
            if size >= limit:
                yield np.concatenate(portion)
                portion, size = [], 0
    if size:
        yield np.concatenate(portion)


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Hashes of the shingles that the most documents share: at most FREQUENT_KEPT, sorted."""
    counted = in_arrow(docs.select("doc_id", "text"), _frequent, "hash long, docs long")
    top = counted.groupBy("hash").agg(F.sum("docs").alias("docs")).orderBy(F.desc("docs"), "hash")
    kept = top.limit(FREQUENT_KEPT).select("hash").toArrow()["hash"].to_numpy()
    return np.sort(kept.astype(np.int64).view(np.uint64)) if len(kept) else np.zeros(1, np.uint64)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """Size, digest, join keys and parity bits of every document's shingle set, stored."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs))
    sets = written(in_arrow(docs.select("doc_id", "text"), lambda b: _sets(b, shared.value), _SETS_DDL))
    shared.unpersist()
    return sets


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pivot, salt, role, doc_id, text) to the same with the shingle set in place of the text."""
    for batch in batches:
        for low, high, w in batch_words(batch.column(1), SPACED, fold=True):
            sets = [shingles(w.hashes[a:b], WORDS).tobytes() for a, b in zip(w.first[:-1], w.first[1:])]
            part = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sets, pa.binary()), part.column(2)], names=["doc_id", "items", "meets"]
            )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pivot, the pivot's own set first, to the pairs that are similar enough."""
    group, pivot = None, None
    for batch in batches:
        linked: list[tuple[int, int]] = []
        columns = [batch.column(i).to_pylist() for i in range(3)]
        for p, salt, doc, items in zip(*columns, batch.column(3)):
            own = np.frombuffer(items.as_buffer(), dtype=np.uint64)
            if (p, salt) != group:
                group, pivot = (p, salt), own.copy()  # role 0 comes first
                continue
            both = len(np.intersect1d(own, pivot, assume_unique=True))
            if 100 * both >= SHARE * (len(own) + len(pivot) - both):
                linked.append((doc, p))
        a, b = zip(*linked) if linked else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The stored ``pairs`` (a, b) of document ids whose whole shingle sets are similar.

    b is the pivot: its set travels once per PIVOT_ROWS partners, each partner's once per
    pair, so a document with any number of partners is spread over tasks.
    """
    pivots = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PIVOT_ROWS).alias("salts"))
    member = pairs.join(pivots, "b").select(
        F.col("a").alias("doc_id"),
        F.struct(F.col("b").alias("pivot"), F.pmod(F.xxhash64("a"), "salts").alias("salt"), F.lit(1).alias("role")).alias("meet"),
    )
    own = pivots.select(
        F.col("b").alias("doc_id"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
    ).select("doc_id", F.struct(F.col("doc_id").alias("pivot"), "salt", F.lit(0).alias("role")).alias("meet"))
    meets = written(member.union(own).groupBy("doc_id").agg(F.collect_list("meet").alias("meets")))
    texts = joined(docs.select("doc_id", "text"), meets, "doc_id", "inner", 4 * pairs.count())
    sets = in_arrow(texts, _with_sets, "doc_id long, items binary, meets array<struct<pivot:long,salt:long,role:int>>")
    rows = sets.select("doc_id", "items", F.explode("meets").alias("m"))
    rows = rows.select(F.col("m.pivot"), F.col("m.salt"), F.col("m.role"), "doc_id", "items")
    dealt = rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "role")
    return in_arrow(dealt.select("pivot", "salt", "doc_id", "items"), _compare, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame, count: int) -> DataFrame:
    """``rows`` with the label of each document's group so far; alone it is its own."""
    out = joined(rows.drop("label"), labels, "doc_id", "left", count)
    return out.withColumn("label", F.coalesce("label", "doc_id"))


def _possible(a: str, b: str):
    """True when sizes and parity bits allow the pair to be similar."""
    differ = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in _SKETCH), F.lit(0))
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * F.least(n, m) >= SHARE * F.greatest(n, m)) & (7 * differ <= n + m)


def _distinct_keys(rows: DataFrame) -> DataFrame:
    """The rows of one key of all that the same documents hold, told by 128 bits and a count."""
    held = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("c"),
        F.bit_xor(F.xxhash64("doc_id")).alias("x"),
        F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("y"),
    )
    kept = written(held.groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key"))
    return written(joined(rows, kept, "key", "left_semi", kept.count()))


def _with_least(rows: DataFrame) -> DataFrame:
    """``rows`` (key, doc_id, label, n, parity bits) with the LEAST_KEYS least keys of their document."""
    columns = ["doc_id", "label", "n", *_SKETCH]  # alike in all rows of a document
    held = rows.groupBy(columns).agg(F.array_sort(F.collect_set("key")).alias("keys"))
    least = F.slice("keys", 1, LEAST_KEYS).alias("least")
    return written(held.select(*columns, least, F.explode("keys").alias("key")))


def _candidates(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents of different labels that share a key and may be similar.

    Similar documents share most of their keys. They are listed at the least key that both
    have among their least ones, and at no key above it; only documents without such a key
    are listed at each one that they share.
    """
    rows = _with_least(rows)
    sides = [rows.select("key", F.struct("doc_id", "label", "n", "least", *_SKETCH).alias(side)) for side in ("m", "p")]
    both = F.array_min(F.array_intersect("m.least", "p.least"))
    listed = F.col("key") <= F.coalesce(both, F.col("key"))
    met = sides[0].join(sides[1], "key").where((F.col("m.label") > F.col("p.label")) & _possible("m", "p") & listed)
    return met.select(F.col("m.doc_id").alias("a"), F.col("p.doc_id").alias("b"))


class _Groups:
    """Groups found so far, and rounds that merge more of them."""

    def __init__(self, docs: DataFrame, sets: DataFrame):
        self.docs = docs
        self.wide = sets.select("doc_id", "n", "wide")
        spark = docs.sparkSession
        self.links = spark.createDataFrame([], "a long, b long")
        self.labels = spark.createDataFrame([], "doc_id long, label long")
        self.count = 0

    def _plausible(self, pairs: DataFrame) -> DataFrame:
        """Stored pairs whose wide sketches, where both have one, differ little enough."""
        rows = pairs.count()
        for side in ("a", "b"):
            own = self.wide.select(F.col("doc_id").alias(side), F.struct("n", "wide").alias(f"{side}_w"))
            pairs = joined(own, pairs, side, "inner", rows) if side == "a" else own.join(pairs, side)
        differ = F.aggregate(
            F.zip_with("a_w.wide", "b_w.wide", lambda x, y: F.bit_count(F.coalesce(x.bitwiseXOR(y), F.lit(0)))),
            F.lit(0),
            lambda total, x: total + x,
        )
        return pairs.where(7 * differ <= F.col("a_w.n") + F.col("b_w.n")).select("a", "b")

    def add(self, pairs: DataFrame) -> int:
        """Verifies stored candidate pairs; the number of links found."""
        new = written(verified(self.docs, written(self._plausible(pairs))))
        found = new.count()
        if found:
            self.links = self.links.union(new)
            self.labels = written(
                components(self.links).select(F.col("id").alias("doc_id"), "label").where("label <> doc_id")
            )
            self.count = self.labels.count()
        return found

    def mixed(self, rows: DataFrame) -> DataFrame:
        """Rows (key, doc_id, n, parity bits) of keys that two labels share, stored."""
        rows = _labelled(rows, self.labels, self.count)
        spans = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        return written(rows.join(spans.where("low < high").select("key"), "key"))

    def merge(self, rows: DataFrame, rounds: int) -> DataFrame:
        """Links documents to one document of each of their keys, another in each round.

        The pivot of a key is its document of the smallest hash; each document tries the
        BEST_PIVOTS that share the most keys with it, so a round's work follows the number
        of documents whatever the size of their groups. Gives the rows of the last round.
        """
        member = F.struct("doc_id", "label", "n", *_SKETCH)
        for turn in range(rounds):
            rows = self.mixed(rows)
            order = F.xxhash64("doc_id", F.lit(turn))
            pivots = rows.groupBy("key").agg(F.min_by(member, order).alias("p"))
            pairs = rows.select("key", member.alias("m")).join(pivots, "key")
            pairs = pairs.where((F.col("m.label") != F.col("p.label")) & _possible("m", "p"))
            pairs = pairs.groupBy(F.col("m.doc_id").alias("a"), F.col("p.doc_id").alias("b")).agg(
                F.count(F.lit(1)).alias("c")
            )
            best = Window.partitionBy("a").orderBy(F.desc("c"), "b")
            pairs = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= BEST_PIVOTS)
            if not self.add(written(pairs.select("a", "b"))):
                break
        return rows


def similar_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text, ...).

    component_id is the smallest doc_id that links reach. Equal sets form one class, which
    one representative stands for. A null, empty or wordless text has no shingles and no
    links; a text of fewer than five words is one shingle. Columns besides doc_id and text
    are ignored. doc_id must be unique; an empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    sets = shingle_sets(docs)

    # classes of equal sets
    named = sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("c"))
    repeated = named.where("c > 1").select("digest", "rep")
    copies = written(sets.select("doc_id", "digest").join(repeated, "digest").where("doc_id <> rep").select("doc_id", "rep"))
    n_copies = copies.count()
    everyone = sets.select("doc_id", F.col("n").alias("n_shingles"))
    sets = joined(sets, copies.select("doc_id"), "doc_id", "left_anti", n_copies)
    groups = _Groups(docs, sets)

    # first rounds: documents whose first segments are equal
    first = sets.select("doc_id", F.explode("first").alias("key"))
    shared = first.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    shared = written(shared)
    rows = sets.select("doc_id", "n", *_SKETCH, F.explode("first").alias("key"))
    groups.merge(joined(rows, shared, "key", "inner", shared.count()), FIRST_ROUNDS)

    # full join: segments that two labels share
    keyed = _labelled(sets.select("doc_id", "keys"), groups.labels, groups.count).select(
        F.explode("keys").alias("key"), "label"
    )
    spans = keyed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    shared = written(spans.where("low < high").select("key"))
    rows = sets.select("doc_id", "n", *_SKETCH, F.explode("keys").alias("key"))
    rows = groups.mixed(groups.merge(joined(rows, shared, "key", "inner", shared.count()), ROUNDS))
    groups.add(written(_candidates(_distinct_keys(rows)).distinct()))

    # the representative has the smallest id of its class
    out = joined(everyone, copies, "doc_id", "left", n_copies).withColumn("rep", F.coalesce("rep", "doc_id"))
    labels = groups.labels.withColumnRenamed("doc_id", "rep")
    out = joined(out, labels, "rep", "left", groups.count)
    return out.select("doc_id", "n_shingles", F.coalesce("label", "rep").alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of similar ones: that of the smallest id."""
    groups = written(similar_groups(docs).where("component_id <> doc_id").select("doc_id"))
    return joined(docs, groups, "doc_id", "left_anti", groups.count())

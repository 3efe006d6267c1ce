"""Benchmark decontamination: windows of benchmark words found in training documents.

Each benchmark item is cut into windows of ten words (a shorter item is one window). Their
hashes go to every task as a sorted array behind a bit table; documents are scanned window
by window, and each hit is verified word by word. When the benchmarks have more windows than
MAX_WINDOWS, they are scanned in blocks of that many, and the hits of a document row are united.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .tables import in_arrow, joined, keyed
from .text import ALNUM, FOLD, pieces, runs, text_bytes, words

WINDOW = 10
# Windows broadcast at a time: about 100 bytes each, with their words.
MAX_WINDOWS = 1_000_000

_LISTS = pa.list_(pa.int64())


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, text) to the item's windows."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for first, last in pieces(offsets):
            part = FOLD[data[offsets[first] : offsets[last]]]
            w = words(part, offsets[first : last + 1], ALNUM)
            rows = []
            for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
                length = min(WINDOW, int(b - a))
                if length == 0:
                    continue
                item = batch.column(0)[first + i].as_py()
                for k, h in enumerate(runs(w.hashes[a:b], length)):
                    rows.append((item, length, h.astype(np.int64), _joined(part, w, a + k, length)))
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["item_id", "length", "hash", "words"]
            )


def _joined(data: np.ndarray, w, at: int, length: int) -> bytes:
    return b" ".join(data[w.starts[i] : w.ends[i]].tobytes() for i in range(at, at + length))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows (length, hash, words) with the ids of the items that have them."""
    cut = benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(
        _windows, "item_id long, length int, hash long, words binary"
    )
    return cut.groupBy("length", "hash", "words").agg(F.collect_set("item_id").alias("items"))


class _Block:
    """Windows of one length, ready to be looked up."""

    def __init__(self, length: int, hashes: np.ndarray, texts: list[bytes], items: list[list[int]]):
        order = np.argsort(hashes, kind="stable")
        self.length, self.hashes = length, hashes[order]
        self.texts = [texts[i] for i in order]
        self.items = [items[i] for i in order]
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, data: np.ndarray, w) -> Iterator[tuple[int, int, list[int]]]:
        """(text, first word, items) of every verified occurrence."""
        found = runs(w.hashes, self.length)
        at = np.flatnonzero(self.bits[(found >> np.uint64(44)).astype(np.int64)])
        where = np.searchsorted(self.hashes, found[at])
        same = self.hashes[np.minimum(where, len(self.hashes) - 1)] == found[at]
        at, where = at[same], where[same]
        text = np.searchsorted(w.first, at, side="right") - 1
        whole = at + self.length <= w.first[text + 1]
        for t, start, k in zip(text[whole], at[whole], where[whole]):
            words_here = _joined(data, w, start, self.length)
            while k < len(self.hashes) and self.hashes[k] == found[start]:
                if self.texts[k] == words_here:
                    yield int(t), int(start), self.items[k]
                k += 1


def _blocks(windows: list[pa.Table]) -> list[_Block]:
    blocks = []
    for part in windows:
        lengths = part["length"].to_numpy()
        for length in np.unique(lengths):
            rows = part.filter(pa.array(lengths == length))
            hashes = rows["hash"].to_numpy().astype(np.int64).view(np.uint64)
            blocks.append(_Block(int(length), hashes, rows["words"].to_pylist(), rows["items"].to_pylist()))
    return blocks


def _scan(batches: Iterator[pa.RecordBatch], windows: pa.Table) -> Iterator[pa.RecordBatch]:
    """(..., text) to (..., words, hit runs as [from, to, ...], items)."""
    blocks = _blocks([windows])
    for batch in batches:
        *carried, text = batch.columns
        data, offsets = text_bytes(text)
        for first, last in pieces(offsets):
            part = FOLD[data[offsets[first] : offsets[last]]]
            w = words(part, offsets[first : last + 1], ALNUM)
            change = np.zeros(len(w.hashes) + 1, dtype=np.int64)
            items: list[set[int]] = [set() for _ in range(last - first)]
            for block in blocks:
                for at, start, ids in block.find(part, w):
                    change[start] += 1
                    change[start + block.length] -= 1
                    items[at].update(ids)
            hit = np.cumsum(change)[:-1] > 0
            hit_runs = [_runs_of(hit[a:b]) for a, b in zip(w.first[:-1], w.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    *(c.slice(first, last - first) for c in carried),
                    pa.array(w.per_text.astype(np.int64)),
                    pa.array(hit_runs, _LISTS),
                    pa.array([sorted(x) for x in items], _LISTS),
                ],
                names=[*batch.schema.names[:-1], "n_words", "hits", "items"],
            )


def _runs_of(hit: np.ndarray) -> list[int]:
    if not hit.any():
        return []
    return np.flatnonzero(np.diff(np.r_[False, hit, False])).tolist()


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """United hit runs and items of each document, counted."""
    for batch in batches:
        n_hit, n_items, digests, spans = [], [], [], []
        for hits, items in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            united: list[int] = []
            for low, high in sorted(zip(hits[0::2], hits[1::2])):
                if united and low <= united[-1]:
                    united[-1] = max(united[-1], high)
                else:
                    united += [low, high]
            ids = sorted({str(i) for i in items})
            n_hit.append(sum(united[1::2]) - sum(united[0::2]))
            n_items.append(len(ids))
            digests.append(sha256(",".join(ids).encode()).hexdigest())
            spans.append(united)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(n_hit, pa.int64()),
                pa.array(n_items, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array([x > 0 for x in n_hit], pa.bool_()),
                pa.array(spans, _LISTS),
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_runs"],
        )


_REPORT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "hit_runs array<long>"
)


def contamination(docs: DataFrame, benchmark: DataFrame, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """What each document (doc_id, text) shares with the items (item_id, text).

    Gives doc_id, n_words, n_hit (words inside an occurrence of a window), n_items (items
    with a window in the document), items_sha256, contaminated, and hit_runs, the hit words
    as [from, to, from, to, ...]. A null or wordless text has no words and no hits; a null
    or wordless item has no windows; an item without an id makes hits but isn't listed. No
    items give no hits. Other columns are ignored. Every document row is reported, whatever
    ids repeat or are null and however many blocks there are.
    """
    windows = written(benchmark_windows(benchmark))
    blocks = max(1, -(-windows.count() // max_windows))
    if blocks == 1:
        # one pass over Python workers: a second one in the same task would be a second worker
        held = docs.sparkSession.sparkContext.broadcast(windows.toArrow())
        return in_arrow(docs.select("doc_id", "text"), lambda b: _report(_scan(b, held.value)), _REPORT)
    rows, parts = keyed(docs, "doc_id", "text"), []  # what several scans find is united by row
    for k in range(blocks):
        block = windows.where(F.pmod("hash", F.lit(blocks)) == k)
        held = docs.sparkSession.sparkContext.broadcast(block.toArrow())
        parts.append(
            in_arrow(
                rows,
                lambda b, held=held: _scan(b, held.value),
                "_row long, doc_id long, n_words long, hits array<long>, items array<long>",
            )
        )
    scanned = parts[0]
    for part in parts[1:]:
        scanned = scanned.union(part)
    scanned = scanned.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.flatten(F.collect_list("items")).alias("items"),
    )
    scanned = scanned.drop("_row")
    return in_arrow(scanned, _report, _REPORT)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes from the first to the last word of each hit run."""
    for batch in batches:
        texts = []
        for text, hits in zip(batch.column(1), batch.column(2).to_pylist()):
            if hits:
                data, offsets = text_bytes(pa.array([text.as_py()]))
                w = words(FOLD[data], offsets, ALNUM)
                kept, at = [], 0
                for low, high in zip(hits[0::2], hits[1::2]):
                    kept.append(data[at : w.starts[low]].tobytes())
                    at = w.ends[high - 1]
                kept.append(data[at:].tobytes())
                texts.append(b"".join(kept).decode())
            else:
                texts.append(text.as_py())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or without the contaminated spans.

    With ``remove="spans"`` the other columns of a shortened document stay as they are,
    but n_chars, if there is one, is counted anew. doc_id must be unique.
    """
    report = written(contamination(docs, benchmark).where("contaminated").select("doc_id", "hit_runs"))
    if remove == "documents":
        return joined(docs, report.select("doc_id"), "doc_id", "left_anti", report.count())
    cut = docs.select("doc_id", "text").join(report, "doc_id").mapInArrow(_cut, "doc_id long, text string")
    cut = cut.withColumnRenamed("text", "_shorter")
    cut = written(cut)
    out = docs.join(cut, "doc_id", "left").withColumn("text", F.coalesce("_shorter", "text")).drop("_shorter")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)

"""Token ids of a corpus in a compressed binary format, written and read by Spark.

Documents are dealt by ranges of their id, so shards and the documents in them are in
ascending order. A shard's ids are cut into blocks of about BLOCK_IDS; a document longer than
that is spread over blocks of its own. Each block is a byte string that can be read without
any other:

    magic "TPID", then little-endian unsigned 32-bit integers: version, vocabulary size,
    documents, ids, bytes of the document table, bytes of the ids, crc32 of both;
    the document table: per document its id (int64), 1 if it has one (uint8), its number
    of ids in this block (uint32);
    the ids, coded by ``range_coder``.

The files are Parquet: a row per block, with its place (shard, block), what lies before it
in its shard, and the byte string. Spark's committer publishes them, so a lost executor
leaves no half-written shard, and any store that Spark can write will do.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .range_coder import decode, encode
from .tables import in_arrow

BLOCK_IDS = 1 << 21
END_ID = 0
# Encoded pieces of text that a worker remembers: twice this number, under 60 MB.
REMEMBERED = 70_000

_HEADER = struct.Struct("<4s7I")
_MAGIC, _VERSION = b"TPID", 1

_BLOCKS = "shard int, block int, first_doc long, first_id long, n_ids long, part int, parts int, data binary"
_BLOCKS_ARROW = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("first_doc", pa.int64()), ("first_id", pa.int64())]
    + [("n_ids", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("data", pa.binary())]
)


def pack(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, vocabulary: int) -> bytes:
    """A block's byte string."""
    table = np.array([i or 0 for i in doc_ids], dtype="<i8").tobytes()
    table += np.array([i is not None for i in doc_ids], dtype=np.uint8).tobytes()
    table += np.array(counts, dtype="<u4").tobytes()
    payload = encode(ids, vocabulary)
    check = crc32(payload, crc32(table))
    return _HEADER.pack(_MAGIC, _VERSION, vocabulary, len(counts), len(ids), len(table), len(payload), check) + table + payload


def unpack(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, their numbers of ids, ids) of a block; ValueError if it is damaged."""
    if len(block) < _HEADER.size:
        raise ValueError("token block cut short")
    magic, version, vocabulary, docs, n, table_bytes, payload_bytes, check = _HEADER.unpack_from(block)
    if magic != _MAGIC or version != _VERSION:
        raise ValueError("not a token block of a known version")
    if len(block) != _HEADER.size + table_bytes + payload_bytes or check != crc32(block[_HEADER.size :]):
        raise ValueError("token block damaged")
    table = block[_HEADER.size : _HEADER.size + table_bytes]
    doc_ids = np.frombuffer(table, "<i8", docs).tolist()
    known = np.frombuffer(table, np.uint8, docs, 8 * docs)
    counts = np.frombuffer(table, "<u4", docs, 9 * docs).astype(np.int64)
    return (
        [i if k else None for i, k in zip(doc_ids, known)],
        counts,
        decode(block[_HEADER.size + table_bytes :], n, vocabulary),
    )


def _visible(character: str) -> bool:
    """"!" to "~" and Latin letters: surely no white space."""
    return "!" <= character <= "~" or "À" <= character <= "ɏ"


# A space that no visible character follows.
_UNSAFE_SPACE = re.compile(" (?![!-~À-ɏ])")


class _Encoder:
    """A byte-level tokenizer that encodes each distinct piece of text once.

    Such a tokenizer never joins text across a space that stands before a visible character
    into one token, so a text is cut before such spaces and the pieces are looked up.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # known before; pieces that are met again move on

    def _pieces(self, text: str) -> list[str]:
        if any(s in text for s in self.special):
            return [text]  # special tokens are found in whole texts
        if "\0" not in text and not _UNSAFE_SPACE.search(text):
            return text.replace(" ", "\0 ").split("\0")
        first, *rest = text.split(" ")
        pieces = [first]
        for p in rest:
            if p and _visible(p[0]) or pieces == [""]:
                pieces.append(" " + p)
            else:  # such a space stays with what is before
                pieces[-1] += " " + p
        return pieces

    def _learn(self, new: list[str]) -> None:
        """Encodes pieces, many joined to one text each, whose tokens are told apart by place."""
        alone = [p for p in new if not (p[0] == " " and len(p) > 1 and _visible(p[1])) or len(p) > 200]
        for p, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            self.known[p] = np.array(e.ids, dtype="<u4").tobytes()
        apart = set(alone)
        many = [p for p in new if p not in apart]
        groups = [many[k : k + 500] for k in range(0, len(many), 500)]
        for group, e in zip(groups, self.tokenizer.encode_batch(["".join(g) for g in groups], add_special_tokens=False)):
            starts = np.fromiter((o[0] for o in e.offsets), dtype=np.int64, count=len(e.ids))
            ends = np.cumsum([len(p) for p in group])
            raw = np.array(e.ids, dtype="<u4").tobytes()
            low = 0
            for p, high in zip(group, (4 * np.searchsorted(starts, ends)).tolist()):
                self.known[p] = raw[low:high]
                low = high

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        get = self.known.get
        cut = [self._pieces(t) for t in texts]
        found = [list(map(get, pieces)) for pieces in cut]
        new = {p for pieces, ids in zip(cut, found) if None in ids for p, x in zip(pieces, ids) if x is None}
        new.discard("")
        again = new & self.older.keys()
        self.known.update((p, self.older[p]) for p in again)
        self._learn(list(new - again))
        self.known[""] = b""
        for pieces, ids in zip(cut, found):
            if None in ids:
                ids = [get(p) if x is None else x for p, x in zip(pieces, ids)]
            yield np.frombuffer(b"".join(ids), dtype="<u4")


_encoders: dict[int, _Encoder] = {}  # of this worker process, by the tokenizer's checksum


def _encoder(model: str) -> _Encoder:
    key = crc32(model.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = _Encoder(model)
    return _encoders[key]


class _Shard:
    """Gathers documents into blocks."""

    def __init__(self, vocabulary: int, block_ids: int):
        self.vocabulary, self.block_ids = vocabulary, block_ids
        self.shard = TaskContext.get().partitionId()
        self.block = self.docs_before = self.ids_before = 0
        self.doc_ids: list[int | None] = []
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.size and self.size + len(ids) > self.block_ids:
            yield self.flush()
        if len(ids) <= self.block_ids:
            self.doc_ids.append(doc_id)
            self.ids.append(ids)
            self.size += len(ids)
            return
        parts = -(-len(ids) // self.block_ids)
        for k in range(parts):
            self.doc_ids = [doc_id]
            self.ids = [ids[k * self.block_ids : (k + 1) * self.block_ids]]
            yield self.flush(k, parts)
        self.docs_before += 1

    def flush(self, part: int = 0, parts: int = 1) -> pa.RecordBatch:
        counts = [len(x) for x in self.ids]
        ids = np.concatenate(self.ids)
        data = pack(self.doc_ids, counts, ids, self.vocabulary)
        row = (self.shard, self.block, self.docs_before, self.ids_before, len(ids), part, parts, data)
        self.block += 1
        self.ids_before += len(ids)
        if parts == 1:
            self.docs_before += len(counts)
        self.doc_ids, self.ids, self.size = [], [], 0
        return pa.RecordBatch.from_pylist([dict(zip(_BLOCKS_ARROW.names, row))], schema=_BLOCKS_ARROW)


def _write(batches: Iterator[pa.RecordBatch], model: str, block_ids: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(model)
    shard = _Shard(encoder.vocabulary, block_ids)
    end = np.full(1, END_ID, dtype=np.uint32)
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            texts = part.column(1).fill_null("").to_pylist()
            for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                yield from shard.add(doc_id, np.r_[ids, end])
    if shard.size:
        yield shard.flush()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, block_ids: int = BLOCK_IDS) -> None:
    """Encodes (doc_id, text) with the tokenizer file and writes the ids to ``path``.

    Every text is followed by END_ID; a null text is empty. Documents are in ascending order
    of doc_id, one without an id first; rows of equal ids stay next to each other in any order.
    """
    with open(tokenizer, encoding="utf-8") as f:  # the driver's copy serves all executors
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    dealt = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    blocks = in_arrow(dealt, lambda b: _write(b, model.value, block_ids), _BLOCKS)
    blocks.write.mode("overwrite").option("compression", "uncompressed").parquet(path)
    model.unpersist()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        for shard, _, first_doc, first_id, _, part, parts, data in zip(*columns, batch.column(7)):
            doc_ids, counts, ids = unpack(data.as_py())
            ends = np.cumsum(counts)
            raw = ids.astype("<u4").tobytes()
            sums = [crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist())]
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, shard, np.int32)),
                    pa.array(np.arange(first_doc, first_doc + n)),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(first_id + ends - counts),
                    pa.array(counts),
                    pa.array(sums, pa.int64()),
                    pa.array([part] * n, pa.int32()),
                    pa.array([raw if parts > 1 else None] * n, pa.binary()),
                ],
                names=["shard", "seq", "doc_id", "start", "n_tokens", "ids_crc32", "part", "raw"],
            )


_ROWS = "shard int, seq long, doc_id long, start long, n_tokens long, ids_crc32 long, part int, raw binary"


def _united(parts: pd.DataFrame) -> pd.DataFrame:
    """One document's blocks to its row."""
    parts = parts.sort_values("part")
    total = 0
    for raw in parts["raw"]:
        total = crc32(raw, total)
    return parts.head(1).assign(n_tokens=parts["n_tokens"].sum(), ids_crc32=total)[
        ["shard", "doc_id", "start", "n_tokens", "ids_crc32"]
    ]


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files at ``path``.

    start counts the ids of all documents before; n_tokens includes the end id; ids_crc32 is
    that of the ids as little-endian unsigned 32-bit integers. Damaged blocks raise.
    """
    blocks = spark.read.parquet(path)
    # one row per shard, of which there are as many as the writer had partitions
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select("shard", before.alias("before"))
    columns = ["shard", "doc_id", "start", "n_tokens", "ids_crc32"]
    cut = in_arrow(blocks.where("parts > 1"), _read, _ROWS)
    long = cut.groupBy("shard", "seq").applyInPandas(
        lambda p: _united(p), "shard int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    whole = in_arrow(blocks.where("parts = 1"), _read, _ROWS)
    rows = whole.select(columns).union(long.select(columns))
    return rows.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )

"""Sharding by fixed virtual slots and a versioned map of slots to shards.

A record's slot is a hash of its id and its text, modulo a fixed number of slots; it never
changes. Shards own slots by a map that is stored in versions. Rebalancing sums the bytes of
each slot and edits the map: the fullest shard hands slots to the emptiest one, the largest that
narrow the gap first, so few slots move and all others stay where they are. A new shard is
an empty one that is filled in this way; the slots of a removed shard go to the emptiest ones.

The map has a row per slot, so its size is a parameter and not the data's: it is edited on the
driver and broadcast. Records are summed per slot before any shuffle, and only once shuffled
whole, by ranges of (shard, slot), so a task writes to one shard or to few.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096
SHARDS = 8


def record_size() -> Column:
    """UTF-8 bytes of the text, none of a null, and one more."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


def text_crc32() -> Column:
    """Unsigned crc32 of the text's UTF-8 bytes; that of no bytes for a null."""
    return F.coalesce(F.crc32("text"), F.lit(0)).cast("long")


def slot_of(slots: int = SLOTS) -> Column:
    """A record's slot. Texts of one id, or without one, lie in different slots."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_crc32().cast("string"))
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % slots).cast("int")


class Sizes:
    """Bytes and records of every slot."""

    def __init__(self, docs: DataFrame, slots: int = SLOTS):
        found = docs.groupBy(slot_of(slots).alias("slot")).agg(
            F.sum(record_size()).alias("bytes"), F.count(F.lit(1)).alias("records")
        )
        self.bytes, self.records = np.zeros(slots, dtype=np.int64), np.zeros(slots, dtype=np.int64)
        for slot, size, records in found.collect():  # at most a row per slot
            self.bytes[slot], self.records[slot] = size, records


def dealt(slots: int = SLOTS, shards: int = SHARDS) -> np.ndarray:
    """The map before any size is known: slots in turn."""
    return np.arange(slots) % shards


def rebalanced(owner: np.ndarray, size: np.ndarray, shards: int) -> np.ndarray:
    """The map ``owner`` edited for ``shards`` shards, until no slot can narrow the widest gap.

    A slot of at most half the gap goes from the fullest shard to the emptiest one, the
    largest first; of equal shards or slots the one of the smallest number. Empty slots stay.
    """
    owner = owner.copy()
    for slot in np.flatnonzero(owner >= shards)[np.argsort(-size[owner >= shards], kind="stable")]:
        loads = np.bincount(owner[owner < shards], size[owner < shards], shards)
        owner[slot] = loads.argmin()
    while True:
        loads = np.bincount(owner, size, shards).astype(np.int64)
        full, empty = int(loads.argmax()), int(loads.argmin())
        movable = np.where((owner == full) & (2 * size <= loads[full] - loads[empty]), size, 0)
        if not movable.any():
            return owner
        owner[movable.argmax()] = empty


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions of the map at ``path``."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    found = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return [v for v in found if fs.exists(_folder(spark, f"{path}/version={v}/_SUCCESS")[1])]


def save_map(spark: SparkSession, path: str, owner: np.ndarray) -> int:
    """Stores the map as the next version, which is never changed again; gives its number.

    Fails when another writer takes that number at the same time.
    """
    version = max(versions(spark, path), default=0) + 1
    rows = spark.createDataFrame([(i, int(s)) for i, s in enumerate(owner)], "virtual_slot int, shard int")
    rows.coalesce(1).write.parquet(f"{path}/version={version}")
    return version


def load_map(spark: SparkSession, path: str, version: int | None = None) -> np.ndarray:
    """A version of the map, the last one by default."""
    version = max(versions(spark, path)) if version is None else version
    rows = spark.read.parquet(f"{path}/version={version}").orderBy("virtual_slot").collect()
    return np.array([r["shard"] for r in rows], dtype=np.int64)


def placed(docs: DataFrame, owner: np.ndarray, sizes: Sizes) -> DataFrame:
    """``docs`` with virtual_slot, shard and slot: the record's place in its shard, from 0.

    A shard's records are ordered by virtual slot, doc_id (nulls first) and the text's crc32;
    records equal in these are in any order. Columns of ``docs`` of these names are replaced.
    """
    before = np.zeros(len(owner), dtype=np.int64)
    for shard in np.unique(owner):
        own = owner == shard
        before[own] = np.cumsum(sizes.records[own]) - sizes.records[own]
    spark = docs.sparkSession
    rows = [(i, int(s), int(b)) for i, (s, b) in enumerate(zip(owner, before))]
    places = spark.createDataFrame(rows, "virtual_slot int, shard int, slot long")
    docs = docs.drop("shard", "slot").withColumn("virtual_slot", slot_of(len(owner)))
    found = docs.join(F.broadcast(places), "virtual_slot").repartitionByRange("shard", "virtual_slot")
    within = Window.partitionBy("shard", "virtual_slot").orderBy(F.asc_nulls_first("doc_id"), text_crc32())
    return found.withColumn("slot", F.col("slot") + F.row_number().over(within) - 1)


def write_shards(docs: DataFrame, path: str, owner: np.ndarray, sizes: Sizes) -> None:
    """Writes ``docs`` to a folder per shard, Parquet files whose records are in order."""
    placed(docs, owner, sizes).write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """The records of all shards at ``path``, with the columns of ``docs`` and their places."""
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in ("shard", "slot", "virtual_slot")]
    return spark.read.schema(", ".join([*kinds, "virtual_slot int", "slot long", "shard int"])).parquet(path)


def shard(docs: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Shards ``docs`` (doc_id, text, ...) under ``path`` and gives the stored records.

    The map at ``path``/map starts with slots dealt in turn, or from its last version, and is
    edited for the bytes found; the records are in ``path``/version=N. Shards are of nearly equal
    bytes: they differ by less than twice the smallest slot that holds anything in the fullest
    one. Null texts have no bytes; null and repeated ids are records like others; records equal
    in id and text share a slot, which is never split. An empty table makes no folder of a shard.
    """
    spark, sizes = docs.sparkSession, Sizes(docs, slots)
    if not versions(spark, f"{path}/map"):
        save_map(spark, f"{path}/map", dealt(slots, shards))
    owner = rebalanced(load_map(spark, f"{path}/map"), sizes.bytes, shards)
    version = save_map(spark, f"{path}/map", owner)
    write_shards(docs, f"{path}/records/version={version}", owner, sizes)
    return read_shards(spark, f"{path}/records/version={version}", docs)

"""Filters of the keys of each group: which groups can hold a key, without reading their keys.

A group's filter is a number of blocks, a power of two that follows its keys, of eight 64-bit
words. A key sets one bit in each word of one block. At the 32 bits a key that blocks are made
for, a filter answers for about one foreign key in 50,000, and for each of its own. A group
has its filter to itself, so one can be replaced without touching the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
KEYS_PER_BLOCK = 16
# Smaller groups have so many blocks too, so that no block is met by many keys at once.
LEAST_BLOCKS = 256


def _block(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col("blocks")).cast("int")


def _places(key: str) -> list[Column]:
    """The bit of each word that a key sets: six bits each of a second hash."""
    second = F.xxhash64(F.col(key), F.lit(1))
    return [F.shiftright(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]


def key_filters(df: DataFrame, group: str, key: str) -> DataFrame:
    """(group, blocks, block, w0 ... w7) for the non-null keys of each group.

    Only 16 bytes a key are shuffled, once; the groups' sizes, a row per group, are broadcast.
    """
    keys = df.where(F.col(key).isNotNull()).select(group, key)
    n = F.count(F.lit(1)).cast("double")
    blocks = F.greatest(F.lit(LEAST_BLOCKS), F.pow(F.lit(2.0), F.ceil(F.log2(n / KEYS_PER_BLOCK))).cast("int"))
    sizes = keys.groupBy(group).agg(blocks.alias("blocks"))
    names = [f"w{i}" for i in range(WORDS)]
    hashed = keys.join(F.broadcast(sizes), group).select(
        group, "blocks", _block(key).alias("block"), *[p.alias(w) for p, w in zip(_places(key), names)]
    )
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), F.col(w))
    return (
        hashed.repartition(group, "block")  # hardly two keys of a task share a block: fold once, after it
        .groupBy(group, "blocks", "block")
        .agg(*[F.bit_or(bit(w)).alias(w) for w in names])
    )


def possible_groups(filters: DataFrame, group: str, keys: DataFrame, key: str) -> DataFrame:
    """(group, key): for each of the distinct ``keys``, the groups whose filter answers.

    Every group that holds the key is among them; few others are.
    """
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]  # powers of two
    if not sizes:
        return keys.select(key).limit(0).select(F.lit(None).cast(filters.schema[group].dataType).alias(group), key)
    asked = keys.select(
        key, *[p.alias(f"_p{i}") for i, p in enumerate(_places(key))], F.explode(F.array(*map(F.lit, sizes))).alias("blocks")
    ).withColumn("block", _block(key))
    answers = F.lit(True)
    for i in range(WORDS):
        answers &= F.call_function("shiftright", F.col(f"w{i}"), F.col(f"_p{i}")).bitwiseAND(F.lit(1).cast("long")) == 1
    return filters.join(asked, ["blocks", "block"]).where(answers).select(group, key)

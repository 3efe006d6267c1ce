"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words of the filter of repeated keys: 2**26 bits, 16 MB broadcast at most, at any data size.
FILTER_WORDS = 1 << 20


def _word(hashed: Column, words: int) -> Column:
    return F.pmod(F.shiftright(hashed, 6), F.lit(words))


def _bit(hashed: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(hashed, F.lit(64)).cast("int"))


def repeated_keys(df: DataFrame, key: str, words: int = FILTER_WORDS) -> DataFrame:
    """A filter for the keys of ``df`` that occur more than once: (word, bits), lazily.

    Counting 8-byte hashes is a narrow shuffle folded map-side; the repeated ones are folded
    to bits of a fixed number of words. Keys that share a bit with a repeated one pass the
    filter too: they are only looked at more closely.
    """
    counted = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.xxhash64(key).alias("_hash"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
    )
    return counted.groupBy(_word(F.col("_hash"), words).alias("_word")).agg(
        F.bit_or(_bit(F.col("_hash"))).alias("_bits")
    )


def keep_first(
    df: DataFrame,
    key: str,
    order: list[str],
    repeated: DataFrame | None = None,
    words: int = FILTER_WORDS,
) -> DataFrame:
    """The first row of each non-null key by ``order``, nulls last.

    ``row_number() = 1`` is planned with a WindowGroupLimit before the shuffle, so each
    map task sends at most one row per key: a key holding a third of all rows shrinks
    to one row per task before it reaches a reducer.

    With ``repeated`` (see ``repeated_keys``, with the same ``words``) only rows of keys that
    may occur more than once are shuffled and sorted; the others pass straight through.
    """
    df = df.where(F.col(key).isNotNull())
    if repeated is None:
        return _first_rows(df, key, order)
    hashed = df.withColumn("_hash", F.xxhash64(key)).withColumn("_word", _word(F.col("_hash"), words))
    seen = F.col("_bits").bitwiseAND(_bit(F.col("_hash"))) != 0
    marked = hashed.join(F.broadcast(repeated), "_word", "left").withColumn(
        "_again", F.coalesce(seen, F.lit(False))
    )
    marked = marked.drop("_hash", "_word", "_bits")
    single = marked.where("NOT _again")
    several = _first_rows(marked.where("_again"), key, order)
    return single.unionByName(several).drop("_again")


def _first_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    first = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")

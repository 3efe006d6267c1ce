"""Equi-joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than a fourth of a mean shuffle partition. At most four times
# as many keys as partitions can, within these bounds, so the list of hot keys is bounded
# however large the data is. Adaptive execution splits what is left.
HOT_KEYS = (500, 40_000)
# Sketches are merged in two steps: per group of tasks, then the groups.
MERGE_GROUPS = 512


def broadcast_limit(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 when switched off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number = text.rstrip("bkmgtp")
    unit = text[len(number) : len(number) + 1]
    return int(number) * 1024 ** " kmgtp".index(unit if unit not in ("", "b") else " ")


def most_hot_keys(df: DataFrame) -> int:
    """How many keys can be hot, from the number of shuffle partitions."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(4 * partitions, HOT_KEYS[0]), HOT_KEYS[1])


def estimated_bytes(df: DataFrame) -> int:
    """The size Spark's optimizer assumes for ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """True when Spark's own size estimate lets it broadcast ``df`` without being told to."""
    return estimated_bytes(df) <= broadcast_limit(df)


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """The hot keys, from one pass over the key column: at most ``most_hot_keys`` rows.

    Each task keeps a sketch of the frequent keys, of fixed size. The counts are
    estimates. They only decide which rows get spread, never a result.
    """
    top = most_hot_keys(df)
    tracked = 8 * top
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    sketches = (
        df.select(F.col(key), group.alias("_group"))
        .where(F.col(key).isNotNull())
        .groupBy("_group")
        .agg(
            F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("sketch"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    # Grouped by a constant: without any key there is no group, where a global aggregate
    # would have to combine no sketches at all, which fails.
    merged = sketches.groupBy(F.lit("all").alias("_all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {top})").alias("top"),
        F.sum("rows").alias("rows"),
    )
    return (
        merged.select(F.explode("top").alias("t"), "rows")
        .where(F.col("t.count") * top > F.col("rows"))
        .select(F.col("t.item").alias(key))
        .limit(top)
    )


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    spread: str,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Join rows of ``left`` to ``right`` on ``key`` (inner, left, left_semi or left_anti).

    A right side within the broadcast limit is left to Catalyst. Beyond it both sides are
    shuffled, and the rows of hot (or null) keys are spread over all shuffle partitions
    by a hash of the ``spread`` column, against copies of the few matching right rows.
    Adaptive execution hashes partitions of the right side that turn out small enough.

    ``hot_from`` names a cheaper relation to find the hot keys in, such as the raw scan
    under ``left``.
    """
    if fits_broadcast(right):
        return left.join(right, key, how)
    salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left if hot_from is None else hot_from, key).withColumn("_hot", F.lit(True)))
    salted_left = (
        left.join(hot, key, "left")
        .withColumn(
            "_salt",
            F.when(
                F.col("_hot") | F.col(key).isNull(),
                F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"),
            ).otherwise(F.lit(0)),
        )
        .drop("_hot")
    )
    salted_right = (
        right.join(hot, key, "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                .otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("_hot")
    )
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")

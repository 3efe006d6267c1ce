"""Numbers and percent ranks over a total order, by range partitions and their totals.

No task orders everything: rows are dealt by ranges of the order, each range is summed, and
a range's rows go on from the totals of the ranges before it. Only those totals, a row per
range, meet in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written

_INDEX_BITS = 33  # of a row within its partition, in monotonically_increasing_id


def _ranged(df: DataFrame, order: list[Column]) -> tuple[DataFrame, str]:
    """``df`` stored by ranges in order, with a column that counts rows in each range."""
    place = "_" * (1 + max(map(len, df.columns)))  # no column's name
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.withColumn(place, F.monotonically_increasing_id())), place


def _before(ranged: DataFrame, place: str, amount: Column) -> DataFrame:
    """(_range, _before, _everything): the amount in all ranges before each, and in all."""
    totals = ranged.groupBy(F.shiftright(place, _INDEX_BITS).alias("_range")).agg(amount.alias("_total"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_range",
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_total").over(Window.partitionBy()).alias("_everything"),
    )


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its rows numbered from 1 in ``order``, as a long column ``name``.

    Rows that are equal in ``order`` are numbered one after the other in any way.
    """
    ranged, place = _ranged(df, order)
    before = _before(ranged, place, F.count(F.lit(1)))
    found = ranged.join(F.broadcast(before), F.shiftright(place, _INDEX_BITS) == F.col("_range"))
    index = F.col(place).bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return found.select(*df.columns, (F.col("_before") + index + 1).alias(name))


def percent_rank_by_count(counts: DataFrame, count: str) -> DataFrame:
    """Histogram of ``counts`` with the descending percent rank of each distinct count.

    Users with equal counts share a rank, so ranking the distinct counts ranks the users:
    rank - 1 is the number of users with a larger count. There are at most
    sqrt(2 x total) distinct counts (1 + 2 + ... + n <= total).
    """
    histogram = counts.groupBy(count).agg(F.count(F.lit(1)).alias("users"))
    ranged, place = _ranged(histogram, [F.desc(count)])
    before = _before(ranged, place, F.sum("users"))
    found = ranged.join(F.broadcast(before), F.shiftright(place, _INDEX_BITS) == F.col("_range"))
    above = Window.partitionBy("_range").orderBy(F.desc(count)).rowsBetween(Window.unboundedPreceding, -1)
    larger = F.col("_before") + F.coalesce(F.sum("users").over(above), F.lit(0))
    others = F.col("_everything") - 1
    return found.select(
        count,
        "users",
        F.when(others > 0, larger.cast("double") / others.cast("double")).otherwise(F.lit(0.0)).alias("pct_rank"),
    )

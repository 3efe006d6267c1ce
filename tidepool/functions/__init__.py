"""Small column helpers shared by all plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DateLike = dt.date | str


def rounded(value: Column, digits: int) -> Column:
    """Round a double half away from zero.

    Scaling first and rounding to an integer avoids Spark's decimal detour in
    ``round(x, n)``, which turns 201/200 into 1.01 although the double is below 1.005.
    """
    scale = float(10**digits)
    return F.round(value.cast("double") * F.lit(scale), 0) / F.lit(scale)


def ratio(top: Column, bottom: Column, digits: int, times: float = 1.0) -> Column:
    """``round(top * times / bottom)`` as a double; null where the bottom is 0 or null."""
    bottom = F.when(bottom != 0, bottom.cast("double"))
    return rounded(top.cast("double") * F.lit(float(times)) / bottom, digits)


def pct(top: Column, bottom: Column, digits: int = 2) -> Column:
    return ratio(top, bottom, digits, times=100.0)


def count_where(condition: Column) -> Column:
    """Number of rows on which the condition holds, as bigint."""
    return F.count(F.when(condition, F.lit(1)))


def day(value: DateLike) -> Column:
    """A date literal."""
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def shift_day(value: DateLike, days: int) -> dt.date:
    value = dt.date.fromisoformat(value) if isinstance(value, str) else value
    return value + dt.timedelta(days=days)


def moment(value: dt.datetime | str | None) -> Column:
    """A zone-free timestamp literal; None means now, in UTC."""
    if value is None:
        value = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def between_days(df: DataFrame, column: str, start: DateLike | None, end: DateLike | None) -> DataFrame:
    """Inclusive, optional date range; a plain comparison, so partitions are pruned."""
    if start is not None:
        df = df.where(F.col(column) >= day(start))
    if end is not None:
        df = df.where(F.col(column) <= day(end))
    return df

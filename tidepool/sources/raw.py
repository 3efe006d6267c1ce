"""Raw input: a users file and events in ``dt=YYYY-MM-DD`` folders, both Parquet.

Writers store times in several ways: as microseconds, as nanoseconds or as text. All are read
to a time without zone; text that is no time becomes null, which cleaning then counts. A
number is taken as nanoseconds. Writers change over the years, so the days of one range, and
the files of one day, may differ: files are grouped by the types they store, and each group
is one scan. A column that a group lacks is null there.
"""

from __future__ import annotations

import datetime as dt
import functools
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import DateLike
from ..schemas import RAW_EVENTS, RAW_USERS, columns

_NANOS = "spark.sql.legacy.parquet.nanosAsLong"


def _time(name: str, stored: str) -> Column:
    """A column of times, stored as ``stored``, without zone."""
    if stored == "bigint":  # nanoseconds since 1970
        return F.expr(
            "timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, "
            f"CAST(floor(CAST(`{name}` AS DECIMAL(20,0)) / 1000) AS DECIMAL(17,0)) / 1000000)"
        )
    return F.col(name).try_cast("timestamp_ntz")


def _conformed(df: DataFrame, ddl: str) -> DataFrame:
    """The declared columns with their types, whatever encoding of times the files have."""
    stored = dict(df.dtypes)

    def column(name: str, kind: str) -> Column:
        if name not in stored:
            return F.lit(None).cast(kind)
        return _time(name, stored[name]) if kind == "timestamp_ntz" else F.col(name).cast(kind)

    return df.select([column(name, kind).alias(name) for name, kind in columns(ddl)])


def _reader(spark: SparkSession):
    # Spark has no type for nanoseconds and refuses such files without this; no other is affected.
    spark.conf.set(_NANOS, "true")
    return spark.read


def _files(spark: SparkSession, folder: str) -> list[str]:
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.getFileStatus(root).isDirectory():
        return [folder]
    found = [s.getPath() for s in fs.listStatus(root) if s.isFile()]
    return [p.toString() for p in found if not p.getName().startswith(("_", "."))]


def _merged_types(spark: SparkSession, base: str, paths: list[str]) -> dict[str, str] | None:
    """Column types over the files of all paths, read in one distributed job; None if they differ."""
    try:
        found = _reader(spark).option("mergeSchema", "true").option("basePath", base).parquet(*paths)
        return dict(found.dtypes)
    except (PySparkException, Py4JJavaError) as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):  # folders without a file
            return {}
        if "CANNOT_MERGE" not in str(error):
            raise
        return None


def _stored_types(spark: SparkSession, base: str, paths: list[str]) -> list[tuple[dict[str, str], list[str]]]:
    """Sets of column types that are stored at ``paths``, each with its paths.

    Paths whose types differ are halved, down to single files, with a job for each part side
    by side. A change of writer thus costs a few jobs more, not one per day.
    """
    sets: list[tuple[dict[str, str], list[str]]] = []
    pending = [paths]
    with ThreadPoolExecutor(8) as pool:
        while pending:
            tried = list(pool.map(lambda some: _merged_types(spark, base, some), pending))
            failed = [some for some, types in zip(pending, tried) if types is None]
            for some, types in zip(pending, tried):
                if not types:
                    continue
                for known, same in sets:  # sets that agree where they overlap are one
                    if all(known.get(name, kind) == kind for name, kind in types.items()):
                        known.update(types)
                        same.extend(some)
                        break
                else:
                    sets.append((types, list(some)))
            parts = [_files(spark, some[0]) if len(some) == 1 else some for some in failed]
            pending = [half for some in parts for half in (some[: len(some) // 2], some[len(some) // 2 :])]
    return sets


def _scans(spark: SparkSession, base: str, paths: list[str], folder: str) -> list[DataFrame]:
    """A scan for each set of stored types."""
    reader = lambda types: _reader(spark).schema(", ".join(f"`{n}` {t}" for n, t in types.items() if n != folder))
    return [reader(types).option("basePath", base).parquet(*some) for types, some in _stored_types(spark, base, paths)]


def extract_users(spark: SparkSession, raw_dir: str) -> DataFrame:
    """All users. Spark raises PATH_NOT_FOUND when the file is missing."""
    return _conformed(_reader(spark).parquet(f"{raw_dir}/users.parquet"), RAW_USERS)


def available_dates(spark: SparkSession, raw_dir: str) -> list[dt.date]:
    """The days that have a folder, from the folders' names; no file is opened or listed."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{raw_dir}/events")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        raise FileNotFoundError(f"{raw_dir}/events")
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(dt.date.fromisoformat(n.removeprefix("dt=")) for n in names if n.startswith("dt="))


def extract_events(
    spark: SparkSession,
    raw_dir: str,
    start: DateLike | None = None,
    end: DateLike | None = None,
    with_source: bool = False,
) -> DataFrame:
    """Events of an inclusive date range; only the matching folders are listed and read.

    ``with_source`` adds the folder's day as ``source_date``.
    """
    days = [
        d
        for d in available_dates(spark, raw_dir)
        if (start is None or str(d) >= str(start)) and (end is None or str(d) <= str(end))
    ]
    ddl = f"{RAW_EVENTS}, source_date date" if with_source else RAW_EVENTS
    if not days:
        return spark.createDataFrame([], ddl)
    paths = [f"{raw_dir}/events/dt={d}" for d in days]
    scans = [
        _conformed(found.withColumnRenamed("dt", "source_date"), ddl)
        for found in _scans(spark, f"{raw_dir}/events", paths, "dt")
    ]
    return functools.reduce(DataFrame.union, scans) if scans else spark.createDataFrame([], ddl)


def extract_events_for_date(spark: SparkSession, raw_dir: str, date: DateLike) -> DataFrame:
    return extract_events(spark, raw_dir, date, date)


def list_available_dates(spark: SparkSession, raw_dir: str) -> DataFrame:
    """The days that have a folder, sorted; also those whose files have no rows."""
    return spark.createDataFrame([(d,) for d in available_dates(spark, raw_dir)], "dt date").orderBy("dt")


def write_users(users: DataFrame, raw_dir: str) -> None:
    users.write.mode("overwrite").option("compression", "snappy").parquet(f"{raw_dir}/users.parquet")


def write_events(events: DataFrame, raw_dir: str, by: str = "event_timestamp", mode: str = "overwrite") -> None:
    """Write events by the day of ``by``. Rebalancing gives each day few files, and a large
    day several."""
    (
        events.withColumn("dt", F.col(by).try_cast("timestamp_ntz").cast("date"))
        .hint("rebalance", "dt")
        .write.mode(mode)
        .partitionBy("dt")
        .option("compression", "snappy")
        .parquet(f"{raw_dir}/events")
    )

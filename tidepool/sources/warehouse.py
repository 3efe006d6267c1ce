"""The star schema as Parquet folders under one root."""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import DateLike, between_days, day
from ..schemas import BUCKET_KEY, PARTITION_COLUMN, STATES, TABLES, columns

DECLARED = TABLES | STATES
# Names the folder of a bucketed table, as <number of buckets>_<bucket>.
BUCKET = "key_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.concat_ws("_", F.lit(str(buckets)), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"))


class Warehouse:
    """Reads and writes the tables declared in ``schemas``.

    ``root`` must be a folder every executor can reach. Whole-table writes go to a
    sibling folder that then replaces the old one, so a table may be derived from itself
    and a failed job leaves it as it was.

    Several tables change together by ``prepare`` or ``prepare_days`` and one ``commit``: what
    is prepared lies beside the tables until a folder that names them all is renamed into
    place. Before that rename nothing has changed, whatever was prepared; after it the next
    access of any table moves what is left. One job at a time may write a warehouse.

    ``buckets`` is how many folders a table with a bucket key gets when it is next written
    whole, at best one per 100 MB or so; until then it keeps the number it was written with.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # -- locations ---------------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _path(self, location: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(location)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def exists_path(self, location: str) -> bool:
        fs, path = self._path(location)
        return fs.exists(path)

    def exists(self, table: str) -> bool:
        self._finish_swap(table)
        return self.exists_path(self.path(table))

    def _finish_swap(self, table: str) -> None:
        """Complete a swap that was cut off on the way, of the whole table or of days."""
        self._finish_commit()
        fs, target = self._path(self.path(table))
        _, done = self._path(f"{self.path(table)}__next/_SUCCESS")
        if not fs.exists(target) and fs.exists(done):
            fs.rename(done.getParent(), target)
        self._finish_days(table)

    def _finish_days(self, table: str) -> None:
        """Move staged day folders into place, once all of them are complete."""
        fs, ready = self._path(f"{self.path(table)}__days/_READY")
        if not fs.exists(ready):
            return
        for status in fs.listStatus(ready.getParent()):
            if not status.isDirectory():
                continue
            staged = status.getPath()
            _, target = self._path(f"{self.path(table)}/{staged.getName()}")
            fs.delete(target, True)
            if len(fs.listStatus(staged)):  # an empty folder stands for a day without rows
                fs.mkdirs(target.getParent())
                if not fs.rename(staged, target):
                    raise OSError(f"could not move {staged.getName()} of {table} into place")
        fs.delete(ready.getParent(), True)

    def _finish_commit(self) -> None:
        """Move into place what a commit names, as far as it hasn't been yet."""
        fs, commit = self._path(f"{self.root}/_commit")
        if not fs.exists(commit):
            return
        for status in fs.listStatus(commit):
            table, _, part = status.getPath().getName().partition(".")
            _, prepared = self._path(f"{self.path(table)}__{part}")
            if not fs.exists(prepared):
                continue
            if part == "days":
                fs.create(self._path(f"{self.path(table)}__days/_READY")[1], True).close()
                self._finish_days(table)
            else:
                _, target = self._path(self.path(table))
                fs.delete(target, True)
                if not fs.rename(prepared, target):
                    raise OSError(f"could not move the new version of {table} into place")
        fs.delete(commit, True)

    def _swap(self, table: str) -> None:
        fs, target = self._path(self.path(table))
        _, staged = self._path(f"{self.path(table)}__next")
        fs.delete(target, True)
        if not fs.rename(staged, target):
            raise OSError(f"could not move the new version of {table} into place")

    # -- reading -----------------------------------------------------------------

    def _stored(self, table: str, location: str) -> DataFrame:
        fields = columns(DECLARED[table])
        stored = ", ".join(f"{n} {t}" for n, t in fields if (table, n) != ("fct_events", "date_key"))
        df = self.spark.read.schema(stored).parquet(location)
        if table == "fct_events":
            df = df.withColumn("date_key", F.col("_partition_date"))
        return df.select([name for name, _ in fields])

    def read(self, table: str) -> DataFrame:
        """A table with its declared schema; empty when it was never written.

        ``date_key`` of the fact table is not stored: it always equals the folder's
        date, and reading it as an alias lets every filter on it prune folders.
        """
        if not self.exists(table):
            return self.spark.createDataFrame([], DECLARED[table])
        return self._stored(table, self.path(table))

    def prepared(self, table: str, part: str = "days") -> DataFrame:
        """What is prepared for a table: its new ``days``, or the ``whole`` of it."""
        return self._stored(table, f"{self.path(table)}__{part}")

    def fact(self, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
        return between_days(self.read("fct_events"), "date_key", start, end)

    def activity(self, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
        return between_days(self.read("user_activity"), "date_key", start, end)

    def create_views(self) -> None:
        """Make every table available to ``spark.sql`` in this session, under its name."""
        for table in TABLES:
            self.read(table).createOrReplaceTempView(table)

    # -- writing -----------------------------------------------------------------

    def _conform(self, df: DataFrame, table: str) -> DataFrame:
        """Declared columns, in order, with declared types."""
        df = df.select([F.col(n).cast(t).alias(n) for n, t in columns(DECLARED[table])])
        return df.drop("date_key") if table == "fct_events" else df

    def _folders(self, df: DataFrame, folder: str, mode: str):
        """Rows of a folder sit in few files, and a folder with most of the rows has many."""
        order = [c for c in (folder, "user_key") if c in df.columns]
        df = df.hint("rebalance", folder).sortWithinPartitions(*order)
        return df.write.mode(mode).partitionBy(folder)

    def _writer(self, df: DataFrame, table: str, mode: str, buckets: int | None = None):
        df = self._conform(df, table)
        if table in BUCKET_KEY:
            df = df.withColumn(BUCKET, _bucket(BUCKET_KEY[table], buckets or self.buckets))
            return self._folders(df, BUCKET, mode)
        folder = PARTITION_COLUMN.get(table)
        return df.write.mode(mode) if folder is None else self._folders(df, folder, mode)

    def replace(self, table: str, df: DataFrame) -> None:
        self._finish_swap(table)
        self._writer(df, table, "overwrite").parquet(f"{self.path(table)}__next")
        self._swap(table)

    def append(self, table: str, df: DataFrame) -> None:
        buckets = self._bucket_count(table)
        if table in BUCKET_KEY and self.exists(table) and not buckets:
            stored = self.read(table)  # written without buckets
            return self.replace(table, stored.unionByName(df.select(stored.columns)))
        self._finish_swap(table)
        self._writer(df, table, "append", buckets).parquet(self.path(table))

    def upsert(self, table: str, df: DataFrame, keys: str | list[str] | None) -> None:
        """Rows whose key is incoming make way for the incoming rows.

        Of a table with buckets only those of incoming keys are read and written, when the
        bucket key is among ``keys``.
        """
        if not keys:
            raise ValueError("upsert needs key columns")
        keys = [keys] if isinstance(keys, str) else keys

        def updated(stored: DataFrame) -> DataFrame:
            kept = stored.join(df.select(keys), keys, "left_anti")
            return kept.unionByName(df.select(kept.columns))

        if BUCKET_KEY.get(table) in keys:
            self.change(table, df, updated)
        else:
            self.replace(table, updated(self.read(table)))

    def _bucket_count(self, table: str) -> int | None:
        """How many buckets the stored table was dealt to, by its folders' names."""
        if table not in BUCKET_KEY or not self.exists(table):
            return None
        fs, path = self._path(self.path(table))
        for status in fs.listStatus(path):
            name, _, value = status.getPath().getName().partition("=")
            if name == BUCKET:
                return int(value.split("_")[0])
        return None

    def change(
        self, table: str, df: DataFrame, changed: Callable[[DataFrame], DataFrame]
    ) -> None:
        """Replace the rows of the buckets that keys of ``df`` fall in by ``changed`` of them.

        ``changed`` is given all stored rows of these buckets, those of other keys included, and
        may not return keys of other buckets: the write fails then. The other buckets are
        neither read nor written. All buckets change together, or none when it is cut off.
        A table without buckets so far is written whole.
        """
        buckets = self._bucket_count(table)
        if buckets is None:
            return self.replace(table, changed(self.read(table)))
        bucket = _bucket(BUCKET_KEY[table], buckets)
        # at most as many names as there are buckets
        touched = sorted(r[0] for r in df.select(bucket.alias(BUCKET)).distinct().collect())
        fields = ", ".join(f"{n} {t}" for n, t in columns(DECLARED[table]))
        stored = self.spark.read.schema(f"{fields}, {BUCKET} string").parquet(self.path(table))
        stored = stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        rows = self._conform(changed(stored), table).withColumn(BUCKET, bucket)
        self._prepare_folders(table, rows, BUCKET, touched, F.col(BUCKET).isin(touched))
        self.commit(f"{table}.days")

    def load_dimension(
        self, df: DataFrame, table: str, mode: str = "replace", key_column: str | None = None
    ) -> None:
        if mode == "replace":
            self.replace(table, df)
        elif mode == "append":
            self.append(table, df)
        elif mode == "upsert":
            self.upsert(table, df, key_column)
        else:
            raise ValueError(f"unknown mode {mode!r}")

    def days(self, table: str) -> list[dt.date]:
        """The days that have a folder, from the folders' names."""
        if not self.exists(table):
            return []
        fs, path = self._path(self.path(table))
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        return sorted(dt.date.fromisoformat(n.partition("=")[2]) for n in names if "=" in n)

    def stamps(self, table: str) -> dict[dt.date, str]:
        """A digest of the names of each day's files, which change with every write of the day."""
        names: dict[dt.date, list[str]] = {}
        for file in self.read(table).inputFiles():
            folder, name = file.split("/")[-2:]
            names.setdefault(dt.date.fromisoformat(folder.partition("=")[2]), []).append(name)
        return {d: hashlib.sha256("\n".join(sorted(n)).encode()).hexdigest() for d, n in names.items()}

    def prepare(self, table: str, df: DataFrame) -> None:
        """Write a new version of a whole table beside it, for ``commit``."""
        self._finish_swap(table)
        self._writer(df, table, "overwrite").parquet(f"{self.path(table)}__whole")

    def prepare_days(self, table: str, df: DataFrame, dates: Iterable[DateLike]) -> None:
        """Write the new content of the folders of ``dates`` beside the table, for ``commit``.

        A date without rows empties its folder. A row of another day makes the write fail
        instead of being lost.
        """
        folder = PARTITION_COLUMN[table]
        dates = [dt.date.fromisoformat(str(d)) for d in dates]
        known = F.col(folder).isin([day(d) for d in dates]) if dates else F.lit(True)
        self._prepare_folders(table, self._conform(df, table), folder, dates, known)

    def _prepare_folders(
        self, table: str, rows: DataFrame, folder: str, names: list, known: Column
    ) -> None:
        kind = rows.schema[folder].dataType
        what = "bucket" if folder == BUCKET else "day"
        stray = F.concat(F.lit(f"row of another {what}: "), F.coalesce(F.col(folder).cast("string"), F.lit("none")))
        rows = rows.withColumn(folder, F.when(known, F.col(folder)).otherwise(F.raise_error(stray).cast(kind)))
        self._finish_swap(table)
        staged = f"{self.path(table)}__days"
        self._folders(rows, folder, "overwrite").parquet(staged)
        fs, _ = self._path(staged)
        for name in names:
            fs.mkdirs(self._path(f"{staged}/{folder}={name}")[1])

    def commit(self, *parts: str) -> None:
        """Make prepared parts, named table.days or table.whole, the tables' content, all or none."""
        fs, commit = self._path(f"{self.root}/_commit")
        _, names = self._path(f"{self.root}/_commit__next")
        fs.delete(names, True)
        fs.mkdirs(names)
        for part in parts:
            fs.create(self._path(f"{self.root}/_commit__next/{part}")[1], True).close()
        if not fs.rename(names, commit):
            raise OSError("could not commit")
        self._finish_commit()

    def replace_days(self, table: str, df: DataFrame, dates: Iterable[DateLike]) -> None:
        """Make ``df`` the whole content of the folders of ``dates``, even of empty ones.

        One write puts all days next to the table, and only when it is complete do they
        replace the old folders; a failed load leaves them as they were.
        """
        self.prepare_days(table, df, dates)
        self.commit(f"{table}.days")

    # -- days whose aggregates are behind ----------------------------------------

    def mark_stale(self, dates: Iterable[DateLike]) -> None:
        """Note that the aggregates of ``dates`` must be computed anew; kept until cleared."""
        for d in dates:
            fs, path = self._path(f"{self.root}/_stale/{d}")
            fs.create(path, True).close()

    def stale_days(self) -> list[dt.date]:
        fs, folder = self._path(f"{self.root}/_stale")
        if not fs.exists(folder):
            return []
        return sorted(dt.date.fromisoformat(s.getPath().getName()) for s in fs.listStatus(folder))

    def clear_stale(self, dates: Iterable[DateLike]) -> None:
        for d in dates:
            fs, path = self._path(f"{self.root}/_stale/{d}")
            fs.delete(path, False)

    def replace_day(self, table: str, df: DataFrame, date: DateLike) -> None:
        self.replace_days(table, df, [date])

    def replace_dates(self, table: str, df: DataFrame, dates: Iterable[DateLike]) -> None:
        """Replace whole dates of a small, unpartitioned table keyed by ``date_key``."""
        kept = self.read(table).where(~F.col("date_key").isin([day(d) for d in dates]))
        self.replace(table, kept.unionByName(df.select(kept.columns)))

    def load_facts(self, df: DataFrame, partition_date: DateLike | None = None) -> None:
        """Append facts, or make them the whole content of one day."""
        if partition_date is None:
            self.append("fct_events", df)
        else:
            self.replace_day("fct_events", df, partition_date)

    # -- inspection --------------------------------------------------------------

    def verify(self, table: str) -> tuple[int, DataFrame]:
        """Row count and a five-row sample of a table."""
        df = self.read(table)
        return df.count(), df.limit(5)

    def table_stats(self) -> DataFrame:
        return table_stats({name: self.read(name) for name in TABLES})


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table; a table without rows counts 0."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, counts)


def fact_date_bounds(activity: DataFrame) -> DataFrame:
    """First and last day with facts, one row."""
    return activity.agg(F.min("date_key").alias("min_date"), F.max("date_key").alias("max_date"))

"""Shared scratch space for tables that live as long as the application."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share.

    A session without one gets a folder in its warehouse, which is shared as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def application_dir(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/tidepool-{spark.sparkContext.applicationId}"


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once, stored in the scratch space and read back."""
    spark = df.sparkSession
    path = f"{application_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

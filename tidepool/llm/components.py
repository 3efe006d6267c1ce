"""Connected components of a link table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: nodes around a centre are linked to the centre's smallest neighbour.

    ``edges`` holds each link as (a, b) with a > b.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.withColumn("low", F.least("a", "low"))
        # each larger neighbour of a centre hangs on the centre's smallest one
        out = edges.select(F.col("b").alias("centre"), F.col("a").alias("n"))
        moved = out.join(low.withColumnRenamed("a", "centre"), "centre").select(
            F.col("n").alias("a"), F.col("low").alias("b")
        )
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("low"))
        moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.union(low.select("a", F.col("low").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every node with a link: the label is the smallest id of its component.

    ``edges`` holds pairs (a, b), in either order, repeated or not. Large-star and
    small-star steps alternate until no link moves; each turn is a stored table, so that
    neither lineage nor a lost executor costs more than one turn. No edges give no rows.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(now.where("a <> b").distinct())
    before = None
    while True:
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if state == before or state[0] == 0:
            break
        before = state
        now = written(_star(_star(now, large=True), large=False))
    roots = now.select(F.col("b").alias("id")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("label")).union(
        roots.select("id", F.col("id").alias("label"))
    )

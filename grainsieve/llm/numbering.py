"""Gapless numbers inside groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grainsieve.plans.durable import cut_lineage

_PART = "__part"
_BEFORE = "__before"
_PLACE = "__place_of_row"


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def numbered(
    df: DataFrame, by: list[str], ties: list[str], name: str, *, equal_rows: bool = False
) -> DataFrame:
    """Add ``name``: how many rows of the same ``by`` come earlier in the order of ``ties``.

    Rows are dealt out by ranges of (``by``, ``ties``), so one group may take many tasks. Every task
    numbers its own rows; what comes before them is summed over a table with a row per group and task.
    Nulls in ``by`` are one group. Rows equal in ``by`` and ``ties`` are numbered in any order; with ``equal_rows``, for tables
    where many may be, they are told apart by their places, so that they take many tasks as well. ``df`` has to be a kept table
    then, whose rows have the same places when they are read again.
    """
    width = shuffle_width(df.sparkSession)
    columns = df.columns
    if equal_rows:
        df = df.withColumn(_PLACE, F.monotonically_increasing_id())
        ties = [*ties, _PLACE]
    dealt = cut_lineage(
        df.repartitionByRange(width, *by, *ties).withColumn(_PART, F.spark_partition_id())
    )
    earlier = (
        Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = dealt.groupBy(*by, _PART).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = totals.select(
        *(F.col(key).alias(f"__o_{key}") for key in by),
        F.col(_PART).alias("__o_part"),
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias(_BEFORE),
    )
    same: Column = reduce(
        Column.__and__,
        (F.col(key).eqNullSafe(F.col(f"__o_{key}")) for key in by),
        F.col(_PART) == F.col("__o_part"),
    )
    inside = Window.partitionBy(*by, _PART).orderBy(*ties)
    return (
        dealt.withColumn("__inside", F.row_number().over(inside))
        .join(offsets, same)
        .select(*columns, (F.col("__inside") - 1 + F.col(_BEFORE)).cast("long").alias(name))
    )

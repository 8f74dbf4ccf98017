"""Running totals over a table of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HEX_DIGITS = 3  # 16 ** 3 buckets

_BUCKET = "__bucket"


def hash_bucket(column: str):
    """First hex digits of a sha-256 string: an even split that keeps the hash order."""
    return F.substring(F.col(column), 1, HEX_DIGITS)


def sum_of_earlier(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows with a smaller ``order``.

    ``order`` holds sha-256 hex strings. Every bucket of hashes is summed in a task of its own; only the
    bucket totals, at most 4096 rows whatever the input, meet in one task and are broadcast.
    """
    bucketed = df.withColumn(_BUCKET, hash_bucket(order))
    earlier_buckets = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(_BUCKET)
        .agg(F.sum(value).alias("__total"))
        .select(
            _BUCKET,
            F.coalesce(F.sum("__total").over(earlier_buckets), F.lit(0)).alias("__offset"),
        )
    )
    earlier_rows = (
        Window.partitionBy(_BUCKET)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        bucketed.withColumn("__inside", F.coalesce(F.sum(value).over(earlier_rows), F.lit(0)))
        .join(F.broadcast(offsets), _BUCKET)
        .withColumn(name, F.col("__inside") + F.col("__offset"))
        .drop(_BUCKET, "__inside", "__offset")
    )

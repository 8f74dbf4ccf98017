"""Document ids and splitting a table by a list of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainsieve.functions.identity import document_id
from grainsieve.operators.holdout import TRAIN, VALIDATION
from grainsieve.plans.bloom import with_chance
from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import BROADCAST_BYTES, BROADCAST_ROWS, attach, fits_broadcast

def document_ids(df: DataFrame, key: str | None = None) -> DataFrame:
    """One ``id`` per row, repeats kept: a content hash, or the ``meta`` field ``key``."""
    return df.select(document_id(key).alias("id"))


def distinct_ids(ids: DataFrame) -> DataFrame:
    """The ids as a set. Copies are removed before the shuffle already, so a much repeated id is cheap."""
    return ids.select(F.col("id").cast("string").alias("id")).filter("id IS NOT NULL").distinct()


def split_by_ids(
    df: DataFrame,
    ids: DataFrame,
    key: str | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``split``: rows whose id is in ``ids`` are ``validation``, all others ``train``.

    All copies of a listed document go together, and a row without an id stays in train. Beyond the broadcast bound
    ``df`` is read twice: rows that are surely not listed stay where they are, only the others are shuffled.
    """
    columns = [name for name in df.columns if name != "split"]
    listed = cut_lineage(distinct_ids(ids)).withColumn("__listed", F.lit(True)).withColumnRenamed("id", "__id")
    rows = df.withColumn("__id", document_id(key).cast("string"))

    def flagged(some: DataFrame) -> DataFrame:
        found = attach(some, listed, on=["__id"], max_rows=max_rows, max_bytes=max_bytes)
        split = F.when(F.col("__listed"), F.lit(VALIDATION)).otherwise(F.lit(TRAIN))
        return found.select(*(F.col(f"`{c}`") for c in columns), split.alias("split"))

    if fits_broadcast(listed, max_rows, max_bytes):
        return flagged(rows)
    rows = with_chance(rows, listed.select("__id"), "__id")
    others = rows.filter(~F.col("__maybe"))
    train = others.select(*(F.col(f"`{c}`") for c in columns), F.lit(TRAIN).alias("split"))
    return train.unionByName(flagged(rows.filter("__maybe").drop("__maybe")))


def rows_in_list(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Rows whose ``column`` is in the one-column table ``allowed``: an allow list of any length."""
    entries = allowed.toDF(column).filter(F.col(column).isNotNull()).distinct()
    return attach(df, cut_lineage(entries), on=[column], how="inner")


def rows_with_ids(df: DataFrame, ids: DataFrame, key: str | None = None) -> DataFrame:
    """The validation side of ``split_by_ids``."""
    return split_by_ids(df, ids, key).filter(F.col("split") == VALIDATION).drop("split")


def rows_without_ids(df: DataFrame, ids: DataFrame, key: str | None = None) -> DataFrame:
    """The train side of ``split_by_ids``."""
    return split_by_ids(df, ids, key).filter(F.col("split") == TRAIN).drop("split")


def store_by_id(
    df: DataFrame, table: str, key: str | None = None, buckets: int = 200, path: str | None = None
) -> None:
    """Keep ``df`` as the table ``table``, bucketed and sorted by ``id`` (see ``document_ids``), for splits by many id lists.

    The rows are shuffled once, here; ``buckets`` should leave each one small enough for a task. A table of that name is replaced. It lies in
    the warehouse, or in ``path``.
    """
    rows = df.withColumn("id", document_id(key).cast("string"))
    _bucketed(rows, table, buckets, path)


def store_ids(ids: DataFrame, table: str, buckets: int = 200, path: str | None = None) -> None:
    """Keep the distinct ids as the table ``table``, with the buckets of the documents they are for."""
    _bucketed(distinct_ids(ids), table, buckets, path)


def _bucketed(rows: DataFrame, table: str, buckets: int, path: str | None) -> None:
    # One task per bucket, so that a bucket is one file; equal ids meet in one, as the join needs them to.
    dealt = rows.repartition(buckets, "id")
    writer = dealt.write.bucketBy(buckets, "id").sortBy("id").mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def split_stored_by_ids(spark: SparkSession, documents: str, ids: str) -> DataFrame:
    """``split_by_ids`` for tables of ``store_by_id`` and ``store_ids`` with as many buckets: bucket meets bucket, and nothing is shuffled."""
    rows = spark.table(documents)
    listed = spark.table(ids).select(F.col("id").alias("__id"), F.lit(True).alias("__listed"))
    split = F.when(F.col("__listed"), F.lit(VALIDATION)).otherwise(F.lit(TRAIN))
    # Ids differ, so the join keeps the rows of the documents as they are.
    found = rows.join(listed.hint("merge"), F.col("id") == F.col("__id"), "left")
    kept = [F.col(f"`{name}`") for name in rows.columns if name not in {"id", "split"}]
    return found.select(*kept, split.alias("split"))

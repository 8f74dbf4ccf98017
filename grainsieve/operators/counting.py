"""Token counts per document, shard, split and collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_token_count(df: DataFrame) -> DataFrame:
    """Fill ``num_tokens`` from ``tokens`` where it is absent or NULL; nothing is written back."""
    if "num_tokens" in df.columns:
        if "tokens" not in df.columns:
            return df
        counted = F.when(F.col("tokens").isNotNull(), F.size("tokens"))
        return df.withColumn("num_tokens", F.coalesce("num_tokens", counted))
    return df.withColumn("num_tokens", F.size("tokens"))


def tokens_per_shard(df: DataFrame, shard_col: str = "shard") -> DataFrame:
    """``shard``, ``examples``, ``tokens``. Only the shard and count columns are read."""
    counted = with_token_count(df)
    return counted.groupBy(F.col(shard_col).alias("shard")).agg(
        F.count(F.lit(1)).alias("examples"),
        F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("tokens"),
    )


def corpus_totals(shards: DataFrame) -> DataFrame:
    """One row of totals from the result of ``tokens_per_shard``."""
    return shards.agg(
        F.count(F.lit(1)).alias("shards"),
        F.coalesce(F.sum("examples"), F.lit(0)).alias("examples"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
    )


def split_totals(df: DataFrame, split_col: str = "split") -> DataFrame:
    """``split``, ``examples``, ``tokens``; tokens are NULL when the table has no ``num_tokens``."""
    known = "num_tokens" in df.columns
    tokens = F.sum("num_tokens") if known else F.lit(None).cast("bigint")
    return df.groupBy(F.col(split_col).alias("split")).agg(
        F.count(F.lit(1)).alias("examples"), tokens.alias("tokens")
    )


def rows_per_split(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(F.col(split_col).alias("split")).agg(F.count(F.lit(1)).alias("examples"))


def token_report(df: DataFrame, shard_col: str = "shard", split_col: str = "split") -> DataFrame:
    """``level``, ``split``, ``shard``, ``shards``, ``examples``, ``tokens`` of every shard, every split and the whole, from one pass.

    ``level`` is ``shard``, ``split`` or ``corpus``; what a level sums over is NULL, which a missing split or shard is too. A shard counts in each split that has
    rows of it, and once in the corpus.
    """
    cells = with_token_count(df).groupBy(F.col(split_col).alias("split"), F.col(shard_col).alias("shard")).agg(
        F.count(F.lit(1)).alias("examples"), F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("tokens")
    )
    # Told apart by the grouping, not by NULL. The cells are one row per split and shard.
    named = cells.withColumn("__shard", F.struct("shard"))
    level = F.grouping_id("shard", "split")
    sets = [[F.col("shard")], [F.col("split")], []]
    return named.groupingSets(sets, "shard", "split").agg(
        F.when(level == 1, F.lit("shard")).when(level == 2, F.lit("split")).otherwise(F.lit("corpus")).alias("level"),
        F.count_distinct("__shard").alias("shards"),
        F.sum("examples").alias("examples"),
        F.sum("tokens").alias("tokens"),
    ).select("level", "split", "shard", "shards", "examples", "tokens")

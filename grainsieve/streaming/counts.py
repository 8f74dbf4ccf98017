"""Token counts per shard over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from grainsieve.operators.counting import with_token_count

_BATCH = "batch"


def count_stream(documents: DataFrame, path: str, checkpoint: str, shard_col: str = "shard") -> StreamingQuery:
    """Start a query that adds the tokens of every file not seen yet to the totals of its shard, and then ends.

    The running totals are the query's state, kept below ``checkpoint``. Each micro-batch stores the new totals of the shards it has
    touched in a folder of its own number: a batch that is run again replaces what it stored before, so nothing counts twice. ``path`` and
    ``checkpoint`` lie in shared storage; a restart goes on where the last run ended.
    """
    totals = (
        with_token_count(documents)
        .groupBy(F.col(shard_col).alias("shard"))
        .agg(F.count(F.lit(1)).alias("examples"), F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("tokens"))
    )

    def store(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_BATCH}={batch}")

    return (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )


def stream_counts(spark: SparkSession, path: str) -> DataFrame:
    """``shard``, ``examples``, ``tokens`` as of the last batch, like ``tokens_per_shard`` over all files so far."""
    stored = spark.read.schema(f"shard STRING, examples BIGINT, tokens BIGINT, {_BATCH} BIGINT").parquet(path)
    latest = stored.groupBy("shard").agg(F.max_by(F.struct("examples", "tokens"), _BATCH).alias("last"))
    return latest.select("shard", "last.examples", "last.tokens")


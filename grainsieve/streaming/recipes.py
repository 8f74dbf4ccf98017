"""Running a recipe over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from grainsieve.plans.recipes import Recipe, apply_recipe
from grainsieve.sinks.writers import CHUNK_ROWS


def stream_documents(
    spark: SparkSession, directory: str, schema: str | T.StructType, fmt: str = "json"
) -> DataFrame:
    """A stream of the files in ``directory``; the schema is fixed, as streams infer none."""
    return spark.readStream.schema(schema).format(fmt).load(directory)


def filter_stream(
    documents: DataFrame,
    recipe: Recipe,
    path: str,
    checkpoint: str,
    carry: tuple[str, ...] = (),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start a query that filters every file not seen yet and then ends.

    Recipes keep no state, so each micro-batch gives what a batch run over the same files would.
    ``path`` and ``checkpoint`` lie in shared storage; a restart goes on where the last run ended.
    """
    writer = (
        apply_recipe(documents, recipe, carry)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", CHUNK_ROWS)
        .trigger(availableNow=True)
    )
    return writer.partitionBy(*carry).start() if carry else writer.start()

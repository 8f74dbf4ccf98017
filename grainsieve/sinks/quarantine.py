"""Taking in JSON lines some of which may be broken: those go to a place of their own, with where they stand."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainsieve.sinks.staging import Store, publish
from grainsieve.sources.readers import CORRUPT, read_documents

_BAD = "__bad"


class TooManyBadLines(ValueError):
    """More lines than allowed could not be read; nothing was stored."""


def ingest_lines(
    spark: SparkSession,
    paths: list[str],
    schema: str | T.StructType,
    path: str,
    quarantine: str,
    most_bad: int | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """Store the rows of JSON lines below ``path`` and the lines that are none below ``quarantine``, as Parquet, in one pass.

    Both have ``row_id``, the file and number of a line (blank lines not counted), and ``_corrupt``, the text of a bad one.
    Gives one row, ``good`` and ``bad``, counted while writing. With more than ``most_bad`` bad lines the call fails; both outputs
    appear by renaming when all is well, and former ones stay until then.
    """
    store = Store(spark, path)
    targets = {False: path.rstrip("/"), True: quarantine.rstrip("/")}
    present = [target for target in targets.values() if store.exists(target)]
    if present and not overwrite:
        raise FileExistsError(f"{present[0]} exists; pass overwrite=True to replace it")
    rows = read_documents(spark, paths, "pandas-jsonl", schema, row_id=True)
    if CORRUPT not in rows.columns:
        rows = rows.withColumn(CORRUPT, F.lit(None).cast("string"))
    observation = Observation()
    bad = F.col(CORRUPT).isNotNull()
    counted = rows.observe(observation, F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    staging, trash = (f"{targets[False]}-{kind}-{uuid.uuid4().hex}" for kind in ("staging", "former"))
    staging, trash = (f"{p.rpartition('/')[0]}/_{p.rpartition('/')[2]}" for p in (staging, trash))
    try:
        counted.withColumn(_BAD, bad).write.partitionBy(_BAD).parquet(staging)
        found = observation.get
        if most_bad is not None and found["bad"] > most_bad:
            raise TooManyBadLines(f"{found['bad']} lines could not be read, more than {most_bad}")
        for is_bad, target in targets.items():
            folder = f"{staging}/{_BAD}={str(is_bad).lower()}"
            if not store.exists(folder):
                # No such rows: an output without any, of the same columns.
                spark.createDataFrame([], rows.schema).write.parquet(folder)
            publish(spark, [(folder, target)], f"{trash}/{is_bad}")
    finally:
        for folder in (staging, trash):
            store.delete(folder)
    return spark.createDataFrame([(found["good"], found["bad"])], "good BIGINT, bad BIGINT")

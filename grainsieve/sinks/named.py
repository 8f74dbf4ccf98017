"""One output per shard, named after it: written by Spark into a staging folder, published by renaming."""

from __future__ import annotations

import logging
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainsieve.functions.text import validation_name
from grainsieve.operators.holdout import VALIDATION
from grainsieve.sinks.staging import Store, compressed, listed, publish

logger = logging.getLogger(__name__)

# Names up to so many are left out by a condition, which prunes files where the name comes from the path; more by a join.
LISTED_NAMES = 5_000

_NAME = "__output"


def output_name(shard: Column, split: Column) -> Column:
    """The shard's name, and for the validation side the same with ``train`` made ``validation``; a name without ``train`` gets it at its end."""
    other = validation_name(shard)
    other = F.when(other == shard, F.concat(shard, F.lit("_validation"))).otherwise(other)
    return F.when(F.coalesce(split == VALIDATION, F.lit(False)), other).otherwise(shard)


def _absent(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose output is not among ``names``; a missing name stays."""
    if not names:
        return df
    if len(names) <= LISTED_NAMES:
        return df.filter(F.coalesce(~F.col(_NAME).isin(*names), F.lit(True)))
    present = df.sparkSession.createDataFrame([(name,) for name in names], f"{_NAME} STRING")
    return df.join(present, _NAME, "left_anti")


def write_named(
    df: DataFrame,
    path: str,
    name: Column,
    fmt: str = "parquet",
    overwrite: bool = False,
    drop: tuple[str, ...] = (),
    max_rows: int | None = None,
) -> list[str]:
    """Write ``name.parquet`` (or ``.jsonl``) below ``path`` for every ``name``; gives the names written.

    Rows of a name are gathered first. A name whose rows fill one task becomes one file; a larger one, or one beyond ``max_rows``, becomes a folder of that name with
    several files, which readers take the same way. Each appears with one rename, after all tasks have ended well: a job that fails
    leaves nothing, one that dies while renaming leaves whole outputs and the rest to be done. Outputs that are there stay as they are
    unless ``overwrite``. Rows without a name are an error.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    extension = "parquet" if fmt == "parquet" else "jsonl"
    name = F.when(name.isNotNull(), name).otherwise(F.raise_error(F.lit("a row has no output name")).cast("string"))
    rows = df.withColumn(_NAME, name).drop(*drop)
    store = Store(spark, root)
    if not overwrite:
        present = [n.removesuffix(f".{extension}") for n in listed(spark, root) if n.endswith(f".{extension}")]
        if present:
            logger.error("%d outputs of %s already exist and are skipped", len(present), root)
        rows = _absent(rows, present)
    staging, trash = (f"{root}/_{kind}-{uuid.uuid4().hex}" for kind in ("staging", "former"))
    writer = compressed(spark, rows.hint("rebalance", F.col(_NAME)).write.partitionBy(_NAME), fmt)
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    if fmt != "parquet":
        writer = writer.option("ignoreNullFields", "false")
    try:
        writer.format("parquet" if fmt == "parquet" else "json").save(staging)
        moves, names = [], []
        for folder in store.children(staging):
            if not folder.startswith(f"{_NAME}="):
                continue
            one = unquote(folder.removeprefix(f"{_NAME}="))
            if "/" in one:
                raise ValueError(f"{one} is no name for a file")
            files = [n for n in store.children(f"{staging}/{folder}") if not n.startswith(("_", "."))]
            source = f"{staging}/{folder}/{files[0]}" if len(files) == 1 else f"{staging}/{folder}"
            moves.append((source, f"{root}/{one}.{extension}"))
            names.append(one)
        publish(spark, moves, trash)
    finally:
        for folder in (staging, trash):
            store.delete(folder)
    return names

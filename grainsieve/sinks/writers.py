"""Writers with overwrite guards."""

from __future__ import annotations

import logging
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from grainsieve.operators.counting import split_totals
from grainsieve.sinks.named import LISTED_NAMES, output_name, write_named
from grainsieve.sinks.staging import compressed, recover, replace
from grainsieve.sources.paths import SPLIT_MARKS, child_names

logger = logging.getLogger(__name__)

# Fixed value: most rows of one output file of the filter stage.
CHUNK_ROWS = 100_000

SPLITS = tuple(SPLIT_MARKS)

# What Spark writes when an output is complete, and the folder name of a NULL partition value.
DONE = "_SUCCESS"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _write(
    writer: DataFrameWriter,
    df: DataFrame,
    path: str,
    fmt: str,
    partition_by: tuple[str, ...],
    overwrite: bool,
    max_rows: int | None,
    on_exists: str,
) -> bool:
    spark = df.sparkSession
    recover(spark, path)
    names = child_names(spark, path)
    if names and not overwrite:
        if on_exists == "error":
            raise FileExistsError(f"{path} holds an earlier result; pass overwrite=True to write it anew")
        if DONE in names:
            logger.error("%s is finished and stays as it is", path)
            return False
        if not all(name.startswith(("_", ".")) for name in names):
            raise FileExistsError(f"{path} holds files but no {DONE}: pass overwrite=True if they may go")
        logger.warning("%s holds leftovers of an unfinished job, which are replaced", path)
    writer = compressed(spark, writer, fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    if DONE in names:
        # The earlier result goes when the new one is whole.
        replace(spark, path, lambda staging: writer.format(fmt).save(staging))
    else:
        writer.format(fmt).mode("overwrite").save(path)
    return True


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    overwrite: bool = False,
    max_rows: int | None = None,
    on_exists: str = "skip",
) -> bool:
    """Write unless ``path`` holds a finished output; tells whether it wrote. ``on_exists="error"`` raises instead.

    What a dead job left in ``_temporary`` is replaced; other files without ``_SUCCESS`` are an error. With ``overwrite`` a finished output
    stays until the new one is whole, and for good if the job fails; ``df`` may read it.
    """
    return _write(df.write, df, path, "parquet", partition_by, overwrite, max_rows, on_exists)


def write_jsonl(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    overwrite: bool = False,
    max_rows: int | None = None,
    on_exists: str = "skip",
) -> bool:
    """As ``write_parquet``, in JSON lines: UTF-8 unescaped, NULL fields written."""
    writer = df.write.option("ignoreNullFields", "false")
    return _write(writer, df, path, "json", partition_by, overwrite, max_rows, on_exists)


def write_text(df: DataFrame, path: str, overwrite: bool = False, on_exists: str = "skip") -> bool:
    """As ``write_parquet``, the lines of a one-column table."""
    return _write(df.write, df, path, "text", (), overwrite, None, on_exists)


def writer_for(fmt: str):
    if fmt == "parquet":
        return write_parquet
    if fmt in {"jsonl", "json"}:
        return write_jsonl
    raise ValueError(f"unknown output format {fmt}")


def write_filtered(df: DataFrame, path: str, overwrite: bool = False) -> bool:
    """Filter output: Parquet files of at most 100,000 rows, one folder per split."""
    return write_parquet(df, path, ("split",), overwrite, max_rows=CHUNK_ROWS)


def _without(df: DataFrame, column: str, names: list[str], null_too: bool) -> DataFrame:
    """Rows whose ``column`` is not among ``names``, nor null with ``null_too``. Files are left out at once where it comes from their path."""
    if len(names) <= LISTED_NAMES:
        other = F.coalesce(~F.col(column).isin(*names), F.lit(True)) if names else F.lit(True)
        return df.filter(other & F.col(column).isNotNull() if null_too else other)
    present = df.sparkSession.createDataFrame([(name,) for name in names], "__present STRING")
    rest = df.join(present, F.col(column).cast("string") == F.col("__present"), "left_anti")
    return rest.filter(F.col(column).isNotNull()) if null_too else rest


def write_shards(
    df: DataFrame,
    path: str,
    overwrite: bool = False,
    fmt: str = "parquet",
    shard_col: str = "shard",
    cluster: bool = False,
) -> DataFrame:
    """Write one folder per shard and leave out the shards ``path`` already has; gives the rows written.

    Present shards are skipped before any work on their rows. With ``overwrite`` the shards of ``df`` replace
    theirs and no others. ``cluster`` gathers the rows of a shard first, in parts of even size: for tables whose tasks hold
    rows of many shards, which would each write a small file to every one of them.
    """
    if not overwrite:
        marker = f"{shard_col}="
        present = [
            name.removeprefix(marker)
            for name in child_names(df.sparkSession, path)
            if name.startswith(marker)
        ]
        if present:
            logger.error("%d shards of %s already exist and are skipped", len(present), path)
            named = [unquote(name) for name in present if name != NO_VALUE]
            df = _without(df, shard_col, named, NO_VALUE in present)
    stored = df.hint("rebalance", F.col(shard_col)) if cluster else df
    writer = stored.write.partitionBy(shard_col).mode("overwrite")
    writer = compressed(df.sparkSession, writer, fmt).option("partitionOverwriteMode", "dynamic")
    if fmt != "parquet":
        writer = writer.option("ignoreNullFields", "false")
    writer.format("parquet" if fmt == "parquet" else "json").save(path)
    return df


def parquet_to_jsonl(df: DataFrame, path: str, overwrite: bool = False) -> bool:
    return write_jsonl(df, path, overwrite=overwrite)


def write_counted(
    df: DataFrame,
    path: str,
    fmt: str,
    partition_by: tuple[str, ...] = ("split",),
    splits: tuple[str, ...] = SPLITS,
    overwrite: bool = False,
    on_exists: str = "skip",
    one_per_shard: bool = False,
) -> DataFrame:
    """Write, and give ``split``, ``examples`` and ``tokens`` (NULL without ``num_tokens``) of what ``path`` holds.

    The rows are counted while they are written. They are read again only if nothing was written,
    or a split has another name than those in ``splits``. With ``one_per_shard`` there are no folders: each ``shard`` becomes an output of its
    name, its validation rows one beside it; present ones are skipped, but their rows are counted.
    """
    known = "num_tokens" in df.columns
    counts: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for place, split in enumerate(splits):
        here = F.col("split") == split
        counts.append(F.count_if(here).alias(f"examples_{place}"))
        tokens = F.sum(F.when(here, F.col("num_tokens"))) if known else F.lit(None)
        counts.append(tokens.cast("bigint").alias(f"tokens_{place}"))
    observation = Observation()
    spark = df.sparkSession
    observed = df.observe(observation, *counts)
    if one_per_shard:
        name = output_name(F.col("shard"), F.col("split"))
        wrote = bool(write_named(observed, path, name, fmt, overwrite, drop=("shard", "split")))
        if not wrote:
            return split_totals(df)
    else:
        wrote = writer_for(fmt)(observed, path, partition_by, overwrite, on_exists=on_exists)
    if wrote:
        seen = observation.get
        rows = [
            (split, seen[f"examples_{place}"], seen[f"tokens_{place}"])
            for place, split in enumerate(splits)
            if seen[f"examples_{place}"]
        ]
        if one_per_shard or sum(examples for _, examples, _ in rows) == seen["rows"]:
            return spark.createDataFrame(rows, "split STRING, examples BIGINT, tokens BIGINT")
    if fmt == "parquet":
        return split_totals(spark.read.parquet(path))
    columns = [f"{name} STRING" for name in partition_by] + ["num_tokens BIGINT"] * known
    return split_totals(spark.read.schema(", ".join(columns)).json(path))


def ingest(df: DataFrame, path: str, fmt: str = "jsonl", overwrite: bool = False) -> DataFrame:
    """Store a table as one folder per ``split``, and count the rows of each.

    An existing ``path`` is an error unless ``overwrite``, which replaces it whole.
    """
    totals = write_counted(df, path, fmt, overwrite=overwrite, on_exists="error")
    return totals.select("split", "examples")

"""Validation-id manifests: one JSON document ``{"key": …, "ids": […]}``, or a table for long ones."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainsieve.functions.identity import HASH_KEY
from grainsieve.plans.durable import cut_lineage
from grainsieve.sinks.writers import write_jsonl, write_parquet, write_text
from grainsieve.sources.paths import child_names
from grainsieve.sources.readers import with_line_numbers

_MANIFEST = "key STRING, ids ARRAY<STRING>"


def read_manifest(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """Key name and the table of ids of a manifest document."""
    manifest = (
        spark.read.schema(_MANIFEST).option("multiLine", True).option("mode", "FAILFAST").json(path)
    )
    key = manifest.select("key").first().key
    return key, manifest.select(F.explode("ids").alias("id"))


def read_ids(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """Key name and ids of a manifest, be it a document, an ordered one, or a table of Parquet files; told by the files' names."""
    names = child_names(spark, path)
    if any(name.endswith(".txt") for name in names):
        key, ids = read_ordered_manifest(spark, path)
        return key, ids.select("id")
    if not any(name.endswith(".parquet") for name in names):
        return read_manifest(spark, path)
    table = read_manifest_table(spark, path)
    first = table.select("key").first()
    return (first.key if first else HASH_KEY), table.select("id")


def write_ordered_manifest(
    ids: DataFrame, order: list[str], path: str, key: str | None, overwrite: bool = False
) -> bool:
    """One manifest document of any number of ids, in ``order`` (columns that tell rows apart), repeats kept.

    It is a folder of text files with an id in each line, written side by side from ranges of the order. The files one behind the other, by
    name, are the JSON document ``{"key": …, "ids": […]}``.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    quoted = F.expr("substring(line, 2, length(line) - 2)")
    dealt = cut_lineage(
        ids.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(F.to_json(F.array(F.col("id").cast("string")), {"ignoreNullFields": "false"}).alias("line"))
        .select(F.spark_partition_id().alias("part"), quoted.alias("line"))
    )
    found = dealt.agg(F.min("part"), F.max("part")).first()
    head = json.dumps({"key": key or HASH_KEY})[:-1] + ', "ids": ['
    if found[0] is None:
        lines = ids.sparkSession.createDataFrame([(head,), ("]}",)], "value STRING").coalesce(1)
    else:
        lines = dealt.mapInArrow(_manifest_lines(found[0], found[1], head), "value STRING")
    return write_text(lines, path, overwrite)


def _manifest_lines(first: int, last: int, head: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = None, ""
        for batch in batches:
            lines = batch.column("line").to_pylist()
            if not lines:
                continue
            if part is None:
                part = batch.column("part")[0].as_py()
                if part == first:
                    yield pa.RecordBatch.from_arrays([pa.array([head, lines.pop(0)])], names=["value"])
            yield pa.RecordBatch.from_arrays([pa.array(["," + line for line in lines], pa.string())], names=["value"])
        if part == last:
            yield pa.RecordBatch.from_arrays([pa.array(["]}"])], names=["value"])

    return run


def read_ordered_manifest(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """Key name and the table (id, place) of a manifest of ``write_ordered_manifest``. Its lines are read side by side; places follow the order."""
    lines = spark.read.text(path)
    head = lines.filter(F.col("value").startswith("{")).first()[0]
    numbered = with_line_numbers(lines, place=True).filter(F.col("value").rlike('^,?(null$|")'))
    id_ = F.from_json(F.concat(F.lit("["), F.ltrim("value", F.lit(",")), F.lit("]")), "array<string>")[0]
    # The head is the first line.
    return json.loads(head + "]}")["key"], numbered.select(id_.alias("id"), (F.col("place") - 1).alias("place"))


def manifest_rows(ids: DataFrame, key: str | None) -> DataFrame:
    return ids.select(F.lit(key or HASH_KEY).alias("key"), F.col("id").cast("string").alias("id"))


def write_manifest_table(
    ids: DataFrame, path: str, key: str | None, overwrite: bool = False, fmt: str = "parquet"
) -> bool:
    """Ids of any number as rows ``(key, id)``."""
    write = write_parquet if fmt == "parquet" else write_jsonl
    return write(manifest_rows(ids, key), path, overwrite=overwrite)


def read_manifest_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema("key STRING, id STRING")
    return reader.parquet(path) if fmt == "parquet" else reader.json(path)


def write_manifest(
    ids: DataFrame, path: str, key: str | None, overwrite: bool = False, max_ids: int = 1_000_000
) -> bool:
    """One manifest document. It is built in one task, so more than ``max_ids`` ids are refused."""
    found = ids.count()
    if found > max_ids:
        raise ValueError(f"{found} ids are too many for one document; write a manifest table")
    document = ids.agg(
        F.lit(key or HASH_KEY).alias("key"),
        F.collect_list(F.col("id").cast("string")).alias("ids"),
    )
    return write_jsonl(document, path, overwrite=overwrite)

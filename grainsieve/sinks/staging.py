"""Outputs that appear whole: they are written beside their place and renamed when they are complete."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrameWriter, SparkSession

from grainsieve.sources.paths import child_names

CODEC_CONF = "spark.sql.parquet.compression.codec"

# Fixed value: of Parquet output, where the session names no codec. A third smaller than Spark's own choice on tokens, and as fast.
CODEC = "zstd"

# Renames that are under way at once.
_AT_ONCE = 16

_STAGING = "_staging-"
_FORMER = "_former-"


def compressed(spark: SparkSession, writer: DataFrameWriter, fmt: str) -> DataFrameWriter:
    """``writer`` with the codec of Parquet output; other formats stay plain."""
    return writer.option("compression", spark.conf.get(CODEC_CONF, CODEC)) if fmt == "parquet" else writer


class Store:
    """Renaming and deleting on whatever store Spark writes to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def rename(self, source: str, target: str) -> None:
        if not self._system.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be renamed to {target}")

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def make(self, path: str) -> None:
        self._system.mkdirs(self._path(path))

    def children(self, path: str) -> list[str]:
        """Names directly below ``path``, hidden ones too."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._system.listStatus(self._path(path)))


def _beside(path: str, mark: str) -> str:
    """A name next to ``path`` that readers of its parent pass over."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{mark}{name}" if parent else f"{mark}{name}"


def recover(spark: SparkSession, path: str) -> None:
    """Put back the former ``path`` if a driver died after it was moved away and before the new one was in its place."""
    store, former = Store(spark, path), _beside(path, _FORMER)
    if store.exists(former):
        if store.exists(path):
            store.delete(former)
        else:
            store.rename(former, path)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path``, then put it in its place.

    The former ``path`` stays readable until the new one is complete, and for good if ``write`` fails. It may be what ``write`` reads.
    """
    recover(spark, path)
    store = Store(spark, path)
    staging, former = f"{_beside(path, _STAGING)}-{uuid.uuid4().hex}", _beside(path, _FORMER)
    try:
        write(staging)
    except BaseException:
        store.delete(staging)
        raise
    if store.exists(path):
        store.rename(path.rstrip("/"), former)
    try:
        store.rename(staging, path.rstrip("/"))
    except BaseException:
        recover(spark, path)
        raise
    store.delete(former)


def publish(spark: SparkSession, moves: list[tuple[str, str]], trash: str) -> None:
    """Rename each source to its target, several at a time. A target that exists goes to the folder ``trash`` first."""
    if not moves:
        return
    store = Store(spark, moves[0][1])

    def move(one: tuple[int, tuple[str, str]]) -> None:
        number, (source, target) = one
        if store.exists(target):
            store.make(trash)
            store.rename(target, f"{trash}/{number}")
        store.rename(source, target)

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        list(pool.map(move, enumerate(moves)))


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names below ``folder`` but for marks and hidden files."""
    return [name for name in child_names(spark, folder) if not name.startswith(("_", "."))]

"""Finding input files through the Hadoop file system API, on any store Spark reads."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import SparkSession

logger = logging.getLogger(__name__)

# Split names, and the words that mark their files.
SPLIT_MARKS = {"train": "train", "validation": "valid", "test": "test"}

# Input formats and their file extensions.
EXTENSIONS = {"parquet": "parquet", "jsonl": "jsonl", "pandas-jsonl": "jsonl"}

# Spark names JSON lines so; its files are taken where a folder has none with the extension itself.
_OTHER_NAMES = {"jsonl": "json"}


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in system.globStatus(path) or ())


def _status(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(path) if system.exists(path) else None


def child_names(spark: SparkSession, directory: str) -> list[str]:
    """Names directly below ``directory``; empty if it does not exist."""
    return [path.rsplit("/", 1)[-1] for path in _glob(spark, f"{directory.rstrip('/')}/*")]


def file_sizes(spark: SparkSession, paths: Iterable[str]) -> list[tuple[str, int]]:
    """Path and bytes of every file that ``paths`` (files, folders or patterns) stand for, folders taken whole but for hidden files."""
    found = []
    for name in paths:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(name)
        system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.globStatus(pattern) or ():
            if status.isFile():
                found.append((status.getPath().toString(), status.getLen()))
                continue
            files = system.listFiles(status.getPath(), True)
            while files.hasNext():
                one = files.next()
                if not one.getPath().getName().startswith(("_", ".")):
                    found.append((one.getPath().toString(), one.getLen()))
    return found


def input_paths(
    spark: SparkSession, paths: Iterable[str], extension: str = "parquet"
) -> list[str]:
    """Paths for a Spark reader: a missing one is skipped with a warning, a file stands for itself.

    A directory becomes the glob of the files with ``extension`` directly in it. If it
    has none but ``column=value`` folders, it is a partitioned table and taken whole.
    """
    found = []
    for name in paths:
        status = _status(spark, name)
        if status is None:
            logger.warning("%s not found and skipped", name)
        elif not status.isDirectory():
            found.append(name)
        else:
            directory = name.rstrip("/")
            names = [extension, *_OTHER_NAMES.get(extension, "").split()]
            present = next((n for n in names if _glob(spark, f"{directory}/*.{n}")), None)
            if present:
                found.append(f"{directory}/*.{present}")
            elif _glob(spark, f"{directory}/*=*"):
                found.append(directory)
    return found


def _split_folders(spark: SparkSession, directory: str, extension: str) -> dict[str, list[str]]:
    """Files of the ``split=`` folders that our writers make; empty without any. Train must have some."""
    names = [extension, *_OTHER_NAMES.get(extension, "").split()]
    found = {}
    for split in SPLIT_MARKS:
        files = [path for n in names for path in _glob(spark, f"{directory}/split={split}/*.{n}")]
        if files:
            found[split] = files
    if found and "train" not in found:
        raise ValueError(f"{directory} has split folders, but none for train")
    return found


def split_files(
    spark: SparkSession, directory: str, extension: str = "jsonl", single: bool = False
) -> dict[str, list[str]]:
    """Files of each split, told by their names. A train file is required.

    Splits may have many files; ``single`` allows one each. A name with the marks of two splits is an error. A folder
    that a writer has divided into ``split=`` folders is taken as that.
    """
    by_split = {}
    owner: dict[str, str] = {}
    folders = _split_folders(spark, directory.rstrip("/"), extension)
    if folders:
        return folders
    for split, mark in SPLIT_MARKS.items():
        files = [
            path
            for path in _glob(spark, f"{directory.rstrip('/')}/*{mark}*")
            if path.endswith(f".{extension}")
        ]
        for path in files:
            if owner.setdefault(path, split) != split:
                raise ValueError(f"{path} names both {owner[path]} and {split}")
        if single and len(files) > 1:
            raise ValueError(f"{directory}: one {split} file expected, not {len(files)}")
        if files:
            by_split[split] = files
    if "train" not in by_split:
        raise ValueError(f"{directory} has no file of the train split")
    return by_split

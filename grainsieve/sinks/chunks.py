"""Output in chunks that are finished one after the other, so that a job that died goes on where it stopped.

A chunk is a fixed range of the input files, in the order of their paths. Its id, made from the paths and sizes of its files, names its folder
``chunk=…`` of the output, which appears whole when the chunk is done. The folders are the ledger: files of chunks that are
there already leave the list of paths before anything is read.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from grainsieve.functions.text import parse_size
from grainsieve.sinks.staging import Store, replace
from grainsieve.sources.paths import file_sizes

logger = logging.getLogger(__name__)

# Input bytes of a chunk: enough to keep a cluster busy, little enough to be done again.
CHUNK_BYTES = "256G"

FOLDER = "chunk="


@dataclass(frozen=True)
class Chunk:
    """Input files that become one folder."""

    number: int
    files: tuple[str, ...]
    digest: str

    @property
    def name(self) -> str:
        return f"{self.number:05d}-{self.digest}"


def plan_chunks(spark: SparkSession, files: list[str], chunk_bytes: int | str = CHUNK_BYTES) -> list[Chunk]:
    """The files in order of their paths, cut where a chunk would outgrow ``chunk_bytes``; a larger file is a chunk by itself.

    Files are not divided. New files behind all others leave the chunks before them, but for the last, as they are.
    """
    most = parse_size(chunk_bytes)
    groups: list[list[tuple[str, int]]] = []
    held = 0
    for path, size in sorted(file_sizes(spark, files)):
        if not groups or held + size > most:
            groups.append([])
            held = 0
        groups[-1].append((path, size))
        held += size
    return [
        Chunk(i, tuple(path for path, _ in group), hashlib.sha256(repr(group).encode()).hexdigest()[:16])
        for i, group in enumerate(groups)
    ]


def finished_chunks(spark: SparkSession, path: str) -> set[str]:
    """Names of the chunks that ``path`` holds whole."""
    return {name.removeprefix(FOLDER) for name in Store(spark, path).children(path) if name.startswith(FOLDER)}


def write_chunks(
    spark: SparkSession,
    chunks: list[Chunk],
    path: str,
    read: Callable[[tuple[str, ...]], DataFrame],
    write: Callable[[DataFrame, str], object],
    overwrite: bool = False,
) -> list[str]:
    """Write every chunk that ``path`` lacks, each as a job of its own; gives the names of those written.

    ``read`` makes the rows of a chunk from its files, ``write`` stores them in a new folder. A folder that belongs to no
    chunk means that the input has changed: that is an error unless ``overwrite``, which writes all chunks anew and removes such folders
    when they are done.
    """
    done = finished_chunks(spark, path)
    strange = done - {chunk.name for chunk in chunks}
    if strange and not overwrite:
        raise FileExistsError(f"{path} holds chunks of another input, such as {min(strange)}; pass overwrite=True to replace them")
    written = []
    for chunk in chunks:
        if chunk.name in done and not overwrite:
            logger.error("%s of %s is finished and stays as it is", chunk.name, path)
            continue
        folder = f"{path.rstrip('/')}/{FOLDER}{chunk.name}"
        replace(spark, folder, lambda staging, files=chunk.files: write(read(files), staging))
        written.append(chunk.name)
    store = Store(spark, path)
    for name in strange:
        store.delete(f"{path.rstrip('/')}/{FOLDER}{name}")
    return written

"""Rows packed into compressed blobs and dealt out as blocks of bounded size.

A block holds whole rows, so work that needs many texts side by side runs once per block, and what it
looks up elsewhere comes to it by a shuffle keyed by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 64 << 20
BLOB_BYTES = 4 << 20

SCHEMA = "block int, name long, data binary"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of about ``BLOB_BYTES``; a single larger row is a part of its own."""
    if not batch.num_rows:
        return
    pieces = max(1, min(batch.num_rows, batch.nbytes // BLOB_BYTES))
    step = -(-batch.num_rows // pieces)
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        if part.num_rows > 1 and part.nbytes > 4 * BLOB_BYTES:
            half = part.num_rows // 2
            yield from _slices(part.slice(0, half))
            yield from _slices(part.slice(half))
        else:
            yield part


def block_count(docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks that all texts fill, from one pass over their lengths."""
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    return max(1, -(-total // block_bytes))


def packed(rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` as (block, name, data): parts of each Arrow batch, as zstd streams, dealt over ``blocks``.

    ``name`` tells a blob from all others; a task that runs again makes the same ones.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get().partitionId(), 0
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            for part in _slices(batch):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                    writer.write_batch(part)
                data = sink.getvalue().to_pybytes()
                name = xxhash.xxh64_intdigest(f"{task} {count}".encode() + data) >> 1
                count += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name % blocks], pa.int32()),
                        pa.array([name], pa.int64()),
                        pa.array([data], pa.binary()),
                    ],
                    names=["block", "name", "data"],
                )

    return rows.mapInArrow(pack, SCHEMA)


def blobs(table: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    """(name, rows) of each blob of a block, in the order of names."""
    names = table.column("name").to_pylist()
    data = table.column("data")
    for i in sorted(range(len(names)), key=names.__getitem__):
        yield names[i], pa.ipc.open_stream(data[i].as_buffer()).read_all()

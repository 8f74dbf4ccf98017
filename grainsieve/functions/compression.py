"""Deflate ratio: the one text measure Spark has no function for."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Batches up to so many bytes are searched for equal texts: those of short texts, which repeat.
REPEAT_BYTES = 4 * 1024 * 1024

# Different texts of such batches whose sizes a task keeps for the next ones, and the longest of them.
KEPT_TEXTS = 100_000
KEPT_LENGTH = 64


def _deflated(value: pa.BinaryScalar) -> int | None:
    data = value.as_buffer()
    return None if data is None else len(zlib.compress(data, level=9))


def _sizes_of_different(values: pa.Array, known: dict[bytes, int]) -> pa.Array:
    """Each different text is deflated once; ``known`` has the sizes of short ones of earlier batches."""
    coded = values.dictionary_encode()
    sizes = []
    for data in coded.dictionary.to_pylist():
        size = known.get(data)
        if size is None:
            size = len(zlib.compress(data, level=9))
            if len(data) <= KEPT_LENGTH:
                if len(known) >= KEPT_TEXTS:
                    known.clear()
                known[data] = size
        sizes.append(size)
    return pa.array(sizes, pa.int64()).take(coded.indices)


def deflated_size(text: Column) -> Column:
    """Bytes of the zlib stream (level 9) of the whole UTF-8 text."""

    def sizes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[bytes, int] = {}
        for texts in batches:
            values = texts.cast(pa.binary())
            if values.nbytes <= REPEAT_BYTES:
                yield _sizes_of_different(values, known)
            else:
                yield pa.array(map(_deflated, values), pa.int64())

    return F.arrow_udf(sizes, "bigint")(text)


def compression_ratio(text: Column) -> Column:
    """Deflated bytes per byte; NULL for an empty text."""
    return deflated_size(text) / F.nullif(F.octet_length(text), F.lit(0))


def compression_score(text: Column, length_factor: float = 0.0) -> Column:
    """The ratio plus ``length_factor`` times the logarithm of the byte length."""
    ratio = compression_ratio(text)
    if not length_factor:
        return ratio
    size = F.nullif(F.octet_length(text), F.lit(0))
    return ratio + F.lit(float(length_factor)) * F.ln(size)

"""A broadcast Bloom filter: which rows surely have a value that is not listed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainsieve.plans.durable import cut_lineage

# Bits of a block (fixed by Spark's bitmap functions), bits for each listed value, and most of them: 128 MiB.
BLOCK_BITS = 32_768
BITS_PER_VALUE = 10
MOST_BITS = 1 << 30
MOST_HASHES = 7

_PLAIN = (1 << 31) - 1


def _places(value: Column, blocks: int, hashes: int) -> tuple[Column, list[Column]]:
    """The block of a value, and its bits there."""
    block = F.pmod(F.xxhash64(value), F.lit(blocks))
    first = F.xxhash64(F.lit(1), value).bitwiseAND(F.lit(_PLAIN))
    step = F.xxhash64(F.lit(2), value).bitwiseAND(F.lit(_PLAIN))
    return block, [F.pmod(first + F.lit(i) * step, F.lit(BLOCK_BITS)) for i in range(hashes)]


def with_chance(df: DataFrame, listed: DataFrame, column: str, name: str = "__maybe") -> DataFrame:
    """Add ``name``: false only for rows whose ``column`` is surely not in the column of that name of ``listed``.

    Every value sets several bits of one block. At ten bits a value fewer than two in a hundred others pass. The table has a fixed bound,
    beyond which there are fewer bits for each value and more pass. Null is never listed.
    """
    listed = listed.filter(F.col(column).isNotNull())
    count = max(1, listed.count())
    bits = max(BLOCK_BITS, min(MOST_BITS, count * BITS_PER_VALUE))
    blocks, hashes = -(-bits // BLOCK_BITS), max(1, min(MOST_HASHES, round(0.69 * bits / count)))
    block, places = _places(F.col(column), blocks, hashes)
    table = (
        listed.select(block.alias("__block"), F.explode(F.array(*places)).alias("__at"))
        .groupBy("__block")
        .agg(F.bitmap_construct_agg("__at").alias("__bits"))
    )
    marked = df.withColumn("__own", block).join(
        F.broadcast(cut_lineage(table)), F.col("__own") == F.col("__block"), "left"
    )

    def is_set(at: Column) -> Column:
        byte = F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1

    hit = F.col(column).isNotNull() & reduce(Column.__and__, map(is_set, places))
    return marked.select(*(F.col(f"`{c}`") for c in df.columns), F.coalesce(hit, F.lit(False)).alias(name))

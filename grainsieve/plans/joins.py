"""Attaching a lookup table to a large table without moving or skewing the large one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainsieve.plans.bloom import with_chance
from grainsieve.plans.durable import cut_lineage

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024

# A key with more rows than this is not left to one task of a shuffled join.
HOT_ROWS = 100_000

_FIXED_WIDTH = 16
# Tasks that rows of a key are dealt over if it is hot, but one of too many such keys to broadcast.
WARM_SALTS = 16

_HIT = "__hit"
_HOT = "__hot"
_SALT = "__salt"
_WARM = "__warm"
_KEY = "__key_hash"
_COLD = -1


def fits_broadcast(
    side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``side`` (one aggregate over it) against the broadcast bound."""
    width: Column = F.lit(0)
    for field in side.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # As text, an entry is about as long as it is wide in memory.
            text = F.col(f"`{field.name}`").cast("string")
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
        width = width + F.lit(_FIXED_WIDTH)
    rows, size = side.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def _renamed(side: DataFrame, on: list[str], prefix: str) -> DataFrame:
    names = {name: f"{prefix}{name}" for name in [*on, *side.columns]}
    return side.select(*(F.col(name).alias(names[name]) for name in side.columns))


def _same_key(on: list[str], prefix: str) -> Column:
    return reduce(Column.__and__, (F.col(key).eqNullSafe(F.col(f"{prefix}{key}")) for key in on))


def _hot_keys(df: DataFrame, on: list[str], hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Keys with more than ``hot_rows`` rows: the largest, as many as may be broadcast, and the hashes of the others, if there are any.

    Rows are counted before the shuffle, so no task sees them all.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    every = hot = cut_lineage(counts.filter(F.col("__rows") > hot_rows))
    limit = hot_rows
    while not fits_broadcast(hot):
        limit *= 10
        hot = every.filter(F.col("__rows") > limit)
    if limit == hot_rows:
        return hot.drop("__rows"), None
    warm = every.filter(F.col("__rows") <= limit).select(F.xxhash64(*on).alias(_KEY)).distinct()
    return hot.drop("__rows"), cut_lineage(warm)


def _with_warm(df: DataFrame, on: list[str], warm: DataFrame | None) -> DataFrame:
    """Add ``__warm``: whether a row's key may be among the hashes ``warm``. Rows of one key agree, in whichever table they are."""
    if warm is None:
        return df.withColumn(_WARM, F.lit(False))
    return with_chance(df.withColumn(_KEY, F.xxhash64(*on)), warm, _KEY, _WARM).drop(_KEY)


def _attach_shuffled(df: DataFrame, side: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    """Left join beyond the broadcast bound: hot keys by broadcast, all others by shuffle.

    Rows with a hot key already have their match when they are shuffled. They go to the task their input
    partition's number hashes to, which spreads a key over all tasks and is the same if a task is
    run again. Where more keys are hot than can be broadcast, a Bloom filter tells the rest: their rows are dealt over ``WARM_SALTS`` tasks, and
    what they match is sent to each of these.
    """
    payload = [name for name in side.columns if name not in on]
    hot, warm = _hot_keys(df.select(*on), on, hot_rows)
    found = side.join(F.broadcast(_renamed(hot, on, "__k_")), _same_key(on, "__k_"), "left_semi")
    hot = hot.join(_renamed(found, on, "__f_"), _same_key(on, "__f_"), "left").select(
        *(F.col(key).alias(f"__h_{key}") for key in on),
        *(F.col(f"__f_{name}").alias(f"__h_{name}") for name in payload),
        F.lit(True).alias(_HOT),
    )
    dealt = F.when(F.col(_HOT), F.spark_partition_id())
    if warm is not None:
        dealt = dealt.when(F.col(_WARM), F.pmod(F.spark_partition_id(), F.lit(WARM_SALTS)))
    marked = _with_warm(df, on, warm).join(
        F.broadcast(cut_lineage(hot)), _same_key(on, "__h_"), "left"
    ).withColumn(_SALT, dealt.otherwise(F.lit(_COLD)))
    # Always _COLD. A plain literal would be taken out of the join key, and with it the salt.
    cold_salt = F.least(F.spark_partition_id(), F.lit(_COLD))
    if warm is None:
        cold = _renamed(side, on, "__c_").withColumn("__c_salt", cold_salt)
    else:
        salts = F.when(F.col(_WARM), F.sequence(F.lit(0), F.lit(WARM_SALTS - 1))).otherwise(F.array(cold_salt))
        copies = _with_warm(side, on, warm).withColumn("__salts", salts)
        cold = copies.select(
            *(F.col(name).alias(f"__c_{name}") for name in side.columns), F.explode("__salts").alias("__c_salt")
        )
    joined = marked.join(
        cold, _same_key(on, "__c_") & (F.col(_SALT) == F.col("__c_salt")), "left"
    )
    return joined.select(
        *(F.col(f"`{name}`") for name in df.columns),
        *(
            F.when(F.col(_HOT), F.col(f"__h_{name}")).otherwise(F.col(f"__c_{name}")).alias(name)
            for name in payload
        ),
    )


def attach(
    df: DataFrame,
    side: DataFrame,
    on: list[str],
    how: str = "left",
    *,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``side`` (unique on ``on``, cheap to read again) to ``df``, null keys matching.

    A side inside the measured bound is broadcast, so ``df`` is not shuffled at all. Beyond it both are
    shuffled, and keys with many rows are taken out first.
    """
    if how not in {"left", "inner"}:
        raise ValueError(f"how must be left or inner, not {how}")
    if fits_broadcast(side, max_rows, max_bytes):
        joined = df.join(F.broadcast(_renamed(side, on, "__k_")), _same_key(on, "__k_"), how)
        payload = [name for name in side.columns if name not in on]
        return joined.select(
            *(F.col(f"`{name}`") for name in df.columns),
            *(F.col(f"__k_{name}").alias(name) for name in payload),
        )
    if how == "left":
        return _attach_shuffled(df, side, on, hot_rows)
    hits = _attach_shuffled(df, side.withColumn(_HIT, F.lit(True)), on, hot_rows)
    return hits.filter(F.col(_HIT)).drop(_HIT)

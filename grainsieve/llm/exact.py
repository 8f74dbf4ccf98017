"""Exact duplicates by distributed radix partitioning, most significant bytes first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach

# Bytes of the first pass; every later one reads eight times as many.
FIRST_BYTES = 64
WIDEN = 8
# Bound of a broadcast table of groups; larger ones are joined by shuffle.
BROADCAST_BYTES = 16 << 20

# Passes that tell their groups apart; far more than any text has digits for.
_PASSES = 32

_KEY = ["__group", "__digits"]


def _digits(start: int, count: int) -> Column:
    """Bytes ``start`` to ``start`` + ``count`` of a text; empty behind its end."""
    return F.substring(F.col("__bytes"), start + 1, count)


def _split(rows: DataFrame, number: int) -> DataFrame:
    """``rows`` with ``__new``, the number of the group in pass ``number``; null for a row that shares its digits with none.

    Groups are counted before the shuffle; hot ones are matched by broadcast, so a group of any size may
    lie in any number of tasks.
    """
    counts = rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("__n"))
    fresh = F.monotonically_increasing_id() * _PASSES + number
    shared = cut_lineage(counts.filter(F.col("__n") > 1).select(*_KEY, fresh.alias("__new")))
    return attach(rows, shared, _KEY, "left", max_bytes=BROADCAST_BYTES)


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without ``text_col``, with ``__uid`` (of the row) and ``__group`` (null for a text without copy).

    The digits of a text are its length and then its UTF-8 bytes. Each pass splits every group by the next bytes; a group
    with one row left, or whose texts have ended, is finished. Bytes are compared themselves: no digest decides.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    named = docs.withColumn("__bytes", text.cast("binary")).drop(text_col)
    named = named.withColumn("__group", F.octet_length("__bytes").cast("long"))
    first = _split(named.withColumn("__digits", _digits(0, FIRST_BYTES)), 0)
    copies = F.col("__new").isNotNull()
    # The text itself goes along for rows that may have a copy; all others are finished.
    state = cut_lineage(
        first.withColumn("__uid", F.monotonically_increasing_id())
        .withColumn("__length", F.col("__group"))
        .withColumn("__group", F.when(copies, F.col("__new")))
        .withColumn("__bytes", F.when(copies & (F.col("__length") > FIRST_BYTES), F.col("__bytes")))
        .drop("__digits", "__new")
    )
    found = state.select("__uid", "__length", "__group", "__bytes").filter(F.col("__group").isNotNull())
    finished = found.filter(F.col("__length") <= FIRST_BYTES).select("__uid", "__group")
    open_rows = found.filter(F.col("__length") > FIRST_BYTES)
    longest = open_rows.agg(F.max("__length")).first()[0] or 0
    done, width, number = FIRST_BYTES, FIRST_BYTES * WIDEN, 1
    while done < longest:
        split = _split(open_rows.withColumn("__digits", _digits(done, width)), number)
        done, width, number = done + width, width * WIDEN, number + 1
        alive = split.filter(F.col("__new").isNotNull()).withColumn("__group", F.col("__new"))
        if done < longest:
            alive = cut_lineage(alive.select("__uid", "__length", "__group", "__bytes"))
        ended = alive.filter(F.col("__length") <= done).select("__uid", "__group")
        finished = finished.unionByName(ended)
        open_rows = alive.filter(F.col("__length") > done)
    finished = cut_lineage(finished)
    return attach(state.drop("__group", "__bytes", "__length"), finished, ["__uid"])


def _ranked_groups(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their groups, and (__group, size, best) of each group of copies."""
    grouped = exact_groups(docs, id_col=id_col, text_col=text_col)
    best = F.max(F.struct(F.col(f"`{id_col}`").alias("id"), F.col("__uid").alias("uid")))
    groups = grouped.filter(F.col("__group").isNotNull()).groupBy("__group").agg(
        best.alias("__best"), F.count(F.lit(1)).alias("__size")
    )
    return grouped, cut_lineage(groups)


def duplicate_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Null texts count as empty. Of equal texts the row with the largest id stays; among rows with that id one does. A null id is
    smaller than any other. An empty table gives no rows.
    """
    sha = F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), 256)
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), sha.alias("text_sha256"))
    grouped, groups = _ranked_groups(slim, "doc_id", "text")
    return attach(grouped, groups, ["__group"]).select(
        "doc_id",
        F.when(F.col("__group").isNull(), F.col("doc_id")).otherwise(F.col("__best.id")).alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("__best.uid") == F.col("__uid"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without exact copies: of each group the row that ``duplicate_report`` keeps."""
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("__row"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
    )
    grouped, groups = _ranked_groups(rows, "doc_id", "text")
    joined = attach(grouped, groups, ["__group"])
    kept = joined.filter(F.coalesce(F.col("__best.uid") == F.col("__uid"), F.lit(True)))
    return kept.select("__row.*")

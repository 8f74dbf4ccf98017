"""Sharding by balanced label propagation: linked documents move together while shards stay even."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainsieve.llm.numbering import numbered
from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach


def _quota(total: int, shards: int) -> list[int]:
    """Rows of each shard: at most one apart."""
    return [total // shards + (shard < total % shards) for shard in range(shards)]


def _per_shard(df: DataFrame, shards: int) -> list[int]:
    """Rows in each shard: one row per shard comes to the driver."""
    found = {row[0]: row[1] for row in df.groupBy("shard").agg(F.count(F.lit(1))).collect()}
    return [found.get(shard, 0) for shard in range(shards)]


def _pair_quotas(wishes: dict[tuple[int, int], int], room: list[int]) -> list[tuple[int, int, int]]:
    """(from, to, rows) that may move between shards: swaps, which change no size, and what each shard has room for."""
    rest, quotas = {}, []
    for (source, to), n in wishes.items():
        swapped = min(n, wishes.get((to, source), 0))
        rest[source, to] = n - swapped
        quotas.append([source, to, swapped])
    asked = [0] * len(room)
    for (_, to), n in rest.items():
        asked[to] += n
    for quota in sorted(quotas, key=lambda q: -rest[q[0], q[1]]):
        source, to, _ = quota
        wanted = rest[source, to]
        given = min(wanted, -(-room[to] * wanted // asked[to])) if asked[to] else 0
        room[to] -= given
        asked[to] -= wanted
        quota[2] += given
    return [tuple(quota) for quota in quotas if quota[2]]


def _home(place: Column, linked: int, total: int, shards: int) -> Column:
    """The shard of linked row number ``place`` if these rows, in order, take of every shard the same share of its rows."""
    base, extra = divmod(total, shards)
    spread = F.floor(place * F.lit(total).cast("decimal(20,0)") / F.lit(linked))
    edge = extra * (base + 1)
    first = F.floor(spread / F.lit(base + 1))
    return (F.when(spread < edge, first).otherwise(extra + F.floor((spread - edge) / F.lit(base))) if base else first).cast("int")


def _propagate(linked: DataFrame, caps: list[int], rounds: int | None) -> DataFrame:
    """``linked`` (uid, hub, shard) after rounds in which rows move to where most of their hub is, until no round moves any.

    The counts of wished moves per pair of shards set the quotas, so that no shard ever outgrows its own; within a pair the
    rows with the largest pull go first, those of a hub together. Every move adds a row to the fullest shard of its hub and so lowers the
    cut: the rounds end by themselves.
    """
    spark = linked.sparkSession
    done = 0
    while rounds is None or done < rounds:
        done += 1
        votes = linked.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
        # The fullest shard of a hub; of equally full ones, a hash of both decides, so that no shard is preferred.
        turn = F.xxhash64("hub", "shard")
        favourite = votes.groupBy("hub").agg(
            F.max(F.struct("n", turn.alias("turn"), "shard")).alias("best"), F.sum("n").alias("all")
        )
        scattered = favourite.filter(F.col("best.n") < F.col("all")).select(
            "hub", F.col("best.shard").alias("to"), F.col("best.n").alias("pull")
        )
        asking = cut_lineage(
            attach(linked, cut_lineage(scattered), ["hub"], "inner")
            .filter(F.col("shard") != F.col("to"))
            .select("uid", F.col("shard").alias("source"), "to", (-F.col("pull")).alias("last"), "hub")
        )
        wishes = {(r[0], r[1]): r[2] for r in asking.groupBy("source", "to").agg(F.count(F.lit(1))).collect()}
        room = [cap - used for cap, used in zip(caps, _per_shard(linked, len(caps)))]
        quotas = _pair_quotas(wishes, room)
        if not quotas:
            break
        ranked = numbered(asking, ["source", "to"], ["last", "hub", "uid"], "place")
        allowed = spark.createDataFrame(quotas, "source int, to int, quota long")
        moves = cut_lineage(
            attach(ranked, allowed, ["source", "to"], "inner").filter(F.col("place") < F.col("quota")).select("uid", "to")
        )
        linked = cut_lineage(
            attach(linked, moves, ["uid"]).select("uid", "hub", F.coalesce("to", "shard").alias("shard"))
        )
    return linked


def shard_documents(
    docs: DataFrame,
    shards: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    link: Column | None = None,
    rounds: int | None = None,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document.

    Documents with the same ``link`` (default: the same text) are linked and moved into one shard; groups too large
    for half a shard are linked in parts that fit. Groups start whole, side by side, so that only those at the edge of a shard are divided, and
    rows move until no shard has room for what would lower the cut (or for ``rounds``). All shards get the same number of rows, but for one. ``size`` is
    the text's UTF-8 bytes plus 16; a null text has none and is linked to no other. ``slot`` counts a shard's rows from 0. Texts are
    read once; an empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text = F.col(f"`{text_col}`").cast("string")
    rows = cut_lineage(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.sha2(link.cast("string") if link is not None else text, 256).alias("hub"),
        )
    )
    total = rows.count()
    caps = _quota(total, shards)
    groups = rows.filter(F.col("hub").isNotNull()).groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    shared = cut_lineage(groups.filter(F.col("n") > 1))
    linked = attach(rows.select("uid", "hub"), shared.select("hub"), ["hub"], "inner")
    part = max(1, -(-(total // shards) // 2))
    chunked = numbered(linked, ["hub"], ["uid"], "place").select(
        "uid", F.xxhash64("hub", F.floor(F.col("place") / part)).alias("hub")
    )
    chunked = cut_lineage(chunked)
    start = numbered(chunked, [], ["hub", "uid"], "place").select(
        "uid", "hub", _home(F.col("place"), max(1, chunked.count()), total, shards).alias("shard")
    )
    settled = _propagate(cut_lineage(start), caps, rounds)
    taken = _per_shard(settled, shards)
    # All others fill what room is left, shard after shard.
    placed = cut_lineage(attach(rows.drop("hub"), settled.select("uid", "shard"), ["uid"]))
    free = numbered(
        placed.filter(F.col("shard").isNull()).withColumn("draw", F.xxhash64("uid")), [], ["draw", "uid"], "place"
    )
    filled, edge = F.lit(shards - 1), sum(caps) - sum(taken)
    for shard in range(shards - 1, -1, -1):
        filled = F.when(F.col("place") < edge, shard).otherwise(filled)
        edge -= caps[shard] - taken[shard]
    columns = ["uid", "doc_id", "size", "text_crc32"]
    everything = placed.filter(F.col("shard").isNotNull()).select(*columns, "shard").unionByName(
        free.select(*columns, filled.cast("int").alias("shard"))
    )
    return numbered(everything, ["shard"], ["uid"], "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )

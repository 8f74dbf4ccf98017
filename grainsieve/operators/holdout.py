"""Holding out validation rows: a fixed number per shard, or up to a token budget.

A row's place in its shard is the order of sha-256 over seed and row id, so the choice does not depend on
how the table is partitioned. The texts are never shuffled: narrow passes count rows per shard and
hash bucket until the bucket the n-th hash falls into is small, a last one ranks the rows of that
bucket, and the full rows are then compared with one cut-off hash per shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainsieve.functions.text import parse_size
from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach
from grainsieve.plans.prefix import sum_of_earlier

TRAIN = "train"
VALIDATION = "validation"

# Fixed value: tokens one document is taken to have when a budget is turned into a row count.
TOKENS_PER_EXAMPLE = 500

# Rows of one shard that may be ranked together, and the hex digits a pass looks further.
RANK_ROWS = 100_000
PASS_DIGITS = 2
_MOST_DIGITS = 8

# Shards up to so many are listed in the plan of a budget sample, which keeps the others from being read.
PRUNED_SHARDS = 100_000

_PLACE = "__place"
_BUCKET = "__bucket"


def hash_place(seed: int, value: Column) -> Column:
    """Seeded pseudo-random order: 64 hex digits."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), value.cast("string")), 256)


def _placed(df: DataFrame, shard_col: str, id_col: str, seed: int, tokens: str | None) -> DataFrame:
    return df.select(
        F.col(shard_col).alias("shard"),
        hash_place(seed, F.col(id_col)).alias(_PLACE),
        (F.lit(0) if tokens is None else F.col(tokens)).cast("bigint").alias("tokens"),
    )


def _cut_buckets(counted: DataFrame, enough: Column) -> DataFrame:
    """Per shard the bucket its cut falls into, from at most 256 bucket counts.

    ``counted`` has what was held out before its first bucket. A shard without a cut keeps one row.
    """
    in_order = Window.partitionBy("shard").orderBy(_BUCKET)
    upto = counted.withColumns(
        {
            "rows_upto": F.col("rows_before") + F.sum("bucket_rows").over(in_order),
            "tokens_upto": F.col("tokens_before") + F.sum("bucket_tokens").over(in_order),
        }
    ).withColumns(
        {
            "rows_before": F.col("rows_upto") - F.col("bucket_rows"),
            "tokens_before": F.col("tokens_upto") - F.col("bucket_tokens"),
        }
    )
    cut = (
        enough
        & (F.col("rows_before") < F.col("held_rows"))
        & (F.col("held_rows") <= F.col("rows_upto"))
    )
    last = ~enough & (F.col("rows_upto") == F.col("rows"))
    return upto.filter(cut | last).select(
        "shard",
        F.when(enough, F.col(_BUCKET)).alias(_BUCKET),
        "rows",
        "tokens",
        "held_rows",
        "rows_before",
        "tokens_before",
        F.when(enough, F.col("bucket_rows")).otherwise(F.lit(0)).alias("bucket_rows"),
    )


def _rows_in_buckets(placed: DataFrame, bounds: DataFrame) -> DataFrame:
    rows = attach(placed.withColumnRenamed("tokens", "row_tokens"), bounds, on=["shard"], how="inner")
    return rows.filter(F.col(_PLACE).startswith(F.col(_BUCKET)))


def _first_buckets(placed: DataFrame) -> DataFrame:
    """Rows and tokens of each shard's buckets, from one pass over the table."""
    whole = Window.partitionBy("shard")
    return (
        placed.groupBy("shard", F.substring(_PLACE, 1, PASS_DIGITS).alias(_BUCKET))
        .agg(
            F.count(F.lit(1)).alias("bucket_rows"),
            F.coalesce(F.sum("tokens"), F.lit(0)).alias("bucket_tokens"),
        )
        .withColumns(
            {
                "rows": F.sum("bucket_rows").over(whole),
                "tokens": F.sum("bucket_tokens").over(whole),
                "rows_before": F.lit(0).cast("bigint"),
                "tokens_before": F.lit(0).cast("bigint"),
            }
        )
    )


def _small_buckets(
    placed: DataFrame, held: Column, rank_rows: int, first: DataFrame | None = None
) -> DataFrame:
    """Cut buckets of at most ``rank_rows`` rows. Only shards with a larger one are looked at again."""
    first = _first_buckets(placed) if first is None else first
    enough = (F.col("held_rows") > 0) & (F.col("held_rows") < F.col("rows"))
    digits = PASS_DIGITS
    bounds = cut_lineage(_cut_buckets(first.withColumn("held_rows", held), enough))
    large = F.col("bucket_rows") > rank_rows
    while digits < _MOST_DIGITS and not bounds.filter(large).isEmpty():
        digits += PASS_DIGITS
        finer = (
            _rows_in_buckets(placed, bounds.filter(large).drop("bucket_rows"))
            .withColumn(_BUCKET, F.substring(_PLACE, 1, digits))
            .groupBy("shard", _BUCKET, "rows", "tokens", "held_rows", "rows_before", "tokens_before")
            .agg(
                F.count(F.lit(1)).alias("bucket_rows"),
                F.coalesce(F.sum("row_tokens"), F.lit(0)).alias("bucket_tokens"),
            )
        )
        refined = _cut_buckets(finer, enough)
        bounds = cut_lineage(bounds.filter(~large).unionByName(refined))
    return bounds


def shard_cuts(
    df: DataFrame,
    n: int,
    shard_col: str,
    id_col: str,
    seed: int = 42,
    short: str = "error",
    tokens_col: str | None = None,
    rank_rows: int = RANK_ROWS,
    buckets: DataFrame | None = None,
) -> DataFrame:
    """Per shard: ``rows``, ``tokens``, ``held_rows``, ``held_tokens`` and the last held-out hash ``cut``.

    A shard with no more than ``n`` rows has no cut; with ``short="spare_one"`` all but one of its rows are
    held out instead. ``buckets`` are those of ``_first_buckets``, where they have been counted already.
    """
    placed = _placed(df, shard_col, id_col, seed, tokens_col)
    held = F.lit(n).cast("bigint")
    if short == "spare_one":
        held = F.least(held, F.col("rows") - 1)
    bounds = _small_buckets(placed, held, rank_rows, buckets)
    candidates = _rows_in_buckets(
        placed,
        bounds.filter(F.col(_BUCKET).isNotNull()).select(
            "shard", _BUCKET, "held_rows", "rows_before", "tokens_before"
        ),
    )
    upto = Window.partitionBy("shard").orderBy(_PLACE)
    ranked = (
        # Rows with the same id share a hash and are counted before they meet.
        candidates.groupBy("shard", _PLACE, "held_rows", "rows_before", "tokens_before")
        .agg(F.count(F.lit(1)).alias("same_place"), F.sum("row_tokens").alias("place_tokens"))
        .withColumns(
            {
                "taken": F.col("rows_before") + F.sum("same_place").over(upto),
                "held_tokens": F.col("tokens_before")
                + F.coalesce(F.sum("place_tokens").over(upto), F.lit(0)),
            }
        )
        .filter(
            (F.col("taken") >= F.col("held_rows"))
            & (F.col("taken") - F.col("same_place") < F.col("held_rows"))
        )
    )
    split_copies = F.raise_error(
        F.concat(
            F.lit(f"column {id_col} repeats within shard "),
            F.coalesce(F.col("shard").cast("string"), F.lit("NULL")),
            F.lit(": the cut would divide rows with the same id"),
        )
    ).cast("string")
    cuts = ranked.select(
        F.col("shard").alias("cut_shard"),
        F.when(F.col("taken") == F.col("held_rows"), F.col(_PLACE)).otherwise(split_copies).alias("cut"),
        "held_tokens",
    )
    joined = bounds.select("shard", "rows", "tokens", "held_rows").join(
        cuts, F.col("shard").eqNullSafe(F.col("cut_shard")), "left"
    )
    return cut_lineage(
        joined.select("shard", "rows", "tokens", "held_rows", "cut", "held_tokens")
    )


def _refuse_short(cuts: DataFrame, affected: Column, n: int) -> None:
    short = cuts.filter(affected & F.col("cut").isNull()).select("shard", "rows").limit(5).collect()
    if short:
        names = ", ".join(f"{row.shard} ({row.rows} rows)" for row in short)
        raise ValueError(f"cannot hold out {n} rows of shards that have no more: {names}")


def holdout_per_shard(
    df: DataFrame,
    n: int | str = 81,
    shard_col: str = "shard",
    id_col: str = "row_id",
    seed: int = 42,
    short: str = "error",
) -> DataFrame:
    """Add ``split``: in every shard exactly ``n`` pseudo-random rows are ``validation``, the rest ``train``.

    ``id_col`` must tell the rows of a shard apart; readers offer ``row_id``. A shard with no more than
    ``n`` rows is an error, or with ``short="spare_one"`` gives all rows but one.
    """
    n = parse_size(n)
    if n <= 0:
        raise ValueError(f"the number of held-out rows must be positive, not {n}")
    if short not in {"error", "spare_one"}:
        raise ValueError(f"short must be error or spare_one, not {short}")
    cuts = shard_cuts(df, n, shard_col, id_col, seed, short)
    if short == "error":
        _refuse_short(cuts, F.lit(True), n)
    columns = [name for name in df.columns if name != "split"]
    flagged = attach(
        df.withColumn("__shard", F.col(shard_col)),
        cuts.select(F.col("shard").alias("__shard"), "cut"),
        on=["__shard"],
    )
    held = hash_place(seed, F.col(id_col)) <= F.col("cut")
    split = F.when(held, F.lit(VALIDATION)).otherwise(F.lit(TRAIN))
    return flagged.select(*(F.col(f"`{c}`") for c in columns), split.alias("split"))


def budget_decisions(
    cuts: DataFrame, train_budget: int, valid_budget: int, seed: int = 42
) -> DataFrame:
    """Walk the shards in seeded order and mark which still feed validation and train.

    A shard feeds a side while that side's total over all earlier shards is below its budget, so a
    budget is overshot by at most one shard. A negative train budget has no limit.
    """
    ordered = cuts.withColumn("order", hash_place(seed, F.col("shard")))
    held = sum_of_earlier(
        ordered.withColumn("held", F.coalesce("held_tokens", F.lit(0))),
        "order",
        "held",
        "valid_before",
    )
    feeds_valid = held.withColumn("valid_active", F.col("valid_before") < F.lit(valid_budget))
    left = F.when(F.col("valid_active"), F.col("tokens") - F.col("held")).otherwise(F.col("tokens"))
    trained = sum_of_earlier(
        feeds_valid.withColumn("train_tokens", left), "order", "train_tokens", "train_before"
    )
    unlimited = F.lit(train_budget < 0)
    return trained.select(
        "shard",
        "order",
        "rows",
        "tokens",
        "cut",
        "held_tokens",
        "valid_active",
        (unlimited | (F.col("train_before") < F.lit(train_budget))).alias("train_active"),
    )


def _active_rows(df: DataFrame, decisions: DataFrame, shard_col: str) -> DataFrame:
    """``df`` without the shards past both budgets.

    A shard told by its path (``shard_path`` of the reader) is then a file that is not opened: Spark holds the condition against the
    paths before it plans the read.
    """
    feeds = F.col("valid_active") | F.col("train_active")
    found = decisions.agg(F.count_if(feeds), F.count_if(~feeds), F.count_if(feeds & F.col("shard").isNull())).first()
    if not found[1] or found[0] > PRUNED_SHARDS:
        return df
    names = [row[0] for row in decisions.filter(feeds).select("shard").collect() if row[0] is not None]
    wanted = F.col(shard_col).isin(*names) if names else F.lit(False)
    return df.filter(wanted | F.col(shard_col).isNull() if found[2] else wanted)


def sample_by_token_budget(
    df: DataFrame,
    train_tokens: int | str = -1,
    valid_tokens: int | str = "10M",
    shard_col: str = "shard",
    id_col: str = "row_id",
    seed: int = 42,
    tokens_per_example: int = TOKENS_PER_EXAMPLE,
    short: str = "error",
) -> DataFrame:
    """Rows that reach the train or validation side of a token budget, with their ``split``.

    ``df`` has ``num_tokens``. Every shard offers ``valid_tokens / tokens_per_example / shards`` rows for
    validation; shards past both budgets are left out, and not read again where ``shard_col`` comes from the path.
    """
    train_budget, valid_budget = parse_size(train_tokens), parse_size(valid_tokens)
    if valid_budget <= 0:
        raise ValueError(f"the validation budget must be positive, not {valid_budget}")
    # The buckets do not depend on how many rows are held out, so they also tell the number of shards.
    buckets = cut_lineage(_first_buckets(_placed(df, shard_col, id_col, seed, "num_tokens")))
    shards = buckets.select("shard").distinct().count()
    columns = [name for name in df.columns if name != "split"]
    if not shards:
        return df.withColumn("split", F.lit(TRAIN))
    n = int(valid_budget / tokens_per_example / shards)
    if n <= 0:
        raise ValueError(f"a budget of {valid_budget} tokens gives no row to each of {shards} shards")
    cuts = shard_cuts(df, n, shard_col, id_col, seed, short, "num_tokens", buckets=buckets)
    decisions = cut_lineage(budget_decisions(cuts, train_budget, valid_budget, seed))
    if short == "error":
        _refuse_short(decisions, F.col("valid_active"), n)
    flagged = attach(
        _active_rows(df, decisions, shard_col).withColumn("__shard", F.col(shard_col)),
        decisions.select(F.col("shard").alias("__shard"), "cut", "valid_active", "train_active"),
        on=["__shard"],
        how="inner",
    )
    held = F.col("valid_active") & F.coalesce(
        hash_place(seed, F.col(id_col)) <= F.col("cut"), F.lit(False)
    )
    split = F.when(held, F.lit(VALIDATION)).when(F.col("train_active"), F.lit(TRAIN))
    return flagged.select(*(F.col(f"`{c}`") for c in columns), split.alias("split")).filter(
        F.col("split").isNotNull()
    )

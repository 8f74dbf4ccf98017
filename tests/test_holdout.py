import random

import pytest
from pyspark.sql import functions as F

from grainsieve.operators import holdout
from grainsieve.operators.holdout import (
    TRAIN,
    VALIDATION,
    budget_decisions,
    hash_place,
    holdout_per_shard,
    sample_by_token_budget,
    shard_cuts,
)
from grainsieve.plans.prefix import sum_of_earlier


def rows(spark, sizes, partitions=3):
    data = [
        (f"s{shard}", f"{shard}-{i}", (i * 7 + shard) % 23)
        for shard, size in enumerate(sizes)
        for i in range(size)
    ]
    frame = spark.createDataFrame(data, "shard STRING, row_id STRING, num_tokens INT")
    return frame.repartition(partitions)


def by_split(frame):
    return {(row.row_id, row.split) for row in frame.collect()}


def test_exact_counts_and_complement(spark):
    frame = rows(spark, [9, 30, 5000])
    split = holdout_per_shard(frame, "4").cache()
    counts = {tuple(r) for r in split.groupBy("shard", "split").count().collect()}
    assert counts == {
        ("s0", VALIDATION, 4),
        ("s0", TRAIN, 5),
        ("s1", VALIDATION, 4),
        ("s1", TRAIN, 26),
        ("s2", VALIDATION, 4),
        ("s2", TRAIN, 4996),
    }
    assert split.drop("split").exceptAll(frame).isEmpty()
    assert split.columns == [*frame.columns, "split"]


def test_smallest_hashes_are_held_out(spark):
    frame = rows(spark, [3000, 40])
    held = holdout_per_shard(frame, 20).filter(F.col("split") == VALIDATION)
    placed = frame.select("shard", "row_id", hash_place(42, F.col("row_id")).alias("h")).collect()
    expected = set()
    for shard in ("s0", "s1"):
        inside = sorted((r.h, r.row_id) for r in placed if r.shard == shard)
        expected |= {row_id for _, row_id in inside[:20]}
    assert {row.row_id for row in held.collect()} == expected


def test_same_choice_for_any_partitioning_other_for_another_seed(spark):
    one, many = rows(spark, [50, 60], 1), rows(spark, [50, 60], 8)
    assert by_split(holdout_per_shard(one, 7)) == by_split(holdout_per_shard(many, 7))
    assert by_split(holdout_per_shard(one, 7)) != by_split(holdout_per_shard(one, 7, seed=1))


def test_short_shards(spark):
    frame = rows(spark, [3, 10, 1])
    with pytest.raises(ValueError, match=r"s0 \(3 rows\)|s2 \(1 rows\)"):
        holdout_per_shard(frame, 3)
    split = holdout_per_shard(frame, 3, short="spare_one")
    held = {r.shard: r["count"] for r in split.filter("split = 'validation'").groupBy("shard").count().collect()}
    assert held == {"s0": 2, "s1": 3}
    for bad in (0, -1):
        with pytest.raises(ValueError):
            holdout_per_shard(frame, bad)


def test_shard_without_a_name(spark):
    frame = rows(spark, [20, 20]).withColumn(
        "shard", F.when(F.col("shard") == "s1", F.col("shard"))
    )
    held = holdout_per_shard(frame, 6).filter("split = 'validation'")
    assert {r.shard: r["count"] for r in held.groupBy("shard").count().collect()} == {None: 6, "s1": 6}


def test_repeated_ids_are_refused_only_at_the_cut(spark):
    frame = rows(spark, [30]).withColumn("copy", F.lit("same"))
    with pytest.raises(Exception, match="repeats within shard"):
        holdout_per_shard(frame, 5, id_col="copy").collect()
    doubled = rows(spark, [30]).union(rows(spark, [30]))
    held = holdout_per_shard(doubled, 6).filter("split = 'validation'")
    assert held.count() == 6
    assert held.select("row_id").distinct().count() == 3


def test_sum_of_earlier(spark):
    source = random.Random(1)
    data = [(f"{source.getrandbits(256):064x}", source.randint(0, 9)) for _ in range(3000)]
    frame = spark.createDataFrame(data, "h STRING, v INT").repartition(5)
    found = {r.h: r.before for r in sum_of_earlier(frame, "h", "v", "before").collect()}
    total, expected = 0, {}
    for h, v in sorted(data):
        expected[h] = total
        total += v
    assert found == expected


def walk(shards, train_budget, valid_budget):
    """The budget rule shard by shard: shards are (order, tokens, held tokens)."""
    train = valid = 0
    verdicts = []
    for _, tokens, held in sorted(shards):
        feeds_valid = valid < valid_budget
        feeds_train = train_budget < 0 or train < train_budget
        verdicts.append((feeds_valid, feeds_train))
        if feeds_train:
            train += tokens - held if feeds_valid else tokens
        if feeds_valid:
            valid += held
    return verdicts


@pytest.mark.parametrize("seed", range(3))
def test_budget_decisions_follow_the_walk(spark, seed):
    source = random.Random(seed)
    data = []
    for i in range(40):
        held = source.randint(0, 20)
        data.append((f"s{i}", 100, held + source.randint(0, 80), f"{i:x}", held))
    cuts = spark.createDataFrame(
        data, "shard STRING, rows BIGINT, tokens BIGINT, cut STRING, held_tokens BIGINT"
    )
    for train_budget, valid_budget in ((500, 90), (-1, 40), (60, 10**6), (10**6, 1), (1, 1)):
        decided = budget_decisions(cuts, train_budget, valid_budget).orderBy("order").collect()
        expected = walk(
            [(r.order, r.tokens, r.held_tokens) for r in decided], train_budget, valid_budget
        )
        assert [(r.valid_active, r.train_active) for r in decided] == expected


def test_budget_sample(spark):
    frame = rows(spark, [40] * 6)
    sampled = sample_by_token_budget(frame, 700, 300, tokens_per_example=10).cache()
    held = sampled.filter("split = 'validation'")
    per_shard = {r["count"] for r in held.groupBy("shard").count().collect()}
    assert per_shard == {5}
    totals = {r.split: r.tokens for r in sampled.groupBy("split").agg(F.sum("num_tokens").alias("tokens")).collect()}
    assert totals["train"] >= 700 and totals["validation"] >= 300
    assert sampled.count() == sampled.select("row_id").distinct().count() < frame.count()
    everything = sample_by_token_budget(frame, -1, "300", tokens_per_example=10)
    assert everything.count() == frame.count()


def test_budget_sample_arguments(spark):
    frame = rows(spark, [40, 3])
    for budget in (0, "-5"):
        with pytest.raises(ValueError, match="positive"):
            sample_by_token_budget(frame, -1, budget)
    with pytest.raises(ValueError, match="gives no row"):
        sample_by_token_budget(frame, -1, 10)
    with pytest.raises(ValueError, match="cannot hold out"):
        sample_by_token_budget(frame, -1, 10_000, tokens_per_example=500)
    assert sample_by_token_budget(frame.limit(0), -1, 10).count() == 0


def test_short_shard_behind_both_budgets_is_no_error(spark):
    frame = rows(spark, [60, 60, 60, 60])
    places = frame.select("shard").distinct().withColumn("h", hash_place(42, F.col("shard")))
    last = places.orderBy(F.desc("h")).first().shard
    short = frame.filter((F.col("shard") != last) | F.col("row_id").rlike("-[01]$"))
    sampled = sample_by_token_budget(short, 10, 40, tokens_per_example=1)
    assert last not in {r.shard for r in sampled.select("shard").distinct().collect()}


@pytest.mark.parametrize("rank_rows", [1, 20, 10**6])
def test_hot_shards_are_cut_in_as_many_passes_as_they_need(spark, rank_rows):
    frame = rows(spark, [20_000, 300, 2, 0, 1000], 4)
    placed = frame.select("shard", hash_place(42, F.col("row_id")).alias("h"), "num_tokens").collect()
    for n in (1, 250):
        cuts = shard_cuts(frame, n, "shard", "row_id", tokens_col="num_tokens", rank_rows=rank_rows)
        found = {r.shard: r for r in cuts.collect()}
        assert set(found) == {"s0", "s1", "s2", "s4"}
        for shard, cut in found.items():
            inside = sorted((r.h, r.num_tokens) for r in placed if r.shard == shard)
            assert cut.rows == len(inside) and cut.tokens == sum(t for _, t in inside)
            if len(inside) > n:
                assert cut.cut == inside[n - 1][0]
                assert cut.held_tokens == sum(t for _, t in inside[:n])
            else:
                assert cut.cut is None


def test_ranked_rows_are_bounded(spark):
    frame = rows(spark, [20_000, 10], 4)
    placed = holdout._placed(frame, "shard", "row_id", 42, None)
    bounds = holdout._small_buckets(placed, F.lit(5).cast("bigint"), 10)
    assert bounds.agg(F.max("bucket_rows")).first()[0] <= 10
    assert {len(r["__bucket"]) for r in bounds.collect()} == {2, 4}


def test_copies_sharing_an_id_end_the_search(spark):
    frame = rows(spark, [2000]).withColumn(
        "copy", F.when(F.col("num_tokens") < 8, F.lit("same")).otherwise(F.col("row_id"))
    )
    cuts = shard_cuts(frame, 3, "shard", "copy", rank_rows=1)
    assert cuts.count() == 1

import hashlib

from pyspark.sql import functions as F

import grainsieve as g
from grainsieve.operators import membership
from grainsieve.plans import bloom, joins
from grainsieve.plans.joins import attach, fits_broadcast


def documents(spark):
    data = [(i, f"text {i % 7}" if i % 11 else None, f"k{i}" if i % 5 else None) for i in range(60)]
    return spark.createDataFrame(data, "id INT, text STRING, key STRING").select(
        "id", "text", F.struct("key").alias("meta")
    )


def test_ids(spark):
    frame = documents(spark)
    hashes = [r.id for r in g.document_ids(frame).collect()]
    assert hashes[1] == hashlib.sha256(b"text 1").hexdigest()
    assert hashes[0] is None and len(hashes) == 60
    assert [r.id for r in g.document_ids(frame, "hash").collect()] == hashes
    assert [r.id for r in g.document_ids(frame, "key").collect()][:2] == [None, "k1"]


def test_numbers_and_strings_meet(spark):
    frame = spark.createDataFrame([(1,), (2,)], "n INT").select(F.lit("t").alias("text"), F.struct("n").alias("meta"))
    ids = spark.createDataFrame([("2",)], "id STRING")
    assert [r.meta.n for r in g.rows_with_ids(frame, ids, "n").collect()] == [2]


def test_split_with_and_without_broadcast(spark):
    frame = documents(spark)
    wanted = [hashlib.sha256(f"text {i}".encode()).hexdigest() for i in (1, 3)]
    ids = spark.createDataFrame([(w,) for w in wanted * 50] + [(None,), ("absent",)], "id STRING")
    for bound in ({}, {"max_rows": 0}, {"max_bytes": 100}):
        split = g.split_by_ids(frame, ids, **bound)
        assert split.columns == ["id", "text", "meta", "split"]
        found = {r.id: r.split for r in split.collect()}
        assert len(found) == 60
        for i, name in found.items():
            listed = i % 11 != 0 and i % 7 in (1, 3)
            assert name == ("validation" if listed else "train")
    both = g.rows_with_ids(frame, ids).count() + g.rows_without_ids(frame, ids).count()
    assert both == 60


def hot_rows(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    return spark.range(3000, numPartitions=16).select("id", key.alias("k"))


def test_hot_keys_are_spread(spark):
    frame = hot_rows(spark)
    side = spark.createDataFrame([("hot", 1), ("4", 2), ("absent", 3)], "k STRING, v INT")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = attach(frame, side, ["k"], max_rows=0, hot_rows=100)
        assert joined.columns == ["id", "k", "v"]
        task = F.spark_partition_id().alias("task")
        tasks = joined.filter("k = 'hot'").select(task).distinct().count()
        assert tasks > 1
        for split in (joined, attach(frame, side, ["k"], max_rows=0, hot_rows=10**6)):
            found = {(r.k, r.v): r["count"] for r in split.groupBy("k", "v").count().collect()}
            assert found.pop(("hot", 1)) == 1000
            assert found.pop((None, None)) == 1000
            assert found.pop(("4", 2)) == 1
            assert len(found) == 999 and {v for _, v in found} == {None}
        inner = attach(frame, side, ["k"], "inner", max_rows=0, hot_rows=100)
        assert inner.count() == 1001
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_missing_keys_match_a_missing_entry(spark):
    side = spark.createDataFrame([(None, 7)], "k STRING, v INT")
    for bounds in ({}, {"max_rows": 0, "hot_rows": 10}, {"max_rows": 0}):
        joined = attach(hot_rows(spark), side, ["k"], "inner", **bounds)
        assert joined.count() == 1000 and joined.filter("v <> 7").count() == 0


def test_hot_keys_beyond_the_bound_are_dealt_as_well(spark, monkeypatch):
    """300 keys are hot, ten of them may be broadcast: the others are found by a Bloom filter and dealt over several tasks."""
    frame = spark.range(6000).select(F.when(F.col("id") < 200, F.lit(-1)).otherwise(F.col("id") % 300).alias("k"), "id")
    side = spark.createDataFrame([(-1, "y"), *((i, f"x{i}") for i in range(0, 310, 2))], "k BIGINT, v STRING")

    def never_more_than_ten(table, *bounds):
        return table.count() <= 10 and not bounds

    monkeypatch.setattr(joins, "fits_broadcast", never_more_than_ten)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach(frame.repartition(7), side, ["k"], max_rows=0, hot_rows=9)
        want = {(i, -1 if i < 200 else i % 300) for i in range(6000)}
        found = joined.collect()
        assert len(found) == 6000 and {(r.id, r.k) for r in found} == want
        assert all(r.v == ("y" if r.k == -1 else None if r.k % 2 else f"x{r.k}") for r in found)
        tasks = joined.filter("k = 4").select(F.spark_partition_id().alias("task")).distinct().count()
        assert tasks > 1
        assert attach(frame, side, ["k"], "inner", max_rows=0, hot_rows=9).count() == sum(1 for _, k in want if k == -1 or k % 2 == 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_bound_is_measured(spark):
    side = spark.createDataFrame([("a" * 100,), (None,)], "k STRING")
    assert fits_broadcast(side)
    assert not fits_broadcast(side, max_rows=1)
    assert not fits_broadcast(side, max_bytes=120)
    assert fits_broadcast(side.limit(0))


def test_allow_list(spark):
    frame = spark.createDataFrame([("py", 1), ("C", 2), ("c", 3), (None, 4)], "ext STRING, n INT")
    allowed = spark.createDataFrame([("c",), ("c",), (None,), ("py",)], "e STRING")
    assert {r.n for r in g.rows_in_list(frame, "ext", allowed).collect()} == {1, 3}


def test_few_rows_pass_the_bloom_filter(spark):
    frame = spark.range(200_000).select(F.col("id").cast("string").alias("__id"))
    listed = frame.filter("__id % 4 = 0")
    passed = bloom.with_chance(frame, listed, "__id").filter("__maybe")
    assert passed.join(listed, "__id", "left_semi").count() == 50_000
    # Under two in a hundred of those not listed.
    assert passed.count() - 50_000 < 0.02 * 150_000
    assert bloom.with_chance(frame, listed.limit(0), "__id").filter("__maybe").isEmpty()
    nulls = spark.createDataFrame([(None,), ("0",), ("1",)], "__id STRING")
    assert {r[0]: r[1] for r in bloom.with_chance(nulls, nulls.limit(2), "__id").collect()}[None] is False


def test_fewer_bits_let_more_pass_but_lose_none(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_BITS", bloom.BLOCK_BITS)
    frame = spark.range(60_000).select(F.col("id").cast("string").alias("__id"))
    listed = frame.filter("__id % 2 = 0")
    passed = bloom.with_chance(frame, listed, "__id").filter("__maybe")
    assert passed.join(listed, "__id", "left_semi").count() == 30_000 and passed.count() < 60_000


def test_stored_tables_are_split_without_an_exchange(spark):
    frame = spark.createDataFrame(
        [(f"text {i % 70}", {"doc": str(i)}, 1) for i in range(300)] + [(None, None, 2)],
        "text STRING, meta MAP<STRING, STRING>, n INT",
    )
    lists = [g.document_ids(frame.filter(F.col("text").isin("text 3", "text 5", "nowhere"))), g.document_ids(frame.limit(0))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        membership.store_by_id(frame, "stored_documents", buckets=5)
        for ids in lists:
            membership.store_ids(ids, "stored_ids", buckets=5)
            split = membership.split_stored_by_ids(spark, "stored_documents", "stored_ids")
            text = split._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in text and "Exchange" not in text
            want = g.split_by_ids(frame, ids)
            rows = [sorted((str(r.text), r.n, r.split) for r in table.collect()) for table in (split, want)]
            assert rows[0] == rows[1] and split.columns == want.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS stored_documents")
        spark.sql("DROP TABLE IF EXISTS stored_ids")

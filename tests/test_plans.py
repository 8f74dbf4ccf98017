"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import grainsieve as g
from checks import inputs
from grainsieve.sources.readers import spread


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def details(frame):
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def stored_code(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("code") / "code")
    inputs.code(spark, sf_dir).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def stored_shaped(spark, stored_code, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shaped") / "shaped")
    g.reformat(spark.read.parquet(stored_code), "content").write.parquet(path)
    return path


def test_recipes_do_not_shuffle(spark, sf_dir, stored_code):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("url", F.lit("http://a.jp"))
    words = g.KeywordLists(adult=["a"])
    frames = [
        g.apply_recipe(documents, g.recipe_for("en_wiki")),
        g.apply_recipe(documents, g.recipe_for("ja_cc", False, words)),
        g.apply_recipe(spark.read.parquet(stored_code), g.recipe_for("code_stack")),
        g.explain_rejections(documents, g.recipe_for("en_wiki")),
    ]
    for frame in frames:
        assert "Exchange" not in plan(frame)


def test_meta_rules_reach_the_scan(spark, stored_code, stored_shaped):
    flat = details(g.apply_recipe(spark.read.parquet(stored_code), g.recipe_for("code_stack")))
    for pushed in ("LessThanOrEqual(max_line_length,1000)", "GreaterThanOrEqual(alphanum_fraction,0.25)", "In(ext"):
        assert pushed in flat
    nested = spark.read.parquet(stored_shaped).filter(F.col("meta.max_line_length") <= 1000)
    assert "LessThanOrEqual(meta.max_line_length,1000)" in details(nested)
    ids = g.document_ids(spark.read.parquet(stored_shaped), "hexsha")
    assert re.search(r"ReadSchema: struct<meta:struct<hexsha:string>>", details(ids))


def test_transforms_run_once(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(g.apply_recipe(documents, g.recipe_for("en_wiki")))
    assert text.count("Bibliography") == 1
    assert "*(1) Generate" in text and "*(1) Filter" in text


def test_compression_comes_last_and_in_arrow_batches(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents = documents.withColumn("url", F.concat(F.lit("http://a.jp/"), "source"))
    text = plan(g.apply_recipe(documents, g.recipe_for("ja_cc", False, g.KeywordLists())))
    assert "ArrowEvalPython" in text and "BatchEvalPython" not in text
    below = text.split("ArrowEvalPython")[1]
    assert "StartsWith" in below and "ぁ-んァ-ン" in below


def test_counting_reads_two_columns(spark, stored_code, tmp_path):
    path = str(tmp_path / "tokens")
    frame = spark.read.parquet(stored_code).selectExpr("ext AS shard", "content", "doc_id AS num_tokens")
    frame.write.parquet(path)
    text = plan(g.tokens_per_shard(spark.read.parquet(path)))
    assert "ReadSchema: struct<shard:string,num_tokens:bigint>" in text


def test_splits_do_not_move_texts(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("num_tokens", F.col("n_chars"))
    ids = g.document_ids(documents.limit(3))
    frames = [
        g.holdout_per_shard(documents, 2, "source", "doc_id"),
        g.sample_by_token_budget(documents, 1000, 2000, "source", "doc_id", tokens_per_example=50),
        g.split_by_ids(documents, ids),
    ]
    for frame in frames:
        text = plan(frame)
        assert "BroadcastHashJoin" in text
        assert not re.search(r"(?<!Broadcast)Exchange (hash|range|Single|RoundRobin)", text)


def test_beyond_the_bound_ids_are_shuffled_with_a_salt(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        split = g.split_by_ids(documents, g.document_ids(documents.limit(20)), max_rows=10)
        text = plan(split)
        assert "SortMergeJoin" in text
        assert re.search(r"Exchange hashpartitioning\([^\n]*__salt", text)
        # Texts that are surely not listed pass by.
        assert re.search(r"\bUnion\b", text)
        train = text[text.index("Union") :].split("\n")
        depth = [len(line) - len(line.lstrip(" :+-")) for line in train]
        second = next(i for i in range(2, len(train)) if depth[i] == depth[1])
        assert not re.search(r"(?<!Broadcast)Exchange (hash|range|Single|RoundRobin)", "\n".join(train[1:second]))
        assert split.filter("split = 'validation'").count() >= 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_keeps_filters_above_the_exchange(spark, sf_dir):
    documents = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = plan(documents.filter(F.col("text").rlike("abc")).select("doc_id"))
    assert text.index("rlike(".upper()) < text.index("RoundRobinPartitioning")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    many = documents.sparkSession.range(100, numPartitions=64)
    assert spread(many) is many

"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainsieve.llm import (
    exact,
    language,
    licenses,
    mixing,
    neighbours,
    packing,
    periods,
    quality,
    sharding,
    simhash,
    suffixes,
    urls,
    variants,
)
from grainsieve.llm.oracles import ORACLES as ORACLES

SHARDS = 40
TOKENIZER = "byte_bpe_50k.json"

# Fixed values: (verdict, host, path) of the rules.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.drop("text_hash")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op9_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_report(_table(spark, sf_dir, "documents"))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(_table(spark, sf_dir, "documents")).drop("spans")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(_table(spark, sf_dir, "documents"))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_report(periods.periodic_runs(_table(spark, sf_dir, "documents"), prepare=periods.plant))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = variants.word_counts(_table(spark, sf_dir, "documents"), change=variants.planted_typo)
    return variants.spelling_variants(counts)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_quality": op2_quality,
    "op3_licenses": op3_licenses,
    "op4_neighbours": op4_neighbours,
    "op5_packing": op5_packing,
    "op6_urls": op6_urls,
    "op7_simhash": op7_simhash,
    "op8_mixing": op8_mixing,
    "op9_exact": op9_exact,
    "op10_suffixes": op10_suffixes,
    "op11_language": op11_language,
    "op12_periods": op12_periods,
    "op13_variants": op13_variants,
    "pipeline": pipeline,
}

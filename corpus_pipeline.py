"""From raw documents to packed sequences: the stages in order, each a DataFrame from the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grainsieve.llm.exact import drop_copies
from grainsieve.llm.mixing import mix
from grainsieve.llm.packing import pack
from grainsieve.llm.quality import keep_good
from grainsieve.llm.queries import tokenizer_path
from grainsieve.llm.simhash import keep_one_of_each
from grainsieve.plans.durable import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models of their languages do not find odd."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints, the document with the smallest id."""
    return keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in token sequences."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Language models and knapsacks are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

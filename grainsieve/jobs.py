"""The stages end to end, from paths to paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainsieve.functions.identity import document_id
from grainsieve.operators.counting import corpus_totals, tokens_per_shard
from grainsieve.operators.holdout import TRAIN, holdout_per_shard, sample_by_token_budget
from grainsieve.operators.membership import document_ids, split_by_ids
from grainsieve.operators.scoring import recipe_quality, with_label_shares
from grainsieve.operators.tokenizing import tokenize, tokenize_with_vocabulary
from grainsieve.plans.recipes import ID_KEYS, KeywordLists, apply_recipe, recipe_for
from grainsieve.sinks.chunks import plan_chunks, write_chunks
from grainsieve.sinks.named import write_named
from grainsieve.sinks.writers import (
    parquet_to_jsonl,
    write_counted,
    write_filtered,
    write_shards,
)
from grainsieve.sources.manifests import (
    read_ids,
    write_manifest,
    write_manifest_table,
    write_ordered_manifest,
)
from grainsieve.sources.paths import file_sizes, split_files
from grainsieve.sources.readers import read_documents, read_jsonl, read_split_files, read_splits, spread


def filter_corpus(
    spark: SparkSession,
    name: str,
    input_dir: str,
    output_dir: str,
    strict: bool = False,
    overwrite: bool = False,
    keywords: KeywordLists | None = None,
    schema: str | T.StructType | None = None,
    spread_input: bool = False,
    chunk_bytes: int | str | None = None,
) -> bool:
    """Filter and clean the split files of a collection. ``spread_input`` deals few large files over all cores first.

    With ``chunk_bytes`` the input is filtered in chunks of whole files, about that large, each finished by itself: after a failure the
    same call reads only what is missing. Tells whether anything was written.
    """
    recipe = recipe_for(name, strict, keywords)

    def filtered(documents: DataFrame) -> DataFrame:
        documents = spread(documents) if spread_input else documents
        return apply_recipe(documents, recipe, carry=("split",))

    if chunk_bytes is None:
        return write_filtered(filtered(read_splits(spark, input_dir, schema)), output_dir, overwrite)
    split_of = {
        path: split
        for split, files in split_files(spark, input_dir).items()
        for path, _ in file_sizes(spark, files)
    }

    def read(files: tuple[str, ...]) -> DataFrame:
        by_split: dict[str, list[str]] = {}
        for path in files:
            by_split.setdefault(split_of[path], []).append(path)
        return filtered(read_split_files(spark, by_split, schema))

    chunks = plan_chunks(spark, list(split_of), chunk_bytes)
    return bool(write_chunks(spark, chunks, output_dir, read, write_filtered, overwrite))


def tokenize_corpus(
    spark: SparkSession,
    input_paths: list[str],
    output_dir: str,
    sentencepiece_model: str,
    input_format: str = "parquet",
    overwrite: bool = False,
    schema: str | T.StructType | None = None,
    spread_input: bool = False,
    one_per_shard: bool = False,
) -> None:
    """Tokenize all shards not tokenized yet, into a folder for each, or with ``one_per_shard`` into one output named like the input file."""
    documents = read_documents(spark, input_paths, input_format, schema, shard=True)
    documents = spread(documents) if spread_input else documents
    _write_tokens(tokenize(documents, sentencepiece_model), output_dir, overwrite, spread_input, one_per_shard)


def _write_tokens(df: DataFrame, output_dir: str, overwrite: bool, cluster: bool, one_per_shard: bool) -> None:
    if one_per_shard:
        write_named(df, output_dir, F.col("shard"), overwrite=overwrite, drop=("shard",))
    else:
        write_shards(df, output_dir, overwrite, cluster=cluster)


def tokenize_corpus_with_vocabulary(
    spark: SparkSession,
    input_paths: list[str],
    output_dir: str,
    vocabulary: DataFrame,
    pattern: str,
    unknown_id: int,
    input_format: str = "parquet",
    overwrite: bool = False,
    one_per_shard: bool = False,
) -> None:
    """As ``tokenize_corpus``, with ids from a table ``(piece, id)``."""
    documents = read_documents(spark, input_paths, input_format, shard=True)
    tokenized = tokenize_with_vocabulary(documents, vocabulary, pattern, unknown_id)
    _write_tokens(tokenized, output_dir, overwrite, False, one_per_shard)


def _train_rows(df: DataFrame) -> DataFrame:
    """What a split may be drawn from: the train rows, where an earlier stage has told splits apart."""
    if "split" not in df.columns:
        return df
    return df.filter(F.coalesce(F.col("split"), F.lit(TRAIN)) == TRAIN).drop("split")


def count_tokens(
    spark: SparkSession, input_paths: list[str], input_format: str = "parquet"
) -> tuple[DataFrame, DataFrame]:
    """Tokens per shard, named by its path, and totals."""
    documents = read_documents(spark, input_paths, input_format, shard_path=True)
    shards = tokens_per_shard(documents, "shard_path")
    return shards, corpus_totals(shards)


def _write_split(
    df: DataFrame, output_dir: str, output_format: str, overwrite: bool, one_per_shard: bool
) -> DataFrame:
    """One pass writes both sides and counts them."""
    stored = df.drop("shard_path", "row_id")
    return write_counted(
        stored, output_dir, output_format, ("split", "shard"), overwrite=overwrite, one_per_shard=one_per_shard
    )


def sample_corpus(
    spark: SparkSession,
    input_paths: list[str],
    output_dir: str,
    train_token_size: str = "-1",
    valid_token_size: str = "10M",
    output_format: str = "jsonl",
    overwrite: bool = False,
    one_per_shard: bool = False,
) -> DataFrame:
    """Take train and validation rows up to token budgets; gives the totals of both."""
    documents = read_documents(spark, input_paths, shard=True, shard_path=True, row_id=True)
    sampled = sample_by_token_budget(_train_rows(documents), train_token_size, valid_token_size, "shard_path")
    return _write_split(sampled, output_dir, output_format, overwrite, one_per_shard)


def split_corpus(
    spark: SparkSession,
    input_paths: list[str],
    output_dir: str,
    valid_examples_per_shard: str = "81",
    output_format: str = "jsonl",
    overwrite: bool = False,
    one_per_shard: bool = False,
    input_format: str = "parquet",
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """Hold out the same number of rows of every shard, of Parquet or JSON lines; gives the totals of both sides."""
    documents = read_documents(
        spark, input_paths, input_format, schema, shard=True, shard_path=True, row_id=True
    )
    split = holdout_per_shard(_train_rows(documents), valid_examples_per_shard, "shard_path")
    return _write_split(split, output_dir, output_format, overwrite, one_per_shard)


def extract_ids(
    spark: SparkSession,
    name: str,
    input_paths: list[str],
    output_file: str,
    input_format: str = "jsonl",
    overwrite: bool = True,
    as_table: bool = True,
    ordered: bool = False,
    schema: str | T.StructType | None = None,
) -> bool:
    """Write the ids of all documents as a table of any length, as one manifest document, or as an ``ordered`` one of any length: by file, then row."""
    if ordered:
        documents = read_documents(spark, input_paths, input_format, schema, row_id=True)
        ids = documents.select(
            document_id(ID_KEYS[name]).alias("id"),
            F.regexp_extract("row_id", "^(.*):", 1).alias("file"),
            F.substring_index("row_id", ":", -1).cast("long").alias("number"),
        )
        return write_ordered_manifest(ids, ["file", "number"], output_file, ID_KEYS[name], overwrite)
    ids = document_ids(read_documents(spark, input_paths, input_format, schema), ID_KEYS[name])
    write = write_manifest_table if as_table else write_manifest
    return write(ids, output_file, ID_KEYS[name], overwrite)


def split_corpus_by_ids(
    spark: SparkSession,
    input_paths: list[str],
    output_dir: str,
    valid_id_file: str,
    output_format: str = "jsonl",
    overwrite: bool = False,
    one_per_shard: bool = False,
) -> DataFrame:
    """Send the documents a manifest (document or table) lists to validation, all others to train."""
    key, ids = read_ids(spark, valid_id_file)
    documents = read_documents(spark, input_paths, shard=True)
    return _write_split(split_by_ids(_train_rows(documents), ids, key), output_dir, output_format, overwrite, one_per_shard)


def evaluate_filter(
    spark: SparkSession,
    name: str,
    input_path: str,
    strict: bool = False,
    keywords: KeywordLists | None = None,
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """Quality of a recipe on labelled documents, with the label shares among the kept ones."""
    labelled = read_jsonl(spark, input_path, schema)
    return with_label_shares(recipe_quality(labelled, recipe_for(name, strict, keywords)))


def convert_to_jsonl(
    spark: SparkSession, input_paths: list[str], output_dir: str, overwrite: bool = False
) -> bool:
    """Parquet documents as JSON lines."""
    return parquet_to_jsonl(read_documents(spark, input_paths), output_dir, overwrite)

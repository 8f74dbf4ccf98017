"""Inputs of the registered queries, derived from the given tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainsieve.functions.text import with_listed_ranges
from grainsieve.plans.recipes import KeywordLists
from grainsieve.sources.readers import spread

# Neutral stand-ins for keyword lists. "the" before "then" and "カナ" beside "カナダ" make the order
# and the katakana rule count.
WORDS = ("the", "then", "an", "and", "der", "que")
KANA_WORDS = ("東京", "カナ", "東", "カナダ", "見て")
KEYWORDS = KeywordLists(
    ads=("ing the", "est"),
    adult=("thon", "thonth"),
    discrimination=("eren", "er"),
    violence=("カナ", "ouou"),
)

# Every lower-case pair, then every pair with an "e" behind: 1,352 entries, half of them
# with an earlier entry as beginning.
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
MANY_WORDS = tuple(
    a + b + end for end in ("", "e") for a in _LETTERS for b in reversed(_LETTERS)
)

PIECES = r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+|[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over all cores for work on their texts."""
    return spread(table(spark, sf_dir, "documents"))


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and texts with kana, URLs, brackets and headings added at their ends."""
    part = F.col("doc_id") % 4
    tail = (
        F.when(part == 0, F.lit("\n東京、カナ。見て https://a.example.jp/x です\n"))
        .when(part == 1, F.lit("（、カナ ） ( ; x ) ()"))
        .when(part == 2, F.lit("\nReferences \nz"))
        .otherwise(F.lit(""))
    )
    return documents(spark, sf_dir).select("doc_id", F.concat("text", tail).alias("text"))


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in web crawl: ``doc_id``, ``text`` with a kana start and full stops, ``url``."""
    part = F.col("doc_id") % 3
    tail = (
        F.when(part == 0, F.lit(".example.jp/"))
        .when(part == 1, F.lit(".example.zz/"))
        .otherwise(F.lit(".example.com/"))
    )
    return documents(spark, sf_dir).select(
        "doc_id",
        F.concat(F.lit("カナ。"), F.replace("text", F.lit("."), F.lit("。"))).alias("text"),
        F.concat(F.lit("https://h"), F.col("doc_id").cast("string"), tail).alias("url"),
    )


def blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which some have no text but white space of several kinds."""
    part = F.col("doc_id") % 8
    text = (
        F.when(part == 0, F.lit(""))
        .when(part == 1, F.lit(" \n\t"))
        .when(part == 2, F.lit("　  "))
        .when(part == 3, F.lit("\x1c\x1f"))
        .when(part == 4, F.lit("​"))
        .otherwise(F.col("text"))
    )
    return documents(spark, sf_dir).select("doc_id", text.alias("text"))


def code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in code collection with measures taken from the texts."""
    lines = F.split("text", "\n", -1)
    part = F.col("doc_id") % 5
    ext = (
        F.when(part == 0, F.lit("py"))
        .when(part == 1, F.lit("C"))
        .when(part == 2, F.lit("exe"))
        .when(part == 3, F.lit("md"))
        .otherwise(F.lit("JS"))
    )
    alphanumeric = F.length(F.regexp_replace("text", with_listed_ranges("[^A-Za-z0-9]"), ""))
    # An empty text has 0 / 0 of them, NaN in DuckDB and an error in Spark.
    fraction = F.when(F.length("text") == 0, F.lit(float("nan"))).otherwise(alphanumeric / F.length("text"))
    return documents(spark, sf_dir).select(
        F.col("text").alias("content"),
        "doc_id",
        ext.alias("ext"),
        F.array_max(F.transform(lines, F.length)).cast("bigint").alias("max_line_length"),
        (F.length("text") / F.size(lines)).alias("avg_line_length"),
        fraction.alias("alphanum_fraction"),
        F.sha2("text", 256).alias("hexsha"),
    )


def tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as shards (``source``) of blank-separated tokens."""
    tokens = F.regexp_extract_all("text", F.lit("[^ \n]+"), F.lit(0))
    return documents(spark, sf_dir).select(
        "doc_id", F.col("source").alias("shard"), "text", tokens.alias("tokens")
    )


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized(spark, sf_dir).select(
        "doc_id", "shard", "text", F.size("tokens").alias("num_tokens")
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents in the common shape: ``text`` and ``meta`` with ``label``."""
    label = (
        F.when(F.col("toxic") == 1, F.lit("1"))
        .when(F.col("quality") == 0, F.lit("2"))
        .otherwise(F.lit("0"))
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", label.alias("label"))
    return (
        documents(spark, sf_dir)
        .join(labels, "doc_id")
        .select("text", F.struct("doc_id", "source", "label").alias("meta"))
    )


def character_model() -> bytes:
    """A sentencepiece model made by rule: one piece per character U+0021 to U+017F, blank and newline."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    kind = proto.ModelProto.SentencePiece
    model = proto.ModelProto()
    pieces = [("<unk>", kind.UNKNOWN), ("<s>", kind.CONTROL), ("</s>", kind.CONTROL)]
    pieces += [(char, kind.NORMAL) for char in ("▁", "\n", *map(chr, range(0x21, 0x180)))]
    for piece, piece_kind in pieces:
        model.pieces.add(piece=piece, type=piece_kind, score=0.0)
    model.trainer_spec.model_type = proto.TrainerSpec.CHAR
    model.trainer_spec.vocab_size = len(pieces)
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    return model.SerializeToString()

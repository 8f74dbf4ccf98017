"""License scans: an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What parts words: all of ASCII but letters and digits.
_BREAKS = "".join(char for char in map(chr, range(128)) if not char.isalnum())


@dataclass(frozen=True)
class Template:
    """Words of a license text. A ``phrase`` counts where all its words stand one after the other."""

    label: str
    text: str
    containment: float = 0.8
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# Phrases and their labels.
PHRASES = (
    Template("cc-by", "cc by", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
    Template("reserved", "all rights reserved", 1.0, True),
)
NOTICES = (
    Template("apache-notice", "licensed under the apache license version 2 0"),
    Template("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-notice", "this work is licensed under a creative commons attribution license"),
    Template("gpl-notice", "this work is licensed under the gnu general public license version"),
    Template("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
)
TEMPLATES = PHRASES + NOTICES


def words_of(text: Column) -> Column:
    """Words of ``text``, A-Z made small. A search for a pattern of word characters takes several times as long."""
    plain = F.translate(text, _UPPER + _BREAKS, _LOWER + " " * len(_BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def _frequencies(rows: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Documents that hold each template token: as many rows as there are tokens, however large the corpus."""
    held = F.array_intersect(words_of(F.col("text")), F.array(*(F.lit(t) for t in tokens)))
    counts = rows.select(F.explode(held).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    found = dict(map(tuple, counts.collect()))
    return {token: found.get(token, 0) for token in tokens}


def _token_rows(templates: Sequence[Template], frequency: dict[str, int]) -> list[tuple]:
    """A row per template and token: its place in the global order (rarest first) and in the template's text."""
    rows = []
    for number, template in enumerate(templates):
        distinct = sorted(set(template.words), key=lambda w: (frequency[w], w))
        least = max(1, ceil(template.containment * len(distinct) - 1e-9))
        for place, word in enumerate(template.words):
            rows.append((word, number, distinct.index(word), place, len(distinct), least, len(template.words)))
    return rows


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    A text block is any stretch of as many words as a template has; it matches if it holds at least the template's
    ``containment`` of its distinct words. Template tokens are ordered by the number of documents that hold them. Only a text
    with a token of some template's prefix (the rarest ones, without which the threshold cannot be met) is looked into.
    Of its blocks, those with too few token places (length) or whose rarest token leaves too few behind it
    (position) go before the distinct words are counted. A phrase's block must also hold its words in
    order. ``n_base`` counts the places of all phrases, ``score`` is the best containment of a match, 0 without one.
    Null texts count as empty. Rows equal in id and text get equal results, each its own row.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    tokens = sorted({word for template in templates for word in template.words})
    frequency = _frequencies(rows, tokens)
    token_rows = _token_rows(templates, frequency)
    prefix = sorted({row[0] for row in token_rows if row[2] <= row[4] - row[5]})
    candidate = F.arrays_overlap("__words", F.array(*(F.lit(t) for t in prefix)))
    slim = cut_lineage(
        rows.withColumn("__words", words_of(F.col("text"))).select(
            "doc_id",
            F.xxhash64("text").alias("hash"),
            F.octet_length("text").alias("bytes"),
            F.size("__words").cast("long").alias("n_words"),
            F.when(candidate, F.col("__words")).alias("words"),
        )
    )
    key = ["doc_id", "hash", "bytes"]
    schema = "token string, template int, rank int, place int, size int, least int, span int"
    table = F.broadcast(spark.createDataFrame(token_rows, schema))
    candidates = slim.filter(F.col("words").isNotNull()).dropDuplicates(key)
    hits = cut_lineage(
        candidates.select(*key, F.posexplode("words").alias("pos", "word"))
        .join(table, F.col("word") == F.col("token"))
        .drop("word", "token")
    )
    results = _matches(hits, templates, key)
    joined = attach(slim.drop("words"), cut_lineage(results), key)
    zero = F.lit(0)
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", zero).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _matches(hits: DataFrame, templates: Sequence[Template], key: list[str]) -> DataFrame:
    """One row per text with a match, from the places (``pos``) of its template tokens."""
    group = [*key, "template"]
    # A token that a template holds several times is one token of the set.
    tokens = hits.select(*group, "pos", "rank", "size", "least", "span").distinct()
    blocks = None
    for span in sorted({len(template.words) for template in templates}):
        ahead = Window.partitionBy(*group).orderBy("pos").rangeBetween(0, span - 1)
        found = (
            tokens.filter(F.col("span") == span)
            .withColumn("n", F.count(F.lit(1)).over(ahead))
            .withColumn("rarest", F.min("rank").over(ahead))
            .withColumn("held", F.collect_set("rank").over(ahead))
            .filter((F.col("n") >= F.col("least")) & (F.col("rarest") <= F.col("size") - F.col("least")))
            .withColumn("overlap", F.size("held"))
            .filter(F.col("overlap") >= F.col("least"))
            .select(*group, "pos", (F.col("overlap") / F.col("size")).alias("score"))
        )
        blocks = found if blocks is None else blocks.unionByName(found)
    in_order = (
        hits.withColumn("origin", F.col("pos") - F.col("place"))
        .groupBy(*[F.col(name).alias(f"__{name}") for name in group], "origin", "span")
        .agg(F.count_distinct("place").alias("n"))
        .filter(F.col("n") == F.col("span"))
        .drop("n", "span")
    )
    label = F.element_at(F.array(*(F.lit(t.label) for t in templates)), F.col("template") + 1)
    phrase = F.element_at(F.array(*(F.lit(t.phrase) for t in templates)), F.col("template") + 1)
    same = F.col("pos") == F.col("origin")
    for name in group:
        same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
    named = blocks.withColumn("label", label).withColumn("phrase", phrase)
    verified = named.join(in_order, same, "left").filter(~F.col("phrase") | F.col("origin").isNotNull())
    base = F.col("phrase")
    return verified.groupBy(*key).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("pos"))).alias("first_word"),
        F.max(F.when(base, F.col("pos"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )

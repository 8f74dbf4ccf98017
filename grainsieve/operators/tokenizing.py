"""Tokenizing documents with a subword model or a plain vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainsieve.functions.text import all_matches
from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import BROADCAST_BYTES, BROADCAST_ROWS, attach, fits_broadcast

# Fixed value: texts encoded at a time.
ENCODE_ROWS = 128

# Fixed value: texts whose pieces are looked up at a time.
LOOK_UP_ROWS = 256

# Bytes of the distinct texts, on average, whose pieces are looked up together beyond the broadcast bound.
BLOCK_BYTES = 4 * 1024 * 1024

_ENCODED = "struct<tokens:array<string>,token_ids:array<int>>"


def _subword_encoder(model: Broadcast[bytes]):
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor(model_proto=model.value)
        pieces = pa.array(processor.id_to_piece(list(range(processor.get_piece_size()))))
        for texts in batches:
            missing = np.asarray(texts.is_null())
            ids = []
            for start in range(0, len(texts), ENCODE_ROWS):
                part = texts.slice(start, ENCODE_ROWS).fill_null("").to_pylist()
                # One thread: Spark already runs one task per core.
                found = processor.encode(part, out_type=int, num_threads=1)
                ids += [np.asarray(row, np.int32) for row in found]
            lengths = np.fromiter(map(len, ids), np.int32, len(ids))
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
            flat = pa.array(np.concatenate([np.empty(0, np.int32), *ids]))
            yield pa.StructArray.from_arrays(
                [
                    pa.ListArray.from_arrays(offsets, pieces.take(flat)),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["tokens", "token_ids"],
                mask=pa.array(missing),
            )

    return F.arrow_udf(encode, _ENCODED)


def _with_tokens(df: DataFrame, encoded: Column) -> DataFrame:
    others = [F.col(f"`{c}`") for c in df.columns if c not in {"tokens", "token_ids", "num_tokens"}]
    token_ids = F.col("__encoded.token_ids")
    return df.select(*others, encoded.alias("__encoded")).select(
        *others,
        F.col("__encoded.tokens").alias("tokens"),
        token_ids.alias("token_ids"),
        F.size(token_ids).alias("num_tokens"),
    )


def tokenize(df: DataFrame, model: bytes | str, text_col: str = "text") -> DataFrame:
    """Append ``tokens``, ``token_ids`` and ``num_tokens`` of a sentencepiece model.

    ``model`` is a path that Spark reads, or the model's bytes. Whatever its size, every node fetches it once, as a broadcast
    variable; only the text goes to the Python workers, which load the model once per task.
    """
    spark = df.sparkSession
    if isinstance(model, str):
        model = bytes(spark.read.format("binaryFile").load(model).select("content").first().content)
    shared = spark.sparkContext.broadcast(model)
    return _with_tokens(df, _subword_encoder(shared)(F.col(text_col)))


def _numbers(pieces: pa.ListArray, known: dict[str, int], unknown_id: int) -> pa.ListArray:
    # Each different piece is looked up once. By way of NumPy they become Python strings several times as fast.
    coded = pieces.flatten().dictionary_encode()
    different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    numbers = np.array([known.get(piece, unknown_id) for piece in different], dtype=np.int32)
    lengths = pc.list_value_length(pieces).fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    found = pa.array(numbers[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else numbers)
    return pa.ListArray.from_arrays(pa.array(offsets), found, mask=pieces.is_null())


def _lookup(vocabulary: pa.Array, ids: pa.Array, unknown_id: int):
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = {piece: number for piece, number in zip(vocabulary.to_pylist(), ids.to_pylist()) if number is not None}
        for pieces in batches:
            # In parts, as what is made of a whole batch on the way takes several times its room.
            for start in range(0, len(pieces), LOOK_UP_ROWS):
                yield _numbers(pieces.slice(start, LOOK_UP_ROWS), known, unknown_id)

    return F.arrow_udf(look_up, "array<int>")


def tokenize_with_vocabulary(
    df: DataFrame,
    vocabulary: DataFrame,
    pattern: str,
    unknown_id: int,
    id_col: str | None = None,
    text_col: str = "text",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Append the same columns from a table ``(piece, id)``; pieces are the matches of ``pattern``.

    A vocabulary beyond the measured bound is joined to the pieces of every distinct text instead of being sent to every task. Rows
    need no id (``id_col`` is not looked at): the answer follows from the text.
    """
    pieces = all_matches(F.col(text_col), pattern)
    vocabulary = cut_lineage(
        vocabulary.select(F.col("piece").cast("string"), F.col("id").cast("int"))
        .filter("piece IS NOT NULL")
        .groupBy("piece")
        .agg(F.min("id").alias("id"))
    )
    if fits_broadcast(vocabulary, max_rows, max_bytes):
        entries = vocabulary.toArrow()
        look_up = _lookup(
            entries["piece"].combine_chunks(), entries["id"].combine_chunks(), unknown_id
        )
        encoded = F.struct(
            F.col("__pieces").alias("tokens"), look_up(F.col("__pieces")).alias("token_ids")
        )
        split = df.withColumn("__pieces", pieces)
        return _with_tokens(split, encoded).drop("__pieces")
    # Pieces follow from the text alone, so every text is looked up once, whatever its rows are called.
    keyed = df.withColumn("__row", F.unhex(F.sha2(F.col(text_col), 256)))
    found = _looked_up(keyed, vocabulary, pattern, unknown_id, text_col, max_rows, max_bytes)
    joined = attach(keyed, found, on=["__row"], max_rows=max_rows, max_bytes=max_bytes)
    token_ids = F.when(F.col(text_col).isNotNull(), F.coalesce("__ids", F.array().cast("array<int>")))
    return _with_tokens(joined, F.struct(pieces.alias("tokens"), token_ids.alias("token_ids"))).drop("__row", "__ids")


def _ids_of_block(unknown_id: int):
    def look_up(texts: pa.Table, known: pa.Table) -> pa.Table:
        pieces = texts["__pieces"].combine_chunks()
        places = pc.index_in(pieces.flatten(), value_set=known["piece"].combine_chunks())
        ids = known["id"].combine_chunks().take(places).fill_null(unknown_id)
        lengths = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
        rows = texts["__row"].combine_chunks()
        return pa.table({"__row": rows, "__ids": pa.ListArray.from_arrays(offsets, ids)})

    return look_up


def _looked_up(
    keyed: DataFrame, vocabulary: DataFrame, pattern: str, unknown_id: int, text_col: str, max_rows: int, max_bytes: int
) -> DataFrame:
    """The ids of every distinct text of ``keyed``, by its hash ``__row``.

    The texts are numbered and looked at in blocks: the different pieces of a block, not all places of all texts, meet the vocabulary, and
    what they found goes back to the texts of the block.
    """
    texts = keyed.filter(F.col("__row").isNotNull()).select("__row", F.col(text_col).alias("__text"))
    numbered = cut_lineage(texts.dropDuplicates(["__row"]).withColumn("__number", F.monotonically_increasing_id()))
    mean = numbered.agg(F.avg(F.octet_length("__text"))).first()[0]
    per_block = max(1, int(BLOCK_BYTES / max(1, mean or 0)))
    place = F.col("__number").bitwiseAND(F.lit((1 << 33) - 1))
    split = all_matches(F.col("__text"), pattern)
    blocks = numbered.withColumn("__block", F.col("__number") - F.pmod(place, F.lit(per_block)))
    different = cut_lineage(blocks.select("__block", F.explode(split).alias("piece")).distinct())
    known = attach(different, vocabulary.filter("id IS NOT NULL"), ["piece"], "inner", max_rows=max_rows, max_bytes=max_bytes)
    # The texts are brought into order before they are split, as the pieces take far more room.
    ordered = blocks.repartition("__block").sortWithinPartitions("__block")
    pieces = ordered.select("__block", "__row", split.alias("__pieces"))
    found = pieces.groupBy("__block").cogroup(known.groupBy("__block"))
    return cut_lineage(found.applyInArrow(_ids_of_block(unknown_id), "__row binary, __ids array<int>"))

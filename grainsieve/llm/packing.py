"""Vector best-fit packing of documents into token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainsieve.llm.numbering import numbered
from grainsieve.plans.durable import cut_lineage

END_ID = 0
_SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds, and how much each residual weighs in the choice of a bin.

    ``cost`` counts attention: the squares of the lengths of the pieces, as each attends to itself alone.
    """

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.cost], dtype=np.int64)


@dataclass
class _Bins:
    """Runs of bins in the same state, with consecutive numbers."""

    first: list[int] = field(default_factory=list)
    count: list[int] = field(default_factory=list)
    left: list[tuple[int, int, int]] = field(default_factory=list)

    def add(self, first: int, count: int, left: tuple[int, int, int]) -> None:
        self.first.append(first)
        self.count.append(count)
        self.left.append(left)


def plan_bins(
    lengths: np.ndarray, counts: np.ndarray, capacity: Capacity, rule: str = "norm"
) -> np.ndarray:
    """Place ``counts[i]`` pieces of ``lengths[i]``, longest first, each into the best bin that can hold it.

    ``rule`` "norm" takes the bin whose weighted residual is smallest after the piece, "dot" the one
    whose residual points most in the piece's direction. Pieces of one length and bins in one state are handled together,
    so the work grows with the number of lengths, never with the number of pieces.
    Rows of the result: length, number of its first piece, pieces, first bin, offset in the bins.
    """
    if rule not in {"norm", "dot"}:
        raise ValueError(f"rule must be norm or dot, not {rule}")
    limits = capacity.limits()
    weights = np.array(capacity.weights)
    bins, rows, opened = _Bins(), [], 0
    for i in np.argsort(-np.asarray(lengths), kind="stable"):
        length, left, number = int(lengths[i]), int(counts[i]), 0
        need = np.array([length, 1, length * length], dtype=np.int64)
        if (need > limits).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left > 0:
            best = None
            if bins.left:
                residual = np.array(bins.left, dtype=np.int64)
                fits = (residual >= need).all(axis=1) & (np.array(bins.count) > 0)
                if fits.any():
                    if rule == "norm":
                        score = (weights * ((residual - need) / limits) ** 2).sum(axis=1)
                    else:
                        score = -(weights * (need / limits) * (residual / limits)).sum(axis=1)
                    best = int(np.argmin(np.where(fits, score, np.inf)))
            if best is None:
                # The next pieces of this length go into the same bin until it is full under "norm", and under
                # "dot" only where no other bin has room, which is the case here as well.
                each = int((limits // need).min())
                new = max(1, left // each)
                bins.add(opened, new, tuple(map(int, limits)))
                opened += new
                continue
            state = np.array(bins.left[best], dtype=np.int64)
            each = int((state // need).min()) if rule == "norm" else 1
            used = min(bins.count[best], left // each) if left >= each else 1
            each = min(each, left)
            first = bins.first[best]
            for k in range(each):
                offset = int(capacity.tokens - state[0] + k * length)
                rows.append((length, number, used, first, offset))
                number += used
            left -= each * used
            after = tuple(map(int, state - each * need))
            bins.first[best] += used
            bins.count[best] -= used
            if bins.count[best] == 0:
                for column in (bins.first, bins.count, bins.left):
                    column[best] = column[-1]
                    column.pop()
            if after[0] > 0 and after[1] > 0 and after[2] > 0:
                bins.add(first, used, after)
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


class Encoder:
    """Token ids of a byte-level vocabulary file of ``tokenizers``, special strings included.

    The same merges run in ``tiktoken``, several times as fast; texts it would treat differently (special tokens) or
    slowly (very long words) go to ``tokenizers``.
    """

    _LONG_WORD = 1000

    def __init__(self, path: str) -> None:
        import json
        import re

        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self._exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        special = [token["content"] for token in spec.get("added_tokens", ())]
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._blank = re.compile(rf"\s{{{self._LONG_WORD}}}")
        self._fast = None
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
        if plain and model.get("type") == "BPE" and spec.get("normalizer") is None:
            # Characters that stand for bytes: printable ones for themselves, the others from U+0100 on.
            kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
            byte_of = {chr(b): b for b in kept}
            byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(kept))}
            assert set(byte_of) == set(pre_tokenizers.ByteLevel.alphabet())
            ranks = {
                bytes(byte_of[c] for c in token): rank
                for token, rank in model["vocab"].items()
                if token not in set(special)
            }
            # Fixed value: the word pattern of byte-level vocabularies of this kind.
            pattern = (
                r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            )
            self._fast = tiktoken.Encoding(
                "bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )

    def _is_slow(self, text: str) -> bool:
        """Whether a word or a run of blanks is very long."""
        if len(text) < self._LONG_WORD:
            return False
        return max(map(len, text.split()), default=0) >= self._LONG_WORD or bool(self._blank.search(text))

    def __call__(self, text: str) -> list[int]:
        if self._fast is None or self._is_slow(text) or (self._special and self._special.search(text)):
            return self._exact.encode(text, add_special_tokens=False).ids
        return self._fast.encode_ordinary(text)


def cut_points(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than ``capacity``."""
    head = total % capacity
    starts = ([0] if head else []) + list(range(head, total, capacity))
    ends = starts[1:] + [total]
    return [(start, end - start) for start, end in zip(starts, ends)]


def tokenized_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every piece of every document."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if keep_ids:
        schema += ", ids array<int>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            at, columns = 0, ([], [], [], [], [], [])
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if keep_ids else 5]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encoder(text.as_py() or ""), END_ID], dtype="<u4")
                for piece, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    own = ids[start : start + length]
                    crc = zlib.crc32(own.tobytes())
                    for column, value in zip(columns, (doc_id, piece, start, length, crc)):
                        column.append(value)
                    if keep_ids:
                        columns[5].append(own.astype(np.int32))
                at += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns[: len(names)], types)], names=names
            )

    slim = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return slim.mapInArrow(encode, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: Capacity = Capacity(),
    *,
    rule: str = "norm",
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its place: ``sequence_id`` and ``offset``.

    A document's tokens end with id 0; null and empty texts are that id alone. Only documents longer than a
    sequence are cut. Repeated rows are packed as often as they come; an empty table gives no rows. The choice of
    bins sees one row per length (at most ``capacity.tokens``); the pieces of a length are numbered where they lie
    and look their places up.
    """
    spark = docs.sparkSession
    pieces = cut_lineage(
        tokenized_pieces(
            docs, tokenizer, capacity.tokens, id_col=id_col, text_col=text_col, keep_ids=keep_ids
        ).withColumn("__tie", F.xxhash64("doc_id", "piece", "ids_crc32"))
    )
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("rows")).toPandas()
    plan = plan_bins(
        histogram["length"].to_numpy(), histogram["rows"].to_numpy(), capacity, rule
    )
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = spark.sparkContext.broadcast(plan)
    counted = numbered(pieces, ["length"], ["__tie", "doc_id", "piece"], "__no", equal_rows=True).drop("__tie")
    names = [name for name in counted.columns if name != "__no"]
    schema = ", ".join(f"{name} {counted.schema[name].dataType.simpleString()}" for name in names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        starts = {length: i for i, length in reversed(list(enumerate(rows[:, 0].tolist())))}
        ends = {length: i + 1 for i, length in enumerate(rows[:, 0].tolist())}
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("__no").to_numpy(zero_copy_only=False)
            row = np.empty(len(length), dtype=np.int64)
            for one in np.unique(length).tolist():
                here = length == one
                firsts = rows[starts[one] : ends[one], 1]
                row[here] = starts[one] + np.searchsorted(firsts, number[here], side="right") - 1
            found = rows[row].reshape(-1, 5)
            columns = [batch.column(name) for name in names]
            columns.append(pa.array(found[:, 3] + number - found[:, 1], pa.int64()))
            columns.append(pa.array(found[:, 4], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return counted.mapInArrow(place, f"{schema}, sequence_id long, offset long")

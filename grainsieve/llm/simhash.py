"""SimHash near-duplicates: pigeonring filtering of fingerprint pairs, then linked groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainsieve.llm.components import components
from grainsieve.llm.numbering import shuffle_width
from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach

SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 7
SEED = 42
# Fingerprints that share a chain are compared in squares of at most so many on a side.
CHUNK = 4096

_BITS = 64


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Bits set in over half the shingles' hashes; 0 without words. A-Z count as a-z, white space is ASCII."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    blanks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    starts = [0, *(blanks + 1).tolist()]
    ends = [*blanks.tolist(), len(joined)]
    take, count = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    if count == 1:
        hashes = [take(joined, SEED)]
    else:
        hashes = [take(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
    ones = np.zeros(_BITS, dtype=np.int64)
    rows = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(rows), 65_536):
        ones += np.unpackbits(rows[at : at + 65_536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big")


def with_fingerprints(
    docs: DataFrame, name: str, *, text_col: str = "text", shingle: int = SHINGLE_WORDS, keep: list[str]
) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``name``, the fingerprint as a signed long."""
    slim = docs.select(*(F.col(f"`{column}`") for column in keep), F.col(f"`{text_col}`").alias("__text"))
    schema = slim.drop("__text").withColumn(name, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            prints = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(prints.view(np.int64))], names=schema.names
            )

    return slim.mapInArrow(run, schema)


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment of a fingerprint, from the lowest."""
    edges = [round(i * _BITS / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def chain_budgets(segments: int, max_bits: int) -> list[int]:
    """Differences that the first 1, 2, … segments of some chain around the ring can have together.

    If two fingerprints differ in at most ``max_bits`` bits, then from some segment on every chain of k segments
    differs in at most k/``segments`` of them.
    """
    return [k * max_bits // segments for k in range(1, segments + 1)]


def ring_masks(segments: int) -> list[list[np.uint64]]:
    """For each segment, the masks of the chains of 1, 2, … segments that start there."""
    bounds = segment_bounds(segments)
    one = [((1 << bits) - 1) << first for first, bits in bounds]
    masks = []
    for start in range(segments):
        mask, chain = 0, []
        for k in range(segments):
            mask |= one[(start + k) % segments]
            chain.append(np.uint64(mask))
        masks.append(chain)
    return masks


def _near(a: np.ndarray, b: np.ndarray, chain: list[np.uint64], budgets: list[int]) -> np.ndarray:
    """Which pairs keep every chain within its budget; the last chain is the whole fingerprint."""
    differ = a ^ b
    alive = np.ones(differ.shape, dtype=bool)
    for mask, budget in zip(chain, budgets):
        alive &= np.bitwise_count(differ & mask) <= budget
    return alive


def _roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``size`` nodes."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _square_links(
    prints: np.ndarray, side: np.ndarray, chain: list[np.uint64], budgets: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Links inside one square as a forest: each linked fingerprint with the first of its group.

    ``side`` 0 and 1 are the two chunks of the square; a square on the diagonal has only 0.
    """
    nothing = np.zeros(0, dtype=np.int64)
    lefts, rights = [nothing], [nothing]
    rows = np.flatnonzero(side == 0)
    others = np.flatnonzero(side == 1) if (side == 1).any() else rows
    for at in range(0, len(rows), 512):
        block = rows[at : at + 512]
        near = _near(prints[block][:, None], prints[others][None, :], chain, budgets)
        i, j = np.nonzero(near)
        lefts.append(block[i])
        rights.append(others[j])
    left, right = np.concatenate(lefts), np.concatenate(rights)
    root = _roots(len(prints), left, right)
    linked = np.flatnonzero(root != np.arange(len(prints)))
    return linked, root[linked]


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(u, v) between distinct fingerprints (column ``fp``) at most ``max_bits`` bits apart, enough to join all such.

    Candidates share, from some segment on, all segments whose chains have no budget; longer chains are checked against
    theirs before the whole. A shared chain with more than ``CHUNK`` fingerprints is compared in squares, each a group
    of its own, so that none outgrows a task and no pair is left out.
    """
    budgets = chain_budgets(segments, max_bits)
    equal = max(1, sum(budget == 0 for budget in budgets))
    masks = ring_masks(segments)
    signed = [int(np.array(m[equal - 1]).view(np.int64)) for m in masks]
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("ring"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key"))
            for i, mask in enumerate(signed)
        )
    )
    keyed = prints.select("fp", F.explode(keys).alias("k")).select("k.ring", "k.key", "fp")
    sizes = keyed.groupBy("ring", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    sized = keyed.join(
        sizes.select(F.col("ring").alias("r"), F.col("key").alias("k"), "n"),
        (F.col("ring") == F.col("r")) & (F.col("key") == F.col("k")),
    )
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    squares = F.transform(
        F.sequence(F.lit(0), F.col("c") - 1),
        lambda other: F.struct(
            F.least(F.col("own"), other).alias("a"),
            F.greatest(F.col("own"), other).alias("b"),
            F.when(other == F.col("own"), 0)
            .otherwise(F.when(F.col("own") < other, 0).otherwise(1))
            .alias("side"),
        ),
    )
    # Without chunks the one square stands on the diagonal. With them, a square off it sees both sides.
    dealt = (
        sized.withColumn("c", chunks)
        .withColumn("own", own)
        .select("ring", "key", "fp", F.explode(squares).alias("s"))
        .select("ring", "key", "s.a", "s.b", "s.side", "fp")
    )
    width = shuffle_width(prints.sparkSession)
    grouped = dealt.repartition(width, "ring", "key", "a", "b").sortWithinPartitions(
        "ring", "key", "a", "b", "side", "fp"
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(keys: np.ndarray, side: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            """Whole squares, in order. Small ones are compared all at once, by distance in the order."""
            new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            starts = np.concatenate([[0], new, [len(keys)]])
            lengths = np.diff(starts)
            group = np.repeat(np.arange(len(lengths)), lengths)
            ring = keys[:, 0].astype(int)
            us, vs = [], []
            small = np.repeat(lengths <= 64, lengths) & (keys[:, 2] == keys[:, 3])
            at = np.flatnonzero(small)
            step = 1
            while len(at):
                at = at[at + step < len(fps)]
                at = at[group[at] == group[np.minimum(at + step, len(fps) - 1)]]
                for i in range(segments):
                    mine = at[ring[at] == i]
                    near = mine[_near(fps[mine], fps[mine + step], masks[i], budgets)]
                    us.append(fps[near])
                    vs.append(fps[near + step])
                step += 1
            for g in np.flatnonzero((lengths > 64) | (keys[starts[:-1], 2] != keys[starts[:-1], 3])):
                a, b = starts[g], starts[g + 1]
                linked, roots = _square_links(fps[a:b], side[a:b], masks[ring[a]], budgets)
                us.append(fps[a:b][linked])
                vs.append(fps[a:b][roots])
            u = np.concatenate([*us, np.zeros(0, np.uint64)]).view(np.int64)
            v = np.concatenate([*vs, np.zeros(0, np.uint64)]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        kept = None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)]
            table = np.stack(columns, axis=1)
            kept = table if kept is None else np.concatenate([kept, table])
            change = np.flatnonzero((kept[1:, :4] != kept[:-1, :4]).any(axis=1))
            if len(change):
                cut = change[-1] + 1
                whole, kept = kept[:cut], kept[cut:]
                yield compare(whole[:, :4], whole[:, 4], whole[:, 5].copy().view(np.uint64))
        if kept is not None and len(kept):
            yield compare(kept[:, :4], kept[:, 4], kept[:, 5].copy().view(np.uint64))

    return grouped.mapInArrow(link, "u long, v long")


def _groups(prints: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """(fp, component_id, rep) from (``fp``, ``doc_id``, ``tie``) of every document."""
    distinct = cut_lineage(
        prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("rep"))
    )
    roots = components(fingerprint_links(distinct.select("fp"), max_bits, segments))
    placed = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("rep").alias("least"))
    joined = placed.join(least.withColumnRenamed("root", "__root"), F.col("root") == F.col("__root"))
    return cut_lineage(
        joined.select("fp", F.col("least.doc_id").alias("component_id"), F.col("least.tie").alias("keep_tie"))
    )


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    ``component_id`` is the smallest doc_id reachable over fingerprints at most ``max_bits`` bits apart. Null and empty
    texts have fingerprint 0 and are linked like any other; null ids count last. Copies share a
    fingerprint, so only distinct fingerprints are compared.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = cut_lineage(
        with_fingerprints(slim, "fp", shingle=shingle, keep=["doc_id"]).withColumn("tie", F.lit(0).cast("long"))
    )
    groups = _groups(prints, max_bits, segments)
    return attach(prints, groups, ["fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """The rows of ``docs`` without all but one of each group of near-duplicates: the one with the smallest id.

    Texts are read twice and not shuffled. Of rows with the same id, that with the smaller text hash stays; of rows
    equal in both, one.
    """
    columns = docs.columns
    tie = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in columns)).alias("__row"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        tie.alias("tie"),
    )
    prints = cut_lineage(with_fingerprints(rows, "fp", shingle=shingle, keep=["doc_id", "tie"]))
    groups = _groups(prints, max_bits, segments)
    # A row is told by id and text hash; the fingerprint follows from the text, so it need not be taken again.
    keepers = attach(prints, groups, ["fp"]).filter(
        F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("tie") == F.col("keep_tie"))
    )
    keepers = cut_lineage(keepers.groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("__equal")))
    kept = attach(rows, keepers, ["doc_id", "tie"], "inner")
    if keepers.agg(F.max("__equal")).first()[0] in (None, 1):
        return kept.select("__row.*")
    first = kept.filter(F.col("__equal") == 1).select("__row.*")
    again = kept.filter(F.col("__equal") > 1).dropDuplicates(["doc_id", "tie"]).select("__row.*")
    return first.unionByName(again)

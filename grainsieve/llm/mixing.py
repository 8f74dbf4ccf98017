"""Mixing sources to target weights: whole epochs, then a subset whose sizes sum to the rest."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainsieve.llm.numbering import numbered
from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
SEED = 20240601
# Budgets up to so many words are met by dynamic programming; what lies above is taken in proportion first.
KNAPSACK = 65_536

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many items of each length to take so that their sum comes as near below ``budget`` as can be found.

    An equal share of every length is taken first, single items of the longest lengths bring the rest under
    ``KNAPSACK``, and a bounded knapsack over the remaining items fills it: exactly, if any subset of them does.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    counts = np.asarray(counts, dtype=np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0:
        return np.zeros_like(counts)
    taken = np.floor(counts * (budget / total)).astype(np.int64)
    rest = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= KNAPSACK or lengths[i] == 0:
            break
        more = min(int(counts[i] - taken[i]), (rest - KNAPSACK + int(lengths[i]) - 1) // int(lengths[i]))
        more = min(more, rest // int(lengths[i]))
        taken[i] += more
        rest -= more * int(lengths[i])
    reachable, steps = 1, []
    within = (1 << (rest + 1)) - 1
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        if length == 0 or length > rest:
            continue
        left, bundle = min(int(counts[i] - taken[i]), rest // length), 1
        while left > 0 and not reachable >> rest & 1:
            bundle = min(bundle, left)
            steps.append((i, bundle, reachable))
            reachable |= (reachable << bundle * length) & within
            left -= bundle
            bundle *= 2
    best = reachable.bit_length() - 1
    for i, bundle, before in reversed(steps):
        if not before >> best & 1:
            taken[i] += bundle
            best -= bundle * int(lengths[i])
    return taken


def _targets(sources: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Add ``target``: weighted shares of all sizes, none above ``most`` times its source's size."""
    ordered = numbered(
        sources.withColumn("__last", F.col("source").isNull()), [], ["__last", "source"], "__place"
    )
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (F.col("__place") % len(weights) + 1).cast("int")
    )
    weighed = cut_lineage(
        ordered.select(
            "source",
            "source_size",
            weight.alias("__weight"),
            (F.col("source_size") * float(most)).alias("__cap"),
        )
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    rate, capped = 0.0, -1
    while True:
        over = F.col("__weight") * rate > F.col("__cap")
        row = weighed.agg(
            F.count(F.when(over, 1)),
            F.coalesce(F.sum(F.when(over, F.col("__cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("__weight"))), F.lit(0.0)),
        ).first()
        if row[0] == capped or row[2] == 0:
            break
        capped = row[0]
        rate = max(rate, (total - row[1]) / row[2])
    target = F.least(F.col("__weight") * rate, F.col("__cap"))
    return weighed.select("source", "source_size", target.alias("target"))


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    size, budget = int(rows["source_size"].iloc[0]), int(round(rows["target"].iloc[0]))
    epochs = budget // size if size else 0
    rows["copies"] = epochs
    rows["part"] = fit_budget(
        rows["size"].to_numpy(), rows["rows"].to_numpy(), budget - epochs * size
    )
    return rows[["source", "size", "rows", "source_size", "target", "copies", "part"]]


def fitted_lengths(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, most_copies: int = MOST_COPIES
) -> DataFrame:
    """A row per source and exact size, from (``source``, ``size``) of every document.

    ``copies`` of all its documents are taken, and one more of ``part`` of its ``rows``.
    """
    lengths = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("rows"))
    lengths = cut_lineage(lengths)
    sources = lengths.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size")
    )
    targets = _targets(sources, weights, most_copies)
    renamed = targets.withColumnRenamed("source", "__source")
    schema = (
        "source string, size long, rows long, source_size long, target double, copies long, part long"
    )
    return cut_lineage(
        lengths.join(renamed, F.col("source").eqNullSafe(F.col("__source")))
        .drop("__source")
        .groupBy("source")
        .applyInPandas(_fit_source, schema)
    )


def _ranked(sized: DataFrame) -> DataFrame:
    """``sized`` with ``__no``, the place of a row among those of its source and size in the order of the draw.

    Rows that are equal throughout have places of their own, so that a cut goes through them as through any others.
    """
    return numbered(sized, ["source", "size"], ["draw", "tie"], "__no", equal_rows=True)


def mix_plan(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, most_copies: int = MOST_COPIES
) -> DataFrame:
    """``fitted_lengths`` with the ``cutoff`` of the draw, for (``source``, ``size``, ``draw``, ``tie``) of every document.

    Rows with ``draw`` below it are among the ``part``, and of the ``tied`` rows that have the cutoff itself, ``tied_part``. It is
    null where all rows or none are.
    """
    fitted = fitted_lengths(sized, weights, most_copies)
    keys = ["source", "size"]
    ranked = cut_lineage(_ranked(sized.select("source", "size", "draw", "tie")))
    open_ = fitted.filter((F.col("part") > 0) & (F.col("part") < F.col("rows"))).select(*keys, "part")
    near = attach(ranked, cut_lineage(open_), keys, "inner")
    cut = cut_lineage(near.filter(F.col("__no") == F.col("part") - 1).select(*keys, F.col("draw").alias("cutoff")))
    tied = (
        attach(near, cut, keys, "inner")
        .filter(F.col("draw") == F.col("cutoff"))
        .groupBy(*keys)
        .agg(
            F.first("cutoff").alias("cutoff"),
            F.count(F.lit(1)).alias("tied"),
            F.count(F.when(F.col("__no") < F.col("part"), 1)).alias("tied_part"),
        )
    )
    return cut_lineage(attach(fitted, cut_lineage(tied), keys))


def _drawn(docs: DataFrame, id_col: str, text_col: str, seed: int) -> list[Column]:
    tie = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return [
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), tie).alias("draw"),
        tie.alias("tie"),
    ]


def _copies(once_more: Column) -> Column:
    wanted = F.col("copies") + F.when(F.coalesce(once_more, F.lit(False)), 1).otherwise(0)
    return F.when(F.col("size") > 0, wanted).otherwise(0).cast("long")


def mix_report(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most_copies: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document.

    Sources share all sizes by weight in the order of their names, null last; no target exceeds ``most_copies`` times its
    source's size. A source's taken words come below its target by less than can be told apart by the sizes
    left. Null and empty texts have size 0 and are not taken. Documents are chosen by a seeded hash of
    id and text, so reruns agree; of rows equal in both, as many are taken as are needed, each for itself. An empty table gives no rows.
    """
    sized = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            *_drawn(docs, id_col, text_col, seed),
        )
    )
    plan = fitted_lengths(sized, weights, most_copies)
    return attach(_ranked(sized), plan, ["source", "size"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies(F.col("__no") < F.col("part"))).alias("taken")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most_copies: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_report`` takes it. Texts are not shuffled, but for repeated rows through which a cut goes."""
    drawn = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("__row"),
        F.col(source_col).cast("string").alias("source"),
        *_drawn(docs, id_col, text_col, seed),
    )
    plan = mix_plan(cut_lineage(drawn.select("source", "size", "draw", "tie")), weights, most_copies)
    planned = attach(drawn, plan, ["source", "size"])
    divided = (F.col("draw") == F.col("cutoff")) & (F.col("tied_part") < F.col("tied"))
    whole = (F.col("part") > 0) & ((F.col("part") == F.col("rows")) | (F.col("draw") <= F.col("cutoff")))
    copies = _copies(whole)
    if not plan.filter(F.col("tied_part") < F.col("tied")).isEmpty():
        repeated = cut_lineage(planned.filter(divided))
        repeated = numbered(repeated, ["source", "size"], [], "__no", equal_rows=True)
        more = repeated.select("__row", _copies(F.col("__no") < F.col("tied_part")).alias("__copies"))
        planned = planned.filter(~F.coalesce(divided, F.lit(False))).select("__row", copies.alias("__copies")).unionByName(more)
    else:
        planned = planned.select("__row", copies.alias("__copies"))
    return (
        planned.filter(F.col("__copies") > 0)
        .select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__copy"))
        .select("__row.*")
    )

"""Judging a filter against labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainsieve.plans.recipes import Recipe, explain_rejections

# Label strings.
ACCEPTABLE = "0"
HARMFUL = "1"
LOW_QUALITY = "2"

LABELS = {"acceptable": ACCEPTABLE, "harmful": HARMFUL, "low_quality": LOW_QUALITY}


def _label(column: str) -> Column:
    return F.col(column).cast("string")


def label_counts(df: DataFrame, label_col: str = "meta.label") -> DataFrame:
    """One row: documents, and how many carry each label."""
    label = _label(label_col)
    return df.agg(
        F.count(F.lit(1)).alias("documents"),
        *(F.count_if(label == value).alias(name) for name, value in LABELS.items()),
    )


def _quality(labelled: DataFrame) -> DataFrame:
    """Precision, recall and F1 of removal from rows of (label, before 0/1, after 0/1)."""
    label = F.col("label")
    bad = label.isin(HARMFUL, LOW_QUALITY)

    def total(condition: Column, weight: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))

    removed = F.col("before") - F.col("after")
    counts = labelled.agg(
        total(bad, removed).alias("tp"),
        total(label == ACCEPTABLE, removed).alias("fp"),
        total(bad, F.col("after")).alias("fn"),
        *(total(label == value, F.col("after")).alias(name) for name, value in LABELS.items()),
        F.coalesce(F.sum("after"), F.lit(0)).alias("kept"),
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = F.col("precision"), F.col("recall")
    rated = counts.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
    return rated.withColumn("f1", ratio(2 * precision * recall, precision + recall))


def filter_quality(
    before: DataFrame, after: DataFrame, label_col: str = "meta.label"
) -> DataFrame:
    """Score a filter from its input and output. Both are counted in one aggregate, without a join."""
    label = _label(label_col).alias("label")
    both = before.select(label, F.lit(1).alias("before"), F.lit(0).alias("after")).unionByName(
        after.select(label, F.lit(0).alias("before"), F.lit(1).alias("after"))
    )
    return _quality(both)


def recipe_quality(df: DataFrame, recipe: Recipe, label_col: str = "meta.label") -> DataFrame:
    """Score a recipe on labelled documents in a single pass over the texts."""
    judged = explain_rejections(df, recipe)
    return _quality(
        judged.select(
            _label(label_col).alias("label"),
            F.lit(1).alias("before"),
            F.col("kept").cast("int").alias("after"),
        )
    )


def with_label_shares(quality: DataFrame) -> DataFrame:
    """Add the share of each label among the kept rows; NULL when nothing was kept."""
    return quality.withColumns(
        {f"{name}_share": F.try_divide(F.col(name), F.col("kept")) for name in LABELS}
    )

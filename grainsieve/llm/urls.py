"""Allow and block rules over hosts and paths, matched by a sorted sweep over reversed-host keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainsieve.llm.numbering import shuffle_width
from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"


def url_host(url: Column) -> Column:
    """What stands behind the first ``://``, up to ``/``, ``?`` or ``#``, A-Z in lower case; empty without one."""
    host = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, _URL, "$1"))
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    path = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, _URL, "$2"))
    return F.coalesce(path, F.lit(""))


def canonical_key(labels: Column, path: Column) -> Column:
    """Reversed labels, a mark that sorts below all else in a host, and the path.

    A rule's urls, for the host it names, are exactly the keys that start with the rule's own key: one interval of the sorted keys.
    """
    return F.concat(F.array_join(labels, "."), F.lit("\x00"), path)


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows of a short list of rules."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _prepared(rules: DataFrame) -> DataFrame:
    """One row per rule key with its text. Of rules with the same key, a block stays before an allow."""
    host = F.translate("host", _UPPER, _LOWER)
    labels = F.reverse(F.split(host, r"\."))
    return (
        rules.select(
            canonical_key(labels, F.col("path")).alias("key"),
            F.concat(host, F.col("path")).alias("rule"),
            "verdict",
            F.size(labels).alias("labels"),
        )
        .groupBy("key")
        .agg(F.max_by(F.struct("rule", "verdict", "labels"), F.col("verdict")).alias("r"))
        .select("key", "r.rule", "r.verdict", "r.labels")
    )


def _sweep(dealt: DataFrame) -> DataFrame:
    """Add ``open``: the last rule at or before each row in the order of keys.

    ``dealt`` lies in ranges of ``key`` and ``tie``, numbered by ``part``. A range is swept by itself; what is open at its
    start is the last rule of the ranges before it, one row per range.
    """
    inside = Window.partitionBy("part").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        dealt.groupBy("part")
        .agg(F.max(F.when(F.col("rule").isNotNull(), F.col("key"))).alias("last"))
        .select(F.col("part").alias("p"), F.max("last").over(before).alias("carried"))
    )
    started = F.last(F.when(F.col("rule").isNotNull(), F.col("key")), ignorenulls=True).over(inside)
    return (
        dealt.withColumn("__started", started)
        .join(F.broadcast(ends), F.col("part") == F.col("p"))
        .withColumn("open", F.coalesce("__started", "carried"))
        .drop("__started", "p", "carried")
    )


def _stacks(rules: DataFrame, width: int) -> DataFrame:
    """(key, stack) of every rule: itself and all rules whose intervals hold its key, innermost first.

    Prefixes of a key are intervals around it, nested in each other, so the stack is found by the rules' own
    prefixes: one probe per cut of the key.
    """
    cuts = F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n))
    probes = rules.select("key", F.explode(cuts).alias("outer"))
    held = probes.join(
        rules.select(F.col("key").alias("outer"), F.struct("rule", "verdict", "labels").alias("held")), "outer"
    )
    return held.groupBy("key").agg(
        F.reverse(F.array_sort(F.collect_list(F.struct(F.length("outer").alias("depth"), "outer", "held")))).alias("stack")
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    url_col: str = "url",
    keep: Sequence[str] = ("page_id",),
    default: str = "allow",
) -> DataFrame:
    """Columns ``keep`` with ``host``, ``path``, ``rule`` and ``verdict`` of every row.

    A rule fits its host and all subdomains where the path starts with the rule's. The longest rule (host and path together)
    wins; of equally long ones that with more labels in its host, then a block. Urls that no rule fits, null ones and those
    without ``://`` get ``default``. Every url stands in the sweep once per ancestor of its host that has no more labels than
    some rule's, as a point among the rules' intervals; both sides are dealt by ranges of keys, and ties are spread.
    """
    width = shuffle_width(pages.sparkSession)
    url = F.col(f"`{url_col}`").cast("string")
    rows = cut_lineage(
        pages.select(
            F.monotonically_increasing_id().alias("uid"),
            F.struct(*(F.col(f"`{name}`") for name in keep)).alias("row"),
            url_host(url).alias("host"),
            url_path(url).alias("path"),
        )
    )
    prepared = cut_lineage(_prepared(rules))
    labels = F.reverse(F.split("host", r"\."))
    # No rule fits an ancestor with more labels than any rule has, however many a host is made of.
    deepest = prepared.agg(F.max("labels")).first()[0] or 1
    ancestors = F.transform(
        F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(deepest))),
        lambda n: canonical_key(F.slice(F.col("labels"), F.lit(1), n), F.col("path")),
    )
    points = (
        rows.filter((F.col("host") != "") | (F.col("path") != ""))
        .select("uid", labels.alias("labels"), "path")
        .select("uid", F.explode(ancestors).alias("key"))
        .select("key", F.xxhash64("uid").alias("tie"), "uid", F.lit(None).cast("string").alias("rule"))
    )
    starts = prepared.select(
        "key",
        F.lit(-(2**63)).cast("long").alias("tie"),
        F.lit(None).cast("long").alias("uid"),
        "rule",
    )
    dealt = cut_lineage(
        points.unionByName(starts)
        .repartitionByRange(width, "key", "tie")
        .withColumn("part", F.spark_partition_id())
    )
    stacks = cut_lineage(_stacks(prepared, width))
    at = _sweep(dealt).filter(F.col("uid").isNotNull() & F.col("open").isNotNull())
    # The rules open at a point are those of the last start's stack that have not ended before it.
    ended = F.filter("stack", lambda s: F.startswith(F.col("key"), s["outer"]))
    best = (
        # One rule may be open at most of the points.
        attach(at.select("uid", "key", "open"), stacks.withColumnRenamed("key", "open"), ["open"], "inner")
        .select("uid", F.explode(ended).alias("s"))
        .groupBy("uid")
        .agg(
            F.max_by(
                F.struct("s.held.rule", "s.held.verdict"),
                F.struct(F.length("s.held.rule"), F.col("s.held.labels"), F.col("s.held.verdict")),
            ).alias("best")
        )
        .withColumnRenamed("uid", "u")
    )
    return rows.join(best, F.col("uid") == F.col("u"), "left").select(
        "row.*",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )

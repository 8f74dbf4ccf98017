"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach

# Nodes whose smallest neighbours are sent to every task instead of being joined, and links of one node that a task may get.
SENT_NODES = 100_000
HOT_LINKS = 100_000


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Hang the neighbours of every node on the smallest of them and itself.

    ``edges`` (u, v) hold v < u. With ``both``, neighbours above a node are moved, else those below it.
    """
    if both:
        links = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        links = edges
    least = cut_lineage(links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    # The centre of a large component has most of its links.
    joined = attach(links, least, ["u"], "inner", max_rows=SENT_NODES, hot_rows=HOT_LINKS)
    if both:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (u, v); root is the smallest node reachable.

    Links may repeat, run either way or join a node to itself (such a node alone gets no row). The rounds grow with
    the logarithm of the longest path; each is kept in the shared folder.
    """
    edges = cut_lineage(
        links.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = None
    while True:
        edges = cut_lineage(_star(_star(edges, both=True), both=False))
        # A sum of hashes tells whether any edge has changed, without keeping both rounds to compare.
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now

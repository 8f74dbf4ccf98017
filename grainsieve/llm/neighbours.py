"""Approximate nearest neighbours over partitions learned from a neighbour graph."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach

# The index is fitted on so many vectors at most, those with the smallest seeded hashes.
SAMPLE = 4096
# The next so many by hash are held out of the fit; they tell how many partitions have to be probed.
HELD_OUT = 1024
# Vectors of a partition, if the sample allows: no partition is learned from fewer than LEARNED sample vectors.
PARTITION_ROWS = 256
LEARNED = 64
# Vectors of one partition, and queries sent there, that meet in one task.
CHUNK = 8192
QUERIES = 4096
GRAPH_NEIGHBOURS = 10
# Share of the held-out vectors' nearest sample vectors that the probed partitions have to hold, on all levels together.
COVERAGE = 0.93
# A partition of more vectors is divided once more, by a router of its own.
DIVIDED_ROWS = 65_536
SEED = 7


def valid_vector(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass(frozen=True)
class Router:
    """A small network from a vector to the probability of each partition, and how many to probe."""

    mean: np.ndarray
    scale: float
    hidden: tuple[np.ndarray, np.ndarray]
    out: tuple[np.ndarray, np.ndarray]
    probes: int

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        x = (vectors - self.mean) / self.scale
        return np.maximum(x @ self.hidden[0] + self.hidden[1], 0) @ self.out[0] + self.out[1]

    def best(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` most probable partitions of each vector, best first."""
        return np.argsort(-self.scores(vectors), axis=1, kind="stable")[:, :count]


def _nearest(vectors: np.ndarray, count: int) -> np.ndarray:
    """Indices of each vector's ``count`` nearest others by inner product, nearest first."""
    near = []
    for at in range(0, len(vectors), 512):
        dots = vectors[at : at + 512] @ vectors.T
        dots[np.arange(len(dots)), at + np.arange(len(dots))] = -np.inf
        part = np.argpartition(-dots, min(count, dots.shape[1] - 1) - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(dots, part, axis=1), axis=1, kind="stable")
        near.append(np.take_along_axis(part, order, axis=1))
    return np.concatenate(near)


def partition_graph(vectors: np.ndarray, near: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Parts of nearly equal size with few graph edges between them.

    Halving along the main direction gives a balanced start; then every node in turn may go where most of its neighbours are,
    as long as no part grows beyond a tenth above its share.
    """
    label = np.zeros(len(vectors), dtype=np.int64)
    groups = [(np.arange(len(vectors)), 0, parts)]
    while groups:
        rows, first, count = groups.pop()
        label[rows] = first
        if count < 2 or len(rows) < 2:
            continue
        centred = vectors[rows] - vectors[rows].mean(axis=0)
        direction = np.linalg.svd(centred.T @ centred)[0][:, 0]
        order = rows[np.argsort(centred @ direction, kind="stable")]
        left = count // 2
        cut = len(rows) * left // count
        groups += [(order[:cut], first, left), (order[cut:], first + left, count - left)]
    source = np.repeat(np.arange(len(vectors)), near.shape[1])
    edges = np.concatenate([np.stack([source, near.ravel()]), np.stack([near.ravel(), source])], axis=1)
    edges = edges[:, np.argsort(edges[0], kind="stable")]
    starts = np.searchsorted(edges[0], np.arange(len(vectors) + 1))
    sizes, most = np.bincount(label, minlength=parts), int(1.1 * len(vectors) / parts) + 1
    for _ in range(rounds):
        moved = 0
        for node in range(len(vectors)):
            votes = np.bincount(label[edges[1, starts[node] : starts[node + 1]]], minlength=parts)
            votes[(sizes >= most) & (np.arange(parts) != label[node])] = -1
            to = int(votes.argmax())
            if votes[to] > votes[label[node]]:
                sizes[label[node]] -= 1
                sizes[to] += 1
                label[node] = to
                moved += 1
        if not moved:
            break
    return label


def train_router(vectors: np.ndarray, label: np.ndarray, parts: int, near: np.ndarray, seed: int = SEED) -> Router:
    """Fit the network by gradient steps over the whole sample; all partitions are probed until ``with_probes`` says fewer."""
    random = np.random.default_rng(seed)
    width = 128
    mean, scale = vectors.mean(axis=0), float(vectors.std()) or 1.0
    x = (vectors - mean) / scale
    # A vector belongs a little to the parts of its neighbours as well.
    soft = np.zeros((len(x), parts))
    np.add.at(soft, (np.repeat(np.arange(len(x)), near.shape[1]), label[near].ravel()), 0.5 / near.shape[1])
    soft[np.arange(len(x)), label] += 0.5
    weights = [
        random.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], width)),
        np.zeros(width),
        random.normal(0, np.sqrt(1 / width), (width, parts)),
        np.zeros(parts),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, 151):
        inner = np.maximum(x @ weights[0] + weights[1], 0)
        logits = inner @ weights[2] + weights[3]
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        wrong = (chance - soft) / len(x)
        back = (wrong @ weights[2].T) * (inner > 0)
        slopes = [x.T @ back, back.sum(axis=0), inner.T @ wrong, wrong.sum(axis=0)]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            corrected = np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8
            weights[i] = weights[i] - 0.01 * first[i] / (1 - 0.9**step) / corrected
    return Router(mean, scale, (weights[0], weights[1]), (weights[2], weights[3]), parts)


def with_probes(router: Router, vectors: np.ndarray, held: np.ndarray, k: int, coverage: float) -> Router:
    """The router with as many probes as find ``coverage`` of the ``k`` nearest of ``vectors`` for held-out ones."""
    parts = router.probes
    dots = held @ vectors.T
    near = np.argpartition(-dots, k - 1, axis=1)[:, :k]
    place = np.argsort(router.best(held, parts), axis=1)
    wanted = place[np.arange(len(held))[:, None], router.best(vectors, 1)[near, 0]]
    covered = [(wanted < probes).mean() for probes in range(1, parts + 1)]
    probes = next((i for i, share in enumerate(covered, 1) if share >= coverage), parts)
    return replace(router, probes=probes)


def fit_matrix(matrix: np.ndarray, rows: int, neighbours: int, coverage: float) -> Router | None:
    """Router from the sample ``matrix`` of ``rows`` vectors; None if it is too small for two partitions."""
    if len(matrix) < 2 * LEARNED:
        return None
    # A fifth of a small sample is held out.
    cut = min(SAMPLE, len(matrix) * 4 // 5)
    matrix, held = matrix[:cut], matrix[cut:]
    parts = max(2, min(-(-rows // PARTITION_ROWS), len(matrix) // LEARNED))
    near = _nearest(matrix, min(neighbours, len(matrix) - 1))
    label = partition_graph(matrix, near[:, :GRAPH_NEIGHBOURS], parts)
    router = train_router(matrix, label, parts, near)
    # The nearest of all rows are about as far away as so many of the sample.
    return with_probes(router, matrix, held, max(1, round(neighbours * cut / rows)), coverage)


def _levels(rows: int) -> int:
    """Two if the partitions of one level would be too large."""
    return 1 + (rows / (SAMPLE // LEARNED) > DIVIDED_ROWS)


def fit_router(vectors: DataFrame, rows: int, neighbours: int = 20) -> Router | None:
    """Router over ``vectors`` (uid, vector), from a bounded sample; None if there are too few for two partitions."""
    sample = (
        vectors.orderBy(F.xxhash64(F.lit(SEED), "uid"), "uid").limit(SAMPLE + HELD_OUT).select("vector").toArrow()
    )
    if not sample.num_rows:
        return None
    matrix = np.stack(sample.column("vector").to_numpy()).astype(np.float64)
    return fit_matrix(matrix, rows, neighbours, COVERAGE ** (1 / _levels(rows)))


def _divided(placed: DataFrame, routed: DataFrame, neighbours: int) -> tuple[DataFrame, DataFrame]:
    """Both tables (uid, id, vector, part) with the partitions of more than ``DIVIDED_ROWS`` divided by routers of their own.

    Each is fitted by a task, from a bounded sample of its partition. A query sent to such a partition goes on to its most probable parts.
    """
    spark = placed.sparkSession
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > DIVIDED_ROWS).collect()
    if not counts:
        return placed, routed
    bounds = [(r["part"], r["n"], int(min(1.0, (SAMPLE + HELD_OUT) / r["n"]) * 2**31)) for r in counts]
    large = F.broadcast(spark.createDataFrame(bounds, "part int, n long, bound long"))
    drawn = F.pmod(F.xxhash64(F.lit(SEED + 1), "uid"), F.lit(2**31))
    sample = placed.join(large, "part").filter(drawn < F.col("bound")).select("part", "n", "uid", "vector")

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        matrix = np.stack(table.column("vector").to_numpy()).astype(np.float64)
        router = fit_matrix(matrix, table.column("n")[0].as_py(), neighbours, COVERAGE**0.5)
        return pa.table({"part": table.column("part")[:1], "router": pa.array([pickle.dumps(router)], pa.binary())})

    fitted = sample.groupBy("part").applyInArrow(fit, "part int, router binary").collect()
    shared = spark.sparkContext.broadcast({r["part"]: pickle.loads(r["router"]) for r in fitted})

    def route(probe: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                part = batch.column("part").to_numpy()
                cells: list[np.ndarray] = [np.array([p], dtype=np.int32) for p in part.tolist()]
                for one in np.unique(part).tolist():
                    router = shared.value.get(one)
                    if router is not None:
                        at = np.flatnonzero(part == one)
                        own = batch.column("vector").take(pa.array(at))
                        best = router.best(np.stack(own.to_numpy(zero_copy_only=False)), router.probes if probe else 1)
                        # Numbers of divided partitions are not used by any whole one.
                        numbers = (1 + one) * (SAMPLE // LEARNED + 1) + best
                        for i, row in zip(at.tolist(), numbers.astype(np.int32)):
                            cells[i] = row
                columns = [batch.column(name) for name in ("uid", "id", "vector")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cells, pa.list_(pa.int32()))], names=["uid", "id", "vector", "parts"])

        return run

    shape = "uid long, id long, vector array<double>, parts array<int>"
    return tuple(
        df.mapInArrow(route(probe), shape).select("uid", "id", "vector", F.explode("parts").alias("part"))
        for df, probe in ((placed, False), (routed, True))
    )


def _search(queries: pa.Table, base: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest of ``base`` for each query: (uid of the query, row of ``base``, score), the query's own row left out.

    Equal vectors are searched once and then stand for their smallest ids, those without id last, so that ties are decided by id alone.
    """
    ids = base.column("id")
    missing = np.asarray(ids.is_null())
    known, own_rows = ids.fill_null(0).to_numpy(), base.column("uid").to_numpy()
    order = np.lexsort((own_rows, known, missing))
    uids = own_rows[order]
    vectors = np.stack(base.column("vector").to_numpy())[order].astype(np.float64) + 0.0
    _, first, group = np.unique(
        vectors.view(np.dtype((np.void, vectors.shape[1] * 8))).ravel(), return_index=True, return_inverse=True
    )
    by_group = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[by_group], np.arange(len(first) + 1))
    different = vectors[first]
    out: tuple[list, list, list] = ([], [], [])
    own = queries.column("query_uid").to_numpy()
    asked = np.stack(queries.column("query").to_numpy()).astype(np.float64)
    for at in range(0, len(asked), 256):
        dots = asked[at : at + 256] @ different.T
        for i, row in enumerate(dots):
            query = asked[at + i]
            if len(row) > k + 1:
                edge = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                near = np.flatnonzero(row >= edge - 1e-9 * (1 + abs(edge)))
            else:
                near = np.arange(len(row))
            # Scores are taken anew in one fixed order of adding, so that equal vectors score equally.
            exact = (different[near] * query).sum(axis=1)
            members = [by_group[starts[g] : min(starts[g + 1], starts[g] + k + 1)] for g in near.tolist()]
            found = np.concatenate(members)
            score = np.repeat(exact, [len(m) for m in members])
            keep = uids[found] != own[at + i]
            found, score = found[keep], score[keep]
            best = np.lexsort((found, -score))[:k]
            out[0].append(np.full(len(best), own[at + i]))
            out[1].append(order[found[best]])
            out[2].append(score[best])
    return tuple(np.concatenate(x) for x in out)


def nearest(
    vectors: DataFrame,
    queries: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    router: Router | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` largest inner products for rows where ``queries`` holds.

    Every valid vector is indexed in its most probable partition; a query is sent to the router's ``probes`` most probable ones,
    where it is compared with all vectors in double precision. Only a table too small for two partitions is searched whole. Ties go to
    the smaller id. A partition that has grown large is divided once more by a router of its own. Every row stands for itself: of repeated rows each is asked, each has its list, and each is a candidate of the others;
    a row without id is a candidate as well, behind those equally near. Vectors that are null, zero or hold null or non-finite components take no
    part; of vectors of several lengths, those of the most common one (the shortest of equally common) do. A large partition is searched
    in chunks, by slices of its queries, so no task meets more than ``CHUNK`` vectors and ``QUERIES`` queries or so.
    """
    spark = vectors.sparkSession
    column = F.col(f"`{vector_col}`")
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(queries, F.lit(False)).alias("asked"),
        column.cast(T.ArrayType(T.DoubleType())).alias("vector"),
    ).filter(valid_vector(F.col("vector")))
    rows = cut_lineage(rows)
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("vector") == common["d"])
    if router is None:
        router = fit_router(rows.select("uid", "vector"), common["n"])
    if router is None:
        placed = rows.withColumn("part", F.lit(0))
        routed = rows.filter("asked").withColumn("part", F.lit(0))
    else:
        shared = spark.sparkContext.broadcast(router)

        def route(count: int):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    matrix = np.stack(batch.column("vector").to_numpy(zero_copy_only=False))
                    best = shared.value.best(matrix, count).astype(np.int32)
                    parts = pa.array(list(best), pa.list_(pa.int32()))
                    columns = [batch.column(name) for name in ("uid", "id", "vector")]
                    yield pa.RecordBatch.from_arrays([*columns, parts], names=["uid", "id", "vector", "parts"])

            return run

        shape = "uid long, id long, vector array<double>, parts array<int>"
        slim = rows.select("uid", "id", "vector", "asked")
        placed = slim.drop("asked").mapInArrow(route(1), shape)
        routed = slim.filter("asked").drop("asked").mapInArrow(route(router.probes), shape)
        placed, routed = (df.select("uid", "id", "vector", F.explode("parts").alias("part")) for df in (placed, routed))
    placed = cut_lineage(placed.select("uid", "id", "vector", "part"))
    routed = cut_lineage(routed.select("uid", "id", "vector", "part"))
    divided = _divided(placed, routed, k)
    if divided[0] is not placed:
        placed, routed = map(cut_lineage, divided)

    def pieces(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    sizes = cut_lineage(pieces(placed, CHUNK, "chunks").join(pieces(routed, QUERIES, "slices"), "part"))

    def dealt(count: str) -> Column:
        return F.pmod(F.xxhash64("uid"), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    base = attach(placed, sizes, ["part"], "inner").select(
        "part", dealt("chunks").alias("chunk"), every("slices").alias("slice"), "uid", "id", "vector"
    )
    asked = attach(routed, sizes, ["part"], "inner").select(
        F.col("part").alias("p"),
        every("chunks").alias("c"),
        dealt("slices").alias("s"),
        F.col("uid").alias("query_uid"),
        F.col("id").alias("query_id"),
        F.col("vector").alias("query"),
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = not (left.num_rows and right.num_rows)
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        query, found, score = none if empty else _search(left, right, k)
        names = dict(zip(left.column("query_uid").to_pylist(), left.column("query_id").to_pylist()))
        columns = {
            "query_uid": pa.array(query),
            "query_id": pa.array([names[uid] for uid in query.tolist()], pa.int64()),
            "uid": right.column("uid").take(pa.array(found)),
            "vec_id": right.column("id").take(pa.array(found)),
            "score": pa.array(score),
        }
        return pa.table(columns)

    found = asked.groupBy("p", "c", "s").cogroup(base.groupBy("part", "chunk", "slice")).applyInArrow(
        search, "query_uid long, query_id long, uid long, vec_id long, score double"
    )
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

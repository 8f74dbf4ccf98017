import numpy as np
import pytest
from pyspark.sql import functions as F

from grainsieve.llm import neighbours
from grainsieve.llm.neighbours import nearest


def _exact(rows, k, asked):
    """Lists of every asked row (not of every id), by comparing it with all other rows."""
    matrix = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for own, (i, v) in enumerate(rows):
        if i is not None and asked(i):
            score = (matrix * np.array(v, dtype=np.float64)).sum(axis=1)
            others = [j for j in range(len(rows)) if j != own]
            others.sort(key=lambda j: (-score[j], rows[j][0] is None, rows[j][0]))
            out.setdefault(i, []).append([(rows[j][0], score[j]) for j in others[:k]])
    return out


def _lists(df):
    """Per query id, its rows by rank: as many of each rank as there are rows with the id."""
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], {}).setdefault(r["rank"], []).append((r["vec_id"], r["score"]))
    return {q: [sorted(own[rank], key=str) for rank in range(1, len(own) + 1)] for q, own in out.items()}


def _ranks(exact):
    return {q: [sorted(own, key=str) for own in zip(*lists)] for q, lists in exact.items()}


def _recall(rows, found, exact):
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in own[0]}) for q, own in exact.items())
    return hits / sum(len(own[0]) for own in exact.values())


def _found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_small_tables_are_searched_whole(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (None, [1.0, 1.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [0.5, -1.0]), (20, [0.0, -3.0]),
    ]
    odd = [(5, None), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [inf, 1.0]), (9, [nan, 1.0]), (10, []), (40, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(
        [(i, v, "x", "y") for i, v in rows + odd], "vec_id long, embedding array<float>, id string, part string"
    )
    found = _found(nearest(df, F.col("vec_id") % 20 == 0, k=3))
    assert found == {q: own[0] for q, own in _exact(rows, 3, lambda i: i % 20 == 0).items()}
    assert _found(nearest(df, F.col("vec_id") == 0, k=50))[0] == _exact(rows, 50, lambda i: i == 0)[0][0]
    assert nearest(df.filter("false"), F.lit(True)).count() == 0


def test_repeated_rows_and_ids(spark):
    """Every row has its own list, in which all other rows stand, those with its own id too."""
    rows = [(20 * (i % 2), [1.0, float(i % 3)]) for i in range(9)] + [(7, [3.0, 3.0])] * 5 + [(None, [3.0, 3.0])] * 2
    rows += [(100 + i, [0.1 * i, 0.2]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for k in (4, 20, 99):
        assert _lists(nearest(df, F.col("vec_id") % 20 == 0, k=k)) == _ranks(_exact(rows, k, lambda i: i % 20 == 0))


def test_groups_are_bounded(spark, monkeypatch):
    """Chunks and slices of a few rows give the same lists as whole partitions; no task meets more than they hold."""
    random = np.random.default_rng(8)
    rows = [(i, random.normal(size=6).round(1).tolist()) for i in range(60)] + [(20, [1.0] * 6)] * 50
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = _lists(nearest(df, F.col("vec_id") % 20 == 0))
    assert whole == _ranks(_exact(rows, 20, lambda i: i % 20 == 0))
    monkeypatch.setattr(neighbours, "CHUNK", 30)
    monkeypatch.setattr(neighbours, "QUERIES", 10)
    assert _lists(nearest(df, F.col("vec_id") % 20 == 0)) == whole


def test_router_finds_most_and_scores_exactly(spark):
    random = np.random.default_rng(5)
    centres = random.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.6 * random.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    # A third are the same vector.
    rows += [(3000 + i, rows[7][1]) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = _found(nearest(df, F.col("vec_id") % 20 == 0))
    exact = _exact(rows, 20, lambda i: i % 20 == 0)
    assert set(found) == set(exact)
    assert _recall(rows, found, exact) >= 0.9
    score = {q: dict(_exact(rows, 5000, lambda i, q=q: i == q)[q][0]) for q in list(exact)[:20]}
    for q in score:
        assert len(found[q]) == 20
        assert all(score[q][i] == s for i, s in found[q])
        assert found[q] == sorted(found[q], key=lambda x: (-x[1], x[0]))


def test_large_partitions_are_divided(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "DIVIDED_ROWS", 400)
    monkeypatch.setattr(neighbours, "PARTITION_ROWS", 600)
    random = np.random.default_rng(6)
    centres = 3 * random.normal(size=(16, 12))
    rows = [(i, (centres[i % 16] + 0.5 * random.normal(size=12)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found, exact = _found(nearest(df, F.col("vec_id") % 20 == 0)), _exact(rows, 20, lambda i: i % 20 == 0)
    assert _recall(rows, found, exact) >= 0.9
    assert all(len(own) == 20 and len({i for i, _ in own}) == 20 for own in found.values())


@pytest.mark.parametrize("table", ["sf0.01", "sf0.1", "check_s"])
def test_recall_through_the_router(spark, table):
    df = spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    router = neighbours.fit_router(df.select(F.col("vec_id").alias("uid"), F.col("embedding").cast("array<double>").alias("vector")), len(rows))
    matrix = np.array([v for _, v in rows], dtype=np.float64)
    asked = [n for n, (i, _) in enumerate(rows) if i % 20 == 0]
    sizes = np.bincount(router.best(matrix, 1)[:, 0], minlength=len(router.out[1]))
    compared = sizes[router.best(matrix[asked], router.probes)].sum() / len(asked) / len(rows)
    found, exact = _found(nearest(df, F.col("vec_id") % 20 == 0)), _exact(rows, 20, lambda i: i % 20 == 0)
    recall = _recall(rows, found, exact)
    print(f"{table}: {len(rows)} vectors, {len(sizes)} parts, {router.probes} probed, {compared:.2f} compared, recall {recall:.3f}")
    assert len(sizes) >= 2 and recall >= 0.9


def test_parts_are_balanced():
    random = np.random.default_rng(2)
    matrix = random.normal(size=(1000, 8))
    near = neighbours._nearest(matrix, 10)
    label = neighbours.partition_graph(matrix, near, 7)
    sizes = np.bincount(label, minlength=7)
    assert sizes.max() <= 1.1 * 1000 / 7 + 2
    cut = (label[near] != label[:, None]).mean()
    assert cut < 0.6

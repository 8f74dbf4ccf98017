import random

import numpy as np
import pytest

from grainsieve.llm import simhash
from tests.llm.brute import fingerprint, groups_of, linked_groups
from tests.llm.cases import ROWS, clashing, documents, empty


def _expected(rows):
    prints = [fingerprint(text) for _, text in rows]
    least = {}
    for group, members in groups_of(linked_groups(prints, simhash.MAX_BITS)).items():
        least[group] = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
    groups = linked_groups(prints, simhash.MAX_BITS)
    return sorted(((r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, groups)), key=repr)


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edge_rows(spark):
    rows = [(r[0], r[1]) for r in ROWS]
    assert _found(simhash.near_duplicates(clashing(spark, documents(spark)))) == _expected(rows)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_documents_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert _found(simhash.near_duplicates(docs)) == _expected(rows)


def _prints(count, seed):
    """Fingerprints in balls and chains around a few centres."""
    rng = random.Random(seed)
    out = [0, 2**64 - 1]
    while len(out) < count:
        p = rng.choice(out) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 3)):
            p ^= 1 << rng.randrange(64)
        out.append(p)
    return sorted(set(out))


@pytest.mark.parametrize("chunk", [4096, 3])
@pytest.mark.parametrize("bits,segments", [(2, 7), (2, 4), (3, 5), (0, 3)])
def test_links_join_all_near_pairs(spark, monkeypatch, chunk, bits, segments):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    prints = _prints(400, bits * 10 + segments)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    links = simhash.fingerprint_links(df, bits, segments).collect()
    number = {int(np.uint64(p).view(np.int64)): i for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in links:
        root[find(number[u])] = find(number[v])
    groups = linked_groups(prints, bits)
    assert sorted(map(sorted, groups_of([find(i) for i in range(len(prints))]).values())) == sorted(
        map(sorted, groups_of(groups).values())
    )


def test_one_of_each_stays(spark):
    docs = documents(spark)
    kept = simhash.keep_one_of_each(clashing(spark, docs))
    assert set(docs.columns) <= set(kept.columns)
    groups = linked_groups([fingerprint(r[1]) for r in ROWS], 2)
    assert kept.count() == len(set(groups))
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(
        (min((ROWS[i][0] for i in members if ROWS[i][0] is not None), default=None) for members in groups_of(groups).values()), key=repr
    )


def test_long_chains_are_one_component(spark):
    from grainsieve.llm.components import components

    edges = [(i, i + 1) for i in range(300)] + [(500, 500), (601, 600), (600, 602)]
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots)
    assert {roots[i] for i in range(301)} == {0}
    assert [roots[i] for i in (600, 601, 602)] == [600] * 3 and 500 not in roots


def test_hot_centres_are_spread(spark, monkeypatch):
    """Stars whose centres have most links, beyond what may be sent to every task."""
    from grainsieve.llm import components as module

    monkeypatch.setattr(module, "SENT_NODES", 0)
    monkeypatch.setattr(module, "HOT_LINKS", 20)
    edges = [(1, i) for i in range(2, 150)] + [(200, i) for i in range(201, 300)] + [(400, 401), (299, 402)]
    found = module.components(spark.createDataFrame(edges, "u long, v long").repartition(6)).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots) == 149 + 101 + 2
    assert {roots[i] for i in range(1, 150)} == {1} and {roots[i] for i in (200, 250, 299, 402)} == {200} and roots[401] == 400

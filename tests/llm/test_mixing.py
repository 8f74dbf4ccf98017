from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grainsieve.llm import mixing
from tests.llm.cases import ROWS, clashing, documents, empty


def _targets(sizes):
    """Sources in order of code points, null last; shares by weight, what exceeds a cap dealt again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, list(order), sum(sizes.values())
    while open_:
        rate = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * rate > 3 * sizes[s]]
        if not over:
            target |= {s: weight[s] * rate for s in open_}
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def _check(rows, docs, tolerance):
    size = {}
    sizes, source_of = Counter(), defaultdict(list)
    for doc_id, text, source in docs:
        n = len([w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w])
        size[doc_id, source] = n
        sizes[source] += n
        source_of[doc_id].append(source)
    targets, taken = _targets(sizes), Counter()
    assert len(rows) == len(docs)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        fits = [s for s in source_of[r["doc_id"]] if sizes[s] == r["source_size"] and abs(targets[s] - r["target"]) < 1e-6]
        assert fits
        taken[fits[0]] += r["taken"]
    for source, target in targets.items():
        assert taken[source] <= target + 1
        assert target - taken[source] <= tolerance, source


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    found = mixing.mix_report(docs).collect()
    _check(found, rows, 60)
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    copies = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    assert copies == Counter({r["doc_id"]: r["taken"] // r["size"] for r in found if r["taken"]})


def test_edge_rows(spark):
    docs = clashing(spark, documents(spark))
    found = mixing.mix_report(docs).collect()
    _check(found, [(r[0], r[1], r[3]) for r in ROWS], 40_010)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["taken"] // r["size"] for r in found if r["size"])
    assert mixing.mix_report(empty(spark)).count() == 0
    assert mixing.mix(empty(spark)).count() == 0


def test_repeated_rows_meet_their_target(spark):
    """300 rows equal throughout, of ten words each: as many are taken as the target asks for, within one text."""
    rows = [(7, "one two three four five six seven eight nine ten", "en", "a", 1)] * 300
    rows += [(1000 + i, "x " * (1 + i % 3), "en", "b", 1) for i in range(500)]
    rows += [(None, None, None, None, None)] * 40 + [(8, "y y y", None, None, 2)] * 200
    docs = documents(spark, rows).repartition(5)
    found = mixing.mix_report(docs).collect()
    _check(found, [(r[0], r[1], r[3]) for r in rows], 10)
    equal = Counter(r["taken"] for r in found if r["doc_id"] == 7)
    assert sum(equal.values()) == 300 and len(equal) <= 2
    mixed = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    wanted = Counter()
    for r in found:
        if r["taken"]:
            wanted[r["doc_id"]] += r["taken"] // r["size"]
    assert mixed == wanted


def test_texts_without_words(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert {(r["doc_id"], r["target"], r["taken"]) for r in mixing.mix_report(df).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1, max_size=10), st.integers(0, 1500))
def test_budget_is_met_as_nearly_as_the_leftover_allows(histogram, budget):
    lengths, counts = np.array(list(histogram)), np.array(list(histogram.values()))
    taken = mixing.fit_budget(lengths, counts, budget)
    assert (taken >= 0).all() and (taken <= counts).all()
    total = int((lengths * taken).sum())
    assert total <= budget
    # Nothing that is left would still fit.
    spare = lengths[(taken < counts) & (lengths > 0)]
    assert not len(spare) or total == budget or budget - total < spare.min()


def test_exact_subset_is_found(monkeypatch):
    assert (mixing.fit_budget(np.array([7, 5]), np.array([3, 3]), 22) * [7, 5]).sum() == 22
    monkeypatch.setattr(mixing, "KNAPSACK", 100)
    lengths = np.arange(1, 200)
    assert (mixing.fit_budget(lengths, np.full(199, 50), 500_001) * lengths).sum() == 500_001


@pytest.mark.parametrize("weights", [(1.0,), (5.0, 1.0)])
def test_other_weights(spark, sf_dir, weights):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix_report(docs, weights).collect()
    sizes = {r["source_size"]: r["target"] for r in rows}
    assert sum(r["taken"] for r in rows) <= sum(r["size"] for r in rows)
    assert len(sizes) > 1

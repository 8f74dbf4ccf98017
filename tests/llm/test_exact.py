import hashlib
from collections import Counter, defaultdict

import pytest

from checks.compare import connect, difference
from grainsieve.llm import exact
from grainsieve.llm.oracles import ORACLES
from grainsieve.llm.queries import QUERIES
from tests.llm.cases import ROWS, clashing, documents, empty


def _check(rows, docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[text or ""].append(doc_id)
    expected, kept = Counter(), Counter()
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            expected[i, best, len(ids), sha] += 1
        kept[best, sha] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == expected
    assert Counter((r["doc_id"], r["text_sha256"]) for r in rows if r["kept"]) == kept


def test_edge_rows(spark):
    docs = clashing(spark, documents(spark))
    _check(exact.duplicate_report(docs).collect(), [(r[0], r[1]) for r in ROWS])
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r["text"] or "" for r in kept.collect()) == Counter({r[1] or "" for r in ROWS})
    assert exact.duplicate_report(empty(spark)).count() == 0
    assert exact.drop_copies(empty(spark)).count() == 0


def test_texts_that_differ_late(spark):
    base = "ab" * 5000
    texts = [base[:n] + x for n in (0, 10, 63, 64, 65, 575, 576, 577, 4671, 4672, 4673, 9999) for x in ("", "x", "y", "x")]
    texts += [base[:i] + "é" + base[i + 2 :] for i in range(0, 9000, 997)] * 2
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _check(exact.duplicate_report(df).collect(), rows)


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(exact, "BROADCAST_BYTES", 0)
    rows = [(i, "the same text in many rows " * 9 if i % 3 else f"own {i % 50}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    _check(exact.duplicate_report(df).collect(), rows)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_oracle(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    assert difference(QUERIES["op9_exact"](spark, sf_dir), connect(sf_dir), ORACLES["op9_exact"]) is None

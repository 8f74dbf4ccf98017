import hashlib
import random
import zlib

import numpy as np
import pytest

from grainsieve.llm import periods
from grainsieve.llm.ntt import squared_differences_vanish
from grainsieve.llm.queries import op12_periods
from tests.llm.cases import ROWS, clashing, documents, empty


def _runs(words, least=12):
    """All runs (start, length, period), by comparing every word with those behind it."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        at = 0
        while at < n - q:
            if words[at] != words[at + q]:
                at += 1
                continue
            stop = at
            while stop < n - q and words[stop] == words[stop + q]:
                stop += 1
            if stop + q - at >= max(least, 2 * q):
                found.setdefault((at, stop + q - at), q)
            at = stop
    return sorted((s, length, q) for (s, length), q in found.items())


def _digest(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(listed).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def _same(found, rows):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted((_digest(*row) for row in rows), key=key)


def test_runs_like_brute_force():
    random.seed(5)
    for _ in range(150):
        texts = []
        for _ in range(random.randint(1, 6)):
            n, kinds = random.randint(0, 130), random.choice([1, 2, 3, 6, 60])
            text = [random.randrange(kinds) for _ in range(n)]
            for _ in range(random.randint(0, 3) if n > 4 else 0):
                a, p = random.randrange(n), random.randint(1, n)
                for i in range(a, random.randint(a, n)):
                    text[i] = text[a + (i - a) % p]
            known: dict = {}
            texts.append(np.array([known.setdefault(x, len(known)) for x in text], dtype=np.int64))
        found = periods.runs_of(texts)
        assert [list(map(tuple, r.tolist())) for r in found] == [_runs(t.tolist()) for t in texts]


@pytest.mark.parametrize("cells", [64, 1 << 19])
def test_every_period_is_found_at_its_scale(monkeypatch, cells):
    monkeypatch.setattr(periods, "CELLS", cells)
    for q in [*range(1, 70), 127, 128, 129, 255]:
        length = max(12, 2 * q)
        text = np.concatenate([1000 + np.arange(5), np.arange(length) % q, 2000 + np.arange(3)])
        assert periods.runs_of([text])[0].tolist() == [[5, length, q]]
        # One word less is no run.
        assert not len(periods.runs_of([np.concatenate([text[: 5 + length - 1], [999]])])[0])


def test_differences_vanish_exactly():
    random_ = np.random.default_rng(2)
    for top in (3, 10**4, 10**7):
        blocks = random_.integers(0, top, (20, 8))
        windows = random_.integers(0, top, (20, 23))
        windows[::2, 4:12] = blocks[::2]
        windows[1, 3:11] = blocks[1] + (np.arange(8) == 5)
        found = squared_differences_vanish(blocks, windows, 16)
        same = np.array([[(w[k : k + 8] == b).all() for k in range(16)] for b, w in zip(blocks, windows)])
        assert (found == same).all() and found[::2, 4].all()


def test_long_periodic_texts():
    text = np.concatenate([np.zeros(30_000, dtype=np.int64), 1 + np.arange(30_000) % 7001])
    assert periods.runs_of([text])[0].tolist() == [[0, 30_000, 1], [30_000, 30_000, 7001]]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = op12_periods(spark, sf_dir).collect()
    _same(found, docs)
    assert sum(r["n_runs"] > 0 for r in found) > len(docs) // 20


def test_edge_rows(spark):
    rows = [r for r in ROWS if r[1] is None or len(r[1]) < 10**6 and not r[1].startswith("word0")]
    rows += [(70 + i, "a b " * (5 + i) + "c", "en", "a", 0) for i in range(6)] + [(None, "z " * 40, None, None, None)]
    found = periods.run_report(periods.periodic_runs(clashing(spark, documents(spark, rows)), prepare=periods.plant))
    _same(found.collect(), [r[:2] for r in rows])
    assert periods.periodic_runs(empty(spark)).count() == 0


def test_collapsed_text(spark):
    docs = documents(spark, [(1, "x " + "a b c " * 5 + "y", None, None, None), (2, None, None, None, None)])
    found = {r["doc_id"]: r for r in periods.periodic_runs(docs, keep_text=True).collect()}
    assert found[1]["collapsed"] == "x a b c y" and [tuple(r) for r in found[1]["runs"]] == [(1, 15, 3)]
    assert found[2]["collapsed"] == "" and found[2]["runs"] == []

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grainsieve.llm import sais, suffixes
from tests.llm.brute import repeated_bytes
from tests.llm.cases import ROWS, clashing, documents, empty


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=80) | st.text("ab", max_size=80).map(str.encode), st.sampled_from([2, 1024]))
def test_suffix_array(data, buckets):
    text = np.frombuffer(data, dtype=np.uint8)
    before, sais.MOST_BUCKETS = sais.MOST_BUCKETS, buckets
    try:
        order = sais.suffix_array(text).tolist()
    finally:
        sais.MOST_BUCKETS = before
    assert order == sorted(range(len(data)), key=lambda i: data[i:])
    if len(data) > 1:
        common = sais.shared_prefixes(text, np.array(order), 9)
        for a, b in zip(order, order[1:]):
            left, right, n = data[a:], data[b:], 0
            while n < 9 and left[n : n + 1] == right[n : n + 1] != b"":
                n += 1
            assert common[b] == n


def _expected(rows, least):
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    covered = repeated_bytes([(rows[i][0], (rows[i][1] or "").encode()) for i in order], least)
    out = {}
    for i, mask in zip(order, covered):
        text = (rows[i][1] or "").encode()
        rest = bytes(b for b, m in zip(text, mask) if not m)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(mask), np.uint8).astype(np.int8), [0]])))
        out[rows[i][0]] = (len(text), sum(mask), len(edges) // 2, hashlib.sha256(rest).hexdigest())
    return out


def _found(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def _passages(seed, count):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    shared = [" ".join(word() for _ in range(rng.randint(10, 80))) for _ in range(6)]
    rows = []
    for i in range(count):
        parts = [rng.choice(shared)[rng.randint(0, 20) :] if rng.random() < 0.5 else " ".join(word() for _ in range(40)) for _ in range(4)]
        rows.append((i, "".join(parts) + rng.choice(["", "x" * 300, "ab" * 90, parts[0]])))
    return rows + [(count, None), (count + 1, ""), (count + 2, "z" * 99), (count + 3, "z" * 100), (count + 4, "z" * 101)]


@pytest.mark.parametrize("seed,hot,sorted_bytes", [(1, 20_000, 4 << 20), (2, 3, 500), (3, 0, 1)])
def test_passages_against_brute_force(spark, monkeypatch, seed, hot, sorted_bytes):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(suffixes, "SORTED_BYTES", sorted_bytes)
    monkeypatch.setattr(suffixes, "HOT_ANCHOR", hot)
    rows = _passages(seed, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _found(suffixes.repeated_spans(df)) == _expected(rows, 100)


def test_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert _found(suffixes.repeated_spans(docs)) == _expected(rows, 100)


def test_edge_rows(spark):
    docs = clashing(spark, documents(spark))
    rows = suffixes.repeated_spans(docs, keep_text=True).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r["n_bytes"] - r["n_removed"] == len(r["kept_bytes"])
        assert hashlib.sha256(r["kept_bytes"]).hexdigest() == r["kept_sha256"]
        assert r["n_removed"] == sum(b - a for a, b in r["spans"]) and r["n_spans"] == len(r["spans"])
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[7]["n_removed"] < by_id[7]["n_bytes"]
    assert by_id[8]["n_removed"] == by_id[8]["n_bytes"]
    assert by_id[9]["spans"] == [[2, 60_000]]
    assert suffixes.repeated_spans(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_a_block_sends_a_passage_once(hot):
    texts = ["abcdefghij" * 3 + f"{i % 7} the same passage stands in every text of this block, " * 4 for i in range(300)]
    rows = pa.table({"__id": pa.array([None, *range(299)], pa.int64()), "__text": texts})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    block = pa.table({"block": pa.array([4], pa.int32()), "name": [9], "data": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
    keys = np.unique(suffixes._Runs([t.encode() for t in texts], 100).key).tobytes()
    listed = {"many": [b"" if hot else keys], "hot": [keys if hot else b""]}
    asked = pa.table({"b": pa.array([4], pa.int32()), **{k: pa.array(v, pa.binary()) for k, v in listed.items()}})
    sent = suffixes._regions(3, 100)(block, asked)
    windows = [t[i : i + 100] for t in set(texts) for i in range(len(t) - 99)]
    places = sum(suffixes._unframe(data).num_rows for data in sent.column("members") if data.is_valid)
    assert places <= len(set(windows))
    late = suffixes._sorted_shard(100)(sent)
    spans = {}
    for data in late.column("spans"):
        for s in suffixes._unframe(data).to_pylist():
            spans.setdefault(s["row"], []).append((s["begin"], s["end"]))
    found = [suffixes.merged(*map(np.array, zip(*spans[i]))) if i in spans else [] for i in range(300)]
    order = [*range(1, 300), 0]
    masks = repeated_bytes([(i, texts[row].encode()) for i, row in enumerate(order)], 100)
    for row, mask in zip(order, masks):
        assert sum(b - a for a, b in found[row]) == sum(mask)

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grainsieve.llm.packing import Capacity, Encoder, cut_points, pack, plan_bins
from grainsieve.llm.queries import tokenizer_path
from tests.llm.cases import ROWS, clashing, documents, empty


def _ids(text):
    exact = Tokenizer.from_file(tokenizer_path())
    return [*exact.encode(text or "", add_special_tokens=False).ids, 0]


def _check(rows, docs, capacity=2048):
    bins = defaultdict(list)
    for r in rows:
        assert 1 <= r["length"] <= capacity
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    expected = Counter()
    for doc_id, text in docs:
        ids = np.array(_ids(text), dtype="<u4")
        for piece, (start, length) in enumerate(cut_points(len(ids), capacity)):
            expected[doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    return len(bins)


def test_cut_points():
    assert cut_points(1, 4) == [(0, 1)]
    assert cut_points(4, 4) == [(0, 4)]
    assert cut_points(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_encoder_equals_tokenizers():
    encoder = Encoder(tokenizer_path())
    texts = [
        "", " ", "  a\n\n b", "it's we'll", "é\u00a0ß\u3000\u0130 \U0001f600\x00", "x" * 5000, "<|endoftext|> and <|endoftext", "\t\r\n" * 9,
        "1234 5.67", "\ud7ff\ue000", " " * 3000 + "a",
    ]
    for text in texts:
        assert [*encoder(text), 0] == _ids(text), text[:30]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_encoder_equals_tokenizers_on_any_text(text):
    assert [*_ENCODER(text), 0] == _ids(text)


_ENCODER = Encoder(tokenizer_path())


def test_edge_rows(spark):
    rows = pack(clashing(spark, documents(spark)), tokenizer_path()).collect()
    _check(rows, [(r[0], r[1]) for r in ROWS])
    assert pack(empty(spark), tokenizer_path()).count() == 0


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = pack(docs, tokenizer_path(), keep_ids=True).collect()
    used = _check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    total = sum(r["length"] for r in rows)
    assert used <= -(-total // 2048) * 1.02 + 1
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"]


@pytest.mark.parametrize("rule", ["norm", "dot"])
@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), min_size=1, max_size=12), st.integers(1, 60))
def test_every_constraint_holds(rule, histogram, documents_each):
    capacity = Capacity(tokens=50, documents=documents_each, cost=2600)
    lengths, counts = np.array(list(histogram)), np.array(list(histogram.values()))
    bins, numbers = defaultdict(list), defaultdict(list)
    for length, first, pieces, bin_, offset in plan_bins(lengths, counts, capacity, rule).tolist():
        for k in range(pieces):
            bins[bin_ + k].append((offset, length))
            numbers[length].append(first + k)
    assert {n: sorted(v) for n, v in numbers.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for own in bins.values():
        assert sum(n for _, n in own) <= 50 and len(own) <= documents_each and sum(n * n for _, n in own) <= 2600
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
    if documents_each >= 50:
        # No two bins that any best fit leaves half empty.
        assert sum(sum(n for _, n in own) <= 25 for own in bins.values()) <= 1


def test_a_piece_beyond_every_bin_is_refused():
    with pytest.raises(ValueError):
        plan_bins(np.array([9]), np.array([1]), Capacity(tokens=8))

import random
import re
import zlib
from collections import Counter, defaultdict

from grainsieve.llm import variants
from grainsieve.llm.queries import op13_variants
from tests.llm.cases import ROWS, clashing, documents, empty


def _near(words):
    """Words one edit apart: those equal without one letter at the same place, and those equal to one without a letter."""
    near, holes = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            rest = word[:i] + word[i + 1 :]
            holes[i, len(word), rest].add(word)
            if rest in words:
                near[word].add(rest)
                near[rest].add(word)
    for same in holes.values():
        for word in same:
            near[word] |= same - {word}
    return near


def _brute(counts):
    near, form = _near(set(counts)), {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out[word] = (form[word], root, n, len(near[word]), counts[form[word]] if form[word] else None)
    return out


def _counted(rows, planted=True):
    total = Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if planted and doc_id is not None and h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def _found(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert _found(op13_variants(spark, sf_dir)) == _brute(_counted(docs))


def test_dense_and_long_words(spark):
    random.seed(3)
    words = {"".join(random.choice("abé") for _ in range(random.randint(5, 7))) for _ in range(700)}
    words |= {"a" * k for k in range(5, 20)} | {"ab" * 3000, "ab" * 3000 + "a", "ab" * 1500 + "c" + "ab" * 1500}
    counts = {w: random.choice([3, 3, 6, 12, 24, random.randint(3, 60)]) for w in words}
    assert _found(variants.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == _brute(counts)


def test_chain_of_forms(spark):
    counts = {"abcdefghij"[:k] + "k" * (10 - k): 3 * 2**k for k in range(11)}
    found = _found(variants.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert found == _brute(counts)
    assert {r[1] for r in found.values()} == {"abcdefghij"}


def test_no_neighbours_and_empty(spark):
    found = _found(variants.spelling_variants(spark.createDataFrame([("apple", 5)], "word string, n long")))
    assert found == {"apple": (None, "apple", 5, 0, None)}
    assert variants.spelling_variants(variants.word_counts(empty(spark))).count() == 0


def test_edge_rows(spark):
    rows = [*ROWS, *((100 + i, "Straßen ÀÉÎÕÜ àéîõü naïve-wörter", None, None, None) for i in range(4))]
    docs = clashing(spark, documents(spark, rows))
    for planted in (True, False):
        counts = variants.word_counts(docs, change=variants.planted_typo if planted else None)
        want = _counted([r[:2] for r in rows], planted)
        assert {r["word"]: r["n"] for r in counts.collect()} == want


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    docs = documents(spark)
    whole = {tuple(r) for r in variants.word_counts(docs).collect()}
    monkeypatch.setattr(variants, "_HELD_WORDS", 2)
    assert {tuple(r) for r in variants.word_counts(docs).collect()} == whole

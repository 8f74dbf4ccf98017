import random
import re

import pytest
from pyspark.sql import functions as F

from grainsieve.functions import keyword_scan
from grainsieve.functions.keyword_scan import KeywordScanner, keyword_counts, within_limits
from grainsieve.functions.keywords import count_keywords, keyword_pattern

LISTS = {
    "ads": ["ab", "カナ", "abab", " a "],
    "adult": ["abab", "ab", "カナ", "カナダ", "b"],
    "discrimination": ["aカ", "ダ", "ab", "ab", ""],
    "violence": [],
}


def _counts(text):
    out = []
    for name, words in LISTS.items():
        pattern = keyword_pattern(words, name != "ads")
        # Java's code points in braces are Python's escapes.
        pattern = pattern and re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), pattern)
        out.append(len(re.findall(pattern, text)) if pattern else 0)
    return out


@pytest.mark.parametrize("step", [1, 3, 1 << 16])
def test_scanner_like_patterns(monkeypatch, step):
    monkeypatch.setattr(keyword_scan, "STEP", step)
    random.seed(4)
    scanner = KeywordScanner(list(LISTS.values()), [name != "ads" for name in LISTS])
    for _ in range(600):
        text = "".join(random.choice("abカナダー x") for _ in range(random.randint(0, 40)))
        want = _counts(text)
        assert scanner.counts(text) == want
        limits = [random.randint(0, 6) for _ in LISTS]
        within = all(n <= m for n, m in zip(scanner.counts(text, limits), limits))
        assert within == all(n <= m for n, m in zip(want, limits))


def test_columns(spark):
    texts = ["abab カナ カナダ", "", None, "ab" * 200, "ナカナ aカナ"]
    frame = spark.createDataFrame([(t,) for t in texts], "text STRING")
    found = frame.select(
        "text",
        keyword_counts(F.col("text"), LISTS).alias("one"),
        *(count_keywords(F.col("text"), words, name != "ads").alias(name) for name, words in LISTS.items()),
        within_limits(F.col("text"), LISTS, {"ads": 3, "adult": 9, "discrimination": 99, "violence": 0}).alias("kept"),
    )
    # One scan of the texts for all lists.
    alone = frame.select(keyword_counts(F.col("text"), LISTS).alias("one")).select("one.ads", "one.adult", "one.violence")
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan.lower()
    for r in found.collect():
        if r.text is None:
            assert r.one is None and r.kept is None
        else:
            counts = {name: r[name] for name in LISTS}
            assert r.one.asDict() == counts
            assert r.kept == (counts["ads"] <= 3 and counts["adult"] <= 9)


def test_stops_behind_the_limit(monkeypatch):
    monkeypatch.setattr(keyword_scan, "STEP", 100)
    scanner = KeywordScanner([["ab"]], [True])
    assert scanner.counts("ab" * 10_000) == [10_000]
    assert 3 < scanner.counts("ab" * 10_000, [3])[0] <= 50

import math
import zlib

from pyspark.sql import functions as F

from grainsieve.functions import predicates as P
from grainsieve.functions.compression import compression_ratio, compression_score


def test_known_ratios(spark):
    texts = [
        "LbdJA66Ufy4Pr6ffQEIo0DL60OL7kQl6y6ohAhqYKf3laCruuR",
        "a" * 200,
        "This is a usual sentence. This sentence should pass this judgment.",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "text STRING").select(
        F.round(compression_ratio(F.col("text")), 3).alias("ratio"),
        P.has_good_compression_ratio(0.1, 1.0).alias("wide"),
        P.has_good_compression_ratio().alias("usual"),
    )
    rows = [tuple(row) for row in frame.collect()]
    assert rows == [(1.16, False, False), (0.06, False, False), (0.924, True, False)]


def test_empty_and_missing_texts_are_rejected(spark):
    frame = spark.createDataFrame([("",), (None,)], "text STRING")
    assert frame.filter(P.has_good_compression_ratio(0.0, 100.0)).count() == 0


def test_whole_texts_against_zlib(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = documents.select("text", compression_score(F.col("text"), 0.01).alias("score"))
    for row in scored.collect():
        data = row.text.encode()
        expected = len(zlib.compress(data, level=9)) / len(data) + 0.01 * math.log(len(data))
        assert math.isclose(row.score, expected, rel_tol=1e-12)


def test_web_crawl_recipe_is_its_rules(spark, sf_dir):
    """The two recipes without SQL, against Python on every row."""
    from checks import inputs
    from checks.queries import QUERIES

    for strict, least in ((False, 0.30), (True, 0.375)):
        suffix = "_strict" if strict else ""
        without = {
            row.doc_id for row in QUERIES[f"recipe_web_crawl_native{suffix}"](spark, sf_dir).collect()
        }
        good = set()
        for row in inputs.web(spark, sf_dir).collect():
            data = row.text.encode()
            if least <= len(zlib.compress(data, level=9)) / len(data) <= 0.70:
                good.add(row.doc_id)
        found = {row.doc_id for row in QUERIES[f"recipe_web_crawl{suffix}"](spark, sf_dir).collect()}
        assert found == without & good
        assert found


def test_equal_texts_are_deflated_once(monkeypatch):
    import pyarrow as pa

    from grainsieve.functions import compression

    seen = []

    def compress(data, level):
        seen.append(data)
        return real(data, level=level)

    real = zlib.compress
    monkeypatch.setattr(compression.zlib, "compress", compress)
    long = b"x" * (compression.KEPT_LENGTH + 1)
    batch = [b"word", None, b"", b"word", long, b"other", long]
    known = {}
    for _ in range(2):
        found = compression._sizes_of_different(pa.array(batch, pa.binary()), known).to_pylist()
        assert found == [None if data is None else len(real(data, level=9)) for data in batch]
    assert sorted(seen) == sorted([b"word", b"", long, b"other", long])


def test_short_and_long_batches_agree(spark):
    from grainsieve.functions.compression import REPEAT_BYTES, deflated_size

    texts = ["a", None, "", "a", "é" * 100, "a", "é" * 100]
    long = "b c" * REPEAT_BYTES
    short = spark.createDataFrame([(t,) for t in texts], "text STRING").coalesce(1)
    both = spark.createDataFrame([(t,) for t in [*texts, long]], "text STRING").coalesce(1)
    expected = [None if t is None else len(zlib.compress(t.encode(), level=9)) for t in [*texts, long]]
    assert [r[0] for r in short.select(deflated_size(F.col("text"))).collect()] == expected[:-1]
    assert [r[0] for r in both.select(deflated_size(F.col("text"))).collect()] == expected

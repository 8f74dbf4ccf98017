"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    sql = ORACLES.get(name)
    if sql is None:
        assert frame.count() >= 0
        assert frame.columns
    else:
        assert difference(frame, duck, sql) is None


ODD_TEXTS = [
    "", None, " ", "\n", "\n\n", "\r\n", "\t \u3000", "a", "a1\n", "\nB!", "é東😀z", "A\x00b", "\u200b", "!?", "x" * 1001,
    "x" * 1000 + "!" * 3000, "9 9\n" * 400, "zZ09@[`{/:\u00aa\u0661", "e\u0301 e",
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Odd texts once for every extension: a folder with ``documents`` and DuckDB over it."""
    folder = tmp_path_factory.mktemp("odd")
    path = str(folder / "documents.parquet")
    rows = [(5 * i + part, text) for i, text in enumerate(ODD_TEXTS) for part in range(5)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return str(folder), connection


def test_code_predicates_on_odd_texts(spark, odd):
    folder, duck = odd
    found = QUERIES["code_predicates"](spark, folder)
    assert found.count() == 5 * len(ODD_TEXTS)
    assert difference(found, duck, ORACLES["code_predicates"]) is None


def test_recipe_code_on_odd_texts(spark, odd):
    folder, duck = odd
    found = QUERIES["recipe_code"](spark, folder)
    kept = {row.text for row in found.collect()}
    assert "a" in kept and "" not in kept
    assert difference(found, duck, ORACLES["recipe_code"]) is None


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_only_compression_has_no_oracle():
    without = set(QUERIES) - set(ORACLES)
    assert without == {
        "recipe_web_crawl",
        "recipe_web_crawl_strict",
        "compression_ratio",
        "compression_band",
    }


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["source", "documents", "characters"]
    assert frame.count() > 0

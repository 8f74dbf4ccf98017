import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainsieve.llm import language
from grainsieve.llm.queries import op11_language
from tests.llm.cases import ROWS, clashing, documents, empty


def _remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_held_out_accuracy(spark, table):
    sf_dir = f"/root/testdata/{table}"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op11_language(spark, sf_dir).collect()
    assert len(found) == len(docs)
    right = tried = 0
    for r in found:
        assert r["held_out"] == (_remainder(r["doc_id"]) == 2) and 0 <= r["score"] <= 1
        assert r["lang_pred"] in {"de", "en", "es", "fr", "und"}
        if r["held_out"]:
            tried += 1
            right += r["lang_pred"] == docs[r["doc_id"]]["lang"]
    assert right >= 0.98 * tried


def test_only_texts_count(spark, sf_dir):
    """A prediction does not change with id, language and source of what is predicted, nor with its neighbours."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learn = docs.filter(~language.held_out(F.col("doc_id"))).select("lang", "text")
    model = language.fit_languages(learn)
    first = language.identify_languages(docs, model=model).collect()
    second = language.identify_languages(
        docs.repartition(5).select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("xx").alias("lang")), model=model
    ).collect()
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in first} == {
        r["doc_id"] - 1000: (r["lang_pred"], r["score"]) for r in second
    }


def test_held_out_rows_are_not_learned_from(spark, sf_dir):
    """Other languages on the rows held out change nothing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lied = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    rows = [
        sorted(tuple(r) for r in language.identify_languages(table).collect()) for table in (docs, lied, docs.repartition(3))
    ]
    assert rows[0] == rows[1] == rows[2]


def test_edge_rows(spark):
    docs = clashing(spark, documents(spark))
    found = language.identify_languages(docs).collect()
    assert len(found) == len(ROWS)
    silent = [r for r in ROWS if not any(c.isalpha() for c in r[1] or "")]
    assert sum(r["lang_pred"] == "und" for r in found) == len(silent)
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und")
    learned = {r[2] for r in ROWS if r[0] is not None and _remainder(r[0]) != 2 and r[1] and r[2] is not None}
    assert {r["lang_pred"] for r in found} <= learned | {"und"}
    assert language.identify_languages(empty(spark)).count() == 0
    # Nothing to learn from.
    bare = documents(spark, [(1, "some text", None, None, None), (None, "more", "en", None, None)])
    assert {r["lang_pred"] for r in language.identify_languages(bare).collect()} == {"und"}


def test_one_language_and_letters_of_other_scripts(spark):
    rows = [(i, "東京 текст" if i % 2 else "123 ½ _", "ja", None, None) for i in range(12)]
    found = language.identify_languages(documents(spark, rows)).collect()
    assert {(r["doc_id"] % 2, r["lang_pred"]) for r in found} == {(0, "und"), (1, "ja")}


def test_copies_of_a_text_are_learned_once(spark):
    """Thousands of copies of one text in one language crowd nothing out."""
    rows = [(i, "der hund und die katze", "de", None, None) for i in range(2000)]
    rows += [(5000 + i, f"the dog and cat number {'i' * i}", "en", None, None) for i in range(20)]
    rows += [(6000 + i, f"le chien est avec un chat {'o' * i}", "fr", None, None) for i in range(20)]
    found = language.identify_languages(documents(spark, rows), learned=10).collect()
    right = [r["lang_pred"] == ("de" if r["doc_id"] < 5000 else "en" if r["doc_id"] < 6000 else "fr") for r in found]
    assert sum(right) >= len(right) - 2


def test_long_texts_are_counted_whole(monkeypatch):
    texts = ["Some words. " * 50 + "fin", "x", "été ÉTÉ " * 30]
    whole = language.gram_shares(texts)
    monkeypatch.setattr(language, "_AT_ONCE", 17)
    assert np.allclose(language.gram_shares(texts), whole, atol=0)
    assert np.allclose((whole**2).sum(axis=1), 1)


def test_families_join_what_is_close():
    profiles = np.array([[1, 0.9, 0, 0], [0, 0, 1, 0.8], [0.9, 1, 0, 0.1], [0, 0.1, 0.9, 1]])
    assert language.families_of(profiles, 2) == [[0, 2], [1, 3]]
    assert language.families_of(profiles, 1) == [[0, 1, 2, 3]]


def test_planes_separate():
    random = np.random.default_rng(1)
    rows = random.normal(size=(300, 20))
    sign = np.sign(rows[:, 0] + 0.5 * rows[:, 1] + 0.2)
    weights = language.linear_svm(rows, sign)
    assert (np.sign(rows @ weights[:-1] + weights[-1]) == sign).mean() > 0.97

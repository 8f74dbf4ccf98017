import math

import pytest
from pyspark.sql import functions as F

from grainsieve.llm import quality
from tests.llm.brute import kneser_ney, rank
from tests.llm.cases import ROWS, clashing, documents, empty


def brute_judgement(spark, docs, labels, order=quality.ORDER):
    """{(doc_id, text): kept} by dictionaries; the hold-out rule is the operator's own."""
    rows = [
        r
        for r in docs.select(
            "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
            (F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(quality.HELD_OUT)) == 0).alias("held"),
        ).collect()
    ]
    good = {}
    for r in labels.collect():
        good[r["doc_id"]] = good.get(r["doc_id"], True) and r["quality"] == 1 and (r["toxic"] or 0) == 0
    kept = {(r["doc_id"], r["text"]): True for r in rows}
    figures, scores, limits = {}, {}, {}
    for lang in {r["lang"] for r in rows}:
        own = [r for r in rows if r["lang"] == lang and r["text"]]
        sure = [r for r in own if good.get(r["doc_id"], False)]
        train = [r["text"].encode() for r in sure if not r["held"]]
        if not train:
            continue
        logp = kneser_ney(train, order)
        score = {r["text"]: (logp(r["text"].encode()), len(r["text"].encode()) + 1) for r in own}
        held = [score[text] for text in {r["text"] for r in sure if r["held"]}]
        for r in own:
            figures[r["doc_id"], r["text"]] = score[r["text"]]
        if not held:
            continue
        typical = rank([-a / n for a, n in held], 0.5)
        smooth = lambda a, n, t=typical: (quality.PRIOR_BYTES * t - a) / (n + quality.PRIOR_BYTES)
        logs = [smooth(*x) for x in held]
        limits[lang] = (len(logs), rank(logs, 0.5), rank(logs, quality.QUANTILE), logs)
        for r in own:
            scores[r["doc_id"], r["text"]] = (lang, smooth(*score[r["text"]]))
    usual = rank([x - half for _, half, _, logs in limits.values() for x in logs], quality.QUANTILE) if limits else 0
    for key, (lang, value) in scores.items():
        n, half, high, _ = limits[lang]
        limit = (n * high + quality.POOLED * (half + usual)) / (n + quality.POOLED)
        kept[key] = value <= limit + 1e-12
    return kept, figures


def test_model_against_dictionaries(spark):
    texts = ["abracadabra", "abra", "cad\x00abra é", "b", "a" * 50]
    rows = [(i, t, "x", i != 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, trusted boolean")
    for order in (1, 2, 4):
        counts = quality.gram_counts(docs, order)
        model = quality.log_probabilities(counts, order)
        scored = quality.score_texts(docs, model, order, keep=["doc_id"]).collect()
        logp = kneser_ney([t.encode() for i, t in enumerate(texts) if i != 1], order)
        assert {r["doc_id"]: r["n_units"] for r in scored} == {i: len(t.encode()) + 1 for i, t in enumerate(texts)}
        for r in scored:
            assert r["logp"] == pytest.approx(logp(texts[r["doc_id"]].encode()), rel=1e-9)


def test_probabilities_sum_to_one(spark):
    # Every continuation of a context that was seen, unseen ones through the bytes they would need.
    texts = ["the cat sat", "the cat ran", "a hat"]
    logp = kneser_ney([t.encode() for t in texts], 3)
    total = sum(math.exp(logp(b"the ca" + bytes([c])) - logp(b"the ca")) for c in range(1, 256))
    assert math.isfinite(total)


def test_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept, figures = brute_judgement(spark, docs, labels)
    rows = quality.judge_quality(docs, labels).collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(text)
    for r in rows:
        key = (r["doc_id"], text[r["doc_id"]])
        assert r["kept"] == kept[key]
        if key in figures:
            assert math.log(r["perplexity"]) == pytest.approx(-figures[key][0] / figures[key][1], rel=1e-9)
    assert {r["doc_id"] for r in quality.keep_good(docs, labels).collect()} == {r["doc_id"] for r in rows if r["kept"]}


def test_edge_rows(spark):
    docs = clashing(spark, documents(spark))
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (2, None, None), (7, 1, None), (None, 1, 0), (99, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.judge_quality(docs, labels).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r["n_bytes"] == 0 or r["lang"] == "de":
            assert r["kept"] and r["threshold"] is None
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in rows)


def test_without_rows_or_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge_quality(empty(spark), none).count() == 0
    assert quality.keep_good(documents(spark), none).count() == len(ROWS)


def test_junk_goes_and_clean_text_stays(spark):
    """In every language: of the labelled junk at most a twentieth stays, of the clean texts at most three in a hundred go."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = quality.judge_quality(docs, labels).join(labels, "doc_id")
    clean = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    shares = judged.groupBy("lang").agg(
        F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("junk"),
        F.avg(F.when(clean, 1 - F.col("kept").cast("int"))).alias("lost"),
    )
    for r in shares.collect():
        print(r)
        assert r["junk"] <= 0.05 and r["lost"] <= 0.03, r


def test_copies_of_one_trusted_text_move_no_limit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = F.pmod(F.xxhash64("text"), F.lit(quality.HELD_OUT)) == 0
    good = labels.filter("quality = 1 AND toxic = 0").select("doc_id")
    one = docs.join(good, "doc_id").filter(held & (F.col("lang") == "en")).orderBy("doc_id").limit(1)
    copies = one.withColumn("doc_id", F.explode(F.sequence(F.lit(10_000), F.lit(10_300))))
    more = labels.unionByName(copies.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")))
    limits = [
        {r[0]: r[1] or -1 for r in quality.judge_quality(d, w).groupBy("lang").agg(F.first("threshold", ignorenulls=True)).collect()}
        for d, w in ((docs, labels), (docs.unionByName(copies), more))
    ]
    assert limits[0] == pytest.approx(limits[1], rel=1e-9)

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import grainsieve as g


def texts(frame):
    return [row.text for row in frame.collect()]


def test_reformat_overlays_meta(spark):
    frame = spark.createDataFrame(
        [Row(content="c", text="t", meta=Row(a=1, b="old"), b="new", n=2)]
    )
    shaped = g.reformat(frame, "content", carry=("n",))
    assert shaped.columns == ["text", "meta", "n"]
    row = shaped.first()
    assert row.text == "c" and row.n == 2
    assert row.meta.asDict() == {"a": 1, "b": "new", "text": "t"}


def test_reformat_without_or_with_missing_meta(spark):
    plain = spark.createDataFrame([("t", "u")], "text STRING, url STRING")
    assert g.reformat(plain).first().meta.asDict() == {"url": "u"}
    missing = spark.createDataFrame(
        [("t", None, "u")], "text STRING, meta STRUCT<a: INT>, url STRING"
    )
    assert g.reformat(missing).first().meta.asDict() == {"a": None, "url": "u"}
    only_text = g.reformat(plain.select("text"))
    assert only_text.columns == ["text", "meta"]
    assert texts(only_text) == ["t"]
    assert g.reformat(plain.limit(0)).count() == 0
    with pytest.raises(TypeError):
        g.reformat(plain.withColumn("meta", F.lit("x")))


def test_wiki_recipe_cuts_then_tidies_then_drops(spark):
    frame = spark.createDataFrame(
        [("a ( )\nNotes\nz", "1"), ("\nNotes\nz", "2"), (" \n", "3"), (None, "4"), ("()", "5")],
        "text STRING, id STRING",
    )
    for name in ("ja_wiki", "en_wiki"):
        kept = g.apply_recipe(frame, g.recipe_for(name))
        assert [(r.text, r.meta.id) for r in kept.collect()] == [("a", "1")]


def web_rows(spark):
    source = random.Random(2)
    hiragana = [chr(c) for c in range(0x3042, 0x3092)]
    long = "カナ。" + "".join("".join(source.choices(hiragana, k=50)) + "。" for _ in range(4))
    return spark.createDataFrame(
        [
            (long, "https://a.example.jp/x"),
            (long, "https://ja.wikipedia.org/x"),
            (long, "no host"),
            (long, None),
            (long + "悪" * 3, "https://b.example.jp/"),
            ("English only.", "https://c.example.jp/"),
            (long + "広告" * 11, "https://d.example.jp/"),
        ],
        "text STRING, url STRING",
    )


def test_web_crawl_recipe(spark):
    words = g.KeywordLists(ads=["広告"], adult=["悪"])
    hosts = [r.meta.url[8] for r in g.apply_recipe(web_rows(spark), g.recipe_for("ja_cc", False, words)).collect()]
    assert hosts == ["a", "b"]
    hosts = [r.meta.url[8] for r in g.apply_recipe(web_rows(spark), g.recipe_for("ja_cc", True, words)).collect()]
    assert hosts == ["a"]


def test_rejections_explain_the_recipe(spark):
    words = g.KeywordLists(ads=["広告"], adult=["悪"])
    recipe = g.recipe_for("ja_cc", True, words)
    judged = g.explain_rejections(web_rows(spark), recipe)
    rows = judged.collect()
    assert [r.valid_domain for r in rows] == [True, False, False, False, True, True, True]
    assert [r.not_adult for r in rows] == [True] * 4 + [False] + [True] * 2
    assert [r.not_ad for r in rows] == [True] * 6 + [False]
    kept = sorted(r.meta.url for r in rows if r.kept)
    assert kept == sorted(r.meta.url for r in g.apply_recipe(web_rows(spark), recipe).collect())


def test_mixed_recipe_keeps_missing_names(spark):
    frame = spark.createDataFrame(
        [("a", (None,)), ("b", ("Books3",)), ("c", ("books3",)), (" ", ("x",))],
        "text STRING, meta STRUCT<pile_set_name: STRING>",
    )
    assert texts(g.apply_recipe(frame, g.recipe_for("en_pile"))) == ["a", "c"]


def test_code_recipe_bounds_and_nulls(spark):
    frame = spark.createDataFrame(
        [
            ("a", "py", 1000, 100.0, 0.25),
            ("b", "PY", 10, 10.0, 0.5),
            ("c", "C", 1001, 10.0, 0.5),
            ("d", "c", 10, 100.5, 0.5),
            ("e", "c", 10, 10.0, 0.24),
            ("f", "c", None, 10.0, 0.5),
            ("g", None, 10, 10.0, 0.5),
            ("", "c", 10, 10.0, 0.5),
        ],
        "content STRING, ext STRING, max_line_length BIGINT, avg_line_length DOUBLE, "
        "alphanum_fraction DOUBLE",
    )
    assert texts(g.apply_recipe(frame, g.recipe_for("code_stack"))) == ["a"]


def test_unknown_recipe_and_missing_lists():
    with pytest.raises(ValueError, match="no recipe is called"):
        g.recipe_for("other")
    with pytest.raises(ValueError, match="keyword lists"):
        g.recipe_for("ja_cc")


def test_filter_quality(spark):
    before = spark.createDataFrame(
        [("a", ("0",)), ("b", ("0",)), ("c", ("1",)), ("d", ("2",)), ("e", ("2",)), ("f", (None,))],
        "text STRING, meta STRUCT<label: STRING>",
    )
    after = before.filter(F.col("text").isin("a", "e", "f"))
    row = g.with_label_shares(g.filter_quality(before, after)).first()
    assert (row.tp, row.fp, row.fn, row.kept) == (2, 1, 1, 3)
    assert (row.precision, row.recall, row.f1) == (2 / 3, 2 / 3, 2 / 3)
    assert (row.acceptable, row.harmful, row.low_quality) == (1, 0, 1)
    assert row.low_quality_share == 1 / 3
    nothing = g.with_label_shares(g.filter_quality(before, before.limit(0))).first()
    assert nothing.acceptable_share is None and nothing.recall == 1.0
    empty = g.filter_quality(before.limit(0), before.limit(0)).first()
    assert (empty.precision, empty.recall, empty.f1) == (0.0, 0.0, 0.0)
    assert tuple(g.label_counts(before).first()) == (6, 2, 1, 2)


def test_number_labels_count_like_strings(spark):
    frame = spark.createDataFrame([("a", (1,)), ("b", (0,))], "text STRING, meta STRUCT<label: INT>")
    assert tuple(g.label_counts(frame).first()) == (2, 1, 1, 0)

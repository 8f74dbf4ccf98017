"""Ordered manifests, bad lines, counts of streams, and the report of all levels."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import grainsieve as g
from grainsieve import jobs
from grainsieve.sinks.quarantine import TooManyBadLines, ingest_lines
from grainsieve.sources.manifests import read_ids, read_ordered_manifest, write_ordered_manifest
from grainsieve.streaming.counts import count_stream, stream_counts
from grainsieve.streaming.recipes import stream_documents


def _document(path):
    """What the files of a manifest are, one behind the other."""
    return "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))


@pytest.mark.parametrize("bytes_", ["1k", "128m"])
def test_ordered_manifest(spark, tmp_path, bytes_):
    path = str(tmp_path / "ids")
    ids = ['plain', 'q"uote', "new\nline", "é, ü", "]}", "{", "", None, "plain"] + [f"id {i}" for i in range(2000)]
    frame = spark.createDataFrame(list(enumerate(ids)), "n INT, id STRING").repartition(7)
    assert write_ordered_manifest(frame, ["n"], path, "hexsha")
    assert not write_ordered_manifest(frame, ["n"], path, "hexsha")
    assert json.loads(_document(path)) == {"key": "hexsha", "ids": ids}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
        key, found = read_ordered_manifest(spark, path)
        assert key == "hexsha"
        assert {(r.place, r.id) for r in found.collect()} == set(enumerate(ids))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    key, table = read_ids(spark, path)
    assert key == "hexsha" and table.columns == ["id"] and table.count() == len(ids)


def test_ordered_manifest_without_ids(spark, tmp_path):
    path = str(tmp_path / "ids")
    write_ordered_manifest(spark.createDataFrame([], "n INT, id STRING"), ["n"], path, None)
    assert json.loads(_document(path)) == {"key": "hash", "ids": []}
    key, found = read_ordered_manifest(spark, path)
    assert key == "hash" and found.count() == 0


def test_ids_keep_the_order_of_files_and_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    want = []
    for name in ("a", "b"):
        rows = [{"text": "x", "meta": {"id": f"{name}{(i * 7) % 50}"}} for i in range(50)]
        want += [r["meta"]["id"] for r in rows]
        (tmp_path / "in" / f"{name}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    path = str(tmp_path / "ids")
    schema = "text STRING, meta STRUCT<id: STRING>"
    jobs.extract_ids(spark, "en_wiki", [str(tmp_path / "in")], path, ordered=True, schema=schema)
    assert json.loads(_document(path)) == {"key": "id", "ids": want}


def test_bad_lines_go_aside(spark, tmp_path):
    raw = tmp_path / "x.jsonl"
    raw.write_text('{"n": 1}\n{"n": \n\n{"n": 3}\nnothing\n')
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    with pytest.raises(TooManyBadLines, match="2 lines"):
        ingest_lines(spark, [str(raw)], "n INT", good, bad, most_bad=1)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["x.jsonl"]
    assert ingest_lines(spark, [str(raw)], "n INT", good, bad, most_bad=2).first() == (2, 2)
    assert {r.n for r in spark.read.parquet(good).collect()} == {1, 3}
    found = spark.read.parquet(bad).collect()
    assert {(r.row_id.rsplit("/", 1)[1], r._corrupt) for r in found} == {("x.jsonl:1", '{"n": '), ("x.jsonl:3", "nothing")}
    with pytest.raises(FileExistsError):
        ingest_lines(spark, [str(raw)], "n INT", good, bad)
    # A failed run leaves what was there; a good one replaces both, also by nothing.
    with pytest.raises(TooManyBadLines):
        ingest_lines(spark, [str(raw)], "n INT", good, bad, most_bad=0, overwrite=True)
    assert spark.read.parquet(good).count() == 2
    raw.write_text('{"n": 9}\n')
    assert ingest_lines(spark, [str(raw)], "n INT", good, bad, overwrite=True).first() == (1, 0)
    assert [r.n for r in spark.read.parquet(good).collect()] == [9] and spark.read.parquet(bad).count() == 0
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bad", "good", "x.jsonl"]


def test_stream_counts_go_on_and_count_once(spark, tmp_path):
    landing, path, state = (str(tmp_path / name) for name in ("in", "counts", "state"))
    Path(landing).mkdir()
    schema = "shard STRING, num_tokens INT"

    def arrive(name, rows):
        (Path(landing) / f"{name}.json").write_text("".join(json.dumps({"shard": s, "num_tokens": n}) + "\n" for s, n in rows))

    def run():
        count_stream(stream_documents(spark, landing, schema), path, state).awaitTermination()
        batch = g.tokens_per_shard(spark.read.schema(schema).json(landing))
        found = stream_counts(spark, path)
        assert {tuple(r) for r in found.collect()} == {tuple(r) for r in batch.collect()}

    arrive("0", [("a", 1), ("a", 2), ("b", 5)])
    run()
    run()  # nothing new
    arrive("1", [("b", 1), ("c", None), (None, 4)])
    run()
    # A batch whose end was not noted is run again.
    last = max((Path(state) / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    arrive("2", [("a", 10)])
    run()


def test_report_of_all_levels(spark):
    rows = [("a", "train", 1), ("a", "train", 2), ("a", "validation", 4), ("b", "train", 8), (None, "train", 16), ("c", None, None)]
    frame = spark.createDataFrame(rows, "shard STRING, split STRING, num_tokens INT")
    found = {tuple(r) for r in g.token_report(frame).collect()}
    assert found == {
        ("shard", None, "a", 1, 3, 7), ("shard", None, "b", 1, 1, 8), ("shard", None, None, 1, 1, 16), ("shard", None, "c", 1, 1, 0),
        ("split", "train", None, 3, 4, 27), ("split", "validation", None, 1, 1, 4), ("split", None, None, 1, 1, 0),
        ("corpus", None, None, 4, 6, 31),
    }
    assert g.token_report(frame.limit(0)).filter("level <> 'corpus'").isEmpty()
    text = g.token_report(frame.withColumn("text", F.lit("x")))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Expand") >= 1

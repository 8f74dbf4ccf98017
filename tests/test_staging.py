"""Outputs that appear whole, in chunks, and under the names of their shards."""

import json
import logging
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import grainsieve as g
from grainsieve import jobs
from grainsieve.sinks import chunks, named, staging
from grainsieve.sinks.writers import write_parquet, write_shards
from grainsieve.sources.readers import read_documents


def _fails(number=3):
    broken = F.raise_error(F.lit("broken row")).cast("long")
    return F.when(F.col("id") == number, broken).otherwise(F.col("id")).alias("id")



def _names(folder):
    return sorted(p.name for p in Path(folder).iterdir() if not p.name.startswith("."))


def test_a_failed_overwrite_leaves_the_former_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    write_parquet(spark.range(5), path)
    with pytest.raises(Exception, match="broken row"):
        write_parquet(spark.range(100).select(_fails()), path, overwrite=True)
    assert spark.read.parquet(path).count() == 5
    assert _names(tmp_path) == ["out"]
    # What is replaced may be read.
    assert write_parquet(spark.read.parquet(path).selectExpr("id + 10 AS id"), path, overwrite=True)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [10, 11, 12, 13, 14]
    assert _names(tmp_path) == ["out"]


def test_a_driver_that_dies_between_two_renames(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    write_parquet(spark.range(5), path)

    class Dies(staging.Store):
        def rename(self, source, target):
            if "_staging-" in source:
                raise KeyboardInterrupt
            super().rename(source, target)

    monkeypatch.setattr(staging, "Store", Dies)
    monkeypatch.setattr(staging, "recover", lambda *_: None)
    with pytest.raises(KeyboardInterrupt):
        write_parquet(spark.range(9), path, overwrite=True)
    assert not Path(path).exists()
    monkeypatch.undo()
    assert not write_parquet(spark.range(9), path)  # put back, and finished
    assert spark.read.parquet(path).count() == 5


def _corpus(folder, files=6, rows=20):
    folder.mkdir()
    for i in range(files):
        name = "valid" if i == 0 else f"train-{i}"
        rows_ = [{"text": f"text {i} {k}\nNotes\nz", "id": f"{i}-{k}"} for k in range(rows)]
        (folder / f"{name}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows_))
    return str(folder)


def test_chunks_resume(spark, tmp_path, monkeypatch, caplog):
    raw, out, whole = _corpus(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "whole")
    schema = "text STRING, id STRING"
    size = (tmp_path / "raw" / "train-1.jsonl").stat().st_size
    read, seen = jobs.read_split_files, []

    def dies(spark_, files, schema_):
        seen.append(sorted(Path(p).name for own in files.values() for p in own))
        if len(seen) == 3:
            raise ConnectionError("the driver died")
        return read(spark_, files, schema_)

    monkeypatch.setattr(jobs, "read_split_files", dies)
    with pytest.raises(ConnectionError):
        jobs.filter_corpus(spark, "en_wiki", raw, out, schema=schema, chunk_bytes=2 * size)
    assert len(_names(out)) == 2
    seen.append(None)
    assert jobs.filter_corpus(spark, "en_wiki", raw, out, schema=schema, chunk_bytes=2 * size)
    # Only what is missing is read.
    assert seen[:2] + seen[4:] == [["train-1.jsonl", "train-2.jsonl"], ["train-3.jsonl", "train-4.jsonl"], ["train-5.jsonl", "valid.jsonl"]]
    monkeypatch.undo()
    jobs.filter_corpus(spark, "en_wiki", raw, whole, schema=schema)
    rows = [sorted((r.text, r.meta.id, r.split) for r in spark.read.parquet(p).collect()) for p in (out, whole)]
    assert rows[0] == rows[1] and len(rows[0]) == 120
    assert not jobs.filter_corpus(spark, "en_wiki", raw, out, schema=schema, chunk_bytes=2 * size)
    # A file behind the others changes the last chunk alone; one that has changed is no chunk of this input.
    (tmp_path / "raw" / "train-3.jsonl").write_text('{"text": "new", "id": "n"}\n')
    with pytest.raises(FileExistsError, match="another input"):
        jobs.filter_corpus(spark, "en_wiki", raw, out, schema=schema, chunk_bytes=2 * size)
    assert jobs.filter_corpus(spark, "en_wiki", raw, out, schema=schema, chunk_bytes=2 * size, overwrite=True)
    assert spark.read.parquet(out).count() == 101


def test_a_chunk_that_fails_leaves_nothing(spark, tmp_path):
    for i in range(3):
        spark.range(4 * i, 4 * i + 4).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
    files = [path for path, _ in chunks.file_sizes(spark, [str(tmp_path / "in")]) if path.endswith(".parquet")]
    plan = chunks.plan_chunks(spark, files, 1)
    out = str(tmp_path / "out")

    def write(transform):
        return chunks.write_chunks(
            spark, plan, out, lambda own: spark.read.parquet(*own).select(transform), write_parquet
        )

    with pytest.raises(Exception, match="broken row"):
        write(_fails(6))
    assert _names(out) == [f"chunk={plan[0].name}"]
    assert write(F.col("id")) == [plan[1].name, plan[2].name]
    assert spark.read.parquet(out).count() == 12


def test_outputs_are_named_after_shards(spark, tmp_path, caplog):
    out = str(tmp_path / "out")
    frame = spark.range(60).select(
        (F.col("id") % 3).alias("k"), F.concat(F.lit("train_"), F.col("id") % 3).alias("shard"),
        F.when(F.col("id") < 9, F.lit("validation")).otherwise(F.lit("train")).alias("split"), "id",
    )
    name = named.output_name(F.col("shard"), F.col("split"))
    want = [f"{side}_{i}.parquet" for side in ("train", "validation") for i in range(3)]
    with pytest.raises(Exception, match="broken row"):
        named.write_named(frame.select("shard", "split", _fails()), out, name)
    assert not Path(out).exists() or _names(out) == []
    assert sorted(named.write_named(frame, out, name, drop=("shard", "split"))) == sorted(w[:-8] for w in want)
    assert _names(out) == want
    assert all(pq.ParquetFile(f"{out}/{w}").schema_arrow.names == ["k", "id"] for w in want)
    for i in range(3):
        assert sorted(pq.read_table(f"{out}/validation_{i}.parquet")["id"].to_pylist()) == [i, i + 3, i + 6]
    caplog.set_level(logging.ERROR)
    (tmp_path / "out" / "train_1.parquet").unlink()
    assert named.write_named(frame.withColumn("id", -F.col("id")), out, name, drop=("shard", "split")) == ["train_1"]
    assert "5 outputs" in caplog.text
    read = read_documents(spark, [out], shard=True)
    assert read.filter("id < 0").select("shard").distinct().collect() == [("train_1",)]
    assert read.count() == 60
    named.write_named(frame.filter("k = 0"), out, name, overwrite=True, drop=("shard", "split"))
    assert _names(out) == want and read_documents(spark, [out]).filter("id < 0").count() == 17
    with pytest.raises(Exception, match="no output name"):
        named.write_named(frame.withColumn("shard", F.lit(None).cast("string")), str(tmp_path / "o"), F.col("shard"))


def test_large_shards_become_folders(spark, tmp_path):
    out = str(tmp_path / "out")
    frame = spark.range(40).select(F.when(F.col("id") < 30, F.lit("a b=%")).otherwise(F.lit("train")).alias("shard"), "id")
    for fmt, extension in (("parquet", "parquet"), ("jsonl", "jsonl")):
        named.write_named(frame, out, F.col("shard"), fmt, drop=("shard",), max_rows=12)
        assert (Path(out) / f"a b=%.{extension}").is_dir() and (Path(out) / f"train.{extension}").is_file()
    assert spark.read.parquet(f"{out}/*.parquet").count() == 40
    assert len((Path(out) / "train.jsonl").read_text().splitlines()) == 10
    # Names beyond the list are left out by a join.
    before = named.LISTED_NAMES
    try:
        named.LISTED_NAMES = 1
        assert named.write_named(frame, out, F.col("shard"), drop=("shard",)) == []
    finally:
        named.LISTED_NAMES = before


def test_split_stage_writes_one_output_per_shard(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        table = pa.table({"text": [f"{i} {k}" for k in range(9)], "num_tokens": [2] * 9})
        pq.write_table(table, tmp_path / "in" / f"train_{i}.parquet")
    out = str(tmp_path / "out")
    for _ in range(2):
        totals = jobs.split_corpus(spark, [str(tmp_path / "in")], out, "4", "parquet", one_per_shard=True)
        assert {tuple(r) for r in totals.collect()} == {("validation", 12, 24), ("train", 15, 30)}
    assert _names(out) == [f"{side}_{i}.parquet" for side in ("train", "validation") for i in range(3)]
    for i in range(3):
        sides = [set(pq.read_table(f"{out}/{side}_{i}.parquet")["text"].to_pylist()) for side in ("train", "validation")]
        assert [len(s) for s in sides] == [5, 4] and len(sides[0] | sides[1]) == 9


def _with_line_ids(spark, path, fmt, schema=None):
    frame = read_documents(spark, [path], fmt, schema, shard=True, shard_path=True, row_id=True)
    number = F.substring_index("row_id", ":", -1)
    return frame.withColumn("own", F.concat_ws(":", "shard", number))


def test_holdout_of_json_lines_equals_that_of_parquet(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "j").mkdir()
    for i in range(3):
        rows = [{"text": f"same {'é' * (k % 7)}", "place": k} for k in range(3000)]
        pq.write_table(pa.Table.from_pylist(rows), tmp_path / "p" / f"train_{i}.parquet")
        lines = [json.dumps(r, ensure_ascii=False) for r in rows]
        lines.insert(1500, "")  # no row
        (tmp_path / "j" / f"train_{i}.jsonl").write_text("\n".join(lines) + "\n")
    parquet = _with_line_ids(spark, str(tmp_path / "p"), "parquet")
    held = {(r.shard, r.place) for r in g.holdout_per_shard(parquet, 50, "shard_path", "own").filter("split = 'validation'").collect()}
    assert len(held) == 150
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            json_ = _with_line_ids(spark, str(tmp_path / "j"), "jsonl", "text STRING, place INT")
            assert json_.rdd.getNumPartitions() > 30 or size == "128m"
            assert json_.filter("CAST(substring_index(row_id, ':', -1) AS INT) <> place").isEmpty()
            again = g.holdout_per_shard(json_, 50, "shard_path", "own").filter("split = 'validation'")
            assert {(r.shard, r.place) for r in again.collect()} == held
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    totals = jobs.split_corpus(
        spark, [str(tmp_path / "j")], str(tmp_path / "out"), "50", "jsonl", input_format="jsonl", schema="text STRING, place INT"
    )
    assert {(r.split, r.examples) for r in totals.collect()} == {("train", 8850), ("validation", 150)}


def test_line_numbers_of_a_file_that_changed(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text("".join(f'{{"n": {i}}}\n' for i in range(5)))
    frame = read_documents(spark, [str(path)], "jsonl", "n INT", row_id=True)
    assert sorted(int(r.row_id.rsplit(":", 1)[1]) for r in frame.collect()) == list(range(5))
    assert read_documents(spark, [str(path)], "jsonl", "n INT", row_id=True).drop("row_id").count() == 5


def test_shards_past_both_budgets_are_not_opened(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(12):
        table = pa.table({"text": ["a"] * 20, "num_tokens": [10] * 20})
        pq.write_table(table, tmp_path / "in" / f"train_{i:02}.parquet")
    documents = read_documents(spark, [str(tmp_path / "in")], shard=True, shard_path=True, row_id=True)
    sampled = g.sample_by_token_budget(documents, 500, 240, "shard_path", tokens_per_example=2)
    kept = {r.shard for r in sampled.select("shard").distinct().collect()}
    assert 3 <= len(kept) < 12
    for i in range(12):
        if f"train_{i:02}" not in kept:
            (tmp_path / "in" / f"train_{i:02}.parquet").write_bytes(b"no parquet at all")
    assert sampled.filter("split = 'train'").agg(F.sum("num_tokens")).first()[0] >= 500


def test_present_shards_beyond_the_list(spark, tmp_path, monkeypatch):
    from grainsieve.sinks import writers

    path = str(tmp_path / "out")
    frame = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "shard STRING, n INT")
    write_shards(frame.filter("n < 3"), path)
    monkeypatch.setattr(writers, "LISTED_NAMES", 1)
    assert {r.n for r in write_shards(frame, path).collect()} == {3, 4}
    assert write_shards(frame, path).count() == 0


def test_parquet_outputs_take_the_smaller_codec(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from grainsieve.sinks.named import write_named
    from grainsieve.sinks.writers import write_parquet, write_shards

    rows = spark.range(100).selectExpr("id", "concat('s', id % 2) AS shard")

    def codecs(path):
        files = glob.glob(f"{path}/**/*.parquet", recursive=True)
        return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}

    def write(folder):
        write_parquet(rows, f"{folder}/a")
        write_shards(rows, f"{folder}/b")
        write_named(rows, f"{folder}/c", F.col("shard"))
        assert sorted(r.id for r in spark.read.parquet(f"{folder}/b").collect()) == list(range(100))
        return [codecs(f"{folder}/{name}") for name in "abc"]

    assert write(tmp_path / "own") == [{"ZSTD"}] * 3
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    try:
        assert write(tmp_path / "named") == [{"GZIP"}] * 3
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")

from collections import Counter

import corpus_pipeline
from grainsieve.llm import mixing, simhash
from tests.llm.brute import fingerprint, groups_of, linked_groups
from tests.llm.cases import ROWS, clashing, documents, empty
from tests.llm.test_packing import _check as check_packing
from tests.llm.test_quality import brute_judgement


def test_stages_against_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, frames = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, docs, sf_dir)
        frame.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        frames.append(docs)
        assert i == 4 or docs.columns == columns
    good, exact, near, mixed, packed = (f.collect() for f in frames)
    original = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept, _ = brute_judgement(spark, original, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert {r["doc_id"] for r in good} == {i for (i, _), k in kept.items() if k}
    last = {}
    for r in good:
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in exact) == sorted(last.values())
    groups = groups_of(linked_groups([fingerprint(r["text"]) for r in exact], simhash.MAX_BITS))
    assert {r["doc_id"] for r in near} == {min(exact[i]["doc_id"] for i in g) for g in groups.values()}
    report = mixing.mix_report(frames[2]).collect()
    assert Counter(r["doc_id"] for r in mixed) == Counter({r["doc_id"]: r["taken"] // r["size"] for r in report if r["taken"]})
    check_packing(packed, [(r["doc_id"], r["text"]) for r in mixed])
    again = corpus_pipeline.run(spark, sf_dir)
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert Counter(map(key, again.collect())) == Counter(map(key, packed))


def test_every_stage_takes_odd_tables(spark, sf_dir):
    for docs, rows in ((clashing(spark, documents(spark)), len(ROWS)), (empty(spark), 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns, name
            assert name == "source_mixing" or out.count() <= rows


def test_stage_list():
    assert len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.ORACLE_SQL is None

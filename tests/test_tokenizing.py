import io

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, SentencePieceTrainer

import grainsieve as g
from checks import inputs


@pytest.fixture(scope="module")
def model():
    words = ["corpus", "document", "filter", "shard", "token", "table", "spark", "東京", "カナ"]
    sentences = [f"{a} {b} {a}{b}" for a in words for b in words]
    target = io.BytesIO()
    SentencePieceTrainer.train(
        sentence_iterator=iter(sentences),
        model_writer=target,
        vocab_size=60,
        hard_vocab_limit=False,
        minloglevel=2,
    )
    return target.getvalue()


def check(frame, processor, texts):
    rows = {r.i: r for r in frame.collect()}
    for i, text in enumerate(texts):
        if text is None:
            assert rows[i].tokens is None and rows[i].num_tokens is None
            continue
        ids = processor.encode_as_ids(text)
        assert rows[i].token_ids == ids
        assert rows[i].tokens == processor.id_to_piece(ids)
        assert rows[i].num_tokens == len(ids)


def test_subword_model(spark, model, tmp_path):
    texts = ["corpus filter", "", None, "東京 カナ unknown ☃☃", "shard " * 5000]
    frame = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING").repartition(3)
    processor = SentencePieceProcessor(model_proto=model)
    tokenized = g.tokenize(frame, model)
    assert tokenized.columns == ["i", "text", "tokens", "token_ids", "num_tokens"]
    assert tokenized.schema["token_ids"].dataType.simpleString() == "array<int>"
    check(tokenized, processor, texts)
    path = tmp_path / "own.model"
    path.write_bytes(model)
    check(g.tokenize(frame, str(path)), processor, texts)


def test_subword_model_on_whole_documents(spark, sf_dir, model):
    documents = inputs.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("int").alias("i"), "text"
    )
    texts = [r.text for r in documents.orderBy("i").collect()]
    check(g.tokenize(documents, model), SentencePieceProcessor(model_proto=model), texts)


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0}])
def test_vocabulary(spark, bounds):
    texts = ["a b zz a", "", None, "   ", "b"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    vocabulary = spark.createDataFrame([("a", 5), ("b", 6), ("b", 7), (None, 1)], "piece STRING, id INT")
    found = g.tokenize_with_vocabulary(frame, vocabulary, r"\S+", -1, "i", **bounds)
    assert found.columns == ["i", "text", "tokens", "token_ids", "num_tokens"]
    rows = {r.i: (r.tokens, r.token_ids, r.num_tokens) for r in found.collect()}
    assert rows == {
        0: (["a", "b", "zz", "a"], [5, 6, -1, 5], 4),
        1: ([], [], 0),
        2: (None, None, None),
        3: ([], [], 0),
        4: (["b"], [6], 1),
    }


def test_empty_vocabulary(spark):
    frame = spark.createDataFrame([(1, "a b")], "i INT, text STRING")
    vocabulary = spark.createDataFrame([], "piece STRING, id INT")
    assert g.tokenize_with_vocabulary(frame, vocabulary, r"\S+", 0, "i").first().token_ids == [0, 0]


def test_token_count_is_taken_from_tokens(spark):
    frame = spark.createDataFrame([("s", ["a", "b"]), ("s", None), ("t", [])], "shard STRING, tokens ARRAY<STRING>")
    shards = {r.shard: (r.examples, r.tokens) for r in g.tokens_per_shard(frame).collect()}
    assert shards == {"s": (2, 2), "t": (1, 0)}
    given = frame.withColumn("num_tokens", F.lit(9))
    assert g.corpus_totals(g.tokens_per_shard(given)).first() == (2, 3, 27)
    assert g.split_totals(frame.withColumn("split", F.lit("x"))).first() == ("x", 3, None)


def test_empty_vocabulary_joined(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "i INT, text STRING")
    for vocabulary in ([], [("a", None)]):
        entries = spark.createDataFrame(vocabulary, "piece STRING, id INT")
        found = g.tokenize_with_vocabulary(frame, entries, r"\S+", 7, max_rows=0)
        assert {r.i: r.token_ids for r in found.collect()} == {1: [7, 7], 2: None, 3: []}


def test_no_texts_joined(spark):
    vocabulary = spark.createDataFrame([("a", 5)], "piece STRING, id INT")
    for rows in ([], [(1, None)]):
        frame = spark.createDataFrame(rows, "i INT, text STRING")
        found = g.tokenize_with_vocabulary(frame, vocabulary, r"\S+", 0, max_rows=0)
        assert [tuple(r) for r in found.collect()] == [(1, None, None, None, None)] * len(rows)


@pytest.mark.parametrize("block_bytes", [1, 40, 1 << 22])
def test_joined_blocks_agree_with_broadcast(spark, monkeypatch, block_bytes):
    from grainsieve.operators import tokenizing

    monkeypatch.setattr(tokenizing, "BLOCK_BYTES", block_bytes)
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(i % 40)) for i in range(200)] + [None] * 3
    frame = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING").repartition(3)
    vocabulary = spark.createDataFrame([(f"w{i}", i) for i in range(0, 23, 2)], "piece STRING, id INT")
    broadcast, joined = (
        {r.i: (r.tokens, r.token_ids) for r in g.tokenize_with_vocabulary(frame, vocabulary, r"\S+", -1, **bounds).collect()}
        for bounds in ({}, {"max_rows": 0})
    )
    assert joined == broadcast


def test_repeated_pieces_meet_the_vocabulary_once_a_block(spark, monkeypatch):
    from grainsieve.operators import tokenizing

    met = []

    def attach(df, side, on, *args, **bounds):
        if list(on) == ["piece"]:
            met.append(df.count())
        return real(df, side, on, *args, **bounds)

    real = tokenizing.attach
    monkeypatch.setattr(tokenizing, "attach", attach)
    texts = [f"{'a ' * 50}b {i}" for i in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING").coalesce(1)
    vocabulary = spark.createDataFrame([("a", 5), ("b", 6)], "piece STRING, id INT")
    found = g.tokenize_with_vocabulary(frame, vocabulary, r"\S+", -1, max_rows=0)
    assert {r.i: r.token_ids for r in found.collect()} == {i: [5] * 50 + [6, -1] for i in range(20)}
    # At most a block for each partition of the distinct texts, and 20 pieces that differ.
    assert len(met) == 1 and met[0] <= 2 * 4 + 20


def test_pieces_are_looked_up_in_parts(spark):
    import pyarrow as pa

    from grainsieve.operators import tokenizing

    look_up = tokenizing._lookup(pa.array(["a", "n"]), pa.array([5, None], pa.int32()), -1).func
    rows = [["a", "b"], None, [], ["n"]] * tokenizing.LOOK_UP_ROWS
    parts = list(look_up(iter([pa.array(rows, pa.list_(pa.string())), pa.array([], pa.list_(pa.string()))])))
    assert max(map(len, parts)) <= tokenizing.LOOK_UP_ROWS
    assert [ids for part in parts for ids in part.to_pylist()] == [[5, -1], None, [], [-1]] * tokenizing.LOOK_UP_ROWS


def test_ids_of_many_rows_in_parts(spark):
    texts = [None if i % 7 == 0 else " ".join(f"w{(i + j) % 11}" for j in range(i % 5)) for i in range(1500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING").coalesce(1)
    vocabulary = spark.createDataFrame([(f"w{i}", i) for i in range(8)], "piece STRING, id INT")
    found = {r.i: r.token_ids for r in g.tokenize_with_vocabulary(frame, vocabulary, r"\S+", -1).collect()}
    number = {f"w{i}": i for i in range(8)}
    assert found == {i: None if t is None else [number.get(w, -1) for w in t.split()] for i, t in enumerate(texts)}


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0}])
def test_pieces_are_not_searched_range_by_range(spark, bounds):
    texts = spark.createDataFrame([("Ab1 é×",), (None,)], "text STRING")
    entries = spark.createDataFrame([("Ab", 7), ("×", 8)], "piece STRING, id INT")
    tokenized = g.tokenize_with_vocabulary(texts, entries, inputs.PIECES, 0, **bounds)
    assert "A-Z" not in tokenized._jdf.queryExecution().optimizedPlan().toString()
    assert {(row.text, tuple(row.tokens or ()), tuple(row.token_ids or ())) for row in tokenized.collect()} == {
        ("Ab1 é×", ("Ab", "1", "é", "×"), (7, 0, 0, 8)), (None, (), ()),
    }

"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import grainsieve as g
from checks import inputs
from grainsieve import jobs
from grainsieve.functions import predicates as P
from grainsieve.functions import text as text_functions
from grainsieve.functions.compression import compression_ratio, compression_score
from grainsieve.functions.keyword_scan import keyword_counts, within_limits
from grainsieve.functions.keywords import count_keywords
from grainsieve.operators.holdout import VALIDATION
from grainsieve.operators.membership import split_stored_by_ids, store_by_id, store_ids
from grainsieve.plans.durable import scratch_path
from grainsieve.plans.recipes import ID_KEYS, META, NOT_EMPTY
from grainsieve.sinks.chunks import plan_chunks, write_chunks
from grainsieve.sinks.named import output_name, write_named
from grainsieve.sinks.quarantine import ingest_lines
from grainsieve.sinks.writers import (
    ingest,
    parquet_to_jsonl,
    write_filtered,
    write_jsonl,
    write_parquet,
    write_shards,
)
from grainsieve.sources.manifests import (
    read_manifest,
    read_manifest_table,
    read_ordered_manifest,
    write_manifest,
    write_manifest_table,
    write_ordered_manifest,
)
from grainsieve.sources.paths import file_sizes, split_files
from grainsieve.sources.readers import read_documents, read_jsonl, read_keyword_lists, read_split_files
from grainsieve.streaming.counts import count_stream, stream_counts
from grainsieve.streaming.recipes import filter_stream, stream_documents

DOCUMENT_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CONVERSATION_SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def kept_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept documents and characters per source after the wiki recipe."""
    kept = g.apply_recipe(inputs.documents(spark, sf_dir), g.recipe_for("en_wiki"))
    return kept.groupBy(F.col("meta.source").alias("source")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("characters")
    )


def reformat_documents(spark, sf_dir):
    nested = inputs.table(spark, sf_dir, "documents").select(
        F.col("text").alias("content"),
        F.struct("doc_id", "lang", F.lit("old").alias("source")).alias("meta"),
        "source",
        F.upper("lang").alias("text"),
    )
    return g.reformat(nested, "content").select(
        "text",
        "meta.doc_id",
        "meta.lang",
        "meta.source",
        F.col("meta.text").alias("meta_text"),
    )


def recipe_wiki(name):
    def run(spark, sf_dir):
        kept = g.apply_recipe(inputs.annotated(spark, sf_dir), g.recipe_for(name))
        return kept.select("meta.doc_id", "text")

    return run


def recipe_web_crawl(strict):
    def run(spark, sf_dir):
        recipe = g.recipe_for("ja_cc", strict, inputs.KEYWORDS)
        return g.apply_recipe(inputs.web(spark, sf_dir), recipe).select("meta.doc_id", "text")

    return run


def recipe_web_crawl_native(strict):
    """The recipe without its one non-SQL rule."""

    def run(spark, sf_dir):
        recipe = g.recipe_for("ja_cc", strict, inputs.KEYWORDS)
        rules = tuple(rule for rule in recipe.rules if rule.name != "compression")
        kept = g.apply_recipe(inputs.web(spark, sf_dir), replace(recipe, rules=rules))
        return kept.select("meta.doc_id", "text")

    return run


def rejections_web_crawl(spark, sf_dir):
    recipe = g.recipe_for("ja_cc", False, inputs.KEYWORDS)
    rules = tuple(rule for rule in recipe.rules if rule.name != "compression")
    judged = g.explain_rejections(inputs.web(spark, sf_dir), replace(recipe, rules=rules))
    names = [*(rule.name for rule in rules), "filled", "kept"]
    return judged.select("meta.doc_id", *names)


def recipe_subset_exclusion(spark, sf_dir):
    source = F.col("source")
    subset = F.when(source == "src1", F.lit("Books3")).when(source != "src2", source)
    mixed = inputs.documents(spark, sf_dir).select(
        "text", F.struct("doc_id", subset.alias("pile_set_name")).alias("meta")
    )
    kept = g.apply_recipe(mixed, g.recipe_for("en_pile"))
    return kept.select("meta.doc_id", "meta.pile_set_name", "text")


def recipe_code(spark, sf_dir):
    kept = g.apply_recipe(inputs.code(spark, sf_dir), g.recipe_for("code_stack"))
    return kept.select("meta.doc_id", "meta.ext", "meta.max_line_length", "meta.hexsha", "text")


def own_recipe(spark, sf_dir):
    """A recipe of the user's own: any boolean column is a rule, any text column a transform."""
    recipe = g.Recipe(
        "own",
        rules=(NOT_EMPTY, g.Rule("english", lambda: F.col("meta.lang") == "en", META)),
        transforms=(lambda text: text_functions.delete_matches(text, "[0-9]+"), F.lower),
    )
    kept = g.apply_recipe(inputs.documents(spark, sf_dir), recipe)
    return kept.select("meta.doc_id", "text")


def url_tld_filter(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.filter(P.has_valid_domain(F.col("url"), ("com", "org"))).select("page_id", "url")


def url_hosts(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    part = F.col("page_id") % 5
    url = (
        F.when(part == 0, F.replace("url", F.lit("://"), F.lit("://user:pw@")))
        .when(part == 1, F.upper("url"))
        .when(part == 2, F.replace("url", F.lit("://"), F.lit("/")))
        .when(part == 3, F.regexp_replace("url", "(example\\.[a-z]+)", "$1.:8080"))
        .otherwise(F.replace("url", F.lit("."), F.lit("_.")))
    )
    return pages.select(
        "page_id",
        text_functions.url_host(url).alias("host"),
        text_functions.host_suffix(url).alias("suffix"),
    )


def code_predicates(spark, sf_dir):
    table = inputs.code(spark, sf_dir)
    return table.select(
        "doc_id",
        P.has_valid_extension(F.col("ext")).alias("extension"),
        P.has_valid_max_line_length(1_000, F.col("max_line_length")).alias("max_line"),
        P.has_valid_avg_line_length(100, F.col("avg_line_length")).alias("avg_line"),
        P.has_valid_alphanum_fraction(0.7, F.col("alphanum_fraction")).alias("alphanum"),
    )


def not_empty(spark, sf_dir):
    return inputs.blanks(spark, sf_dir).filter(P.is_not_empty()).select("doc_id")


def japanese_prefix(spark, sf_dir):
    moved = inputs.web(spark, sf_dir).select(
        "doc_id", F.concat(F.repeat(F.lit("x"), (F.col("doc_id") % 60).cast("int")), "text").alias("text")
    )
    return moved.filter(P.is_japanese()).select("doc_id")


def sentence_length(limit):
    def run(spark, sf_dir):
        kept = inputs.web(spark, sf_dir).filter(P.has_good_average_sentence_length(limit))
        return kept.select("doc_id")

    return run


def keyword_count(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select(
        "doc_id", count_keywords(F.col("text"), inputs.WORDS).cast("bigint").alias("matches")
    )


def keyword_count_many(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select(
        "doc_id", count_keywords(F.col("text"), inputs.MANY_WORDS).cast("bigint").alias("matches")
    )


def keyword_reject(spark, sf_dir):
    return (
        inputs.documents(spark, sf_dir)
        .filter(P.has_few_keywords(inputs.WORDS, 30) & P.is_not_ad_content(("ing", "in"), 10))
        .select("doc_id")
    )


def keyword_katakana(spark, sf_dir):
    return inputs.annotated(spark, sf_dir).select(
        "doc_id", count_keywords(F.col("text"), inputs.KANA_WORDS).cast("bigint").alias("matches")
    )


def compression(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select(
        "doc_id", compression_ratio(F.col("text")).alias("ratio")
    )


def compression_band(spark, sf_dir):
    score = compression_score(F.col("text"), 0.01)
    return inputs.documents(spark, sf_dir).filter(score.between(0.3, 0.7)).select("doc_id")


def _plain_words(spark, sf_dir):
    """ASCII words of all texts that hold no three letters twice: deflate finds nothing to shorten in them."""
    found = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    words = inputs.documents(spark, sf_dir).select(F.explode(found).alias("word"))
    threes = F.transform(
        F.sequence(F.lit(1), F.length("word") - 2), lambda i: F.substring(F.col("word"), i, F.lit(3))
    )
    once = F.size(F.array_distinct(threes)) == F.length("word") - 2
    return words.filter((F.length("word") < 3) | once)


def compression_words(spark, sf_dir):
    rated = _plain_words(spark, sf_dir).select("word", compression_ratio(F.col("word")).alias("ratio"))
    return rated.groupBy("word").agg(
        F.count(F.lit(1)).alias("places"), F.min("ratio").alias("least"), F.max("ratio").alias("most")
    )


def compression_words_band(spark, sf_dir):
    score = compression_score(F.col("word"), 0.01)
    inside = _plain_words(spark, sf_dir).filter(score.between(1.75, 2.5))
    return inside.groupBy("word").agg(F.count(F.lit(1)).alias("places"))


def null_shards(spark, sf_dir):
    """Shards stored in two goes, some rows without one."""
    path = scratch_path(spark, "null-shards")
    shard = F.when(F.col("source") != "src3", F.col("source"))
    rows = inputs.table(spark, sf_dir, "documents").select("doc_id", shard.alias("shard"))
    write_shards(rows.filter("shard < 'src2'"), path)
    write_shards(rows, path)
    write_shards(rows, path)
    stored = spark.read.schema("doc_id BIGINT, shard STRING").parquet(path)
    return stored.groupBy("shard").agg(F.count(F.lit(1)).alias("documents"))


def _raw_pages(spark, sf_dir):
    part = F.col("doc_id") % 10
    split = F.when(part == 0, F.lit("test")).when(part == 1, F.lit("validation"))
    return inputs.documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), "text", F.coalesce(split, F.lit("train")).alias("split")
    )


def _filtered_job(spark, sf_dir):
    """Ingest, then the filter stage on what ingest wrote; gives the folder."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "filtered")
    ingest(_raw_pages(spark, sf_dir), raw)
    jobs.filter_corpus(spark, "en_wiki", raw, out, schema="id BIGINT, text STRING")
    return out


def job_filtered(spark, sf_dir):
    stored = spark.read.parquet(_filtered_job(spark, sf_dir))
    return stored.select("meta.id", "text", "split")


def _tokenized_job(spark, sf_dir):
    out = scratch_path(spark, "tokens")
    pieces = vocabulary(spark, sf_dir)
    jobs.tokenize_corpus_with_vocabulary(
        spark, [_filtered_job(spark, sf_dir)], out, pieces, inputs.PIECES, 0
    )
    return out


def job_tokens(spark, sf_dir):
    """All stages up to the token count, whose totals do not depend on how many shards there are."""
    _, totals = jobs.count_tokens(spark, [_tokenized_job(spark, sf_dir)])
    return totals.select("examples", "tokens")


def job_by_ids(spark, sf_dir):
    """Held-out rows of the fixed split, taken again by their ids: both splits of the train rows must agree."""
    tokens = _tokenized_job(spark, sf_dir)
    held, ids, again = (scratch_path(spark, name) for name in ("held", "ids", "by-ids"))
    jobs.split_corpus(spark, [tokens], held, "1", "parquet")
    jobs.extract_ids(spark, "en_wiki", [f"{held}/split=validation"], ids, "parquet")
    jobs.split_corpus_by_ids(spark, [tokens], again, ids, "parquet")
    first = spark.read.parquet(held).select("meta.id", F.col("split").alias("first"))
    second = spark.read.parquet(again).select("meta.id", "split")
    return first.join(second, "id").select("id", (F.col("first") == F.col("split")).alias("agrees"))


def job_listed(spark, sf_dir):
    """Kept pages split by a manifest of the ids of some of them, written in order and in parts."""
    pages = _filtered_job(spark, sf_dir)
    some, ids, out = (scratch_path(spark, name) for name in ("some", "ids", "listed"))
    write_parquet(spark.read.parquet(pages).filter(F.col("meta.id") % 7 == 0), some)
    jobs.extract_ids(spark, "en_wiki", [some], ids, "parquet", ordered=True)
    jobs.split_corpus_by_ids(spark, [pages], out, ids, "parquet")
    return spark.read.parquet(out).select("meta.id", F.col("split").cast("string").alias("split"))


def job_sampled(spark, sf_dir):
    """Without a train budget every train row is on one side; both are stored, converted and read."""
    sampled, lines = scratch_path(spark, "sampled"), scratch_path(spark, "lines")
    tokens = _tokenized_job(spark, sf_dir)
    shards, _ = jobs.count_tokens(spark, [tokens])
    jobs.sample_corpus(spark, [tokens], sampled, "-1", str(500 * shards.count()), "parquet")
    jobs.convert_to_jsonl(spark, [sampled], lines)
    stored = read_documents(spark, [lines], "jsonl", "text STRING, meta STRUCT<id: BIGINT>")
    return stored.select("meta.id", "text")


def chunk_resume(spark, sf_dir):
    """The filter stage in some six chunks of input files: a first run dies behind the second chunk, the next one does the rest."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "chunks")
    ingest(_raw_pages(spark, sf_dir), raw)
    files = split_files(spark, raw)
    split_of = {path: split for split, own in files.items() for path in own}
    started = []

    def read(own):
        started.append(own)
        if len(started) == 3:
            raise InterruptedError("the driver died")
        by_split = {}
        for path in own:
            by_split.setdefault(split_of[path], []).append(path)
        pages = read_split_files(spark, by_split, "id BIGINT, text STRING")
        return g.apply_recipe(pages, g.recipe_for("en_wiki"), carry=("split",))

    sizes = file_sizes(spark, list(split_of))
    chunks = plan_chunks(spark, list(split_of), max(1, sum(size for _, size in sizes) // 6))
    try:
        write_chunks(spark, chunks, out, read, write_filtered)
    except InterruptedError:
        write_chunks(spark, chunks, out, read, write_filtered)
    return spark.read.parquet(out).select("meta.id", "text", "split")


def named_shards(spark, sf_dir):
    """Both sides of a split under the names of their shards, read back by these; the first run stores only some."""
    path = scratch_path(spark, "named")
    counted = inputs.counted(spark, sf_dir).withColumn("shard", F.concat(F.lit("train_"), "shard"))
    split = g.holdout_per_shard(counted, 5, "shard", "doc_id")
    name = output_name(F.col("shard"), F.col("split"))
    write_named(split.filter("shard < 'train_src2'"), path, name, drop=("shard", "split"))
    write_named(split, path, name, drop=("shard", "split"))
    return read_documents(spark, [path], shard=True).select("doc_id", F.col("shard").alias("output"), "num_tokens")


def safe_overwrite(spark, sf_dir):
    """Of two overwriting jobs the first fails half-way; what is stored then is the second's, made from the rows it replaces."""
    path = scratch_path(spark, "overwritten")
    rows = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang")
    write_parquet(rows, path)
    broken = F.when(F.col("doc_id") % 100 == 99, F.raise_error(F.lit("half-way")).cast("long")).otherwise(0)
    try:
        write_parquet(rows.limit(0).unionByName(rows.withColumn("doc_id", broken)), path, overwrite=True)
    except Exception:  # noqa: BLE001
        stored = spark.read.parquet(path)
        write_parquet(stored.withColumn("doc_id", F.col("doc_id") + 1), path, overwrite=True)
    return spark.read.parquet(path)


def holdout_json_lines(spark, sf_dir):
    """Rows held out of JSON lines, told apart by file and number of their line."""
    lines = scratch_path(spark, "lines")
    write_jsonl(inputs.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("shard")), lines)
    stored = read_documents(spark, [lines], "jsonl", "doc_id BIGINT, shard STRING", row_id=True)
    split = g.holdout_per_shard(stored, 5, "shard", "row_id")
    return split.groupBy("shard", "split").agg(
        F.count(F.lit(1)).alias("documents"), F.count_distinct("row_id").alias("row_ids")
    )


def split_by_ids_stored(spark, sf_dir):
    """Documents and ids kept by id, then split bucket by bucket."""
    documents, ids = (f"stored_{name}_{uuid.uuid4().hex}" for name in ("documents", "ids"))
    store_by_id(inputs.counted(spark, sf_dir), documents, buckets=16, path=scratch_path(spark, "documents"))
    store_ids(_held_out_hashes(spark, sf_dir), ids, buckets=16, path=scratch_path(spark, "ids"))
    return split_stored_by_ids(spark, documents, ids).select("doc_id", "split")


def token_report(spark, sf_dir):
    split = g.holdout_per_shard(inputs.counted(spark, sf_dir).drop("text"), 7, "shard", "doc_id")
    return g.token_report(split)


def manifest_ordered(spark, sf_dir):
    """Hashes of all documents in their order, repeats kept, as one document in parts, read back with their places."""
    path = scratch_path(spark, "ordered")
    ids = inputs.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("id"))
    write_ordered_manifest(ids, ["doc_id"], path, None)
    key, found = read_ordered_manifest(spark, path)
    return found.withColumn("key", F.lit(key))


def quarantine(spark, sf_dir):
    """Every ninth document is cut short on its way to the file; both outputs are read back."""
    lines, good, bad = (scratch_path(spark, name) for name in ("lines", "good", "bad"))
    row = F.to_json(F.struct("doc_id", "lang"))
    damaged = F.when(F.col("doc_id") % 9 == 0, F.substring(row, 1, 9)).otherwise(row)
    inputs.table(spark, sf_dir, "documents").select(damaged.alias("value")).write.text(lines)
    files = [path for path, _ in file_sizes(spark, [lines])]
    ingest_lines(spark, files, "doc_id BIGINT, lang STRING", good, bad)
    stored = spark.read.parquet(good).select(F.lit("good").alias("output"), "doc_id", "lang", "_corrupt")
    return stored.unionByName(
        spark.read.parquet(bad).select(F.lit("bad").alias("output"), "doc_id", "lang", "_corrupt")
    )


def stream_token_counts(spark, sf_dir):
    """Shards counted as their files arrive, in two runs of one query."""
    landing, path, state = (scratch_path(spark, name) for name in ("landing", "counts", "counts-state"))
    counted = inputs.counted(spark, sf_dir).select("doc_id", "shard", "num_tokens")
    for part in (0, 1):
        counted.filter(F.col("doc_id") % 2 == part).write.mode("append").json(landing)
        arriving = stream_documents(spark, landing, "shard STRING, num_tokens INT")
        count_stream(arriving, path, state).awaitTermination()
    return stream_counts(spark, path)


def filter_evaluation(spark, sf_dir):
    """The score of a recipe on labelled JSON lines, from path to path."""
    path = scratch_path(spark, "labelled")
    source = F.col("meta.source")
    named = F.when(source == "src1", F.lit("Books3")).otherwise(source)
    labelled = inputs.labelled(spark, sf_dir)
    write_jsonl(labelled.select("text", F.struct("meta.label", named.alias("pile_set_name")).alias("meta")), path)
    schema = "text STRING, meta STRUCT<label: STRING, pile_set_name: STRING>"
    return jobs.evaluate_filter(spark, "en_pile", f"{path}/*.json", schema=schema)


def collection_ids(spark, sf_dir):
    """Ids of the same documents by the rule of each collection."""
    rows = inputs.table(spark, sf_dir, "documents").select(
        "text", F.struct(F.col("doc_id").alias("id"), F.reverse(F.md5("text")).alias("hexsha")).alias("meta")
    )
    tables = [g.document_ids(rows, key).withColumn("collection", F.lit(name)) for name, key in ID_KEYS.items()]
    return reduce(DataFrame.unionByName, tables)


_LISTS = {"ads": ("ing", "in"), "adult": inputs.WORDS, "discrimination": inputs.KANA_WORDS, "violence": inputs.MANY_WORDS}


def keyword_one_pass(spark, sf_dir):
    """Matches of four lists from one reading of each text."""
    counted = inputs.annotated(spark, sf_dir).select("doc_id", keyword_counts(F.col("text"), _LISTS).alias("found"))
    return counted.select("doc_id", *(F.col(f"found.{name}").cast("bigint").alias(name) for name in _LISTS))


def keyword_limits(spark, sf_dir):
    """Documents in which none of four lists passes its limit."""
    limits = {"ads": 200, "adult": 60, "discrimination": 1, "violence": 4000}
    kept = inputs.annotated(spark, sf_dir).filter(within_limits(F.col("text"), _LISTS, limits))
    return kept.select("doc_id")


def keyword_files(spark, sf_dir):
    """Documents few enough keywords are in, with the lists read from files."""
    paths = {}
    for name in ("ads", "adult", "discrimination", "violence"):
        paths[name] = scratch_path(spark, name)
        entries = [(word,) for word in getattr(inputs.KEYWORDS, name)]
        spark.createDataFrame(entries, "value STRING").coalesce(1).write.text(paths[name])
    lists = read_keyword_lists(spark, **{name: f"{path}/part-*" for name, path in paths.items()})
    return inputs.annotated(spark, sf_dir).select(
        "doc_id",
        *(
            count_keywords(F.col("text"), words).cast("bigint").alias(name)
            for name, words in (("adult", lists.adult), ("violence", lists.violence))
        ),
    )


def text_sizes(spark, sf_dir):
    size = F.octet_length("text")
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id",
        size.cast("bigint").alias("bytes"),
        F.round(F.lit(0.01) * F.ln(size), 9).alias("penalty"),
    )


def transform_query(transform):
    def run(spark, sf_dir):
        return inputs.annotated(spark, sf_dir).select(
            "doc_id", transform(F.col("text")).alias("text")
        )

    return run


def tokenize_subword(spark, sf_dir):
    tokenized = g.tokenize(
        inputs.documents(spark, sf_dir).select("doc_id", "text"), inputs.character_model()
    )
    return tokenized.select(
        "doc_id",
        F.array_join("tokens", "").alias("pieces"),
        F.array_join(F.col("token_ids").cast("array<string>"), " ").alias("ids"),
        F.col("num_tokens").cast("bigint").alias("num_tokens"),
    )


def vocabulary(spark, sf_dir):
    """Every piece of the benchmark texts, numbered by the start of its hash."""
    pieces = inputs.table(spark, sf_dir, "benchmark").select(
        F.explode(F.regexp_extract_all("text", F.lit(inputs.PIECES), F.lit(0))).alias("piece")
    )
    number = F.conv(F.substring(F.sha2("piece", 256), 1, 6), 16, 10).cast("int")
    return pieces.distinct().select("piece", number.alias("id"))


def repeated_id():
    """An id that many documents share and every third one lacks."""
    return F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 50).alias("doc_id")


def tokenize_vocabulary(doc_id="doc_id", **bounds):
    def run(spark, sf_dir):
        tokenized = g.tokenize_with_vocabulary(
            inputs.documents(spark, sf_dir).select(doc_id() if callable(doc_id) else doc_id, "text"),
            vocabulary(spark, sf_dir),
            inputs.PIECES,
            unknown_id=0,
            id_col="doc_id",
            **bounds,
        )
        return tokenized.select(
            "doc_id",
            F.array_join("tokens", "|").alias("pieces"),
            F.array_join(F.col("token_ids").cast("array<string>"), " ").alias("ids"),
            F.col("num_tokens").cast("bigint").alias("num_tokens"),
        )

    return run


def tokens_per_shard(spark, sf_dir):
    return g.tokens_per_shard(inputs.tokenized(spark, sf_dir).drop("text")).orderBy("shard")


def corpus_totals(spark, sf_dir):
    return g.corpus_totals(g.tokens_per_shard(inputs.tokenized(spark, sf_dir).drop("text")))


def holdout_per_shard(spark, sf_dir):
    split = g.holdout_per_shard(inputs.counted(spark, sf_dir), 5, "shard", "doc_id")
    return split.select("doc_id", "shard", "split")


def split_totals(spark, sf_dir):
    return g.split_totals(g.holdout_per_shard(inputs.counted(spark, sf_dir), "7", "shard", "doc_id"))


def rows_per_split(spark, sf_dir):
    return g.rows_per_split(g.holdout_per_shard(inputs.counted(spark, sf_dir), 7, "shard", "doc_id"))


def token_budget_sample(spark, sf_dir):
    counted = inputs.counted(spark, sf_dir)
    total = counted.agg(F.sum("num_tokens")).first()[0]
    sampled = g.sample_by_token_budget(
        counted, total // 3, total // 40, "shard", "doc_id", tokens_per_example=50
    )
    return sampled.select("doc_id", "shard", "split")


def hash_ids(spark, sf_dir):
    return g.document_ids(inputs.table(spark, sf_dir, "documents"))


def key_ids(spark, sf_dir):
    shaped = g.reformat(inputs.table(spark, sf_dir, "documents"))
    return g.document_ids(shaped, "doc_id")


def distinct_ids(spark, sf_dir):
    return g.distinct_ids(g.document_ids(inputs.table(spark, sf_dir, "documents")))


def _held_out_hashes(spark, sf_dir):
    split = g.holdout_per_shard(inputs.counted(spark, sf_dir), 5, "shard", "doc_id")
    return g.document_ids(split.filter(F.col("split") == VALIDATION))


def split_by_ids(**bounds):
    def run(spark, sf_dir):
        ids = _held_out_hashes(spark, sf_dir)
        split = g.split_by_ids(inputs.counted(spark, sf_dir), ids, **bounds)
        return split.select("doc_id", "split")

    return run


def rows_with_ids(spark, sf_dir):
    kept = g.rows_with_ids(inputs.counted(spark, sf_dir), _held_out_hashes(spark, sf_dir))
    return kept.select("doc_id", "num_tokens")


def rows_without_ids(spark, sf_dir):
    kept = g.rows_without_ids(inputs.counted(spark, sf_dir), _held_out_hashes(spark, sf_dir))
    return kept.select("doc_id", "num_tokens")


def allow_list(spark, sf_dir):
    good = inputs.table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    rows = inputs.table(spark, sf_dir, "documents").select("doc_id", "source")
    return g.rows_in_list(rows, "doc_id", good)


def split_write(spark, sf_dir):
    """Both sides written in one pass, one folder per split and shard, and read back."""
    path = scratch_path(spark, "split")
    split = g.holdout_per_shard(inputs.counted(spark, sf_dir), 5, "shard", "doc_id")
    write_parquet(split, path, ("split", "shard"))
    return spark.read.parquet(path).select(
        "doc_id", F.col("shard").cast("string").alias("shard"), "split", "num_tokens"
    )


def label_counts(spark, sf_dir):
    return g.label_counts(inputs.labelled(spark, sf_dir))


def _scored_recipe():
    return g.Recipe(
        "scored",
        rules=(
            NOT_EMPTY,
            g.Rule("few_words", lambda: P.has_few_keywords(inputs.WORDS, 30)),
            g.Rule("subset", lambda: P.is_not_excluded("src1", F.col("meta.source")), META),
        ),
    )


def filter_quality(spark, sf_dir):
    before = inputs.labelled(spark, sf_dir)
    return g.filter_quality(before, g.apply_recipe(before, _scored_recipe()))


def recipe_quality(spark, sf_dir):
    return g.recipe_quality(inputs.labelled(spark, sf_dir), _scored_recipe())


def label_shares(spark, sf_dir):
    quality = g.recipe_quality(inputs.labelled(spark, sf_dir), _scored_recipe())
    return g.with_label_shares(quality).select(
        "acceptable_share", "harmful_share", "low_quality_share"
    )


def jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "conversations")
    turns = inputs.table(spark, sf_dir, "conversations")
    missing = F.when(F.col("turn") > 0, F.col("role"))
    parquet_to_jsonl(turns.withColumn("role", missing), path)
    return read_jsonl(spark, path, CONVERSATION_SCHEMA)


def tolerant_jsonl(spark, sf_dir):
    """Every ninth document is cut short on its way to the file."""
    path = scratch_path(spark, "damaged")
    row = F.to_json(F.struct("doc_id", "lang"))
    damaged = F.when(F.col("doc_id") % 9 == 0, F.substring(row, 1, 9)).otherwise(row)
    inputs.table(spark, sf_dir, "documents").select(damaged.alias("value")).write.text(path)
    return read_jsonl(spark, path, "doc_id BIGINT, lang STRING", tolerant=True)


def parquet_shards(spark, sf_dir):
    """Some shards stored first and skipped when all are, then read with the shard's name and a row id."""
    path = scratch_path(spark, "shards")
    rows = inputs.table(spark, sf_dir, "documents").withColumnRenamed("source", "shard")
    write_shards(rows.filter("shard < 'src2'"), path)
    write_shards(rows, path)
    stored = read_documents(spark, [path], shard=True, row_id=True)
    return stored.groupBy("shard").agg(
        F.count(F.lit(1)).alias("documents"), F.count_distinct("row_id").alias("row_ids")
    )


def filtered_chunks(spark, sf_dir):
    path = scratch_path(spark, "filtered")
    split = F.when(F.col("doc_id") % 10 == 0, F.lit("validation")).otherwise(F.lit("train"))
    rows = inputs.documents(spark, sf_dir).withColumn("split", split)
    write_filtered(g.apply_recipe(rows, g.recipe_for("en_wiki"), carry=("split",)), path)
    return spark.read.parquet(path).select("meta.doc_id", "text", "split")


def ingest_counts(spark, sf_dir):
    part = F.col("doc_id") % 10
    split = F.when(part == 0, F.lit("test")).when(part == 1, F.lit("validation"))
    rows = inputs.table(spark, sf_dir, "documents")
    rows = rows.withColumn("split", F.coalesce(split, F.lit("train")))
    return ingest(rows, scratch_path(spark, "ingested"))


def concatenated_shards(spark, sf_dir):
    """Several paths read as one bag of rows."""
    files = [f"{sf_dir}/documents.parquet", f"{sf_dir}/missing.parquet"]
    shards = read_documents(spark, [*files, files[0]], shard=True)
    return shards.groupBy("shard", "lang").agg(F.count(F.lit(1)).alias("documents"))


def manifest_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    write_manifest(_held_out_hashes(spark, sf_dir), path, None)
    key, ids = read_manifest(spark, path)
    return ids.select(F.lit(key).alias("key"), "id")


def manifest_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "manifest-table")
    write_manifest_table(
        g.document_ids(inputs.table(spark, sf_dir, "documents")), path, None, fmt="jsonl"
    )
    return read_manifest_table(spark, path, "jsonl")


def stream_recipe(spark, sf_dir):
    path, state = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    landing = scratch_path(spark, "landing")
    write_jsonl(inputs.annotated(spark, sf_dir), landing)
    arriving = stream_documents(spark, landing, "doc_id BIGINT, text STRING")
    filter_stream(arriving, g.recipe_for("en_wiki"), path, state).awaitTermination()
    return spark.read.parquet(path).select("meta.doc_id", "text")


def parse_sizes(spark, sf_dir):
    items = inputs.table(spark, sf_dir, "lineitem")
    part = F.col("l_linenumber") % 7
    suffix = F.lit("")
    for place, letter in enumerate("kKMBGT", start=1):
        suffix = F.when(part == place, F.lit(letter)).otherwise(suffix)
    size = F.concat(F.col("l_quantity").cast("bigint").cast("string"), suffix)
    return items.select(
        "l_orderkey", "l_linenumber", text_functions.parse_size_column(size).alias("size")
    )


def shard_names(spark, sf_dir):
    path = F.concat(F.lit("/data/train_"), "source", F.lit(".train.parquet"))
    stem = text_functions.file_stem(path)
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", stem.alias("stem"), text_functions.validation_name(stem).alias("validation_stem")
    )


QUERIES = {
    "kept_by_source": kept_by_source,
    "reformat_documents": reformat_documents,
    "recipe_en_wiki": recipe_wiki("en_wiki"),
    "recipe_ja_wiki": recipe_wiki("ja_wiki"),
    "recipe_web_crawl": recipe_web_crawl(False),
    "recipe_web_crawl_strict": recipe_web_crawl(True),
    "recipe_web_crawl_native": recipe_web_crawl_native(False),
    "recipe_web_crawl_native_strict": recipe_web_crawl_native(True),
    "rejections_web_crawl": rejections_web_crawl,
    "recipe_subset_exclusion": recipe_subset_exclusion,
    "recipe_code": recipe_code,
    "own_recipe": own_recipe,
    "url_tld_filter": url_tld_filter,
    "url_hosts": url_hosts,
    "code_predicates": code_predicates,
    "not_empty": not_empty,
    "japanese_prefix": japanese_prefix,
    "sentence_length": sentence_length(250),
    "sentence_length_strict": sentence_length(80),
    "keyword_count": keyword_count,
    "keyword_count_many": keyword_count_many,
    "keyword_reject": keyword_reject,
    "keyword_katakana": keyword_katakana,
    "compression_ratio": compression,
    "compression_band": compression_band,
    "compression_words": compression_words,
    "compression_words_band": compression_words_band,
    "null_shards": null_shards,
    "job_filtered": job_filtered,
    "job_tokens": job_tokens,
    "job_by_ids": job_by_ids,
    "job_listed": job_listed,
    "job_sampled": job_sampled,
    "chunk_resume": chunk_resume,
    "named_shards": named_shards,
    "safe_overwrite": safe_overwrite,
    "holdout_json_lines": holdout_json_lines,
    "split_by_ids_stored": split_by_ids_stored,
    "token_report": token_report,
    "manifest_ordered": manifest_ordered,
    "quarantine": quarantine,
    "stream_token_counts": stream_token_counts,
    "filter_evaluation": filter_evaluation,
    "collection_ids": collection_ids,
    "keyword_files": keyword_files,
    "keyword_one_pass": keyword_one_pass,
    "keyword_limits": keyword_limits,
    "text_sizes": text_sizes,
    "extract_japanese": transform_query(text_functions.extract_japanese_text),
    "strip_footnotes": transform_query(text_functions.remove_wikipedia_footnote),
    "strip_parens": transform_query(text_functions.remove_empty_parenthesis),
    "tokenize_subword": tokenize_subword,
    "tokenize_vocab": tokenize_vocabulary(),
    "tokenize_vocab_joined": tokenize_vocabulary(max_rows=0),
    "tokenize_vocab_repeats": tokenize_vocabulary(repeated_id),
    "tokenize_vocab_repeats_joined": tokenize_vocabulary(repeated_id, max_rows=0),
    "tokens_per_shard": tokens_per_shard,
    "corpus_totals": corpus_totals,
    "holdout_per_shard": holdout_per_shard,
    "split_totals": split_totals,
    "rows_per_split": rows_per_split,
    "token_budget_sample": token_budget_sample,
    "hash_ids": hash_ids,
    "key_ids": key_ids,
    "distinct_ids": distinct_ids,
    "split_by_ids": split_by_ids(),
    "split_by_ids_shuffled": split_by_ids(max_rows=0),
    "rows_with_ids": rows_with_ids,
    "rows_without_ids": rows_without_ids,
    "allow_list": allow_list,
    "split_write": split_write,
    "label_counts": label_counts,
    "filter_quality": filter_quality,
    "recipe_quality": recipe_quality,
    "label_shares": label_shares,
    "jsonl_roundtrip": jsonl_roundtrip,
    "tolerant_jsonl": tolerant_jsonl,
    "parquet_shards": parquet_shards,
    "filtered_chunks": filtered_chunks,
    "ingest_counts": ingest_counts,
    "concatenated_shards": concatenated_shards,
    "manifest_roundtrip": manifest_roundtrip,
    "manifest_table_roundtrip": manifest_table_roundtrip,
    "stream_recipe": stream_recipe,
    "parse_sizes": parse_sizes,
    "shard_names": shard_names,
}

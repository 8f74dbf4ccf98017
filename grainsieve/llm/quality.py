"""A quality classifier: interpolated modified Kneser-Ney over bytes, trained on trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainsieve.llm.blocks import blobs, block_count, packed
from grainsieve.plans.durable import cut_lineage
from grainsieve.plans.joins import attach

ORDER = 4  # bytes of the longest n-gram; 7 at most, so that a key is a positive long
# A text is odd if its log-score lies above this quantile of its language's held-out trusted texts.
QUANTILE = 0.97
# So many held-out texts of any language count in each language's quantile, by how far they lie from the median of their own: a quantile of a few
# texts alone is that of one or two odd ones.
POOLED = 400
# One in so many distinct trusted texts is held out of training, for the thresholds.
HELD_OUT = 5
# Bytes of a typical trusted text added to every document, so that a few odd ones do not condemn a short text.
PRIOR_BYTES = 64

_SYMBOLS = 256
# Bytes of text whose keys are made at once.
_AT_ONCE = 1 << 20


def text_keys(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """n-gram keys of all texts behind each other, and how many each has: one per byte and one for its end.

    A key holds ``order`` bytes, the last lowest. Texts begin with zeros and end with one; a zero in a text counts
    as a one.
    """
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    pad = bytes(order - 1)
    joined = np.frombuffer(
        b"".join(pad + t.replace(b"\0", b"\1") + b"\0" for t in texts), dtype=np.uint8
    ).astype(np.int64)
    keys = np.zeros(len(joined), dtype=np.int64)
    for back in range(order):
        keys[back:] |= joined[: len(joined) - back] << (8 * back)
    inner = np.ones(len(joined), dtype=bool)
    starts = np.cumsum(sizes + order - 1) - (sizes + order - 1)
    for i in range(order - 1):
        inner[starts + i] = False
    return keys[inner], sizes


def _by_language(langs: pa.ChunkedArray) -> Iterator[tuple[str, np.ndarray]]:
    coded = pc.fill_null(langs, "").combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    for code, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, np.flatnonzero(codes == code)


def _encoded(texts, rows: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Rows and their texts in UTF-8, in parts of about ``_AT_ONCE`` bytes."""
    part, held, size = [], [], 0
    for i in rows.tolist():
        part.append(i)
        held.append((texts[i].as_py() or "").encode())
        size += len(held[-1])
        if size >= _AT_ONCE:
            yield np.array(part), held
            part, held, size = [], [], 0
    if part:
        yield np.array(part), held


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(found))
    return found, total.astype(np.int64)


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """(lang, key, count) over ``docs`` (lang, text, trusted): count in trusted texts, 0 for n-grams of others only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, trusted = batch.column("text"), batch.column("trusted")
            good = pc.fill_null(trusted, False).to_numpy(zero_copy_only=False)
            for lang, rows in _by_language(pa.chunked_array([batch.column("lang")])):
                seen, counts = [], []
                for part, held in _encoded(texts, rows):
                    keys, sizes = text_keys(held, order)
                    weight = np.repeat(good[part].astype(np.int64), sizes)
                    for column, values in zip((seen, counts), _summed([keys], [weight])):
                        column.append(values)
                found, total = _summed(seen, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(total)],
                    names=["lang", "key", "count"],
                )

    parts = docs.select("lang", "text", "trusted").mapInArrow(count, "lang string, key long, count long")
    return parts.groupBy("lang", "key").agg(F.sum("count").alias("count"))


def _suffix(key: Column, order: int) -> Column:
    return key.bitwiseAND(F.lit((1 << 8 * order) - 1))


def _discounts(table: DataFrame) -> DataFrame:
    """Per language, the three discounts of modified Kneser-Ney from the counts of counts."""
    n = [F.count(F.when(F.col("count") == i, 1)).cast("double").alias(f"n{i}") for i in range(1, 5)]
    y = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2")))
    y = F.coalesce(y, F.lit(0.5))

    def discount(i: int) -> Column:
        ratio = F.when(F.col(f"n{i}") > 0, F.col(f"n{i + 1}") / F.col(f"n{i}"))
        value = F.coalesce(i - (i + 1) * y * ratio, F.lit(i / 2))
        return F.least(F.greatest(value, F.lit(0.01 * i)), F.lit(float(i)))

    return (
        table.groupBy("lang")
        .agg(*n)
        .select("lang", *(discount(i).alias(f"d{i}") for i in (1, 2, 3)))
    )


def log_probabilities(counts: DataFrame, order: int) -> DataFrame:
    """(lang, key, logp) of every n-gram in ``counts``, by the model that the counts above 0 make.

    Every order is a table of its own, sharded by language and n-gram: how often an n-gram of the longest order stands in
    trusted text, and before how many different bytes a shorter one does. Shorter orders are solved first and joined to
    the longer ones by suffix. A language without trusted text gets no row.
    """
    tables, needed = {}, {order: counts.select("lang", "key")}
    tables[order] = counts.filter(F.col("count") > 0)
    for n in range(order - 1, 0, -1):
        tables[n] = cut_lineage(
            tables[n + 1].groupBy("lang", _suffix(F.col("key"), n).alias("key")).agg(F.count(F.lit(1)).alias("count"))
        )
        needed[n] = cut_lineage(needed[n + 1].select("lang", _suffix(F.col("key"), n).alias("key")).distinct())
    lower = None
    for n in range(1, order + 1):
        value = F.when(F.col("count") == 1, F.col("d1")).when(F.col("count") == 2, F.col("d2")).otherwise(F.col("d3"))
        cut = attach(tables[n], cut_lineage(_discounts(tables[n])), ["lang"]).select(
            F.col("lang").alias("__l"), F.col("key").alias("__k"), "count", value.alias("off")
        )
        context = cut.groupBy(
            F.col("__l").alias("__cl"), F.shiftright("__k", 8).alias("__ck")
        ).agg(F.sum("count").alias("total"), F.sum("off").alias("spared"))
        found = (
            needed[n]
            .join(cut, (F.col("lang") == F.col("__l")) & (F.col("key") == F.col("__k")), "left")
            .join(
                context,
                (F.col("lang") == F.col("__cl")) & (F.shiftright("key", 8) == F.col("__ck")),
                "left",
            )
        )
        if lower is None:
            below: Column = F.lit(1.0 / _SYMBOLS)
            found = found.filter(F.col("total").isNotNull())
        else:
            shorter = lower.select(F.col("lang").alias("__pl"), F.col("key").alias("__pk"), F.col("p").alias("__p"))
            found = found.join(
                shorter, (F.col("lang") == F.col("__pl")) & (_suffix(F.col("key"), n - 1) == F.col("__pk"))
            )
            below = F.col("__p")
        own = F.coalesce(F.greatest(F.col("count") - F.col("off"), F.lit(0.0)) / F.col("total"), F.lit(0.0))
        rest = F.coalesce(F.col("spared") / F.col("total"), F.lit(1.0)) * below
        lower = cut_lineage(found.select("lang", "key", (own + rest).alias("p")))
    return lower.select("lang", "key", F.log("p").alias("logp"))


def score_texts(docs: DataFrame, model: DataFrame, order: int, *, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs``, ``n_units`` and ``logp`` (of all units; null where no model has the language).

    Each block names the n-grams of its texts once; these are joined to the sharded model and come back to the block.
    """
    rows = docs.select(*(F.col(f"`{name}`") for name in keep), F.col("lang").alias("__lang"), F.col("text").alias("__text"))
    shape = rows.drop("__lang", "__text").schema
    store = packed(rows, block_count(docs, "text"))

    def name_keys(table: pa.Table) -> pa.Table:
        seen: dict[str, list[np.ndarray]] = {}
        for _, rows in blobs(table):
            for lang, at in _by_language(rows.column("__lang")):
                for _, held in _encoded(rows.column("__text"), at):
                    seen.setdefault(lang, []).append(np.unique(text_keys(held, order)[0]))
        block = table.column("block")[0].as_py()
        merged = {lang: np.unique(np.concatenate(parts)) for lang, parts in seen.items()}
        return pa.table(
            {
                "block": pa.array(np.full(sum(map(len, merged.values())), block, np.int32)),
                "lang": pa.array([lang for lang, keys in merged.items() for _ in keys], pa.string()),
                "key": pa.array(np.concatenate([*merged.values(), np.zeros(0, np.int64)])),
            }
        )

    asked = store.groupBy("block").applyInArrow(name_keys, "block int, lang string, key long")
    answers = asked.join(
        model.select(F.col("lang").alias("l"), F.col("key").alias("k"), "logp"),
        (F.col("lang") == F.col("l")) & (F.col("key") == F.col("k")),
    ).select(F.col("block").alias("b"), "lang", "key", "logp")

    def score(table: pa.Table, found: pa.Table) -> pa.Table:
        known = {}
        for lang, at in _by_language(found.column("lang")):
            own = found.take(pa.array(at))
            known[lang] = (own.column("key").combine_chunks(), own.column("logp").to_numpy())
        out = []
        for _, rows in blobs(table):
            units = np.zeros(rows.num_rows, dtype=np.int64)
            logp = np.full(rows.num_rows, np.nan)
            for lang, at in _by_language(rows.column("__lang")):
                for part, held in _encoded(rows.column("__text"), at):
                    keys, sizes = text_keys(held, order)
                    units[part] = sizes
                    if lang not in known:
                        continue
                    place = pc.index_in(pa.array(keys), value_set=known[lang][0])
                    if place.null_count:
                        raise RuntimeError("a block met other texts than it had asked for")
                    values = known[lang][1][place.to_numpy(zero_copy_only=False)]
                    logp[part] = np.add.reduceat(values, np.cumsum(sizes) - sizes)
            columns = [rows.column(i) for i in range(rows.num_columns - 2)]
            out.append(
                pa.table(
                    [*columns, pa.array(units), pa.array(logp, from_pandas=True)],
                    names=[*shape.names, "n_units", "logp"],
                )
            )
        return pa.concat_tables(out)

    fields = T.StructType([*shape.fields, T.StructField("n_units", T.LongType()), T.StructField("logp", T.DoubleType())])
    return store.groupBy("block").cogroup(answers.groupBy("b")).applyInArrow(score, fields)


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    quantile: float = QUANTILE,
    pooled: float = POOLED,
    prior_bytes: int = PRIOR_BYTES,
) -> DataFrame:
    """(doc_id, lang, text_hash, n_bytes, perplexity, score, threshold, kept) of every document.

    Trusted are documents that ``labels`` (doc_id, quality, toxic) call good and not toxic; where labels disagree the worst
    counts. One model per language (null and empty names are one) is trained on all of them but those held out by
    text hash. ``score`` is the perplexity per byte with ``prior_bytes`` of the language's median added. The limit of a language is the
    ``quantile`` of the log-scores of its n different held-out texts, weighing n, and its median plus that quantile of all languages' distances from
    their medians, weighing ``pooled``. Null and empty texts and languages without held-out or trained text are kept, with null figures:
    nothing speaks against them.
    """
    good = (
        labels.groupBy(F.col("doc_id").alias("doc_id"))
        .agg((F.bool_and(F.col("quality") == 1) & F.coalesce(F.bool_and(F.coalesce("toxic", F.lit(0)) == 0), F.lit(True))).alias("trusted"))
        .filter(F.col("trusted") & F.col("doc_id").isNotNull())
    )
    good = cut_lineage(good)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
        text.alias("text"),
    )
    rows = rows.filter(F.col("text") != "")
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    held = F.pmod("text_hash", F.lit(HELD_OUT)) == 0
    training = attach(hashed, good, ["doc_id"]).withColumn("trusted", F.col("trusted") & ~held)
    model = log_probabilities(cut_lineage(gram_counts(training, order)), order)
    scored = cut_lineage(
        attach(score_texts(hashed, model, order, keep=["doc_id", "lang", "text_hash"]), good, ["doc_id"])
    )
    sure = F.col("trusted") & held

    def middle(column: str, *shares: float) -> list[Column]:
        return [F.percentile_approx(column, share, 10_000) for share in shares]

    plain = scored.withColumn("own", -F.col("logp") / F.col("n_units"))
    # Copies of a text count once. Their scores are the same.
    trusted = plain.filter(sure).select("lang", "text_hash", "own", "logp", "n_units").dropDuplicates(["lang", "text_hash"])
    typical = cut_lineage(trusted.groupBy("lang").agg(middle("own", 0.5)[0].alias("typical")))

    def smooth(df: DataFrame) -> DataFrame:
        weighed = (prior_bytes * F.col("typical") - F.col("logp")) / (F.col("n_units") + prior_bytes)
        return attach(df, typical, ["lang"]).withColumn("logscore", weighed)

    smoothed, trusted = smooth(plain), cut_lineage(smooth(trusted).select("lang", "logscore"))
    half, high = middle("logscore", 0.5, quantile)
    own = cut_lineage(
        trusted.groupBy("lang").agg(half.alias("half"), high.alias("high"), F.count(F.lit(1)).alias("texts"))
    )
    away = attach(trusted, own.select("lang", "half"), ["lang"]).withColumn("away", F.col("logscore") - F.col("half"))
    usual = away.agg(middle("away", quantile)[0].alias("usual")).first()["usual"]
    share = F.col("texts") / (F.col("texts") + F.lit(float(pooled)))
    limit = share * F.col("high") + (1 - share) * (F.col("half") + F.lit(usual).cast("double"))
    limits = own.select("lang", limit.alias("limit"))
    judged = attach(smoothed, cut_lineage(limits), ["lang"]).select(
        "doc_id",
        "lang",
        "text_hash",
        (F.col("n_units") - 1).alias("n_bytes"),
        F.exp("own").alias("perplexity"),
        F.exp("logscore").alias("score"),
        F.exp("limit").alias("threshold"),
        F.coalesce(F.col("logscore") <= F.col("limit"), F.lit(True)).alias("kept"),
    )
    none = F.lit(None).cast("double")
    blank = docs.filter(text == "").select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
        F.xxhash64(F.lit("")).alias("text_hash"),
        F.lit(0).cast("long").alias("n_bytes"),
        none.alias("perplexity"),
        none.alias("score"),
        none.alias("threshold"),
        F.lit(True).alias("kept"),
    )
    return judged.unionByName(blank)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps. Rejected ones are told by id, language and text hash."""
    id_col, text_col, lang_col = (options.get(k, d) for k, d in (("id_col", "doc_id"), ("text_col", "text"), ("lang_col", "lang")))
    rejected = judge_quality(docs, labels, **options).filter(~F.col("kept"))
    rejected = cut_lineage(
        rejected.select("doc_id", "lang", "text_hash", F.lit(True).alias("__rejected")).distinct()
    )
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("__row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("text_hash"),
    )
    judged = attach(rows, rejected, ["doc_id", "lang", "text_hash"])
    return judged.filter(F.col("__rejected").isNull()).select("__row.*")

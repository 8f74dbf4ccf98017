"""Spelling variants: words one edit apart, found by walking a trie that is a table of edges."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainsieve.llm.numbering import shuffle_width
from grainsieve.plans.durable import cut_lineage, scratch_path

SHORTEST = 5
LEAST_COUNT = 3
# A form stands at least so many times as often as its variant.
FORM_RATIO = 2

# Nodes nearer to the root than this are on the paths of many words: their states are dealt over SALTS tasks.
SHALLOW = 5
SALTS = 16

# Different words that a task holds before it hands their counts on.
_HELD_WORDS = 200_000
_WORD = re.compile("[A-Za-zÀ-ÿ]+")


def planted_typo(doc_id: int | None, word: str, seed: int) -> str:
    """``word`` without one code point if 97 divides the checksum of id and word; ``seed`` is that of the id and a colon."""
    if doc_id is None:
        return word
    h = zlib.crc32(word.encode(), seed)
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    least: int = LEAST_COUNT,
    change: Callable[[int | None, str, int], str] | None = None,
) -> DataFrame:
    """(word, n) of words of ``shortest`` code points that all texts hold ``least`` times; counts are summed before the shuffle.

    ``change`` may alter a word of a document first, given its id, the word, and the checksum of id and colon.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            texts = pc.cast(batch.column("text"), pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                # bytes.lower changes A to Z alone.
                found = Counter(_WORD.findall((text.as_py() or b"").lower().decode()))
                if change is not None:
                    seed = zlib.crc32(f"{doc_id}:".encode())
                    for word, n in found.items():
                        word = change(doc_id, word, seed)
                        if len(word) >= shortest:
                            held[word] += n
                else:
                    for word, n in found.items():
                        if len(word) >= shortest:
                            held[word] += n
                if len(held) >= _HELD_WORDS:
                    yield handed()
                    held.clear()
        yield handed()

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    parts = rows.mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: a lineage cut whose copy is compressed."""
    path = scratch_path(df.sparkSession, f"variants-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _ranges(strings: DataFrame, column: str) -> DataFrame:
    """Rows dealt out by ranges of ``column``, in its order."""
    return strings.repartitionByRange(shuffle_width(strings.sparkSession), column).sortWithinPartitions(column)


def _shared(a: str, b: str) -> int:
    """Code points that two strings share at their beginnings."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


# Rows inside a range, its first one, and a last one that repeats the end of it.
_INSIDE, _FIRST, _LAST = 0, 1, 2


def _with_before(strings: DataFrame) -> DataFrame:
    """Each of the distinct strings ``s`` with how much it ``shares`` with the one before it in order (0 for the first).

    Each task looks along its own range. What stands before a range is the last string of an earlier one; of these there are as many
    as ranges, and the driver joins them up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = part = None
        for batch in batches:
            rows = batch.column("s").to_pylist()
            if not rows:
                continue
            kinds = [_INSIDE] * len(rows)
            shares = []
            for s in rows:
                shares.append(0 if last is None else _shared(last, s))
                last = s
            if part is None:
                part, kinds[0] = batch.column("part")[0].as_py(), _FIRST
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("s"), pa.array(shares, pa.int32()), pa.array(kinds, pa.int32())],
                names=["part", "s", "shares", "kind"],
            )
        if part is not None:
            columns = [pa.array([part], pa.int32()), pa.array([last]), pa.array([0], pa.int32()), pa.array([_LAST], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "s", "shares", "kind"])

    dealt = _ranges(strings, "s").select(F.spark_partition_id().alias("part"), "s")
    found = _kept(dealt.mapInArrow(run, "part int, s string, shares int, kind int"), "order")
    marks = sorted((r["part"], r["kind"], r["s"]) for r in found.filter(F.col("kind") != _INSIDE).collect())
    firsts, before = [], ""
    for _, kind, s in marks:
        if kind == _FIRST:
            firsts.append((s, _shared(before, s)))
        before = s
    inside = found.filter(F.col("kind") == _INSIDE).select("s", "shares")
    return inside.unionByName(strings.sparkSession.createDataFrame(firsts, "s string, shares int"))


def trie_edges(words: DataFrame, starts: DataFrame) -> DataFrame:
    """(node, label, child, child_id, child_n, child_letters) of the trie over ``words`` (s, id, n) with further nodes ``starts`` (s).

    Paths without branch are one edge. A node is named by the string it stands for; children that are no words have no id, ``child_letters`` are those its
    own edges begin with. Of strings in order, neighbours share exactly the branches of the trie, and a node shares with the one
    before it its parent.
    """
    branches = _with_before(words.select("s")).select(F.substring("s", F.lit(1), F.col("shares")).alias("s"))
    named = words.select("s", "id", "n")
    none = [F.lit(None).cast("long").alias(name) for name in ("id", "n")]
    nodes = named.unionByName(branches.unionByName(starts).filter(F.col("s") != "").select("s", *none))
    nodes = _kept(nodes.groupBy("s").agg(F.max("id").alias("id"), F.max("n").alias("n")), "nodes")
    placed = _with_before(nodes.select("s")).filter(F.col("shares") > 0).select(
        "s", F.substring("s", F.lit(1), F.col("shares")).alias("node"), F.expr("substring(s, shares + 1)").alias("label")
    )
    letters = placed.groupBy("node").agg(F.array_join(F.collect_set(F.substring("label", 1, 1)), "").alias("child_letters"))
    edges = placed.join(nodes, "s").join(letters.withColumnRenamed("node", "s"), "s", "left")
    return edges.select(
        "node",
        "label",
        F.col("s").alias("child"),
        F.col("id").alias("child_id"),
        F.col("n").alias("child_n"),
        F.coalesce("child_letters", F.lit("")).alias("child_letters"),
    )


def _salt(node: Column, by: Column) -> Column:
    return F.when(F.length(node) < SHALLOW, F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")


# What has been edited on a state's way: nothing, a letter exchanged, a letter inserted.
_PLAIN, _EXCHANGED, _INSERTED = 0, 1, 2


def _step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """All states one edge further; ``rest`` is what is left of the word behind its position.

    Without an edit yet, a state also leaves its word's path: along another edge one letter is exchanged, or inserted. A letter
    left out is the same as one inserted from the other word's side. Of the states reached, those are kept that are at an end or have an edge to go on by.
    """
    joined = frontier.withColumn("salt", _salt(F.col("node"), F.col("id"))).join(edges, ["node", "salt"])
    tail = F.expr("substring(label, 2)")
    own = F.col("rest").startswith(F.col("label"))
    leaves = (F.col("edit") == _PLAIN) & (F.substring("label", 1, 1) != F.substring("rest", 1, 1))
    exchanged = leaves & (F.length("rest") > 0) & F.expr("substring(rest, 2)").startswith(tail)
    inserted = leaves & F.col("rest").startswith(tail)

    def state(when: Column, eaten: str, edit: Column) -> Column:
        return F.when(when, F.struct(F.expr(f"substring(rest, {eaten})").alias("rest"), edit.cast("byte").alias("edit")))

    moves = F.array(
        state(own, "length(label) + 1", F.col("edit")),
        state(exchanged, "length(label) + 1", F.lit(_EXCHANGED)),
        state(inserted, "length(label)", F.lit(_INSERTED)),
    )
    return (
        joined.filter(own | exchanged | inserted)
        .select(
            "id", "n", F.explode(moves).alias("move"), F.col("child").alias("node"), "child_id", "child_n", "child_letters"
        )
        .filter(F.col("move").isNotNull())
        .select("id", "n", "move.rest", "move.edit", "node", "child_id", "child_n", "child_letters")
        .filter(
            F.when((F.col("edit") == _PLAIN), F.col("child_letters") != "")
            .when(F.col("rest") == "", F.col("child_id").isNotNull())
            .otherwise(F.contains("child_letters", F.substring("rest", 1, 1)))
        )
        .drop("child_letters")
    )


def near_words(words: DataFrame) -> DataFrame:
    """(id, near, near_n) of ``words`` (word, id, n) that differ by one inserted, deleted or replaced code point; every pair both ways, once.

    One edit leaves the first or the second half of a word as it is. Words go into the trie as they are and backwards, and the
    frontier starts at the half of each: states of word, position, node and edit are joined with the edges level by level, where
    paths fork. A state that ends with its word, after one edit, at a word's node has found a neighbour. Words of any length and any number of
    neighbours are found whole.
    """
    half = F.floor(F.length("word") / 2).cast("int")
    ways = [
        words.select(F.concat(F.lit(">"), "word").alias("s"), "id", "n", (1 + half).alias("position")),
        words.select(F.concat(F.lit("<"), F.reverse("word")).alias("s"), "id", "n", (1 + F.length("word") - half).alias("position")),
    ]
    both = ways[0].unionByName(ways[1])
    frontier = both.select(
        "id", "n", F.expr("substring(s, position + 1)").alias("rest"), F.lit(_PLAIN).cast("byte").alias("edit"),
        F.expr("substring(s, 1, position)").alias("node"),
    )
    edges = trie_edges(both.drop("position"), frontier.select(F.col("node").alias("s")).distinct())
    salts = F.when(F.length("node") < SHALLOW, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    # Dealt once for all levels. What an executor loses of it is made again from the table below.
    edges = _kept(edges.withColumn("salt", F.explode(salts)), "edges")
    edges = edges.repartition(shuffle_width(words.sparkSession), "node", "salt").sortWithinPartitions("node", "salt")
    edges = edges.persist(StorageLevel.DISK_ONLY)
    found = []
    while True:
        states = _kept(_step(frontier, edges), "states")
        ended = (F.col("edit") != _PLAIN) & (F.col("rest") == "")
        found.append(states.filter(ended & F.col("child_id").isNotNull()).select("id", "n", "edit", "child_id", "child_n"))
        frontier = states.filter(~ended).drop("child_id", "child_n")
        if frontier.isEmpty():
            break
    edges.unpersist()
    there = F.struct("id", F.col("child_id").alias("near"), F.col("child_n").alias("near_n"))
    back = F.struct(F.col("child_id").alias("id"), F.col("id").alias("near"), F.col("n").alias("near_n"))
    pairs = reduce(DataFrame.unionByName, found)
    return (
        pairs.select(F.explode(F.when(F.col("edit") == _INSERTED, F.array(there, back)).otherwise(F.array(there))).alias("pair"))
        .select("pair.*")
        .repartition("id")
        .distinct()
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): the end of the chain of forms from each word of ``forms`` (id, form). Each round doubles what is followed."""
    links = cut_lineage(forms.select("id", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("id").alias("root"), F.col("root").alias("next"))
        longer = cut_lineage(links.join(ahead, "root", "left").select("id", "root", "next"))
        if longer.filter(F.col("next").isNotNull()).isEmpty():
            return longer.select("id", "root")
        links = longer.select("id", F.coalesce("next", "root").alias("root"))


def spelling_variants(counts: DataFrame, *, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``counts`` (word, n; words differ and are not null).

    A word's form is its most frequent near word (ties: the smallest) if that is at least ``ratio`` times as frequent; ``root`` follows forms
    to the last, which is the word itself where there is none. An empty table gives no rows.
    """
    plain = counts.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n"))
    # Ids follow the order of the words, so the smallest word has the smallest id.
    words = _kept(_ranges(plain, "word").withColumn("id", F.monotonically_increasing_id()), "words")
    near = near_words(words).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("last"), "near")).alias("best")
    )
    judged = _kept(near.select("id", "n_near", F.col("best.near").alias("form"), (-F.col("best.last")).alias("form_n")), "near")
    enough = F.col("form_n") >= ratio * F.col("n")
    forms = _kept(
        words.join(judged, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            *(F.when(enough, F.col(name)).alias(name) for name in ("form", "form_n")),
        ),
        "forms",
    )
    changed = forms.filter(F.col("form").isNotNull())
    names = [words.select(F.col("id").alias(key), F.col("word").alias(name)) for key, name in (("form", "f"), ("root", "r"))]
    # Words without a form, which are most, need no join.
    named = changed.join(_roots(changed), "id").join(names[0], "form").join(names[1], "root")
    alone = forms.filter(F.col("form").isNull()).select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n"
    )
    return alone.unionByName(named.select("word", F.col("f").alias("form"), F.col("r").alias("root"), "n", "n_near", "form_n"))

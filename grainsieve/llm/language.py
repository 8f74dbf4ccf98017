"""Language identification: first the family, then one-versus-one support vector machines inside it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainsieve.plans.durable import cut_lineage

UNDETERMINED = "und"
# Different texts a language is learned from, about: those with the smallest seeded hashes.
LEARNED = 600
# Languages that are learned: those with the most different texts.
LANGUAGES = 256
# Texts of all languages together that tell the families apart.
FAMILY_TEXTS = 3000
SEED = 11

# Buckets that byte n-grams of one to four letters are hashed into.
DIM = 1 << 13
_GRAM = 4
# Texts and bytes that are counted at once.
_TEXTS = 64
_AT_ONCE = 1 << 20
_OTHER = re.compile(rb"[^a-z\x80-\xff]+")
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    """Whether any code point is a letter of some script."""
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def _framed(text: str) -> bytes:
    """Lower-cased letters, all else made single blanks, with blanks around for n-grams at the ends."""
    return b" " + _OTHER.sub(b" ", text.lower().encode()).strip() + b" " * _GRAM


def _counted(frames: list[bytes]) -> np.ndarray:
    """Counts of hashed n-grams, a row per frame. N-grams start anywhere but in the last ``_GRAM`` - 1 blanks."""
    sizes = np.array([len(f) - _GRAM + 1 for f in frames], dtype=np.int64)
    joined = np.frombuffer(b"".join(frames), dtype=np.uint8).astype(np.uint32)
    starts = np.cumsum(sizes + _GRAM - 1) - (sizes + _GRAM - 1)
    row = np.repeat(np.arange(len(frames)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    code = np.zeros(len(at), dtype=np.uint32)
    out = np.zeros(len(frames) * DIM, dtype=np.int64)
    for n in range(_GRAM):
        code |= joined[at + n] << np.uint32(8 * n)
        hashed = (code + np.uint32(n * 0x9E3779B9 % 2**32)) * np.uint32(2654435761)
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(2246822519)
        out += np.bincount(row * DIM + (hashed >> np.uint32(19)), minlength=len(out))
    return out.reshape(len(frames), DIM)


def gram_shares(texts: list[str]) -> np.ndarray:
    """Square roots of the shares of hashed n-grams of each whole text: rows of length 1."""
    counts = np.zeros((len(texts), DIM), dtype=np.int64)
    part: list[int] = []
    frames: list[bytes] = []
    held = 0

    def done() -> None:
        nonlocal held
        np.add.at(counts, part, _counted(frames))
        part.clear()
        frames.clear()
        held = 0

    for i, text in enumerate(texts):
        frame = _framed(text)
        # A long text is counted in pieces that share the letters an n-gram reaches over.
        for first in range(0, max(1, len(frame) - _GRAM + 1), _AT_ONCE):
            piece = frame[first : first + _AT_ONCE + _GRAM - 1]
            part.append(i)
            frames.append(piece)
            held += len(piece)
            if held >= _AT_ONCE:
                done()
    if frames:
        done()
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def _parts(texts: list) -> Iterator[tuple[int, int]]:
    for at in range(0, len(texts), _TEXTS):
        yield at, min(at + _TEXTS, len(texts))


def families_of(profiles: np.ndarray, count: int) -> list[list[int]]:
    """Languages (rows of mean shares) in ``count`` families: the two closest are made one again and again, by average cosine."""
    unit = profiles / np.maximum(np.linalg.norm(profiles, axis=1, keepdims=True), 1e-12)
    close = unit @ unit.T
    groups = [[i] for i in range(len(profiles))]
    while len(groups) > count:
        _, a, b = max(
            (close[np.ix_(groups[a], groups[b])].mean(), -a, -b) for a, b in combinations(range(len(groups)), 2)
        )
        groups[-a] = sorted(groups[-a] + groups[-b])
        del groups[-b]
    return sorted(groups)


def linear_svm(rows: np.ndarray, sign: np.ndarray, cost: float = 20.0, rounds: int = 30) -> np.ndarray:
    """Weights and bias (last) of a support vector machine, by coordinate ascent on its dual."""
    random = np.random.default_rng(SEED)
    x = np.concatenate([rows, np.ones((len(rows), 1), dtype=rows.dtype)], axis=1)
    length = (x * x).sum(axis=1)
    weights, alpha = np.zeros(x.shape[1], dtype=np.float64), np.zeros(len(x))
    for _ in range(rounds):
        largest = 0.0
        for i in random.permutation(len(x)).tolist():
            slope = sign[i] * float(x[i] @ weights) - 1
            new = min(max(alpha[i] - slope / length[i], 0.0), cost)
            step = new - alpha[i]
            if step:
                weights += step * sign[i] * x[i]
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return weights


@dataclass(frozen=True)
class LanguageModel:
    """Families of languages, a separating plane for each, and planes between the languages of a family."""

    names: list[str]
    families: list[list[int]]
    family_planes: np.ndarray
    pairs: list[list[tuple[int, int]]]
    pair_planes: list[np.ndarray]

    def judge(self, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number and score of each row.

        The family with the largest margin is taken; in it every pair of languages votes, ties go to the larger sum of margins, then to the
        smaller name. The score grows with the lead of the family and with the winner's smallest margin.
        """
        x = np.concatenate([shares, np.ones((len(shares), 1))], axis=1)
        best = np.zeros(len(x), dtype=np.int64)
        score = np.ones(len(x))
        if len(self.families) > 1:
            margins = x @ self.family_planes.T
            best = margins.argmax(axis=1)
            two = np.partition(margins, -2, axis=1)[:, -2:]
            score /= 1 + np.exp(-2 * (two[:, 1] - two[:, 0]))
        found = np.array([members[0] for members in self.families])[best]
        for family, members in enumerate(self.families):
            rows = np.flatnonzero(best == family)
            if len(members) < 2 or not len(rows):
                continue
            margins = x[rows] @ self.pair_planes[family].T
            votes, sums = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            least = np.full((len(rows), len(members)), np.inf)
            for k, (a, b) in enumerate(self.pairs[family]):
                for one, m in ((members.index(a), margins[:, k]), (members.index(b), -margins[:, k])):
                    votes[:, one] += m > 0
                    sums[:, one] += m
                    least[:, one] = np.minimum(least[:, one], m)
            rank = np.lexsort((np.broadcast_to(np.arange(len(members)), votes.shape), -sums, -votes), axis=1)[:, 0]
            found[rows] = np.array(members)[rank]
            score[rows] /= 1 + np.exp(-2 * least[np.arange(len(rows)), rank])
        return found, score


def _packed(shares: np.ndarray) -> tuple[bytes, bytes]:
    at = np.flatnonzero(shares)
    return at.astype(np.uint16).tobytes(), shares[at].astype(np.float32).tobytes()


def _unpacked(table: pa.Table) -> np.ndarray:
    """Rows of shares in the order of their hashes, the same however the rows came here."""
    table = table.sort_by("hash")
    out = np.zeros((table.num_rows, DIM), dtype=np.float32)
    for row, at, value in zip(out, table.column("at"), table.column("value")):
        row[np.frombuffer(at.as_buffer(), dtype=np.uint16)] = np.frombuffer(value.as_buffer(), dtype=np.float32)
    return out


def _features(rows: DataFrame) -> DataFrame:
    """(lang, hash, at, value) of ``rows`` (lang, hash, text) whose text has a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _parts(texts):
                fine = [i for i in range(a, b) if has_letter(texts[i])]
                if fine:
                    packed = [_packed(row) for row in gram_shares([texts[i] for i in fine])]
                    own = batch.take(pa.array(fine))
                    columns = [own.column("lang"), own.column("hash"), *(pa.array(c, pa.binary()) for c in zip(*packed))]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "hash", "at", "value"])

    return rows.mapInArrow(run, "lang string, hash long, at binary, value binary")


def _profile(table: pa.Table) -> pa.Table:
    mean = _unpacked(table).mean(axis=0, dtype=np.float64)
    return pa.table({"lang": table.column("lang")[:1], "profile": pa.array([mean.tobytes()], pa.binary())})


def _plane(table: pa.Table) -> pa.Table:
    sign = table.sort_by("hash").column("sign").to_numpy().astype(np.float64)
    weights = linear_svm(_unpacked(table), sign)
    return pa.table({"task": table.column("task")[:1], "plane": pa.array([weights.tobytes()], pa.binary())})


def fit_languages(
    learn: DataFrame, *, learned: int = LEARNED, languages: int = LANGUAGES, family_texts: int = FAMILY_TEXTS
) -> LanguageModel | None:
    """A model from ``learn`` (lang, text), where neither is null; None if there is nothing to learn from.

    A language is learned from about ``learned`` of its different texts, chosen by seeded hash, whole. Equal texts count once. Families come from the
    languages' mean n-gram shares: as many as the square root of the number of languages. The planes are fitted side by side, each by a task with a
    bounded sample; what comes to the driver are one profile per language and the planes.
    """
    spark = learn.sparkSession
    hashed = learn.select("lang", F.xxhash64(F.lit(SEED), "text").alias("hash"), "text")
    sizes = hashed.select("lang", "hash").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    known = sizes.orderBy(F.desc("texts"), "lang").limit(languages).collect()
    if not known:
        return None
    # The hash is even, so that a share of its range holds about the same share of the texts.
    limits = [(r["lang"], int(min(1.0, learned / r["texts"]) * 2**31)) for r in known]
    bound = F.broadcast(spark.createDataFrame(limits, "lang string, bound long"))
    chosen = (
        hashed.join(bound, "lang")
        .filter(F.pmod(F.col("hash"), F.lit(2**31)) < F.col("bound"))
        .select("lang", "hash", "text")
        .dropDuplicates(["lang", "hash"])
    )
    features = cut_lineage(_features(chosen))
    profiles = dict(features.groupBy("lang").applyInArrow(_profile, "lang string, profile binary").collect())
    names = sorted(profiles)
    if not names:
        return None
    mean = np.stack([np.frombuffer(profiles[name]) for name in names])
    families = families_of(mean, max(1, round(len(names) ** 0.5)))
    share = int(min(1.0, family_texts / (learned * len(names))) * 2**16)
    tasks, pairs = [], []
    for family, members in enumerate(families):
        if len(families) > 1:
            tasks += [(name, f"family {family}", 1 if i in members else -1, share) for i, name in enumerate(names)]
        pairs.append(list(combinations(members, 2)))
        for a, b in pairs[-1]:
            tasks += [(names[a], f"pair {a} {b}", 1, 2**16), (names[b], f"pair {a} {b}", -1, 2**16)]
    planes = {}
    if tasks:
        wanted = F.broadcast(spark.createDataFrame(tasks, "lang string, task string, sign int, share int"))
        few = F.pmod(F.xxhash64("hash"), F.lit(2**16)) < F.col("share")
        rows = features.join(wanted, "lang").filter(few).select("task", "sign", "hash", "at", "value")
        fitted = rows.groupBy("task").applyInArrow(_plane, "task string, plane binary").collect()
        planes = {task: np.frombuffer(plane) for task, plane in fitted}
    none = np.zeros(DIM + 1)
    return LanguageModel(
        names,
        families,
        np.stack([planes.get(f"family {f}", none) for f in range(len(families))]),
        pairs,
        [np.stack([planes.get(f"pair {a} {b}", none) for a, b in own]) if own else none[None] for own in pairs],
    )


def held_out(doc_id: Column) -> Column:
    """Whether a row may not be learned from: the checksum of its id leaves 2. Rows without id are not held out, but not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    model: LanguageModel | None = None,
    learned: int = LEARNED,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, from its whole text alone.

    Without a ``model``, one is fitted on rows with id, text and language that are not ``held_out``. A text that is null or has no letter is
    ``und`` with score 0, and so is every text where nothing could be learned. Documents are not shuffled.
    """
    text = F.col(f"`{text_col}`").cast("string")
    identity, lang = F.col(f"`{id_col}`"), F.col(f"`{lang_col}`").cast("string")
    if model is None:
        usable = identity.isNotNull() & ~held_out(identity) & text.isNotNull() & lang.isNotNull()
        model = fit_languages(docs.filter(usable).select(lang.alias("lang"), text.alias("text")), learned=learned)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _parts(range(batch.num_rows)):
                part = batch.slice(a, b - a)
                texts = part.column("text").to_pylist()
                fine = np.array([i for i, t in enumerate(texts) if shared.value is not None and has_letter(t)], dtype=np.int64)
                names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if len(fine):
                    found, scores[fine] = shared.value.judge(gram_shares([texts[i] for i in fine]))
                    for i, one in zip(fine.tolist(), found.tolist()):
                        names[i] = shared.value.names[one]
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(names), pa.array(np.round(scores, 9))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(identity.alias("doc_id"), held_out(identity).alias("held_out"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")

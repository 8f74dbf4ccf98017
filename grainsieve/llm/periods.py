"""Periodic runs of words, found by block convolution at dyadic scales."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainsieve.llm.ntt import squared_differences_vanish

# A run has at least so many words, and at least two periods.
LEAST = 12
# Words that are searched side by side; a longer text is searched alone.
SLICE_WORDS = 1 << 18
# Numbers in one array of transforms.
CELLS = 1 << 19

RUN = "struct<start:long,length:long,period:long>"


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(block, smallest distance, largest distance) of each scale for texts of up to ``longest`` words.

    A run of period q has an aligned block whose copy q words further lies in the run as well if the words before the last
    period, at least q and at least ``LEAST`` - q, are no fewer than two blocks less one.
    """
    block, low = 2, 1
    while 2 * low <= longest:
        high = 6 if block == 2 else 4 * block - 2
        yield block, low, high
        block, low = 2 * block, high + 1


def _recurring(ids: np.ndarray, order: np.ndarray, ranked: np.ndarray, at: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whether the word at each place ``at`` stands again ``low`` to ``high`` places further."""
    n = len(ids)
    key = ids[at] * np.int64(2 * n) + at
    nxt = np.searchsorted(ranked, key + low)
    inside = nxt < n
    out = np.zeros(len(at), dtype=bool)
    out[inside] = ranked[nxt[inside]] <= key[inside] + high
    return out


def _reach(ids: np.ndarray, text: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words from ``at`` on, going by ``step``, equal those ``distance`` further; fewer than ``most``."""
    out = np.zeros(len(at), dtype=np.int64)
    moves = np.arange(most, dtype=np.int64) * step
    rows = max(1, CELLS // most)
    n = len(ids)
    for first in range(0, len(at), rows):
        left = at[first : first + rows, None] + moves
        right = left + distance[first : first + rows, None]
        valid = (left >= 0) & (right < n)
        left, right = np.where(valid, left, 0), np.where(valid, right, 0)
        same = valid & (ids[left] == ids[right])
        # Equal ids stand in one text only.
        out[first : first + rows] = np.where(same.all(axis=1), most, same.argmin(axis=1))
    return out


def runs_of(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """For each text (word numbers from 0), its runs as rows (start, length, period), ordered by start, then period.

    At each scale, blocks of a power of two of words are looked for in the words that follow, by exact sums of squared
    differences. Blocks holding a word that does not come again there are left out beforehand, as they cannot occur. Neighbouring
    blocks that recur at one distance form a chain, which is extended by less than a block on either side. A stretch found with several
    periods has the smallest.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    n = int(sizes.sum())
    none = np.zeros((0, 3), dtype=np.int64)
    if not n:
        return [none] * len(texts)
    local = np.concatenate(texts).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    kinds = np.array([int(t.max()) + 1 if len(t) else 0 for t in texts], dtype=np.int64)
    ids = local + (np.cumsum(kinds) - kinds)[text]
    place = np.arange(n, dtype=np.int64)
    order = np.argsort(ids, kind="stable")
    ranked = ids[order] * np.int64(2 * n) + order
    repeated = np.bincount(ids)[ids] > 1
    starts, stops, periods = [], [], []
    # The longest run known so far at each word.
    cover_end, cover_period = np.zeros(n, dtype=np.int64), np.ones(n, dtype=np.int64)
    for block, low, high in scales(int(sizes.max())):
        # Blocks lie on multiples of their size, wholly inside one text, with room for a copy behind them.
        blocks = place[: n - block + 1 : block]
        ok = (text[blocks] == text[blocks + block - 1]) & (blocks + low + block <= ends[text[blocks]])
        if block <= 64:
            for k in range(block):
                ok[ok] &= repeated[blocks[ok] + k]
            for k in range(block):
                here = np.flatnonzero(ok)
                ok[here] = _recurring(ids, order, ranked, blocks[here] + k, low, high)
        blocks = blocks[ok]
        if block > 64 and len(blocks):
            inner = np.concatenate([[0], np.cumsum(~repeated)])
            blocks = blocks[inner[blocks + block] == inner[blocks]]
            for k in range(0, block, block // 64):
                blocks = blocks[_recurring(ids, order, ranked, blocks + k, low, high)]
        shifts = high - low + 1
        width = shifts + block - 1
        rows = max(1, CELLS // (2 * width))
        found_at, found_by = [], []
        for first in range(0, len(blocks), rows):
            part = blocks[first : first + rows]
            window = part[:, None] + np.arange(low, low + width)
            outside = window >= ends[text[part]][:, None]
            values = local[np.where(outside, 0, window)] + 1
            values[outside] = 0  # equals no word
            own = local[part[:, None] + np.arange(block)] + 1
            row, shift = np.nonzero(squared_differences_vanish(own, values, shifts))
            found_at.append(part[row])
            found_by.append(shift + low)
        if not found_at:
            continue
        at, distance = np.concatenate(found_at), np.concatenate(found_by).astype(np.int64)
        if not len(at):
            continue
        by = np.lexsort((at, distance))
        at, distance = at[by], distance[by]
        new = np.concatenate([[True], (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + block)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        begin, end, period = at[first], at[last] + block, distance[first]
        # Inside a run whose period divides the distance, the stretch is that run again.
        known = (end + period <= cover_end[begin]) & (period % cover_period[begin] == 0)
        begin, end, period = begin[~known], end[~known], period[~known]
        begin = begin - _reach(ids, text, begin - 1, period, -1, block)
        end = end + period + _reach(ids, text, end, period, 1, block)
        long_enough = end - begin >= np.maximum(least, 2 * period)
        starts.append(begin[long_enough])
        stops.append(end[long_enough])
        periods.append(period[long_enough])
        long_runs = np.flatnonzero(long_enough & (end - begin > high + 2 * block))
        for i in long_runs[np.lexsort((-period[long_runs], (end - begin)[long_runs]))].tolist():
            cover_end[begin[i] : end[i]], cover_period[begin[i] : end[i]] = end[i], period[i]
    if not starts:
        return [none] * len(texts)
    begin, end, period = (np.concatenate(c) for c in (starts, stops, periods))
    by = np.lexsort((period, end, begin))
    begin, end, period = begin[by], end[by], period[by]
    smallest = np.concatenate([[True], (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])])[: len(begin)]
    begin, end, period = begin[smallest], end[smallest], period[smallest]
    by = np.lexsort((period, begin))
    begin, end, period = begin[by], end[by], period[by]
    owner = text[begin]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    rows = np.stack([begin - begins[owner], end - begin, period], axis=1)
    return [rows[a:b] for a, b in zip(cuts, cuts[1:])]


def kept_words(count: int, runs: np.ndarray) -> np.ndarray:
    """Which words are in no run, or only within the first period of those that hold them."""
    edge = np.zeros(count + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return edge[:-1].cumsum() == 0


def plant(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document by the checksum of its id made periodic from some word on; without id, as it is."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * -(-(n - a) // p))[: n - a]


def _numbers(words: list[bytes]) -> np.ndarray:
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def periodic_runs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    keep_text: bool = False,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed_sha256[, collapsed]) of every document; nothing is shuffled.

    Words are what stands between ASCII white space, in UTF-8; ``prepare`` may change them first. A run is a maximal stretch of at least
    ``least`` words and two periods that repeats with its smallest period; ``runs`` has (start, length, period) of each by start, then
    period. The collapsed text has every run's first period only, words joined by a blank. Null and empty texts have no words and no runs.
    Rows may repeat, and ids may be null.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(ids: list, words: list[list[bytes]], numbers: list[np.ndarray]) -> pa.RecordBatch:
            found = runs_of(numbers, least)
            texts = []
            for own, runs in zip(words, found):
                if len(runs):
                    own = [own[i] for i in np.flatnonzero(kept_words(len(own), runs)).tolist()]
                texts.append(b" ".join(own))
            columns = {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array([len(w) for w in words], pa.int64()),
                "runs": pa.array(
                    [[dict(zip(("start", "length", "period"), r)) for r in runs.tolist()] for runs in found],
                    pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
                ),
                "collapsed_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            }
            if keep_text:
                columns["collapsed"] = pa.array(texts, pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            ids, words, numbers, held = [], [], [], 0
            texts = pc.cast(batch.column("text"), pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                own = (text.as_py() or b"").split()
                if prepare is not None:
                    own = prepare(doc_id, own)
                ids.append(doc_id)
                words.append(own)
                numbers.append(_numbers(own))
                held += len(own)
                if held >= SLICE_WORDS:
                    yield flush(ids, words, numbers)
                    ids, words, numbers, held = [], [], [], 0
            if ids:
                yield flush(ids, words, numbers)

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    schema = f"doc_id long, n_words long, runs array<{RUN}>, collapsed_sha256 string"
    return rows.mapInArrow(search, schema + (", collapsed string" if keep_text else ""))


def run_report(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period) and digests, from ``periodic_runs``."""
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    )
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    ranked = F.transform(
        "runs", lambda r: F.struct((-r["length"]).alias("last"), r["start"].alias("start"), r["period"].alias("period"))
    )
    best = F.array_min(ranked)
    length = -best["last"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * length / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        "collapsed_sha256",
    )

"""Repeated passages found by suffix arrays over shards of the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainsieve.llm.blocks import blobs, block_count, packed
from grainsieve.llm.sais import shared_prefixes, suffix_array

LEAST = 100
GRAM = 16
BLOCK_BYTES = 32 << 20
# Anchors met more often than this are split by the windows themselves.
HOT_ANCHOR = 20_000
# Bytes of one suffix array.
SORTED_BYTES = 4 << 20

_SLICE = 256 << 10
_END = 255  # in no UTF-8 text


def _window_keys(text: np.ndarray, least: int) -> np.ndarray:
    """For every window of ``least`` bytes, the smallest hash of a ``GRAM`` inside: equal windows have equal keys."""
    hashed = text.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    width = 1
    factor = 0xD6E8FEB86659FD93
    while width < GRAM:
        hashed = hashed[: len(hashed) - width] * np.uint64(factor) + hashed[width:]
        factor = factor * factor % 2**64
        width *= 2
    hashed ^= hashed >> np.uint64(32)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed ^= hashed >> np.uint64(29)
    return _slide(np.minimum, hashed, least - GRAM + 1), hashed


def _slide(pick, values: np.ndarray, span: int) -> np.ndarray:
    """``pick`` over every ``span`` neighbours."""
    reach, width = values, 1
    while width * 2 <= span:
        reach = pick(reach[: len(reach) - width], reach[width:])
        width *= 2
    rest = span - width
    return pick(reach[: len(reach) - rest], reach[rest:]) if rest else reach


class _Runs:
    """Runs of neighbouring windows with the same key, of all long enough texts of a blob."""

    def __init__(self, texts: list[bytes], least: int) -> None:
        rows, starts, counts, keys, repeats = [], [], [], [], []
        part, size = [], 0
        long_rows = [i for i, text in enumerate(texts) if len(text) >= least]
        for i in long_rows:
            part.append(i)
            size += len(texts[i])
            if size >= _SLICE or i == long_rows[-1]:
                found = self._of_slice([texts[j] for j in part], least)
                rows.append(np.array(part, dtype=np.int32)[found[0]])
                for column, values in zip((starts, counts, keys, repeats), found[1:]):
                    column.append(values)
                part, size = [], 0
        empty = np.zeros(0, dtype=np.int64)
        self.row = np.concatenate([*rows, empty.astype(np.int32)])
        self.start = np.concatenate([*starts, empty])
        self.count = np.concatenate([*counts, empty])
        self.key = np.concatenate([*keys, empty])
        self.repeats = np.concatenate([*repeats, empty])

    @staticmethod
    def _of_slice(texts: list[bytes], least: int):
        joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        offsets = np.cumsum(sizes) - sizes
        smallest, hashed = _window_keys(joined, least)
        # Window starts of each text, and a new run wherever text or key changes.
        new = np.empty(len(smallest), dtype=bool)
        new[0] = True
        np.not_equal(smallest[1:], smallest[:-1], out=new[1:])
        new[offsets] = True
        valid = np.ones(len(smallest), dtype=bool)
        for end in (offsets + sizes)[:-1]:
            valid[end - least + 1 : end] = False
        begins = np.flatnonzero(new & valid)
        broken = np.flatnonzero(new | ~valid)
        ends = np.append(broken, len(smallest))[np.searchsorted(broken, begins, side="right")]
        key = smallest[begins]
        # How often the key's gram stands in the run: a run that holds it twice may repeat itself.
        span = least - GRAM + 1
        padded = np.concatenate([np.zeros(span - 1, np.uint64), smallest, np.zeros(span - 1, np.uint64)])
        chosen = np.flatnonzero(_slide(np.maximum, padded, span)[: len(hashed)] == hashed)
        low = np.searchsorted(chosen, begins)
        high = np.searchsorted(chosen, ends - 1 + span)
        number = high - low
        run = np.repeat(np.arange(len(begins)), number)
        at = np.arange(len(run)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(low, number)
        times = np.bincount(run, weights=hashed[chosen[at]] == key[run], minlength=len(begins))
        row = np.searchsorted(offsets, begins, side="right") - 1
        return row, begins - offsets[row], ends - begins, key.view(np.int64), np.maximum(times, 1).astype(np.int64)


def _texts(rows: pa.Table) -> list[bytes]:
    return [(t.as_py() or "").encode() for t in rows.column("__text")]


def _frame(**columns: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict(columns)
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unframe(data: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all()


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _anchors(parts: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        """The keys of a block and how often each stands in it, dealt over ``parts``."""
        keys, counts = [], []
        for _, rows in blobs(table):
            runs = _Runs(_texts(rows), least)
            keys.append(runs.key)
            counts.append(runs.repeats)
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate(counts), minlength=len(key)).astype(np.int32)
        part = (key.view(np.uint64) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        pieces = [p for p in np.split(order, cuts) if len(p)]
        block = table.column("block")[0].as_py()
        return pa.table(
            {
                "part": pa.array([int(part[p[0]]) for p in pieces], pa.int32()),
                "block": pa.array([block] * len(pieces), pa.int32()),
                "keys": pa.array([key[p].tobytes() for p in pieces], pa.binary()),
                "counts": pa.array([count[p].tobytes() for p in pieces], pa.binary()),
            }
        )

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Of one part's keys, those that stand in the corpus twice or more, for each block that has them."""
    keys = [np.frombuffer(k.as_buffer(), dtype=np.int64) for k in table.column("keys")]
    counts = [np.frombuffer(c.as_buffer(), dtype=np.int32) for c in table.column("counts")]
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(found))
    blocks, many, hot, seen = [], [], [], 0
    for block, own in zip(table.column("block").to_pylist(), keys):
        times = total[at[seen : seen + len(own)]]
        seen += len(own)
        if (times > 1).any():
            blocks.append(block)
            many.append(own[(times > 1) & (times <= HOT_ANCHOR)].tobytes())
            hot.append(own[times > HOT_ANCHOR].tobytes())
    return pa.table(
        {"b": pa.array(blocks, pa.int32()), "many": pa.array(many, pa.binary()), "hot": pa.array(hot, pa.binary())}
    )


def _among(values: np.ndarray, table: pa.Table, name: str) -> np.ndarray:
    listed = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in table.column(name)]
    wanted = np.sort(np.concatenate([*listed, np.zeros(0, np.int64)]))
    if not len(wanted):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return wanted[at] == values


def _earliest(group: np.ndarray, when: np.ndarray) -> np.ndarray:
    """Which member of each group (0, 1, …) comes first."""
    order = np.lexsort((when, group))
    return order[np.unique(group[order], return_index=True)[1]]


def _joined_spans(owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of each owner, those that overlap or touch made one."""
    order = np.lexsort((begin, owner))
    base = owner[order].astype(np.int64) << np.int64(32)
    low, high = base + begin[order], np.maximum.accumulate(base + end[order])
    new = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
    last = np.append(new[1:], len(order)) - 1
    return owner[order][new], begin[order][new], high[last] - base[new]


def _regions(shards: int, least: int):
    def run(table: pa.Table, asked: pa.Table) -> pa.Table:
        """Texts of a block's repeated runs, each once with the first place where it stands in the block.

        All its other places repeat that one, so they are late whatever other blocks hold: a passage goes out once per block,
        not once per copy. Runs of hot anchors are cut into windows, which are told apart in the same way.
        """
        number: dict[tuple[int, bytes], int] = {}
        texts: list[bytes] = []
        keys: list[int] = []
        repeats: list[bool] = []
        hot: list[bool] = []
        empty = np.zeros(0, dtype=np.int64)
        region, owner, start = [empty], [empty], [empty]
        documents: list[tuple[np.ndarray, ...]] = []
        seen = 0
        for name, rows in blobs(table) if asked.num_rows else ():
            body = _texts(rows)
            runs = _Runs(body, least)
            is_hot = _among(runs.key, asked, "hot")
            at = np.flatnonzero(is_hot | _among(runs.key, asked, "many"))
            columns = (runs.row, runs.start, runs.count, runs.key, runs.repeats > 1, is_hot)
            found = []
            for row, first, count, key, again, many in zip(*(c[at].tolist() for c in columns)):
                text = body[row][first : first + count - 1 + least]
                own = number.setdefault((key, text), len(texts))
                if own == len(texts):
                    texts.append(text)
                    keys.append(key)
                    repeats.append(again)
                    hot.append(many)
                found.append(own)
            region.append(np.array(found, dtype=np.int64))
            owner.append(runs.row[at] + np.int64(seen))
            start.append(runs.start[at])
            ids = rows.column("__id")
            documents.append(
                (
                    np.array(ids.is_null()),
                    pc.fill_null(ids, 0).to_numpy(),
                    np.full(len(body), name, dtype=np.int64),
                    np.arange(len(body)),
                )
            )
            seen += len(body)
        names = ("shard", "block", "regions", "members", "late")
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        out: list[tuple] = []
        if texts:
            block = table.column("block")[0].as_py()
            absent, ids, blob, row = (np.concatenate(c) for c in zip(*documents))
            in_order = np.empty(seen, dtype=np.int64)
            in_order[np.lexsort((row, blob, ids, absent))] = np.arange(seen)
            region, owner, start = (np.concatenate(c) for c in (region, owner, start))
            size = np.array([len(t) for t in texts], dtype=np.int64)
            first = _earliest(region, (in_order[owner] << np.int64(32)) + start)
            other = np.ones(len(region), dtype=bool)
            other[first] = False
            late = [(owner[other], start[other], start[other] + size[region[other]])]
            owner, start = owner[first], start[first]
            is_hot = np.array(hot)
            whole, cut = np.flatnonzero(~is_hot), np.flatnonzero(is_hot)
            windows: dict[bytes, int] = {}
            member = [
                windows.setdefault(texts[i][k : k + least], len(windows))
                for i in cut.tolist()
                for k in range(len(texts[i]) - least + 1)
            ]
            member = np.array(member, dtype=np.int64)
            spread = size[cut] - least + 1
            step = np.arange(len(member)) - np.repeat(np.cumsum(spread) - spread, spread)
            w_owner, w_start = np.repeat(owner[cut], spread), np.repeat(start[cut], spread) + step
            first = _earliest(member, (in_order[w_owner] << np.int64(32)) + w_start)
            other = np.ones(len(member), dtype=bool)
            other[first] = False
            late.append((w_owner[other], w_start[other], w_start[other] + least))
            key = np.array([keys[i] for i in whole] + [xxhash.xxh64_intdigest(w) >> 1 for w in windows], dtype=np.int64)
            text = [texts[i] for i in whole] + list(windows)
            again = np.concatenate([np.array(repeats)[whole], np.zeros(len(windows), dtype=bool)])
            owner, start = np.concatenate([owner[whole], w_owner[first]]), np.concatenate([start[whole], w_start[first]])
            shard = (key.view(np.uint64) // np.uint64(7) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            for piece in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                at = owner[piece]
                data = _frame(key=key[piece], text=pa.array([text[i] for i in piece], pa.binary()), repeats=again[piece])
                places = _frame(absent=absent[at], id=ids[at], name=blob[at], row=row[at], start=start[piece])
                out.append((int(shard[piece[0]]), block, data, places, None))
            spans = [np.concatenate(c) for c in zip(*late)]
            if len(spans[0]):
                at, begin, end = _joined_spans(*spans)
                own_late = _frame(name=blob[at], row=row[at], begin=begin, end=end)
                out.append((block % shards, block, None, None, own_late))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, types)], names=list(names))

    return run


def repeated_windows(texts: list[bytes], rank: np.ndarray, start: np.ndarray, least: int) -> list[np.ndarray]:
    """For each text, which of its windows of ``least`` bytes also stand earlier.

    Text i stands at ``start[i]`` of the document of rank ``rank[i]``. All texts are sorted in one suffix array.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    joined = np.frombuffer(b"".join(t + bytes([_END]) for t in texts), dtype=np.uint8)
    offsets = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    inside = np.arange(len(joined)) - offsets[text]
    whole = inside + least <= sizes[text]
    order = suffix_array(joined)
    common = shared_prefixes(joined, order, least, whole)
    when = (rank[text] << np.int64(32)) + start[text] + inside
    sorted_ = order[whole[order]]
    new = np.flatnonzero(common[sorted_] < least)
    group = np.zeros(len(sorted_), dtype=np.int64)
    group[new] = 1
    group = group.cumsum() - 1
    late = np.zeros(len(joined), dtype=bool)
    if len(sorted_):
        first = np.minimum.reduceat(when[sorted_], new)
        late[sorted_] = when[sorted_] != first[group]
    return [late[o : o + max(0, s - least + 1)] for o, s in zip(offsets, sizes)]


def _sorted_shard(least: int):
    def run(table: pa.Table) -> pa.Table:
        """Places in a shard's regions that repeat earlier ones, per block; what blocks found late themselves goes along."""
        number: dict[tuple[int, bytes], int] = {}
        key_of, text_of, repeats, fields = [], [], [], []
        found = table.filter(pc.is_valid(table.column("late")))
        out_blocks, data = found.column("block").to_pylist(), found.column("late").to_pylist()
        table = table.filter(pc.is_valid(table.column("regions")))
        if not table.num_rows:
            return pa.table({"b": pa.array(out_blocks, pa.int32()), "spans": pa.array(data, pa.binary())})
        for block, listed, placed in zip(
            table.column("block").to_pylist(), table.column("regions"), table.column("members")
        ):
            regions, members = _unframe(listed), _unframe(placed)
            local = []
            for key, text, again in zip(*(regions.column(c).to_pylist() for c in ("key", "text", "repeats"))):
                own = number.setdefault((key, text), len(text_of))
                if own == len(text_of):
                    key_of.append(key)
                    text_of.append(text)
                    repeats.append(again)
                local.append(own)
            columns = [_column(members, c) for c in ("absent", "id", "name", "row", "start")]
            fields.append([np.array(local, dtype=np.int64), np.full(len(local), block), *columns])
        region, block, absent, ids, name, row, start = (np.concatenate(c) for c in zip(*fields))
        # Documents in their order: by id, rows without one last, rows with the same one in any fixed order.
        by_place = np.lexsort((start, row, name, ids, absent))
        region, block, absent, ids, name, row, start = (
            c[by_place] for c in (region, block, absent, ids, name, row, start)
        )
        doc = np.stack([absent, ids, name, row], axis=1)
        rank = np.concatenate([[0], (doc[1:] != doc[:-1]).any(axis=1).cumsum()]).astype(np.int64)
        # Of equal texts the first place stands for all; every other one repeats it whole.
        first = np.full(len(text_of), len(region), dtype=np.int64)
        np.minimum.at(first, region, np.arange(len(region)))
        spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = np.array([len(t) for t in text_of], dtype=np.int64)
        others = np.flatnonzero(first[region] != np.arange(len(region)))
        spans.append((others, start[others], start[others] + size[region[others]]))
        # A text that is alone with its anchor, and holds it once, shares a window with no text and not with itself.
        keys = np.array(key_of, dtype=np.int64)
        _, at, texts_of_key = np.unique(keys, return_inverse=True, return_counts=True)
        sorted_ = np.flatnonzero((texts_of_key[at] > 1) | np.array(repeats, dtype=bool))
        todo, held = [], 0
        ordered = sorted_[np.argsort(keys[sorted_], kind="stable")].tolist()
        for i, one in enumerate(ordered):
            todo.append(one)
            held += len(text_of[one])
            last = i + 1 == len(ordered)
            if last or held >= SORTED_BYTES and key_of[ordered[i + 1]] != key_of[one]:
                places = first[np.array(todo)]
                late = repeated_windows([text_of[j] for j in todo], rank[places], start[places], least)
                for place, flags in zip(places.tolist(), late):
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
                    if len(edges):
                        begin, end = edges[::2] + start[place], edges[1::2] - 1 + least + start[place]
                        spans.append((np.full(len(begin), place), begin, end))
                todo, held = [], 0
        place, begin, end = (np.concatenate(c) for c in zip(*spans))
        order = np.argsort(block[place], kind="stable")
        for piece in np.split(order, np.flatnonzero(np.diff(block[place][order])) + 1):
            if len(piece):
                out_blocks.append(int(block[place[piece[0]]]))
                at = place[piece]
                data.append(_frame(name=name[at], row=row[at], begin=begin[piece], end=end[piece]))
        return pa.table({"b": pa.array(out_blocks, pa.int32()), "spans": pa.array(data, pa.binary())})

    return run


def merged(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that the spans cover; spans that touch are one run."""
    out: list[list[int]] = []
    for a, b in sorted(zip(begin.tolist(), end.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_spans(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    keep_text: bool = False,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans[, kept_bytes]) of every document.

    ``spans`` are the maximal runs of bytes that some string of ``least`` bytes covers which also starts earlier: in a
    row with a smaller id (rows without id come last, rows with the same one in a fixed order) or further left. Null
    texts count as empty; texts shorter than ``least`` keep all bytes. Whole texts are searched, as UTF-8.

    Blocks of texts name the anchors of their windows; anchors met twice come back to the block, which sends the texts around
    them, each once per block, to the shard of the anchor. There equal windows meet in one suffix array. An anchor met too
    often for one shard is sent window by window.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    blocks = block_count(docs, text_col, BLOCK_BYTES)
    store = packed(rows, blocks)
    named = store.groupBy("block").applyInArrow(
        _anchors(2 * blocks, least), "part int, block int, keys binary, counts binary"
    )
    asked = named.groupBy("part").applyInArrow(_repeated, "b int, many binary, hot binary")
    regions = store.groupBy("block").cogroup(asked.groupBy("b")).applyInArrow(
        _regions(2 * blocks, least), "shard int, block int, regions binary, members binary, late binary"
    )
    late = regions.groupBy("shard").applyInArrow(_sorted_shard(least), "b int, spans binary")

    def cut(table: pa.Table, found: pa.Table) -> pa.Table:
        spans: dict[tuple[int, int], list[tuple]] = {}
        parts = [_unframe(data) for data in found.column("spans")]
        if parts:
            every = pa.concat_tables(parts)
            name, row, begin, end = (_column(every, c) for c in ("name", "row", "begin", "end"))
            order = np.lexsort((row, name))
            new = np.flatnonzero((np.diff(name[order]) != 0) | (np.diff(row[order]) != 0)) + 1
            for piece in np.split(order, new):
                spans[int(name[piece[0]]), int(row[piece[0]])] = merged(begin[piece], end[piece])
        out = []
        for name_, rows in blobs(table):
            columns: list[list] = [[] for _ in range(5)]
            for i, text in enumerate(_texts(rows)):
                own, kept, at = spans.get((name_, i), []), [], 0
                for a, b in own:
                    kept.append(text[at:a])
                    at = b
                rest = b"".join([*kept, text[at:]])
                values = (len(text), len(text) - len(rest), [list(s) for s in own], hashlib.sha256(rest).hexdigest(), rest)
                for column, value in zip(columns, values):
                    column.append(value)
            data = {
                "doc_id": rows.column("__id"),
                "n_bytes": pa.array(columns[0], pa.int64()),
                "n_removed": pa.array(columns[1], pa.int64()),
                "n_spans": pa.array([len(s) for s in columns[2]], pa.int64()),
                "kept_sha256": pa.array(columns[3], pa.string()),
                "spans": pa.array(columns[2], pa.list_(pa.list_(pa.int64()))),
            }
            if keep_text:
                data["kept_bytes"] = pa.array(columns[4], pa.binary())
            out.append(pa.table(data))
        return pa.concat_tables(out) if out else None

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    if keep_text:
        schema += ", kept_bytes binary"
    return store.groupBy("block").cogroup(late.groupBy("b")).applyInArrow(cut, schema)

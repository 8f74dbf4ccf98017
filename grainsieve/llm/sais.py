"""Suffix arrays by induced sorting, in steps over whole buckets."""

from __future__ import annotations

import numpy as np

# Alphabets up to this size are induced bucket by bucket; the names of larger ones are ranked by doubling.
MOST_BUCKETS = 1024


def _types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the empty suffix behind the end is the smallest."""
    turns = np.flatnonzero(text[:-1] != text[1:])
    runs = np.diff(np.concatenate([[-1], turns, [len(text) - 1]]))
    smaller = np.concatenate([text[turns] < text[turns + 1], [False]])
    return np.repeat(smaller, runs)


def _deal(queues: list[list[np.ndarray]], text: np.ndarray, suffixes: np.ndarray) -> None:
    """Append suffixes, order kept, to the queues of their first letters."""
    if not len(suffixes):
        return
    letters = text[suffixes]
    if len(suffixes) > 1:
        order = np.argsort(letters, kind="stable")
        suffixes, letters = suffixes[order], letters[order]
        cuts = np.flatnonzero(letters[1:] != letters[:-1]) + 1
    else:
        cuts = np.zeros(0, dtype=np.int64)
    if not len(cuts):
        queues[int(letters[0])].append(suffixes)
        return
    edges = [0, *cuts.tolist(), len(suffixes)]
    firsts = letters[np.array(edges[:-1])].tolist()
    for letter, a, b in zip(firsts, edges, edges[1:]):
        queues[letter].append(suffixes[a:b])


def _joined(chunks: list[np.ndarray]) -> np.ndarray:
    return chunks[0] if len(chunks) == 1 else np.concatenate(chunks)


def _induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes from leftmost-smaller ones (``seeds``, in order): larger types upwards, then smaller ones downwards."""
    n = len(text)
    up: list[list[np.ndarray]] = [[] for _ in range(letters)]
    own: list[list[np.ndarray]] = [[] for _ in range(letters)]
    _deal(own, text, seeds)
    up[int(text[n - 1])].append(np.array([n - 1], dtype=seeds.dtype))
    for letter in range(letters):
        # What a bucket holds is dealt at once; what that adds to the bucket itself comes next.
        queue, at = up[letter], 0
        while at < len(queue):
            before = _joined(queue[at:]) - 1
            at = len(queue)
            before = before[before >= 0]
            _deal(up, text, before[~smaller[before]])
        if own[letter]:
            before = _joined(own[letter]) - 1
            before = before[before >= 0]
            _deal(up, text, before[~smaller[before]])
    down: list[list[np.ndarray]] = [[] for _ in range(letters)]
    for letter in range(letters - 1, -1, -1):
        queue, at = down[letter], 0
        while at < len(queue):
            before = _joined(queue[at:]) - 1
            at = len(queue)
            before = before[before >= 0]
            _deal(down, text, before[smaller[before]])
        if up[letter]:
            before = _joined(up[letter])[::-1] - 1
            before = before[before >= 0]
            _deal(down, text, before[smaller[before]])
    parts = []
    for letter in range(letters):
        parts += up[letter]
        if down[letter]:
            parts.append(_joined(down[letter])[::-1])
    return np.concatenate(parts)


def _equal_neighbours(text: np.ndarray, order: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each leftmost-smaller substring equals the one before it in ``order``."""
    left, right = order[:-1], order[1:]
    size = length[1:]
    open_ = np.flatnonzero((length[:-1] == size) & (left + size <= len(text)) & (right + size <= len(text)))
    same = np.zeros(len(order), dtype=bool)
    step = 0
    while len(open_):
        ended = size[open_] <= step
        same[open_[ended] + 1] = True
        open_ = open_[~ended]
        open_ = open_[text[left[open_] + step] == text[right[open_] + step]]
        step += 1
    return same


def _rank_by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of a text over a large alphabet."""
    n = len(names)
    rank, reach = names.astype(np.int64), 1
    while True:
        ahead = np.full(n, -1, dtype=np.int64)
        ahead[: n - reach] = rank[reach:] if reach < n else ahead[: n - reach]
        key = rank * (n + 1) + ahead + 1
        order = np.argsort(key)
        steps = np.concatenate([[0], (key[order[1:]] != key[order[:-1]]).cumsum()])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = steps
        if steps[-1] == n - 1 or reach >= n:
            return order
        reach *= 2


def suffix_array(text: np.ndarray, letters: int = 256) -> np.ndarray:
    """Start of every suffix of ``text`` (integers below ``letters``), in order.

    Suffixes are classified, leftmost-smaller substrings are sorted by inducing and named, the text of their names is sorted
    by the same way while its alphabet is small, and all suffixes are induced from them.
    """
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    smaller = _types(text)
    first = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + np.int32(1)
    if len(first) > 1:
        is_first = np.zeros(n, dtype=bool)
        is_first[first] = True
        order = _induce(text, smaller, first, letters)
        order = order[is_first[order]]
        place = np.zeros(n, dtype=np.int32)
        # A substring reaches to the next start; the last one, which ends with the text, equals no other.
        place[first] = np.diff(np.concatenate([first, [n]])) + 1
        names = np.empty(n, dtype=np.int32)
        names[order] = (~_equal_neighbours(text, order, place[order])).cumsum() - 1
        reduced = names[first]
        distinct = int(reduced.max()) + 1
        if distinct < len(first):
            if distinct <= MOST_BUCKETS:
                inner = suffix_array(reduced, distinct)
            else:
                inner = _rank_by_doubling(reduced)
            first = first[inner]
        else:
            first = order
    return _induce(text, smaller, first, letters)


def shared_prefixes(
    text: np.ndarray, order: np.ndarray, least: int, wanted: np.ndarray | None = None
) -> np.ndarray:
    """For every suffix, in the order of the text, the length it shares with the suffix before it in ``order``, up to ``least``.

    Suffixes that are not ``wanted`` get 0. This is the permuted array of common prefixes. It is found eight letters at a time for all suffixes at once,
    those that differ dropping out.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.uint8), np.zeros(least + 8, dtype=np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    packed = np.ascontiguousarray(words).view(np.uint64).ravel()
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    common = np.zeros(n, dtype=np.int32)
    open_ = np.flatnonzero(before >= 0 if wanted is None else (before >= 0) & wanted)
    for step in range(0, least, 8):
        differ = packed[open_ + step] ^ packed[before[open_] + step]
        low = differ & (~differ + np.uint64(1))
        # The lowest differing byte in memory order tells how many of the eight agree.
        bits = np.where(differ == 0, 64, np.bitwise_count(low - np.uint64(1)))
        common[open_] = np.minimum(step + bits // 8, least)
        open_ = open_[differ == 0]
    limit = n - np.maximum(np.arange(n), before)
    return np.minimum(common, limit).astype(np.int32)

"""Counting the entries of several keyword lists in one reading of a text.

All lists go into one automaton, which runs over Arrow batches of texts. For each list, what it finds is then
counted as ``count_keywords`` counts: from the left, the earlier entry first, without overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainsieve.functions.keywords import KATAKANA

# Characters that are read before it is looked whether a limit has been passed.
STEP = 1 << 16


class KeywordScanner:
    """An automaton over ordered lists; ``bounded`` lists take entries of katakana alone only where no katakana touches them, after all others."""

    def __init__(self, lists: Sequence[Sequence[str]], bounded: Sequence[bool]) -> None:
        import ahocorasick

        self._count = len(lists)
        self._kana = re.compile(KATAKANA)
        entries: dict[str, list[tuple[int, int, bool]]] = {}
        for number, words in enumerate(lists):
            plain = list(dict.fromkeys(word for word in (word.strip() for word in words) if word))
            alone = [bool(bounded[number] and re.fullmatch(f"{KATAKANA}+", word)) for word in plain]
            for place, (word, kana) in enumerate(zip(plain, alone)):
                entries.setdefault(word, []).append((number, place + len(plain) * kana, kana))
        self._longest = max(map(len, entries), default=0)
        self._automaton = ahocorasick.Automaton()
        for word, own in entries.items():
            self._automaton.add_word(word, (len(word), own))
        if entries:
            self._automaton.make_automaton()

    def _touched(self, text: str, start: int, end: int) -> bool:
        before, behind = text[start - 1 : start] if start else "", text[end : end + 1]
        return bool(self._kana.match(before) or self._kana.match(behind))

    def counts(self, text: str, limits: Sequence[int] | None = None) -> list[int]:
        """Matches of each list. With ``limits`` reading ends where any list has passed its own."""
        counts, free = [0] * self._count, [0] * self._count
        if not self._longest:
            return counts
        step = len(text) if limits is None else STEP
        for first in range(0, len(text), max(1, step)):
            best: list[dict[int, tuple[int, int]]] = [{} for _ in counts]
            stop = min(len(text), first + step + self._longest - 1)
            for last, (length, own) in self._automaton.iter(text, first, stop):
                start = last + 1 - length
                if start >= first + step:
                    continue
                for number, place, kana in own:
                    found = best[number].get(start)
                    if (found is None or place < found[0]) and not (kana and self._touched(text, start, last + 1)):
                        best[number][start] = (place, last + 1)
            for number, found in enumerate(best):
                for start in sorted(found):
                    if start >= free[number]:
                        counts[number] += 1
                        free[number] = found[start][1]
            if limits is not None and any(n > limit for n, limit in zip(counts, limits)):
                break
        return counts


def keyword_counts(
    text: Column, lists: Mapping[str, Sequence[str]], free: Sequence[str] = ("ads",)
) -> Column:
    """A struct with the matches of each list, null for a null text; lists named in ``free`` have no katakana rule."""
    names, words = list(lists), [list(lists[name]) for name in lists]
    bounded = [name not in free for name in names]

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = KeywordScanner(words, bounded)
        for texts in batches:
            rows = [None if t is None else dict(zip(names, scanner.counts(t))) for t in texts.to_pylist()]
            yield pa.array(rows, pa.struct([(name, pa.int32()) for name in names]))

    shape = T.StructType([T.StructField(name, T.IntegerType()) for name in names])
    return F.arrow_udf(scan, shape)(text)


def within_limits(
    text: Column, lists: Mapping[str, Sequence[str]], limits: Mapping[str, int], free: Sequence[str] = ("ads",)
) -> Column:
    """Whether no list has more matches than its limit; a text is read little further than to the first one that has. Null for a null text."""
    names, words = list(lists), [list(lists[name]) for name in lists]
    bounded, most = [name not in free for name in names], [limits[name] for name in names]

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = KeywordScanner(words, bounded)
        for texts in batches:
            yield pa.array(
                [
                    None if t is None else all(n <= m for n, m in zip(scanner.counts(t, most), most))
                    for t in texts.to_pylist()
                ],
                pa.bool_(),
            )

    return F.arrow_udf(scan, T.BooleanType())(text)

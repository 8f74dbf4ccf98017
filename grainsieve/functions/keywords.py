"""Counting keywords from an ordered list."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a katakana word is made of.
KATAKANA = "[ァ-ヴー]"

_LEAF = 8


def _literal(char: str) -> str:
    return rf"\x{{{ord(char):x}}}"


def _ordered_choice(words: list[str]) -> str:
    """A pattern that matches as ``w1|w2|…`` does, with shared beginnings read once.

    Words with different first characters exclude each other, so they may be regrouped; words with
    the same one keep their order. A word that ends here stays a barrier: what came before
    it is tried before, what came after it after.
    """
    choices: list[str] = []
    by_first: dict[str, list[str]] = {}

    def close_group() -> None:
        if by_first:
            tails = {first: _ordered_choice(rest) for first, rest in by_first.items()}
            choices.append(_search_tree(sorted(tails), tails))
            by_first.clear()

    for word in words:
        if word:
            by_first.setdefault(word[0], []).append(word[1:])
        else:
            close_group()
            choices.append("")
    close_group()
    return choices[0] if len(choices) == 1 else f"(?:{'|'.join(choices)})"


def _search_tree(firsts: list[str], tails: dict[str, str]) -> str:
    """Choose by first character in a logarithmic number of range tests."""
    if len(firsts) <= _LEAF:
        options = [_literal(first) + tails[first] for first in firsts]
    else:
        middle = len(firsts) // 2
        options = [
            f"(?=[{_literal(half[0])}-{_literal(half[-1])}]){_search_tree(half, tails)}"
            for half in (firsts[:middle], firsts[middle:])
        ]
    return options[0] if len(options) == 1 else f"(?:{'|'.join(options)})"


def keyword_pattern(words: Iterable[str], katakana_bounded: bool = True) -> str | None:
    """Pattern for an ordered keyword list, ``None`` for an empty one.

    Earlier entries win over later ones at the same place. With ``katakana_bounded`` an entry made only
    of katakana counts only where no katakana touches it, and is tried after all others.
    """
    entries = [word for word in (word.strip() for word in words) if word]
    bounded = [
        word for word in entries if katakana_bounded and re.fullmatch(f"{KATAKANA}+", word)
    ]
    free = [word for word in entries if word not in set(bounded)]
    parts = []
    if free:
        parts.append(_ordered_choice(free))
    if bounded:
        parts.append(f"(?<!{KATAKANA}){_ordered_choice(bounded)}(?!{KATAKANA})")
    return "|".join(parts) or None


def count_keywords(
    text: Column, words: Iterable[str], katakana_bounded: bool = True
) -> Column:
    """Number of non-overlapping keyword matches in ``text``."""
    pattern = keyword_pattern(words, katakana_bounded)
    if pattern is None:
        return F.when(text.isNotNull(), F.lit(0))
    return F.regexp_count(text, F.lit(pattern))


def at_most_keywords(
    text: Column, words: Iterable[str], limit: int, katakana_bounded: bool = True
) -> Column:
    """Whether ``count_keywords`` gives at most ``limit``. A text is read no further than to the match beyond it.

    Each match is an atomic group: once found it stands, so that the same matches are counted as when all are.
    """
    pattern = keyword_pattern(words, katakana_bounded)
    if pattern is None or limit < 0:
        return F.when(text.isNotNull(), F.lit(limit >= 0))
    return ~text.rlike(rf"(?s)\A(?>.*?(?:{pattern})){{{limit + 1}}}")

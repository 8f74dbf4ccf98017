"""Column expressions over text, URLs, sizes and file names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The section headings after which an encyclopedia article has no more prose.
FOOTNOTE_HEADINGS = (
    "脚注",
    "関連項目",
    "日本国内の関連項目",
    "出典",
    "出典・脚注",
    "参照",
    "外部リンク",
    "参考文献",
    "その他関連事項",
    "Footnotes",
    "See also",
    "Further reading",
    "Bibliography",
    "References",
    "Notes",
    "Citations",
    "Sources",
    "External links",
)

# Patterns of the Japanese text extraction.
KANA = r"[\p{IsHiragana}\p{IsKatakana}ー]"
URL = r"(?U)https?://[\w/:%#$&?()~.=+\-]+"
LONG_ASCII_RUN = r"[\x00-\x7F]{100,}"

# A character Python's str.strip keeps: strip also removes the four separators U+001C to U+001F.
_NOT_STRIPPED = r"[^\p{IsWhite_Space}\x1c-\x1f]"

# Groups 1 and 2: a bracketed host and its zone; 3 and 4: any other.
_HOST = (
    r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#]*@)?"
    r"(?:\[([^\]/?#%]*)(%[^\]/?#]*)?\]|([^/?#:@\[%]*)(%[^/?#:@\[]*)?)"
)


def has_visible_text(text: Column) -> Column:
    return text.rlike(_NOT_STRIPPED)


def url_host(url: Column) -> Column:
    """Host, ``''`` if the URL has none, in lower case up to a ``%``. Any character may be part of it."""
    name = F.concat(F.regexp_extract(url, _HOST, 1), F.regexp_extract(url, _HOST, 3))
    zone = F.concat(F.regexp_extract(url, _HOST, 2), F.regexp_extract(url, _HOST, 4))
    return F.concat(F.lower(name), zone)


def host_suffix(url: Column) -> Column:
    """Text after the host's last dot; ``''`` for a host that ends in a dot."""
    return F.substring_index(url_host(url), ".", -1)


def delete_matches(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def extract_japanese_text(text: Column, line_sep: str = "") -> Column:
    """Lines holding kana, without URLs and long ASCII runs, put together with ``line_sep``."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(KANA))
    cleaned = F.transform(
        lines, lambda line: delete_matches(delete_matches(line, URL), LONG_ASCII_RUN)
    )
    return F.array_join(cleaned, line_sep)


def remove_wikipedia_footnote(
    text: Column, headings: tuple[str, ...] = FOOTNOTE_HEADINGS
) -> Column:
    """Text up to the first line that is one of ``headings``. Needs a newline on both sides."""
    names = "|".join(rf"\Q{name}\E" for name in headings)
    return F.regexp_replace(text, rf"(?Us)\n(?:{names})\s*\n.*", "")


def _tidy_brackets(text: Column, opening: str, closing: str, separators: str, empty: str) -> Column:
    """Trim separators inside one kind of brackets, then drop empty ones.

    A run of separators in front of a closing bracket is only tried from its start and never given
    back, so a long run without a bracket is read once. Texts without such brackets skip it all.
    """
    tidied = F.regexp_replace(text, rf"(?U)\Q{opening}\E{separators}*+", opening)
    tidied = F.regexp_replace(
        tidied, rf"(?U)(?<!{separators}){separators}++\Q{closing}\E", closing
    )
    tidied = F.regexp_replace(tidied, rf"(?U){empty}", "")
    return F.when(text.contains(opening) | text.contains(closing), tidied).otherwise(text)


def tidy_wide_brackets(text: Column) -> Column:
    return _tidy_brackets(text, "（", "）", r"[\s,，、;；]", r"（\s*+）")


def tidy_ascii_brackets(text: Column) -> Column:
    return _tidy_brackets(text, "(", ")", r"[\s,;]", r"\s?\(\s*+\)")


def remove_empty_parenthesis(text: Column) -> Column:
    """Both kinds of brackets, the full-width ones first."""
    return tidy_ascii_brackets(tidy_wide_brackets(text))


# A class of shorthands, ranges and characters that mean themselves; a pattern of such classes and of what is neither escape nor group.
_ITSELF = r"[^\[\]\\^&-]"
_CLASS = rf"\[\^?(?:\\[dsw]|{_ITSELF}-{_ITSELF}|{_ITSELF})+\]"
_PLAIN = re.compile(rf"(?:{_CLASS}|[^\[\]\\(])*")
_RANGE = re.compile(rf"\\.|({_ITSELF})-({_ITSELF})", re.DOTALL)


def _listed(found: re.Match[str]) -> str:
    first, last = found.groups()
    if first is None or last > "\xff":
        return found[0]
    members = "".join(map(chr, range(ord(first), ord(last) + 1)))
    return members if re.fullmatch(f"{_ITSELF}+", members) else found[0]


def with_listed_ranges(pattern: str) -> str:
    """``pattern`` with the characters of Latin-1 ranges in place of the ranges, if nothing in it could give them another meaning.

    It matches the same. Java looks such characters up in one table, but compares with range after range, many times slower.
    """
    if not _PLAIN.fullmatch(pattern):
        return pattern
    return re.sub(_CLASS, lambda found: _RANGE.sub(_listed, found[0]), pattern)


def all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(with_listed_ranges(pattern)), F.lit(0))


# Size suffixes and their factors.
SIZE_FACTORS = {
    "k": 10**3,
    "K": 10**3,
    "M": 10**6,
    "B": 10**9,
    "G": 10**9,
    "T": 10**12,
}


def parse_size(size: str | int) -> int:
    """``7K`` is 7000, ``10M`` ten million; a fraction or another suffix is an error."""
    size = str(size)
    factor = SIZE_FACTORS.get(size[-1:])
    return int(size) if factor is None else int(size[:-1]) * factor


def parse_size_column(size: Column) -> Column:
    """``parse_size`` for a string column; a malformed size fails the query, NULL stays NULL."""
    suffix = F.substring(size, -1, 1)
    factor = F.lit(1).cast("bigint")
    for letter, value in SIZE_FACTORS.items():
        factor = F.when(suffix == letter, F.lit(value).cast("bigint")).otherwise(factor)
    digits = F.regexp_extract(size, r"^\s*([+-]?[0-9]+)\s*[kKMBGT]?$", 1)
    malformed = F.raise_error(F.concat(F.lit("not a size: "), size)).cast("bigint")
    return (
        F.when(size.isNull(), F.lit(None).cast("bigint"))
        .when(digits != "", digits.cast("bigint") * factor)
        .otherwise(malformed)
    )


def file_stem(path: Column) -> Column:
    """Last path element without its last extension."""
    name = F.substring_index(path, "/", -1)
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+$", "")


def validation_name(stem: Column) -> Column:
    return F.replace(stem, F.lit("train"), F.lit("validation"))

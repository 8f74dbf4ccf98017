"""Document predicates: boolean columns over ``text`` and ``meta``, true keeps the row.

A NULL input makes a predicate NULL, and a filter drops the row; ``is_not_excluded`` alone keeps it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainsieve.functions.compression import compression_score
from grainsieve.functions.keywords import at_most_keywords
from grainsieve.functions.text import has_visible_text, host_suffix

# Accepted last labels of a web host.
VALID_DOMAINS = (
    "biz",
    "cc",
    "com",
    "info",
    "jp",
    "me",
    "net",
    "org",
    "site",
    "tokyo",
    "tv",
    "work",
    "xyz",
)

# Fixed value: pages already covered by the encyclopedia collection.
EXCLUDED_URL_PREFIX = "https://ja.wikipedia.org/"

# Accepted file extensions of source code, case-sensitive.
VALID_EXTENSIONS = (
    "asm", "bat", "cmd", "c", "h", "cs", "cpp", "hpp", "c++", "h++", "cc", "hh", "C", "H",
    "cmake", "css", "dockerfile", "f90", "f", "f03", "f08", "f77", "f95", "for", "fpp", "go",
    "hs", "html", "java", "js", "jl", "lua", "md", "markdown", "php", "php3", "php4", "php5",
    "phps", "phpt", "pl", "pm", "pod", "perl", "ps1", "psd1", "psm1", "py", "rb", "rs", "sql",
    "scala", "sh", "bash", "command", "zsh", "ts", "tsx", "tex", "vb", "Dockerfile", "Makefile",
    "xml", "rst", "m", "smali",
)


def _text() -> Column:
    return F.col("text")


def _meta(field: str) -> Column:
    return F.col("meta").getField(field)


def has_valid_domain(
    url: Column | None = None,
    domains: Iterable[str] = VALID_DOMAINS,
    excluded_prefix: str = EXCLUDED_URL_PREFIX,
) -> Column:
    url = _meta("url") if url is None else url
    return ~url.startswith(excluded_prefix) & host_suffix(url).isin(*domains)


def has_valid_extension(
    ext: Column | None = None, extensions: Iterable[str] = VALID_EXTENSIONS
) -> Column:
    return (_meta("ext") if ext is None else ext).isin(*extensions)


def has_valid_max_line_length(limit: int = 1_000, length: Column | None = None) -> Column:
    return (_meta("max_line_length") if length is None else length) <= limit


def has_valid_avg_line_length(limit: float = 100, length: Column | None = None) -> Column:
    return (_meta("avg_line_length") if length is None else length) <= limit


def has_valid_alphanum_fraction(minimum: float = 0.25, fraction: Column | None = None) -> Column:
    return (_meta("alphanum_fraction") if fraction is None else fraction) >= minimum


def is_not_excluded(value: str, field: Column) -> Column:
    """``field`` is another value or NULL."""
    return ~field.eqNullSafe(F.lit(value))


def is_not_empty(text: Column | None = None) -> Column:
    return has_visible_text(_text() if text is None else text)


def is_japanese(text: Column | None = None, lookup_size: int = 50) -> Column:
    """Hiragana or katakana within the first ``lookup_size`` characters."""
    text = _text() if text is None else text
    return F.substring(text, 1, lookup_size).rlike("[ぁ-んァ-ン]")


def has_good_average_sentence_length(
    max_average_sentence_length: int = 250, text: Column | None = None
) -> Column:
    text = _text() if text is None else text
    stops = F.length(text) - F.length(F.replace(text, F.lit("。"), F.lit("")))
    return stops >= F.length(text) / F.lit(max_average_sentence_length)


def has_few_keywords(
    words: Iterable[str],
    max_allowed_num: int = 3,
    text: Column | None = None,
    katakana_bounded: bool = True,
) -> Column:
    """At most ``max_allowed_num`` matches: adult, discrimination and violence lists."""
    text = _text() if text is None else text
    return at_most_keywords(text, words, max_allowed_num, katakana_bounded)


def is_not_ad_content(
    words: Iterable[str], max_allowed_num: int = 10, text: Column | None = None
) -> Column:
    """Advertisement list: every entry counts wherever it stands."""
    return has_few_keywords(words, max_allowed_num, text, katakana_bounded=False)


def has_good_compression_ratio(
    min_score: float = 0.3,
    max_score: float = 0.7,
    length_factor: float = 0.0,
    text: Column | None = None,
) -> Column:
    text = _text() if text is None else text
    return compression_score(text, length_factor).between(min_score, max_score)

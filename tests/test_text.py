"""Text expressions against literal edges and against plain Python on random strings."""

import random
import re
from urllib.parse import urlsplit

import pytest
import regex
from pyspark.sql import functions as F

from checks import inputs
from grainsieve.functions import predicates as P
from grainsieve.functions import text as T
from grainsieve.functions.keywords import at_most_keywords, count_keywords, keyword_pattern


def column(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, text STRING")
    rows = frame.select("i", expression(F.col("text")).alias("out")).collect()
    return [row.out for row in sorted(rows, key=lambda row: row.i)]


def random_texts(alphabet, count=400, longest=40, seed=3):
    source = random.Random(seed)
    return ["".join(source.choices(alphabet, k=source.randint(0, longest))) for _ in range(count)]


def test_footnotes(spark):
    texts = [
        "body\nReferences  \nrest\nNotes\nz",
        "References\nrest",
        "body\nReferences",
        "body\nReferences\n",
        "body\n出典・脚注　\n\nrest",
        "body\nReferences x\nrest",
        "\nNotes\n",
        None,
    ]
    assert column(spark, texts, T.remove_wikipedia_footnote) == [
        "body",
        "References\nrest",
        "body\nReferences",
        "body",
        "body",
        "body\nReferences x\nrest",
        "",
        None,
    ]


def test_brackets(spark):
    texts = ["（、東京） ( ) foo (; a ,) （）(())", "a ()", "（　）b", "no brackets", "x )", None]
    assert column(spark, texts, T.remove_empty_parenthesis) == [
        "（東京） foo (a) ()",
        "a",
        "b",
        "no brackets",
        "x)",
        None,
    ]


# The six substitutions in their order.
def test_brackets_like_six_substitutions(spark):
    def expected(text):
        for pattern, replacement in (
            (r"（[\s,，、;；]*", "（"),
            (r"[\s,，、;；]*）", "）"),
            (r"（\s*）", ""),
            (r"\([\s,;]*", "("),
            (r"[\s,;]*\)", ")"),
            (r"\s?\(\s*\)", ""),
        ):
            text = regex.sub(pattern, replacement, text)
        return text

    texts = random_texts("（）()、,; \n　\x1c\xa0a東")
    assert column(spark, texts, T.remove_empty_parenthesis) == [expected(t) for t in texts]


def test_brackets_read_long_blank_runs_once(spark):
    blanks = " " * 400_000
    assert column(spark, [f"({blanks}x{blanks}y)"], T.remove_empty_parenthesis) == [
        f"(x{blanks}y)"
    ]


def test_japanese_text(spark):
    texts = ["abc\n見てhttps://a.com/x です\nカナ" + "x" * 120 + "終", "", "abc", "ー\nー", None]
    assert column(spark, texts, T.extract_japanese_text) == ["見て ですカナ終", "", "", "ーー", None]
    assert column(spark, ["ア\nx\nイ"], lambda c: T.extract_japanese_text(c, "\n")) == ["ア\nイ"]


def test_japanese_text_like_python(spark):
    # The patterns of the extraction.
    kana = regex.compile(r"[\p{Hiragana}\p{Katakana}ー]")
    url = regex.compile(r"https?://[\w/:%#\$&\?\(\)~\.=\+\-]+")
    run = regex.compile("[\x00-\x7f]{100,}")

    def expected(text):
        return "".join(
            run.sub("", url.sub("", line)) for line in text.split("\n") if kana.search(line)
        )

    pieces = ["カ", "ひ", "漢", "\n", "\r", " ", "a" * 60, "https://a.jp/%é", "http://", "x", "。"]
    source = random.Random(5)
    texts = ["".join(source.choices(pieces, k=source.randint(0, 12))) for _ in range(400)]
    assert column(spark, texts, T.extract_japanese_text) == [expected(t) for t in texts]


def test_not_empty_is_strip(spark):
    blanks = [chr(c) for c in range(0x3001) if not chr(c).strip()] + ["​", "᠎", "a"]
    assert column(spark, ["", *blanks], P.is_not_empty) == [
        value.strip() != "" for value in ["", *blanks]
    ]


def test_japanese_prefix(spark):
    texts = ["あ", "x" * 49 + "ン", "x" * 50 + "ン", "漢字", "ー", "𠮷" * 49 + "ん", None]
    assert column(spark, texts, P.is_japanese) == [True, True, False, False, False, True, None]


def test_sentence_length(spark):
    texts = ["", "a" * 250, "a" * 249 + "。", "a" * 250 + "。", "a" * 251 + "。。"]
    expected = [t.count("。") >= len(t) / 250 for t in texts]
    verdicts = column(spark, texts, lambda c: P.has_good_average_sentence_length(250, c))
    assert verdicts == expected


HOSTS = {
    "https://my_host.jp/": "my_host.jp",
    "http://a.b.example.COM:80/x": "a.b.example.com",
    "http://a.com.": "a.com.",
    "no-scheme.jp/x": "",
    "//b.org?q": "b.org",
    "http://u:p@c.net#f": "c.net",
    "http://x@y@d.tv/": "d.tv",
    "http://[::1]:8/": "::1",
    "http://日本.jp/": "日本.jp",
    "mailto:a@b.com": "",
}


def test_hosts(spark):
    assert column(spark, list(HOSTS), T.url_host) == list(HOSTS.values())
    for url, host in HOSTS.items():
        assert (urlsplit(url).hostname or "") == host


def test_hosts_of_random_urls(spark):
    source = random.Random(9)
    starts = ["http://", "https://", "//", "HTTP://", "ht+tp://", "1tp://", "http:/", "", ":"]
    expected = {}
    for _ in range(3000):
        url = source.choice(starts) + "".join(
            source.choices("aB.-_:/@?#[]%1é東;", k=source.randint(0, 9))
        )
        try:
            expected[url] = urlsplit(url).hostname or ""
        except ValueError:
            pass
    assert column(spark, list(expected), T.url_host) == list(expected.values())


def test_valid_domain(spark):
    urls = [*HOSTS, "https://ja.wikipedia.org/wiki/x", "http://ja.wikipedia.org/", None]
    accepted = [True, True, False, False, True, True, True, False, True, False, False, True, None]
    assert column(spark, urls, P.has_valid_domain) == accepted


def test_sizes(spark):
    sizes = {"7K": 7000, "7k": 7000, "10M": 10**7, "2B": 2 * 10**9, "1G": 10**9, "3T": 3 * 10**12}
    sizes |= {"81": 81, "-1": -1, " 5": 5}
    assert [T.parse_size(size) for size in sizes] == list(sizes.values())
    assert column(spark, [*sizes, None], T.parse_size_column) == [*sizes.values(), None]
    for bad in ("1.5M", "10m", "", "K", "7K "):
        with pytest.raises(ValueError):
            T.parse_size(bad)
        with pytest.raises(Exception, match="not a size"):
            column(spark, [bad], T.parse_size_column)


def test_names(spark):
    paths = ["/a/train_0.parquet", "train.train.jsonl", "/a/b", "s3://x/.hidden"]
    stems = column(spark, paths, T.file_stem)
    assert stems == ["train_0", "train.train", "b", ".hidden"]
    assert column(spark, stems, T.validation_name)[:2] == ["validation_0", "validation.validation"]


def keywords_in(text, words):
    kana = [w for w in words if re.fullmatch("[ァ-ヴー]+", w)]
    parts = [re.escape(w) for w in words if w not in kana]
    if kana:
        parts.append(f"(?<![ァ-ヴー])(?:{'|'.join(kana)})(?![ァ-ヴー])")
    return len(re.findall("|".join(parts), text)) if parts else 0


def test_keyword_order_and_bounds(spark):
    def count(words):
        return lambda text: count_keywords(text, words)

    assert column(spark, ["abab"], count(["ab", "abab"])) == [2]
    assert column(spark, ["abab"], count(["abab", "ab"])) == [1]
    assert column(spark, ["アカ アカ ネアカ アカxアカ"], count(["アカ"])) == [4]
    assert column(spark, ["ネアカ"], lambda c: count_keywords(c, ["アカ"], False)) == [1]
    assert column(spark, ["a.b a+b axb", None], count(["a.b", "a+b", "", "  "])) == [2, None]
    assert column(spark, ["abc", None], count([])) == [0, None]
    assert column(spark, ["😀😁x"], count(["😁x", "😀"])) == [2]
    assert keyword_pattern([" ", ""]) is None


@pytest.mark.parametrize("seed", range(4))
def test_keywords_like_plain_alternation(spark, seed):
    source = random.Random(seed)
    words = []
    for alphabet in ("abcde", "あいう漢字", "アカサー"):
        for _ in range(40):
            words.append("".join(source.choices(alphabet, k=source.randint(1, 5))))
    words.append("aカ")
    source.shuffle(words)
    texts = random_texts("abcdefあいうえ漢字アカサーネ ", count=300, seed=seed)
    expected = [keywords_in(text, words) for text in texts]
    assert column(spark, texts, lambda c: count_keywords(c, words)) == expected
    for limit in (-1, 0, 2, 5):
        assert column(spark, texts, lambda c: at_most_keywords(c, words, limit)) == [n <= limit for n in expected]


def test_keyword_limit_is_inclusive(spark):
    texts = ["x " * n for n in range(6)]
    assert column(spark, texts, lambda c: P.has_few_keywords(["x"], 3, c)) == [True] * 4 + [False] * 2


def test_keyword_limit_on_long_texts_and_nothing(spark):
    long = "\nno such word" * 200_000
    texts = [long, long + "key\nkey", "key" + long + "key" + long + "key", None]
    assert column(spark, texts, lambda c: at_most_keywords(c, ["key", "ke"], 2)) == [True, True, False, None]
    assert column(spark, ["a", None], lambda c: at_most_keywords(c, [], 0)) == [True, None]


def test_listed_ranges_match_the_same(spark):
    texts = ["".join(map(chr, range(0x250))), "ab-c é×÷_東1😀\x0b \n", "", None, *random_texts("aZz09éß×-^&[]\\ \n東😀", 100)]
    patterns = [
        inputs.PIECES, "[^a-c]+", "[^a-z0-9]", r"[\sa-y\d]{2,3}", "a-c|[a-c]", "[ -#é-÷]+|.", "[a-c-e]+", "[A-z]+", "[-a-c]", "[^^a-c]", "[a-c&&[^b]]",
        r"[\w-z]", r"\[a-c]", "(?i)[a-c]+", "[ぁ-んa-c]", "[a-東]+", r"[\x41-c]", r"\Q[a-c]\E|[a-c]", "[^A-Za-z\\s]$",
    ]
    frame = spark.createDataFrame([(v,) for v in texts], "text STRING")
    found = [T.all_matches(F.col("text"), pattern) for pattern in patterns]
    plain = [F.regexp_extract_all("text", F.lit(pattern), F.lit(0)) for pattern in patterns]
    for row in frame.select(F.array(*found).alias("found"), F.array(*plain).alias("plain")).collect():
        assert row.found == row.plain


def test_listed_ranges():
    assert T.with_listed_ranges("[a-d]+|[^0-3x]|a-d") == "[abcd]+|[^0123x]|a-d"
    for pattern in ["[a-c-e]", "[A-z]", "[c-a]", r"[\w-z]", "[a-c&&[b]]", "(?i)[a-c]", r"\[a-c]", "[ぁ-ん]"]:
        assert T.with_listed_ranges(pattern) == pattern

"""The registered queries in SQL, for DuckDB on the same tables."""

from __future__ import annotations

from checks import inputs
from grainsieve.functions.predicates import VALID_DOMAINS, VALID_EXTENSIONS
from grainsieve.functions.text import FOOTNOTE_HEADINGS

# RE2 knows only ASCII \s and \w, so the Unicode classes are spelled out.
SPACE = r"\s\v\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
STRIPPED = SPACE + r"\x1c-\x1f"
WORD = r"\p{L}\p{M}\p{Nd}\p{Pc}"
VISIBLE = f"[^{STRIPPED}]"
KANA = r"[\p{Hiragana}\p{Katakana}ー]"


def _list(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


ANNOTATED = """
annotated AS (
  SELECT doc_id, text || CASE doc_id % 4
    WHEN 0 THEN chr(10) || '東京、カナ。見て https://a.example.jp/x です' || chr(10)
    WHEN 1 THEN '（、カナ ） ( ; x ) ()'
    WHEN 2 THEN chr(10) || 'References ' || chr(10) || 'z'
    ELSE '' END AS text
  FROM documents
)"""

WEB = """
web AS (
  SELECT doc_id, 'カナ。' || replace(text, '.', '。') AS text,
    'https://h' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.example.jp/' WHEN 1 THEN '.example.zz/'
      ELSE '.example.com/' END AS url
  FROM documents
)"""

CODE = """
code AS (
  SELECT text, doc_id,
    CASE doc_id % 5 WHEN 0 THEN 'py' WHEN 1 THEN 'C' WHEN 2 THEN 'exe' WHEN 3 THEN 'md' ELSE 'JS' END
      AS ext,
    CAST(list_max([length(l) FOR l IN string_split(text, chr(10))]) AS BIGINT) AS max_line_length,
    length(text) / len(string_split(text, chr(10))) AS avg_line_length,
    length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) / length(text) AS alphanum_fraction,
    sha256(text) AS hexsha
  FROM documents
)"""

COUNTED = r"""
counted AS (
  SELECT doc_id, source AS shard, text,
    CAST(len(regexp_extract_all(text, '[^ \n]+')) AS BIGINT) AS num_tokens
  FROM documents
)"""

HELD = """
held AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY shard ORDER BY sha256('42:' || doc_id)) <= {n}
    THEN 'validation' ELSE 'train' END AS split
  FROM counted
)"""

LABELLED = """
labelled AS (
  SELECT d.doc_id, d.text, d.source,
    CASE WHEN toxic = 1 THEN '1' WHEN quality = 0 THEN '2' ELSE '0' END AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""


def matches(text: str, words, katakana: tuple[str, ...] = ()) -> str:
    """Keyword count; katakana words count among the maximal katakana runs."""
    found = f"len(regexp_extract_all({text}, '{'|'.join(words)}'))" if words else "0"
    if katakana:
        runs = f"regexp_extract_all({text}, '[ァ-ヴー]+')"
        found += f" + len([r FOR r IN {runs} IF r IN ({_list(katakana)})])"
    return f"CAST({found} AS BIGINT)"


def visible(text: str) -> str:
    return f"regexp_matches({text}, '{VISIBLE}')"


def footnotes(text: str) -> str:
    return f"regexp_replace({text}, '(?s)\\n(?:{'|'.join(FOOTNOTE_HEADINGS)})[{SPACE}]*\\n.*', '')"


# The six substitutions in their order.
def brackets(text: str) -> str:
    steps = (
        (f"（[{SPACE},，、;；]*", "（"),
        (f"[{SPACE},，、;；]*）", "）"),
        (f"（[{SPACE}]*）", ""),
        (rf"\([{SPACE},;]*", "("),
        (rf"[{SPACE},;]*\)", ")"),
        (rf"[{SPACE}]?\([{SPACE}]*\)", ""),
    )
    for pattern, replacement in steps:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


def japanese(text: str) -> str:
    url = rf"https?://[{WORD}/:%#$&?()~.=+\-]+"
    line = f"regexp_replace(l, '{url}', '', 'g')"
    line = rf"regexp_replace({line}, '[\x00-\x7F]{{100,}}', '', 'g')"
    lines = f"[{line} FOR l IN string_split({text}, chr(10)) IF regexp_matches(l, '{KANA}')]"
    return f"array_to_string({lines}, '')"


def stops(text: str, limit: int) -> str:
    count = f"(length({text}) - length(replace({text}, '。', '')))"
    return f"{count} >= length({text}) / {limit}"


HOST = (
    r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#]*@)?"
    r"(?:\[([^\]/?#]*)\]|([^/?#:@\[]*))"
)


def host(url: str) -> str:
    parts = " || ".join(f"regexp_extract({url}, '{HOST}', {group})" for group in (1, 2))
    return f"lower({parts})"


def suffix(url: str) -> str:
    return f"string_split({host(url)}, '.')[-1]"


def domain(url: str, domains) -> str:
    return (
        f"(NOT starts_with({url}, 'https://ja.wikipedia.org/') "
        f"AND {suffix(url)} IN ({_list(domains)}))"
    )


def _web_rules(strict: bool) -> dict[str, str]:
    limit, sentence = (2, 80) if strict else (3, 250)
    words = inputs.KEYWORDS
    return {
        "valid_domain": domain("url", VALID_DOMAINS),
        "not_empty": visible("text"),
        "japanese": "regexp_matches(substring(text, 1, 50), '[ぁ-んァ-ン]')",
        "not_ad": f"{matches('text', words.ads)} <= 10",
        "not_adult": f"{matches('text', words.adult)} <= {limit}",
        "not_discrimination": f"{matches('text', words.discrimination)} <= {limit}",
        "not_violence": f"{matches('text', ('ouou',), ('カナ',))} <= {limit}",
        "sentence_length": stops("text", sentence),
    }


def _web_crawl(strict: bool) -> str:
    rules = " AND ".join(_web_rules(strict).values())
    return f"""
WITH {WEB}, cleaned AS (SELECT doc_id, {japanese("text")} AS text FROM web WHERE {rules})
SELECT * FROM cleaned WHERE {visible("text")}"""


def _wiki() -> str:
    return f"""
WITH {ANNOTATED},
  cut AS (SELECT doc_id, {footnotes("text")} AS text FROM annotated WHERE {visible("text")}),
  cleaned AS (SELECT doc_id, {brackets("text")} AS text FROM cut)
SELECT * FROM cleaned WHERE {visible("text")}"""


def _rejections() -> str:
    rules = _web_rules(False)
    names = ", ".join(f"{rule} AS {name}" for name, rule in rules.items())
    kept = " AND ".join([*rules, "filled"])
    return f"""
WITH {WEB}, judged AS (
  SELECT doc_id, {names}, {visible(japanese("text"))} AS filled FROM web)
SELECT *, {kept} AS kept FROM judged"""


def _vocabulary(doc_id: str = "doc_id") -> str:
    pieces = rf"regexp_extract_all(text, '{inputs.PIECES}')"
    return f"""
WITH vocabulary AS (
  SELECT piece, CAST('0x' || substr(sha256(piece), 1, 6) AS INTEGER) AS id
  FROM (SELECT DISTINCT unnest({pieces}) AS piece FROM benchmark)),
pieces AS (SELECT doc_id, {pieces} AS tokens FROM documents),
places AS (
  SELECT doc_id, unnest(tokens) AS piece, generate_subscripts(tokens, 1) AS place FROM pieces),
ids AS (
  SELECT doc_id, string_agg(CAST(coalesce(id, 0) AS VARCHAR), ' ' ORDER BY place) AS ids
  FROM places LEFT JOIN vocabulary USING (piece) GROUP BY doc_id)
SELECT {doc_id} AS doc_id, array_to_string(tokens, '|') AS pieces, coalesce(ids, '') AS ids,
  CAST(len(tokens) AS BIGINT) AS num_tokens
FROM pieces LEFT JOIN ids USING (doc_id)"""


_BUDGET = f"""
WITH {COUNTED},
limits AS (
  SELECT sum(num_tokens) // 3 AS t, sum(num_tokens) // 40 AS v,
    CAST(floor((sum(num_tokens) // 40) / 50 / count(DISTINCT shard)) AS BIGINT) AS n
  FROM counted),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY sha256('42:' || doc_id)) AS place
  FROM counted),
shards AS (
  SELECT shard, sum(num_tokens) AS a, sum(CASE WHEN place <= n THEN num_tokens ELSE 0 END) AS h
  FROM ranked, limits GROUP BY shard),
valid AS (
  SELECT *, coalesce(sum(h) OVER (ORDER BY sha256('42:' || shard)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < (SELECT v FROM limits) AS valid_active
  FROM shards),
active AS (
  SELECT *, coalesce(sum(CASE WHEN valid_active THEN a - h ELSE a END)
    OVER (ORDER BY sha256('42:' || shard) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    < (SELECT t FROM limits) AS train_active
  FROM valid),
flagged AS (
  SELECT doc_id, shard, CASE WHEN valid_active AND place <= n THEN 'validation'
    WHEN train_active THEN 'train' END AS split
  FROM ranked JOIN active USING (shard), limits)
SELECT * FROM flagged WHERE split IS NOT NULL"""

_BY_IDS = f"""
WITH {COUNTED}, {HELD.format(n=5)},
ids AS (SELECT DISTINCT sha256(text) AS id FROM held WHERE split = 'validation'),
flagged AS (
  SELECT doc_id, num_tokens,
    CASE WHEN sha256(text) IN (SELECT id FROM ids) THEN 'validation' ELSE 'train' END AS split
  FROM counted)"""


def _quality(kept: str) -> str:
    return f"""
WITH {LABELLED},
judged AS (
  SELECT label, {kept} AS kept
  FROM labelled),
counts AS (
  SELECT count(*) FILTER (NOT kept AND label <> '0') AS tp,
    count(*) FILTER (NOT kept AND label = '0') AS fp,
    count(*) FILTER (kept AND label <> '0') AS fn,
    count(*) FILTER (kept AND label = '0') AS acceptable,
    count(*) FILTER (kept AND label = '1') AS harmful,
    count(*) FILTER (kept AND label = '2') AS low_quality,
    count(*) FILTER (kept) AS kept
  FROM judged),
rated AS (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall
  FROM counts),
quality AS (
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM rated)"""


_QUALITY = _quality(f"{visible('text')} AND {matches('text', inputs.WORDS)} <= 30 AND source <> 'src1'")
_SHARES = """acceptable / nullif(kept, 0) AS acceptable_share, harmful / nullif(kept, 0) AS harmful_share,
  low_quality / nullif(kept, 0) AS low_quality_share"""


PLAIN_WORDS = """
WITH words AS (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM documents),
  threes AS (
  SELECT word, list_transform(range(1, length(word) - 1), lambda i: substring(word, i, 3)) AS parts FROM words),
  plain AS (
  SELECT word, (length(word) + 8) / length(word) AS ratio FROM threes
  WHERE length(word) < 3 OR len(list_distinct(parts)) = length(word) - 2)"""

KEPT_PAGES = f"""
WITH cut AS (SELECT doc_id, {footnotes("text")} AS text FROM documents WHERE {visible("text")}),
  cleaned AS (SELECT doc_id, {brackets("text")} AS text FROM cut),
  pages AS (
  SELECT doc_id, text,
    CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS split
  FROM cleaned WHERE {visible("text")})"""


ORACLES = {
    "kept_by_source": f"""
WITH cut AS (SELECT source, {footnotes("text")} AS text FROM documents WHERE {visible("text")}),
  cleaned AS (SELECT source, {brackets("text")} AS text FROM cut)
SELECT source, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS characters
FROM cleaned WHERE {visible("text")} GROUP BY source""",
    "reformat_documents": """
SELECT text, doc_id, lang, source, upper(lang) AS meta_text FROM documents""",
    "recipe_en_wiki": _wiki(),
    "recipe_ja_wiki": _wiki(),
    "recipe_web_crawl_native": _web_crawl(False),
    "recipe_web_crawl_native_strict": _web_crawl(True),
    "rejections_web_crawl": _rejections(),
    "recipe_subset_exclusion": f"""
SELECT doc_id, text,
  CASE WHEN source = 'src1' THEN 'Books3' WHEN source <> 'src2' THEN source END AS pile_set_name
FROM documents WHERE {visible("text")} AND source <> 'src1'""",
    "recipe_code": f"""
WITH {CODE}
SELECT doc_id, ext, max_line_length, hexsha, text FROM code
WHERE ext IN ({_list(VALID_EXTENSIONS)}) AND max_line_length <= 1000 AND avg_line_length <= 100
  AND alphanum_fraction >= 0.25 AND {visible("text")}""",
    "own_recipe": f"""
WITH cleaned AS (
  SELECT doc_id, lower(regexp_replace(text, '[0-9]+', '', 'g')) AS text FROM documents
  WHERE lang = 'en' AND {visible("text")})
SELECT * FROM cleaned WHERE {visible("text")}""",
    "url_tld_filter": f"""
SELECT page_id, url FROM pages WHERE {domain("url", ("com", "org"))}""",
    "url_hosts": rf"""
WITH urls AS (
  SELECT page_id, CASE page_id % 5
    WHEN 0 THEN replace(url, '://', '://user:pw@')
    WHEN 1 THEN upper(url)
    WHEN 2 THEN replace(url, '://', '/')
    WHEN 3 THEN regexp_replace(url, '(example\.[a-z]+)', '\1.:8080', 'g')
    ELSE replace(url, '.', '_.') END AS url
  FROM pages)
SELECT page_id, {host("url")} AS host, {suffix("url")} AS suffix FROM urls""",
    "code_predicates": f"""
WITH {CODE}
SELECT doc_id, ext IN ({_list(VALID_EXTENSIONS)}) AS extension, max_line_length <= 1000 AS max_line,
  avg_line_length <= 100 AS avg_line, alphanum_fraction >= 0.7 AS alphanum
FROM code""",
    "not_empty": f"""
WITH blanks AS (
  SELECT doc_id, CASE doc_id % 8
    WHEN 0 THEN ''
    WHEN 1 THEN ' ' || chr(10) || chr(9)
    WHEN 2 THEN chr(12288) || chr(160) || chr(8195)
    WHEN 3 THEN chr(28) || chr(31)
    WHEN 4 THEN chr(8203)
    ELSE text END AS text
  FROM documents)
SELECT doc_id FROM blanks WHERE {visible("text")}""",
    "japanese_prefix": f"""
WITH {WEB}, moved AS (SELECT doc_id, repeat('x', doc_id % 60) || text AS text FROM web)
SELECT doc_id FROM moved WHERE regexp_matches(substring(text, 1, 50), '[ぁ-んァ-ン]')""",
    "sentence_length": f"WITH {WEB} SELECT doc_id FROM web WHERE {stops('text', 250)}",
    "sentence_length_strict": f"WITH {WEB} SELECT doc_id FROM web WHERE {stops('text', 80)}",
    "keyword_count": f"SELECT doc_id, {matches('text', inputs.WORDS)} AS matches FROM documents",
    "keyword_count_many": f"""
SELECT doc_id, {matches('text', inputs.MANY_WORDS)} AS matches FROM documents""",
    "keyword_reject": f"""
SELECT doc_id FROM documents
WHERE {matches('text', inputs.WORDS)} <= 30 AND {matches('text', ('ing', 'in'))} <= 10""",
    "keyword_katakana": f"""
WITH {ANNOTATED}
SELECT doc_id, {matches('text', ('東京', '東', '見て'), ('カナ', 'カナダ'))} AS matches
FROM annotated""",
    "text_sizes": """
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, round(0.01 * ln(strlen(text)), 9) AS penalty
FROM documents""",
    "extract_japanese": f"WITH {ANNOTATED} SELECT doc_id, {japanese('text')} AS text FROM annotated",
    "strip_footnotes": f"WITH {ANNOTATED} SELECT doc_id, {footnotes('text')} AS text FROM annotated",
    "strip_parens": f"WITH {ANNOTATED} SELECT doc_id, {brackets('text')} AS text FROM annotated",
    "tokenize_subword": """
WITH chars AS (
  SELECT doc_id, string_split(replace(text, ' ', '▁'), '') AS tokens FROM documents)
SELECT doc_id, array_to_string(tokens, '') AS pieces,
  array_to_string([CASE c WHEN '▁' THEN 3 WHEN chr(10) THEN 4 ELSE unicode(c) - 28 END
    FOR c IN tokens], ' ') AS ids,
  CAST(len(tokens) AS BIGINT) AS num_tokens
FROM chars""",
    "tokenize_vocab": _vocabulary(),
    "tokenize_vocab_joined": _vocabulary(),
    "tokenize_vocab_repeats": _vocabulary("CASE WHEN doc_id % 3 > 0 THEN doc_id % 50 END"),
    "tokenize_vocab_repeats_joined": _vocabulary("CASE WHEN doc_id % 3 > 0 THEN doc_id % 50 END"),
    "tokens_per_shard": f"""
WITH {COUNTED}
SELECT shard, count(*) AS examples, CAST(sum(num_tokens) AS BIGINT) AS tokens
FROM counted GROUP BY shard""",
    "corpus_totals": f"""
WITH {COUNTED}
SELECT count(DISTINCT shard) AS shards, count(*) AS examples, CAST(sum(num_tokens) AS BIGINT) AS tokens
FROM counted""",
    "holdout_per_shard": f"""
WITH {COUNTED}, {HELD.format(n=5)} SELECT doc_id, shard, split FROM held""",
    "split_totals": f"""
WITH {COUNTED}, {HELD.format(n=7)}
SELECT split, count(*) AS examples, CAST(sum(num_tokens) AS BIGINT) AS tokens FROM held GROUP BY split""",
    "rows_per_split": f"""
WITH {COUNTED}, {HELD.format(n=7)} SELECT split, count(*) AS examples FROM held GROUP BY split""",
    "token_budget_sample": _BUDGET,
    "hash_ids": "SELECT sha256(text) AS id FROM documents",
    "key_ids": "SELECT CAST(doc_id AS VARCHAR) AS id FROM documents",
    "distinct_ids": "SELECT DISTINCT sha256(text) AS id FROM documents",
    "split_by_ids": f"{_BY_IDS} SELECT doc_id, split FROM flagged",
    "split_by_ids_shuffled": f"{_BY_IDS} SELECT doc_id, split FROM flagged",
    "rows_with_ids": f"""
{_BY_IDS} SELECT doc_id, CAST(num_tokens AS INTEGER) AS num_tokens FROM flagged
WHERE split = 'validation'""",
    "rows_without_ids": f"""
{_BY_IDS} SELECT doc_id, CAST(num_tokens AS INTEGER) AS num_tokens FROM flagged
WHERE split = 'train'""",
    "allow_list": """
SELECT doc_id, source FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "split_write": f"""
WITH {COUNTED}, {HELD.format(n=5)}
SELECT doc_id, shard, split, CAST(num_tokens AS INTEGER) AS num_tokens FROM held""",
    "label_counts": f"""
WITH {LABELLED}
SELECT count(*) AS documents, count(*) FILTER (label = '0') AS acceptable,
  count(*) FILTER (label = '1') AS harmful, count(*) FILTER (label = '2') AS low_quality
FROM labelled""",
    "filter_quality": f"{_QUALITY} SELECT * FROM quality",
    "recipe_quality": f"{_QUALITY} SELECT * FROM quality",
    "label_shares": f"""
{_QUALITY}
SELECT {_SHARES}
FROM quality""",
    "jsonl_roundtrip": """
SELECT conv_id, turn, CASE WHEN turn > 0 THEN role END AS role, text FROM conversations""",
    "tolerant_jsonl": """
WITH lines AS (
  SELECT doc_id, lang, '{"doc_id":' || doc_id || ',"lang":"' || lang || '"}' AS line FROM documents)
SELECT CASE WHEN doc_id % 9 > 0 THEN doc_id END AS doc_id,
  CASE WHEN doc_id % 9 > 0 THEN lang END AS lang,
  CASE WHEN doc_id % 9 = 0 THEN substring(line, 1, 9) END AS _corrupt
FROM lines""",
    "parquet_shards": """
SELECT source AS shard, count(*) AS documents, count(*) AS row_ids FROM documents GROUP BY source""",
    "filtered_chunks": f"""
WITH cut AS (SELECT doc_id, {footnotes("text")} AS text FROM documents WHERE {visible("text")}),
  cleaned AS (SELECT doc_id, {brackets("text")} AS text FROM cut)
SELECT doc_id, text, CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split
FROM cleaned WHERE {visible("text")}""",
    "ingest_counts": """
SELECT CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS split,
  count(*) AS examples
FROM documents GROUP BY 1""",
    "concatenated_shards": """
SELECT 'documents' AS shard, lang, 2 * count(*) AS documents FROM documents GROUP BY lang""",
    "manifest_roundtrip": f"""
WITH {COUNTED}, {HELD.format(n=5)}
SELECT 'hash' AS key, sha256(text) AS id FROM held WHERE split = 'validation'""",
    "manifest_table_roundtrip": "SELECT 'hash' AS key, sha256(text) AS id FROM documents",
    "stream_recipe": _wiki(),
    "parse_sizes": """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) * CASE l_linenumber % 7
  WHEN 1 THEN 1000 WHEN 2 THEN 1000 WHEN 3 THEN 1000000 WHEN 4 THEN 1000000000
  WHEN 5 THEN 1000000000 WHEN 6 THEN 1000000000000 ELSE 1 END AS BIGINT) AS size
FROM lineitem""",
    "shard_names": """
SELECT doc_id, 'train_' || source || '.train' AS stem,
  'validation_' || source || '.validation' AS validation_stem
FROM documents""",
    "compression_words": f"""{PLAIN_WORDS}
SELECT word, count(*) AS places, min(ratio) AS least, max(ratio) AS most FROM plain GROUP BY word""",
    "compression_words_band": f"""{PLAIN_WORDS}
SELECT word, count(*) AS places FROM plain
WHERE ratio + 0.01 * ln(length(word)) BETWEEN 1.75 AND 2.5 GROUP BY word""",
    "chunk_resume": f"""{KEPT_PAGES}
SELECT doc_id AS id, text, split FROM pages""",
    "named_shards": f"""
WITH {COUNTED}, {HELD.format(n=5)}
SELECT doc_id, CASE split WHEN 'train' THEN 'train_' ELSE 'validation_' END || shard AS output, num_tokens FROM held""",
    "safe_overwrite": "SELECT doc_id + 1 AS doc_id, lang FROM documents",
    "holdout_json_lines": """
WITH sizes AS (SELECT source AS shard, count(*) AS n FROM documents GROUP BY source)
SELECT shard, 'validation' AS split, CAST(5 AS BIGINT) AS documents, CAST(5 AS BIGINT) AS row_ids FROM sizes
UNION ALL SELECT shard, 'train', n - 5, n - 5 FROM sizes""",
    "split_by_ids_stored": f"{_BY_IDS} SELECT doc_id, split FROM flagged",
    "token_report": f"""
WITH {COUNTED}, {HELD.format(n=7)}
SELECT CASE WHEN grouping(shard) = 0 THEN 'shard' WHEN grouping(split) = 0 THEN 'split' ELSE 'corpus' END AS level,
  split, shard, count(DISTINCT shard) AS shards, count(*) AS examples, CAST(sum(num_tokens) AS BIGINT) AS tokens
FROM held GROUP BY GROUPING SETS ((shard), (split), ())""",
    "manifest_ordered": """
SELECT 'hash' AS key, sha256(text) AS id, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents""",
    "quarantine": """
WITH lines AS (
  SELECT doc_id, lang, '{"doc_id":' || doc_id || ',"lang":"' || lang || '"}' AS line FROM documents)
SELECT CASE WHEN doc_id % 9 > 0 THEN 'good' ELSE 'bad' END AS output,
  CASE WHEN doc_id % 9 > 0 THEN doc_id END AS doc_id,
  CASE WHEN doc_id % 9 > 0 THEN lang END AS lang,
  CASE WHEN doc_id % 9 = 0 THEN substring(line, 1, 9) END AS _corrupt
FROM lines""",
    "stream_token_counts": f"""
WITH {COUNTED}
SELECT shard, count(*) AS examples, CAST(sum(num_tokens) AS BIGINT) AS tokens FROM counted GROUP BY shard""",
    "filter_evaluation": f"""
{_quality(f"{visible('text')} AND source <> 'src1'")}
SELECT *, {_SHARES} FROM quality""",
    "collection_ids": """
SELECT c.collection, CASE c.key WHEN 'id' THEN CAST(doc_id AS VARCHAR) WHEN 'hexsha' THEN reverse(md5(text)) ELSE sha256(text) END AS id
FROM documents, (VALUES ('ja_wiki', 'id'), ('en_wiki', 'id'), ('ja_cc', 'hash'), ('en_pile', 'hash'), ('code_stack', 'hexsha')) AS c(collection, key)""",
    "keyword_files": f"""
WITH {ANNOTATED}
SELECT doc_id, {matches('text', inputs.KEYWORDS.adult)} AS adult, {matches('text', ('ouou',), ('カナ',))} AS violence
FROM annotated""",
    "keyword_one_pass": f"""
WITH {ANNOTATED}
SELECT doc_id, {matches('text', ('ing', 'in'))} AS ads, {matches('text', inputs.WORDS)} AS adult,
  {matches('text', ('東京', '東', '見て'), ('カナ', 'カナダ'))} AS discrimination, {matches('text', inputs.MANY_WORDS)} AS violence
FROM annotated""",
    "keyword_limits": f"""
WITH {ANNOTATED}
SELECT doc_id FROM annotated
WHERE {matches('text', ('ing', 'in'))} <= 200 AND {matches('text', inputs.WORDS)} <= 60
  AND {matches('text', ('東京', '東', '見て'), ('カナ', 'カナダ'))} <= 1 AND {matches('text', inputs.MANY_WORDS)} <= 4000""",
    "job_listed": f"""{KEPT_PAGES}
SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN 'validation' ELSE 'train' END AS split FROM pages WHERE split = 'train'""",
    "null_shards": """
SELECT CASE WHEN source <> 'src3' THEN source END AS shard, count(*) AS documents FROM documents GROUP BY 1""",
    "job_filtered": f"""{KEPT_PAGES}
SELECT doc_id AS id, text, split FROM pages""",
    "job_tokens": f"""{KEPT_PAGES}
SELECT count(*) AS examples, sum(len(regexp_extract_all(text, '{inputs.PIECES}'))) AS tokens FROM pages""",
    "job_by_ids": f"""{KEPT_PAGES}
SELECT doc_id AS id, true AS agrees FROM pages WHERE split = 'train'""",
    "job_sampled": f"""{KEPT_PAGES}
SELECT doc_id AS id, text FROM pages WHERE split = 'train'""",
}

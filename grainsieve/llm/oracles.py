"""SQL for DuckDB that gives the rows of the registered queries, where SQL can."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op6_urls"] = r"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS n,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), lowered AS (
  SELECT page_id, n, coalesce(translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(path, '') AS path
  FROM parts
), rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best AS (
  SELECT n, arg_max({'r': h || p, 'v': verdict}, length(h || p)) AS b
  FROM lowered JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY n
)
SELECT page_id, host, path, b.r AS rule, coalesce(b.v, 'allow') AS verdict
FROM lowered LEFT JOIN best USING (n)
"""

ORACLES["op9_exact"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# The table of the checksum, made by its rule.
_CRC = """
crc_steps AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM range(256) AS r(i)
)"""


def _crc32(text: str) -> str:
    """The checksum of a string, byte by byte over a table of 256 steps."""
    data = f"hex(encode({text}))"
    numbers = f"list_transform(range(CAST(length({data}) / 2 AS BIGINT)), lambda k: CAST('0x' || substring({data}, 2 * k + 1, 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {numbers}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])))"


ORACLES["op12_periods"] = f"""
WITH {_CRC},
texts AS (
  SELECT row_number() OVER () AS doc, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words,
    {_crc32("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents, crc_steps
), measured AS (
  SELECT doc, doc_id, words, len(words) AS n, h,
    CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a, 3 + (h // 10) % 8 AS parts
  FROM texts
), planted AS (
  SELECT doc, doc_id, n, CASE WHEN a IS NULL THEN words
    ELSE list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END]) END AS words
  FROM measured
), placed AS (SELECT doc, unnest(range(n)) AS i, unnest(words) AS word FROM planted),
pairs AS (
  SELECT x.doc, x.i, y.i - x.i AS q FROM placed x JOIN placed y ON x.doc = y.doc AND x.word = y.word AND y.i > x.i
), islands AS (
  SELECT doc, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT doc, q, i, i - row_number() OVER (PARTITION BY doc, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc, q, island HAVING count(*) + q >= greatest(12, 2 * q)
), runs AS (SELECT doc, start, length, min(q) AS period FROM islands GROUP BY doc, start, length),
dropped AS (
  SELECT DISTINCT doc, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc, string_agg(word, ' ' ORDER BY i) AS text FROM placed ANTI JOIN dropped USING (doc, i) GROUP BY doc
), listed AS (
  SELECT doc, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    arg_min({{'start': start, 'length': length, 'period': period}}, {{'last': -length, 'start': start, 'period': period}}) AS best
  FROM runs GROUP BY doc
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (doc) LEFT JOIN kept USING (doc)
"""

ORACLES["op13_variants"] = f"""
WITH RECURSIVE {_CRC},
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (SELECT doc_id, run, count(*) AS c FROM found GROUP BY ALL),
hashed AS (SELECT run, c, {_crc32("doc_id || ':' || run")} AS h FROM counted, crc_steps),
changed AS (
  SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, c
  FROM hashed
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM changed GROUP BY word HAVING sum(c) >= 3 AND length(word) >= 5
), holes AS (
  SELECT word, i, length(word) AS size, substring(word, 1, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), shorter AS (SELECT DISTINCT h.word AS long, w.word AS short FROM holes h JOIN words w ON h.rest = w.word),
near AS (
  SELECT a.word, b.word AS near FROM holes a JOIN holes b ON a.i = b.i AND a.size = b.size AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT long, short FROM shorter UNION SELECT short, long FROM shorter
), best AS (
  SELECT near.word, count(*) AS n_near, arg_min({{'word': near, 'n': w.n}}, {{'last': -w.n, 'word': near}}) AS b
  FROM near JOIN words w ON near.near = w.word GROUP BY near.word
), judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 2 * n THEN b.word END AS form, CASE WHEN b.n >= 2 * n THEN b.n END AS form_n
  FROM words LEFT JOIN best USING (word)
), paths AS (
  SELECT word, form AS target FROM judged WHERE form IS NOT NULL
  UNION ALL SELECT paths.word, judged.form FROM paths JOIN judged ON paths.target = judged.word WHERE judged.form IS NOT NULL
), ends AS (SELECT paths.word, target FROM paths JOIN judged ON target = judged.word WHERE judged.form IS NULL)
SELECT word, form, coalesce(target, word) AS root, n, n_near, form_n FROM judged LEFT JOIN ends USING (word)
"""

ORACLES["op10_suffixes"] = """
WITH texts AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS doc, doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), sized AS (SELECT doc, doc_id, digits, CAST(length(digits) // 2 AS BIGINT) AS n FROM texts),
places AS (SELECT doc, digits, unnest(range(n - 99)) AS i FROM sized WHERE n >= 100),
windows AS (SELECT doc, i, substring(digits, 2 * i + 1, 200) AS bytes FROM places),
late AS (
  SELECT doc, i FROM (SELECT doc, i, row_number() OVER (PARTITION BY bytes ORDER BY doc, i) AS r FROM windows) WHERE r > 1
), marked AS (
  SELECT doc, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM late
), grouped AS (SELECT doc, i, sum(fresh) OVER (PARTITION BY doc ORDER BY i) AS span FROM marked),
spans AS (SELECT doc, min(i) AS a, max(i) + 100 AS b FROM grouped GROUP BY doc, span),
ends AS (SELECT doc, a, b FROM spans UNION ALL SELECT doc, n, n FROM sized),
gaps AS (SELECT doc, coalesce(lag(b) OVER (PARTITION BY doc ORDER BY a, b), 0) AS start, a FROM ends),
kept AS (
  SELECT doc, string_agg(substring(digits, 2 * start + 1, 2 * (a - start)), '' ORDER BY start, a) AS digits
  FROM gaps JOIN sized USING (doc) GROUP BY doc
), removed AS (SELECT doc, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed FROM spans GROUP BY doc)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(kept.digits)) AS kept_sha256
FROM sized JOIN kept USING (doc) LEFT JOIN removed USING (doc)
"""

"""Building blocks of the DuckDB SQL."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_az(expr: str) -> str:
    """A-Z only, as the contracts say."""
    return f"translate({expr}, '{UPPER}', '{UPPER.lower()}')"


SHINGLE_COMPONENTS = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({lower_az("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
      THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.c >= 75 * (x.n + y.n - p.c)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
"""

_WORDS8 = "[0-9a-z\\x{80}-\\x{10FFFF}]+"
BENCHMARK_WINDOWS = f"""
WITH b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({lower_az("coalesce(text, '')")}, '{_WORDS8}') AS ws
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(ws), 13) AS size,
    unnest(list_transform(range(1, len(ws) - least(len(ws), 13) + 2),
      lambda i: array_to_string(ws[i:i + least(len(ws), 13) - 1], ' '))) AS w
  FROM b WHERE len(ws) > 0),
d AS (
  SELECT doc_id, regexp_extract_all({lower_az("coalesce(text, '')")}, '{_WORDS8}') AS ws
  FROM documents),
pos AS (
  SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
  FROM d, (SELECT DISTINCT size FROM win) WHERE len(ws) >= size),
hit AS (
  SELECT a.doc_id, a.i, a.size, win.item
  FROM (SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS w FROM pos) a
  JOIN win ON win.size = a.size AND win.w = a.w),
word AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
"""

_TURN = "coalesce(role, 'unknown')"
_BODY = "coalesce(text, '')"
MAXIMAL_CHATS = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, {_TURN} AS role, {_BODY} AS text FROM conversations),
c AS (
  SELECT conv_id, list({{'role': role, 'text': text}}
    ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || text)) AS turns
  FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT turns[1:i] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS i FROM c)),
k AS (
  SELECT arg_min(conv_id, (length(conv_id::VARCHAR), conv_id::VARCHAR)) AS conv_id, turns, count(*) AS copies
  FROM c ANTI JOIN p USING (turns) GROUP BY turns),
s AS (SELECT *, unnest(range(0, (len(turns) + 63) // 64)) AS segment FROM k)
SELECT conv_id, segment::BIGINT AS segment, len(turns)::BIGINT AS n_turns, copies::BIGINT AS copies,
  sha256(array_to_string(list_transform(turns[segment * 64 + 1:segment * 64 + 64], lambda x:
    '<|im_start|>' || replace(x.role, '<|', '< |') || chr(10) || replace(x.text, '<|', '< |')
    || '<|im_end|>' || chr(10)), '')) AS chat_sha256
FROM s
"""


def _day(x: str, at: int) -> str:
    return f"('0x' || substr(md5({x}), {at}, 2))::INT % 30"


_HOST = "[A-Za-z][A-Za-z0-9+.-]*://"
URL_VERDICTS = f"""
WITH c AS (
  SELECT page_id, ts,
    nullif(lower(regexp_extract(url, '^{_HOST}(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    lower(regexp_extract(url, '^{_HOST}[^/?#]*/([^/?#]*)', 1)) AS seg
  FROM pages LEFT JOIN events ON event_id = page_id),
h AS (SELECT DISTINCT host, array_to_string(string_split(host, '.')[-3:], '.') AS d FROM c WHERE host IS NOT NULL),
e AS (
  SELECT DISTINCT d AS rule, 'block' AS action, {_day('d', 1)} AS day FROM h
  UNION ALL SELECT DISTINCT d, 'allow', {_day('d', 3)} FROM h
  UNION ALL SELECT DISTINCT d || '/de', 'block', {_day('d', 7)} FROM h
  UNION ALL SELECT host, 'allow', {_day('host', 1)} FROM h WHERE {_day('host', 5)} % 2 = 0
  UNION ALL SELECT host, 'block', {_day('host', 3)} FROM h WHERE {_day('host', 5)} % 2 = 0),
l AS (SELECT rule, max(action) AS action, TIMESTAMP '2024-01-01 00:00:00' + day * INTERVAL 1 DAY AS since
  FROM e GROUP BY rule, day),
r AS (
  SELECT page_id, ts, n, k,
    array_to_string(string_split(host, '.')[n:], '.') || CASE WHEN k = 0 THEN '/' || seg ELSE '' END AS rule
  FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS n FROM c WHERE host IS NOT NULL), (VALUES (0), (1)) v(k)
  WHERE k = 1 OR seg <> ''),
a AS (
  SELECT page_id, r.rule, l.action, row_number() OVER (PARTITION BY page_id ORDER BY k, n, l.since DESC) AS i
  FROM r JOIN l ON l.rule = r.rule AND l.since <= r.ts)
SELECT c.page_id, c.host, coalesce(a.action, 'allow') AS verdict, a.rule
FROM c LEFT JOIN a ON a.page_id = c.page_id AND a.i = 1
"""


#: Operator 12: crc32 as a fold over the bytes with the table of its polynomial; near words by
#: equal patterns (one code point masked) and by deleting one code point; roots by recursion.
SPELLING_VARIANTS = """
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::UBIGINT, list_transform(range(8), lambda k: k::UBIGINT)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END)) AS t),
run AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
own AS (SELECT doc_id, w, count(*) AS n, hex(coalesce(doc_id::VARCHAR, 'null') || ':' || w) AS x FROM run GROUP BY ALL),
hashed AS (
  SELECT w, n, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(x) + 1, 2),
    lambda i: ('0x' || substr(x, i, 2))::UBIGINT)), lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT]))) AS h
  FROM own, tab),
word AS (
  SELECT v AS word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::BIGINT)
    || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS v FROM hashed) WHERE length(v) >= 5 GROUP BY v HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
pair AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cut x JOIN word y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM cut x JOIN word y ON x.a || x.b = y.word),
near AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM pair GROUP BY word),
form AS (
  SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
    CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n FROM word w LEFT JOIN near USING (word)),
walk AS (
  SELECT word, word AS step, 0 AS steps FROM form
  UNION ALL SELECT k.word, f.form, steps + 1 FROM walk k JOIN form f ON k.step = f.word WHERE f.form IS NOT NULL),
root AS (SELECT word, arg_max(step, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM form JOIN root USING (word)
"""

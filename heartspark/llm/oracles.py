"""DuckDB SQL of the queries of this subpackage that SQL can express, written apart from the operators."""

from __future__ import annotations

from .quality import COMMON

CHAT = r"""
WITH rows AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM rows
), e AS (
  SELECT *,
    replace(regexp_replace(replace(r, '\', '\\'), '([<\[])(\||/?INST\]|/?s>)', '\1\\\2', 'g'), chr(10), '<\n>') AS er,
    regexp_replace(replace(x, '\', '\\'), '([<\[])(\||/?INST\]|/?s>)', '\1\\\2', 'g') AS ex
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(x)) FILTER (WHERE r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY k) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  sum(length(er) + length(ex) + length('<|im_start|>') + 1 + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def secrets() -> str:
    names = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
    pem = (r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----((\r?\n(Proc-Type|DEK-Info): [^\r\n]*){1,9}\r?\n)?([^-]*-----END [A-Z ]{0,30}PRIVATE KEY-----"
           r"|(\r?\n[\t ]*[A-Za-z0-9+/=]+[\t ]*\r?(?m:$)|(\\r)?\\n[A-Za-z0-9+/=]{16,})*)")
    kinds = [
        ("assign", rf"""({names})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32),
        ("private_key", pem, 0, 1), ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
        ("slack", "xox[abeoprs]-[A-Za-z0-9-]{10,}", 0, 1), ("google", "AIza[0-9A-Za-z_-]{35}", 0, 1),
        ("stripe", "[rs]k_live_[0-9A-Za-z]{16,}", 0, 1),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1)]
    matched = " UNION ALL ".join(
        f"SELECT row, '{kind}' AS kind, {rank} AS rank, {least} AS least, regexp_extract_all(x, '{p}') AS whole, "
        f"regexp_extract_all(x, '{p}', {group}) AS part, regexp_split_to_array(x, '{p}') AS gaps FROM d" for rank, (kind, p, group, least) in enumerate(kinds))
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS x FROM documents),
m AS ({matched}),
u AS (SELECT row, kind, rank, least, unnest(whole) AS w, unnest(part) AS p, unnest(gaps[:len(whole)]) AS gap, unnest(range(len(whole))) AS i FROM m),
s AS (SELECT *, sum(length(gap) + length(w)) OVER (PARTITION BY row, kind ORDER BY i) AS e FROM u),
f AS (SELECT row, kind, rank, e - length(w) AS b, kind || ':' || (e - length(w)) || ':' || e AS said FROM s WHERE length(p) >= least)
SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(said, ',' ORDER BY b, rank) FILTER (WHERE rank < 3), '')) AS base_sha256,
  coalesce(string_agg(said, ',' ORDER BY b, rank), '') AS spans
FROM d LEFT JOIN f USING (row) GROUP BY row, doc_id
"""


def quality() -> str:
    words = sorted({w for words in COMMON.values() for w in words.split()})
    langs = ", ".join(f"'{x}'" for x in sorted(COMMON))
    gap = r"[\x20\x09-\x0D]"
    listed = ", ".join(f"('{w}')" for w in words)

    def size(pattern: str) -> str:
        return f"length(x) - length(regexp_replace(x, '{pattern}', '', 'g'))"

    classes = ["[a-z]", r"\p{Lu}", "[0-9]", gap, r"[.,;:''\"()-]", r"[!#$%&*+/<=>?@\[\\\]^_`{|}~]"]
    chars = " UNION ALL ".join(f"SELECT row, {k} AS k, {size(p)} AS n FROM d" for k, p in enumerate(classes))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, [v FOR v IN regexp_split_to_array(x, '{gap}+') IF v <> ''] AS ws,
  [v FOR v IN string_split(x, chr(10)) IF regexp_matches(v, '[^\x20\x09-\x0D]')] AS ls FROM d),
win AS (SELECT row, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT row, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT row, i FROM win QUALIFY count(*) OVER (PARTITION BY row, g) > 1),
repeated AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY row),
base AS (SELECT w.row, doc_id, lang, x, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  {size('[#*$%&|<>]')} AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeated r USING (row)),
some_class AS ({chars}),
class AS (SELECT row, k, n FROM some_class UNION ALL
  SELECT d.row, {len(classes)}, length(x) - coalesce(s.n, 0) FROM d LEFT JOIN (SELECT row, sum(n) AS n FROM some_class GROUP BY row) s USING (row)),
bins AS (SELECT v FROM (VALUES {listed}) listed(v)),
said AS (SELECT row, v, count(*) AS n FROM (SELECT row, unnest(regexp_split_to_array(lower(x), '[^\p{{L}}]+')) AS v FROM d) JOIN bins USING (v) GROUP BY row, v),
common AS (SELECT row, v, coalesce(n, 0) AS n FROM d CROSS JOIN bins LEFT JOIN said USING (row, v) UNION ALL
  SELECT b.row, '', greatest(0, b.n_words - coalesce(s.n, 0)) FROM base b LEFT JOIN (SELECT row, sum(n) AS n FROM said GROUP BY row) s USING (row)),
hist AS (SELECT row, 'char' AS h, k::VARCHAR AS bin, n::DOUBLE / greatest(1, sum(n) OVER (PARTITION BY row)) AS p FROM class UNION ALL
  SELECT row, 'word', v, n::DOUBLE / greatest(1, sum(n) OVER (PARTITION BY row)) FROM common),
one AS (SELECT min(row) AS row, lang FROM base WHERE n_words >= 50 AND lang IN ({langs}) GROUP BY lang, x),
shape AS (SELECT row, h, bin, p, lang AS rl FROM hist JOIN one USING (row)),
mean1 AS (SELECT rl, h, bin, avg(p) AS q FROM shape GROUP BY rl, h, bin),
near AS (SELECT row FROM shape JOIN mean1 USING (rl, h, bin) WHERE h = 'char' GROUP BY row HAVING sqrt(greatest(0.0, sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) <= 0.2),
mean2 AS (SELECT rl, h, bin, avg(p) AS q FROM shape WHERE row IN (SELECT row FROM near) GROUP BY rl, h, bin),
ref AS (SELECT * FROM mean2 UNION ALL SELECT * FROM mean1 WHERE rl NOT IN (SELECT rl FROM mean2)),
dist AS (SELECT row, rl, h, sqrt(greatest(0.0, sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js
  FROM hist JOIN ref USING (h, bin) GROUP BY row, rl, h),
two AS (SELECT row, rl, max(js) FILTER (WHERE h = 'char') AS c, max(js) FILTER (WHERE h = 'word') - 1.8 / sqrt(greatest(1, any_value(n_words))) AS w
  FROM dist JOIN base USING (row) GROUP BY row, rl),
nearest AS (SELECT row, min(greatest(c - 0.21, w - 0.32, least(c - 0.165, w - 0.10))) AS excess FROM two GROUP BY row),
judged AS (SELECT b.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  coalesce(excess > 0, false) AND n_words >= 50 AND (lang IS NULL OR lang IN (SELECT rl FROM ref)) AS apart
  FROM base b LEFT JOIN nearest USING (row))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND NOT apart AS kept FROM judged
"""


WARC = r"""
WITH a AS (
  SELECT page_id, coalesce(html, '') AS b, coalesce(page_id, 0) AS m, regexp_replace(trim(coalesce(url, '')), '#.*$', '') AS u0, url FROM pages
), c AS (
  SELECT *, regexp_replace(u0, '^([Hh][Tt][Tt][Pp][Ss]?:)?//', '') AS u FROM a
), d AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^(www[0-9]*|m)\.', '')
    || regexp_replace(regexp_extract(substr(u, length(regexp_extract(u, '^([^/?]*)', 1)) + 1), '^([^?]*)', 1), '/+$', '') AS place,
    list_sort([p FOR p IN string_split(regexp_extract(u, '\?(.*)$', 1), '&')
      IF p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z]+|gclid|fbclid|ref|phpsessid|jsessionid|sid)(=|$)')]) AS params
  FROM c
), k AS (
  SELECT *, place || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS key,
    '"' || left(sha256(b), 16) || '"' AS tag, 1600000000 + 60 * m AS s FROM d
), r AS (SELECT key, s, max(page_id::VARCHAR) AS id FROM k GROUP BY key, s),
v AS (SELECT *, 1600000000 + 60 * (m + ('0x' || left(sha256(coalesce(url, '')), 4))::BIGINT % 4001 - 1000) AS s2 FROM k),
j AS (SELECT v.page_id, v.key, v.s2, v.tag, r.id FROM v ASOF LEFT JOIN r ON v.key = r.key AND v.s2 > r.s),
t AS (SELECT j.*, k.tag AS their, octet_length(encode(k.b)) AS n FROM j LEFT JOIN k ON j.id = k.page_id::VARCHAR)
SELECT page_id, key AS canonical_url, id::BIGINT AS target_page_id,
  CASE WHEN id IS NULL THEN 'missing' WHEN tag = their THEN 'resolved' ELSE 'mismatch' END AS outcome,
  CASE WHEN id IS NOT NULL AND tag = their THEN concat_ws(chr(10), 'cache-control: max-age=120', 'content-length: ' || n,
    'content-type: text/html; charset=utf-8', 'date: ' || s2, 'etag: W/' || tag) END AS headers
FROM t
"""


CONVERSATIONS = r"""
WITH RECURSIVE crc AS (
  SELECT [list_reduce(list_prepend(i::UBIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) FOR i IN range(256)] AS tab
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    [ord(c)::UBIGINT FOR c IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')] AS key FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::UBIGINT, key),
    lambda c, b: xor(tab[(xor(c, b) & 255)::BIGINT + 1], c >> 8)), 4294967295::UBIGINT) % 20 AS d FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE d <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM damaged
), faulty AS (
  SELECT *, left(role, 1) AS c, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS was, lead(i) OVER (PARTITION BY conv_id ORDER BY i) IS NULL AS final FROM placed
), turns AS (
  SELECT *, CASE c WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS k, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more,
    fault IN ('blank', 'duplicate') AS gone FROM faulty
), costs AS (
  SELECT conv_id, max(i) + 1 AS i, 0 AS c0, 6 AS cs, 3 AS cu, 0 AS ca FROM turns GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, least(z0, 3 + least(zu, 3 + za)), least(zs, 3 + least(zu, 3 + za)), least(zu, 3 + za), least(za, 3 + zu) FROM (
    SELECT t.conv_id, t.i,
      least(4 + n.c0, CASE WHEN gone THEN 9999999 ELSE more + least(3 + n.cu, CASE k WHEN 1 THEN n.cs WHEN 2 THEN n.cu ELSE 9999999 END) END) AS z0,
      least(4 + n.cs, CASE WHEN gone THEN 9999999 ELSE more + least(3 + n.cu, CASE k WHEN 2 THEN n.cu ELSE 9999999 END) END) AS zs,
      least(4 + n.cu, CASE WHEN gone THEN 9999999 ELSE more + least(3 + n.ca, CASE k WHEN 3 THEN n.ca ELSE 9999999 END) END) AS zu,
      least(4 + n.ca, CASE WHEN gone THEN 9999999 ELSE more + least(3 + n.cu, CASE k WHEN 2 THEN n.cu ELSE 9999999 END) END) AS za
    FROM costs n JOIN turns t ON t.conv_id IS NOT DISTINCT FROM n.conv_id AND t.i = n.i - 1)
), vec AS (
  SELECT conv_id, i, [c0, cs, cu, ca] AS v FROM costs
), walk AS (
  SELECT conv_id, 1::BIGINT AS i, 0 AS s, 0 AS step, '' AS e, NULL::VARCHAR AS line, v[1] AS cost FROM vec WHERE i = 1
  UNION ALL
  SELECT conv_id, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE WHEN e = 'D' THEN s WHEN e = 'K' THEN k ELSE need END, step + 1, e,
    CASE e WHEN 'I' THEN nm || ':' WHEN 'K' THEN role || ':' || text WHEN 'R' THEN nm || ':' || text END, cost FROM (
    SELECT w.conv_id, w.i, w.s, w.step, w.cost, t.k, t.role, t.text, CASE WHEN w.s = 2 THEN 3 ELSE 2 END AS need, CASE WHEN w.s = 2 THEN 'assistant' ELSE 'user' END AS nm,
      CASE WHEN t.i IS NULL THEN 'I' WHEN 4 + n.v[w.s + 1] = h.v[w.s + 1] THEN 'D'
        WHEN 3 + h.v[CASE WHEN w.s = 2 THEN 4 ELSE 3 END] = h.v[w.s + 1] THEN 'I'
        WHEN ((w.s IN (0, 1, 3) AND t.k = 2) OR (w.s = 2 AND t.k = 3) OR (w.s = 0 AND t.k = 1)) AND t.more + n.v[t.k + 1] = h.v[w.s + 1] THEN 'K' ELSE 'R' END AS e
    FROM walk w JOIN vec h ON h.conv_id IS NOT DISTINCT FROM w.conv_id AND h.i = w.i
      LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i
      LEFT JOIN vec n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.i = w.i + 1
    WHERE t.i IS NOT NULL OR w.s IN (1, 2))
), repaired AS (
  SELECT conv_id, max(cost) AS cost, string_agg(e, '' ORDER BY step) AS audit, coalesce(string_agg(line, chr(10) ORDER BY step), '') AS body FROM walk GROUP BY conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE was IS NOT NULL AND was || c NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""

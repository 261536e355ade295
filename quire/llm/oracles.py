"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS.format(t="t")} AS w,
  list_filter(string_split(t, chr(10)), lambda x: trim(x, {_SPACE}) <> '') AS lines FROM d),
windows AS (SELECT r, i, list_slice(w, i, i + 4) AS g FROM w, unnest(range(1, len(w) - 3)) AS u(i)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 5)) AS u(p) GROUP BY r),
c AS (SELECT w.r, doc_id, t, len(w) AS n_words, len(list_distinct(lines)) AS n_distinct, len(lines) AS n_lines,
  length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
  length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters,
  length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS capitals,
  length(t) - length(replace(t, '!', '')) AS shouts
  FROM w LEFT JOIN covered USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  100 * n_symbols > 6 * greatest(word_chars, 1)
  OR (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)
  OR (regexp_matches(t, '\p{{Lu}}{{3}}') AND 2 * capitals > letters AND letters >= 40)
  OR 100 * shouts > 6 * greatest(word_chars, 1)
  OR greatest(word_chars, 1) > 60 * greatest(n_words, 1) AS rejected FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept FROM f
"""

# Links and the least id reachable, over rows numbered r
_REACH = """reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)"""

NEAR_COPIES = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
  {_WORDS.format(t=_LOWER.format(t="coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))
  END AS g FROM d),
e AS (SELECT r, len(g) AS n, unnest(g) AS x FROM s),
links AS (SELECT p.r AS a, q.r AS b FROM e p JOIN e q ON p.x = q.x AND p.r <> q.r
  GROUP BY p.r, q.r, p.n, q.n HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
{_REACH},
least AS (SELECT a, min(doc_id) AS m FROM reach JOIN s ON b = r GROUP BY a)
SELECT doc_id, len(g) AS n_shingles, coalesce(least(m, doc_id), doc_id) AS component_id FROM s LEFT JOIN least ON a = r
"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT p.r AS a, q.r AS b FROM v p JOIN v q ON p.label = q.label AND p.r <> q.r
  WHERE list_cosine_similarity(p.e, q.e) >= 0.93),
{_REACH},
least AS (SELECT a, min(vec_id) AS m FROM reach JOIN v ON b = r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(m, vec_id), vec_id) AS component_id,
  coalesce(least(m, vec_id), vec_id) = vec_id AS kept
FROM v LEFT JOIN least ON least.a = r LEFT JOIN n ON n.a = r
"""

LINE_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, doc_id, unnest(string_split(t, chr(10))) AS line,
  unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i FROM d),
k AS (SELECT *, {_LOWER.format(t=f"trim(line, {_SPACE})")} AS key FROM l),
common AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT k.*, common.key IS NOT NULL AS gone FROM k LEFT JOIN common USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY r
"""

# Unsigned crc32 of an ASCII text {s}, with the table t of the 256 byte values
_CRC_TABLE = """crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i)))"""
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""

# Pairs of equal six words q apart, in stretches; six words and more on either side make a run of at least twelve
WORD_RUNS = f"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(t="coalesce(text, '')")} AS w,
  {_CRC.format(s="CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc),
g AS (SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS hit, (h // 10) % greatest(len(w), 1) AS a,
  1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p FROM d),
v AS (SELECT r, doc_id, n, CASE WHEN hit THEN list_transform(range(n),
  lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM g),
grams AS (SELECT r, i, list_slice(w, i + 1, i + 6) AS x FROM v, unnest(range(0, n - 5)) AS u(i)),
again AS (SELECT r, i, x FROM grams QUALIFY count(*) OVER (PARTITION BY r, x) > 1),
pairs AS (SELECT a.r, a.i, b.i - a.i AS q FROM again a JOIN again b ON a.r = b.r AND a.x = b.x AND a.i < b.i),
parts AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT r, q, min(i) AS s, count(*) + 5 AS same FROM parts GROUP BY r, q, island),
runs AS (SELECT r, s, same + q AS l, min(q) AS q FROM stretches WHERE same >= q AND same + q >= 12 GROUP BY r, s, same + q),
told AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
  first(struct_pack(s := s, l := l, q := q) ORDER BY l DESC, s, q) AS best FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, k FROM runs, unnest(range(s + q, s + l)) AS u(k)),
words AS (SELECT r, k, w[k + 1] AS x FROM v, unnest(range(0, n)) AS u(k)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY k) AS t FROM words ANTI JOIN gone USING (r, k) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
  1000 * best.l // best.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM v LEFT JOIN told ON told.r = v.r LEFT JOIN kept ON kept.r = v.r
"""

# States: 0 begin, 1 after system, 2 after user, 3 after assistant; inserts never pay, as deleting the turn they answer costs less
CONVERSATIONS = rf"""
WITH RECURSIVE {_CRC_TABLE},
src AS (SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_CRC.format(s="coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f
  FROM conversations, crc),
hurt AS (SELECT r, conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
  CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy FROM src WHERE f <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, copy) AS i FROM hurt),
judged AS (SELECT *, left(role, 1) AS s, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' ELSE '' END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM placed),
told AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (prev IS NOT NULL AND prev || s NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
arcs AS (SELECT * FROM (VALUES (0, '', 'D', 2, 0), (1, '', 'D', 2, 1), (2, '', 'D', 2, 2), (3, '', 'D', 2, 3),
  (0, 's', 'K', 0, 1), (0, 'u', 'K', 0, 2), (1, 'u', 'K', 0, 2), (3, 'u', 'K', 0, 2), (2, 'a', 'K', 0, 3),
  (0, 'user', 'R', 1, 2), (1, 'user', 'R', 1, 2), (3, 'user', 'R', 1, 2), (2, 'assistant', 'R', 1, 3)) AS a(f, x, e, c, t)),
steps AS (SELECT conv_id, i, f, t, e, c + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS c,
  CASE e WHEN 'K' THEN role || ':' || text WHEN 'R' THEN x || ':' || text END AS line
  FROM judged JOIN arcs ON e = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (e = 'R' OR x = s))),
best AS (SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM told
  UNION ALL SELECT conv_id, i, state, cost, audit, lines FROM (
    SELECT s.conv_id, s.i, s.t AS state, b.cost + s.c AS cost, b.audit || s.e AS audit,
      CASE WHEN s.line IS NULL THEN b.lines ELSE list_append(b.lines, s.line) END AS lines
    FROM best b JOIN steps s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i + 1 AND s.f = b.state)
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
ends AS (SELECT b.* FROM best b JOIN told t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.n = b.i WHERE state IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY cost, audit) = 1)
SELECT c.conv_id, coalesce(t.gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
  coalesce(e.audit, '') AS audit, sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

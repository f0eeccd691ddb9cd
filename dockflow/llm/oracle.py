"""Text queries as DuckDB SQL, for those that SQL can express."""

from __future__ import annotations

import string

WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
listed AS (SELECT rid, regexp_extract_all(text, '{WORD}') AS ws FROM d),
toks AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM listed),
win AS (
  SELECT rid, p, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM toks WINDOW o AS (PARTITION BY rid ORDER BY p)),
rep AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM win WHERE c IS NOT NULL) WHERE k > 1),
cov AS (SELECT rid, count(DISTINCT p + k) AS n FROM rep, range(3) r(k) GROUP BY 1),
islands AS (
  SELECT rid, w, count(*) AS n
  FROM (SELECT rid, w, p - row_number() OVER (PARTITION BY rid, w ORDER BY p) AS grp FROM toks) GROUP BY rid, w, grp),
doubled AS (SELECT rid, sum(n // 2) AS n FROM islands GROUP BY 1),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY 1),
c AS (
  SELECT d.rid, doc_id, text, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(doubled.n, 0) AS n_doubled, len(string_split(text, chr(10))) AS n_lines,
         length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_bangs
  FROM d JOIN listed USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN doubled USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words OR n_dup_lines * 10 > n_lines * 3
            OR (n_upper > 50 AND n_upper * 10 > n_letters * 6) OR n_bangs * 4 > n_words
            OR word_chars < n_words * 2 OR word_chars > n_words * 40 OR n_doubled * 8 > n_words
            OR n_letters * 10 < word_chars * 5) AS kept
FROM b"""

OVERLAP = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS ws
  FROM documents),
long AS (
  SELECT DISTINCT rid, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)),
sh AS (SELECT * FROM long UNION ALL SELECT rid, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 2),
sizes AS (SELECT rid, count(*) AS n FROM sh GROUP BY 1),
common AS (SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.rid < b.rid GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rid AS src, rid AS dst FROM d UNION SELECT r.src, e.b FROM reach r JOIN edges e ON e.a = r.dst)
SELECT x.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d x LEFT JOIN sizes USING (rid)
JOIN (SELECT src, min(doc_id) AS component_id FROM reach JOIN d ON d.rid = dst GROUP BY 1) ON src = x.rid"""

MIX = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS cap, sum(source_size) OVER () AS budget FROM s),
l AS (
  SELECT *, CAST(budget - (sum(cap) OVER o - cap) AS DOUBLE)
            / CAST(sum(weight) OVER () - (sum(weight) OVER o - weight) AS DOUBLE) AS level
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS UNBOUNDED PRECEDING)),
shared AS (SELECT level FROM l WHERE cap >= weight * level ORDER BY CAST(cap AS DOUBLE) / weight, rank LIMIT 1),
t AS (
  SELECT source, rank, source_size, budget, least(CAST(cap AS DOUBLE), coalesce(weight * (SELECT level FROM shared), cap)) AS target
  FROM l),
q AS (
  SELECT doc_id, size, rank, source_size, budget, target, sum(size) OVER o AS served, row_number() OVER o AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
  WINDOW o AS (PARTITION BY rank ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)),
p AS (
  SELECT rank, place, target, budget, source_size, served - size AS start, size, (size + 127) // 128 AS pieces,
         unnest(generate_series(0, (size + 127) // 128 * 3 - 1)) AS piece
  FROM q WHERE size > 0 AND target > 0),
f AS (
  SELECT rank, place, piece, budget, least(128, size - piece % pieces * 128) AS words,
         CAST(source_size * (piece // pieces) + start + piece % pieces * 128 + least(128, size - piece % pieces * 128) AS DOUBLE) / target AS finish
  FROM p),
line AS (SELECT *, sum(words) OVER (ORDER BY finish, rank, place, piece ROWS UNBOUNDED PRECEDING) AS total FROM f),
taken AS (
  SELECT rank, place, sum(greatest(0, least(words, budget - total + words))) AS taken FROM line GROUP BY 1, 2)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN taken USING (rank, place)"""



def _then(state: str, cost: str, mark: str, line: str = "''") -> str:
    """A repair carried on: ten digits of cost and the audit in ``k``, the repaired rows in ``t``; null stays null."""
    key = f"lpad(CAST(CAST(left({state}.k, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({state}.k, 11) || '{mark}'"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'k': {key}, 't': {state}.t || {line}}} END"


_USER, _ASSISTANT = "E'user:\\n'", "E'assistant:\\n'"
REPAIR = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS key
  FROM conversations),
kinds AS (
  SELECT source.*, xor(list_reduce(list_prepend(4294967295, list_transform(key, lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM source, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS time
  FROM kinds),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         rtrim(text, E' \t\n\x0b\x0c\r') AS body
  FROM damaged),
checked AS (
  SELECT *, left(role, 1) AS initial, body = '' AS blank,
         body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS duplicate,
         body <> '' AND right(body, 1) NOT IN ('.', '!', '?') AS short,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
         role || ':' || text || E'\n' AS line
  FROM ordered),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, {{'k': '0000000000', 't': ''}} AS q0, CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR)) AS q1,
         {{'k': '0000000005I', 't': {_USER}}} AS q2, {{'k': '0000000010II', 't': {_USER} || {_ASSISTANT}}} AS q3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, pos, q0, q1, best_u AS q2, least(best_a, {_then("best_u", "5", "I", _ASSISTANT)}) AS q3
  FROM (
    SELECT *, least(q2, {_then("q0", "5", "I", _USER)}, {_then("q1", "5", "I", _USER)}, {_then("q3", "5", "I", _USER)}) AS best_u, q3 AS best_a
    FROM (
      SELECT conv_id, pos, {_then("q0", "2", "D")} AS q0,
        least({_then("q1", "2", "D")}, CASE WHEN stays AND initial = 's' THEN {_then("q0", "late", "K", "line")} END) AS q1,
        least({_then("q2", "2", "D")}, CASE WHEN stays AND initial = 'u' THEN {_then("open", "late", "K", "line")}
              WHEN stays THEN {_then("open", "late + 1", "R", "'user:' || text || E'\n'")} END) AS q2,
        least({_then("q3", "2", "D")}, CASE WHEN stays AND initial = 'a' THEN {_then("q2", "late", "K", "line")}
              WHEN stays THEN {_then("q2", "late + 1", "R", "'assistant:' || text || E'\n'")} END) AS q3
      FROM (
        SELECT s.conv_id, r.pos, q0, q1, q2, q3, least(q0, q1, q3) AS open, NOT (blank OR duplicate) AS stays,
               CASE WHEN short THEN 5 ELSE 0 END AS late, initial, line, text
        FROM steps s JOIN checked r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.pos = s.pos + 1)))),
ends AS (SELECT conv_id, least(q0, q3) AS best FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (short AND NOT duplicate) AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM checked GROUP BY conv_id)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(left(best.k, 10) AS BIGINT) AS cost,
       substr(best.k, 11) AS audit, sha256(left(best.t, greatest(length(best.t) - 1, 0))) AS repaired_sha256
FROM ends LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ends.conv_id"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{TERM}')"
RANKED = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ts FROM documents),
sizes AS (SELECT count(*) AS documents, CAST(sum(len(ts)) AS BIGINT) AS words FROM d WHERE len(ts) > 0),
held AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM d) GROUP BY 1, 2),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, sizes GROUP BY t, documents),
impacts AS (
  SELECT rid, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(ts) * documents) // words))) AS impact
  FROM held JOIN weights USING (t) JOIN d USING (rid), sizes),
items AS (SELECT row_number() OVER () AS iid, item_id, unnest({_TERMS}) AS t FROM benchmark),
scores AS (SELECT iid, item_id, rid, CAST(sum(impact) AS BIGINT) AS score FROM items JOIN impacts USING (t) GROUP BY 1, 2, 3)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN d USING (rid) WHERE score > 0 QUALIFY rank <= 20"""

LLM_ORACLE = {
    "op3_quality_cascade": QUALITY,
    "op8_overlap_join": OVERLAP,
    "op9_fair_mix": MIX,
    "op12_branch_and_bound_repair": REPAIR,
    "op13_k2_treap_search": RANKED,
}

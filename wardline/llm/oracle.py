"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

from . import chat

_WORD = r"[^\x20\x09-\x0D]+"

# crc32 of the UTF-8 bytes of a string, as SQL over the table of 256 remainders `t.crc`
_CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_concat([4294967295], list_transform(range(strlen({text})),
      lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1])), 4294967295)"""


STRUCTURE = rf"""
WITH RECURSIVE t AS ({_CRC_TABLE}),
messages AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS hit
  FROM conversations, t),
damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM messages WHERE hit <> 0),
placed AS (
  SELECT *, row_number() OVER w AS pos, lag(left(role, 1)) OVER w AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy)),
rows_ AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b' WHEN nth > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 't' ELSE '.' END AS fault
  FROM placed),
inserts(s, k, s2) AS (VALUES (0,0,0),(0,1,2),(0,2,3),(1,0,1),(1,1,2),(1,2,3),(2,0,2),(2,1,3),(2,2,2),(3,0,3),(3,1,2),(3,2,3)),
steps(s, initial, s2) AS (VALUES (0,'s',1),(0,'u',2),(1,'u',2),(2,'a',3),(3,'u',2)),
edits AS (
  SELECT i.s, repeat('I', i.k) || 'K' AS edit, 5 * i.k AS cost, p.initial, p.s2 FROM inserts i JOIN steps p ON i.s2 = p.s
  UNION ALL
  SELECT i.s, repeat('I', i.k) || 'R', 5 * i.k + 1, NULL, p.s2 FROM inserts i JOIN steps p ON i.s2 = p.s WHERE p.initial <> 's'),
ways(conv_id, pos, state, best) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {{'c': CAST(0 AS BIGINT), 'a': ''}} FROM rows_
  UNION ALL
  SELECT conv_id, pos, state, min(best) FROM (
    SELECT r.conv_id, r.pos, e.s2 AS state,
           {{'c': w.best.c + e.cost + CASE WHEN r.fault = 't' THEN 5 ELSE 0 END, 'a': w.best.a || e.edit}} AS best
    FROM ways w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1
    JOIN edits e ON e.s = w.state AND coalesce(e.initial, r.initial) = r.initial
    WHERE r.fault NOT IN ('b', 'd')
    UNION ALL
    SELECT r.conv_id, r.pos, w.state, {{'c': w.best.c + 2, 'a': w.best.a || 'D'}}
    FROM ways w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1) GROUP BY conv_id, pos, state),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
         count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id),
solved AS (
  SELECT c.conv_id, min({{'c': w.best.c + CASE w.state WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
                         'a': w.best.a || CASE w.state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}}) AS best
  FROM counts c JOIN ways w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.pos GROUP BY c.conv_id),
marks AS (
  SELECT conv_id, i, substr(best.a, i, 1) AS edit, i - length(replace(left(best.a, i), 'I', '')) AS ins,
         length(replace(left(best.a, i), 'D', '')) AS place
  FROM (SELECT conv_id, best, unnest(range(1, length(best.a) + 1)) AS i FROM solved)),
kept AS (
  SELECT m.conv_id, place, edit, CASE WHEN edit = 'I' THEN '' ELSE r.text END AS text, r.role,
         first_value(CASE WHEN edit = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id ORDER BY place) AS shift
  FROM marks m LEFT JOIN rows_ r ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND m.i - m.ins = r.pos AND edit <> 'I'
  WHERE edit <> 'D'),
texts AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - 1 - shift) % 2 = 0 THEN 'user' ELSE 'assistant' END
                                    || ':' || text, chr(10) ORDER BY place)) AS h
  FROM kept GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s.best.c, 0) AS cost,
       coalesce(s.best.a, '') AS audit, coalesce(x.h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN solved s ON a.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN texts x ON a.conv_id IS NOT DISTINCT FROM x.conv_id
"""

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i
  FROM (SELECT r, regexp_extract_all(text, '{_WORD}') AS ws FROM d)),
grams AS (
  SELECT r, i, w, lead(w, 4) OVER (PARTITION BY r ORDER BY i) AS w4,
         lead(w, 1) OVER (PARTITION BY r ORDER BY i) AS w1, lead(w, 2) OVER (PARTITION BY r ORDER BY i) AS w2,
         lead(w, 3) OVER (PARTITION BY r ORDER BY i) AS w3 FROM w),
repeated AS (
  SELECT r, i FROM grams WHERE w4 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, w, w1, w2, w3, w4) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY r),
lines AS (
  SELECT r, source, line, regexp_extract_all(line, '{_WORD}') AS ws
  FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM d)),
worded AS (SELECT r, source, line, len(ws) AS n, lower(array_to_string(ws, ' ')) AS norm FROM lines WHERE len(ws) > 0),
frequent AS (SELECT source, norm FROM worded GROUP BY source, norm HAVING count(DISTINCT r) > 100),
lost AS (
  SELECT r, sum(n) AS words, count(*) AS gone FROM worded JOIN frequent
  ON worded.norm = frequent.norm AND worded.source IS NOT DISTINCT FROM frequent.source GROUP BY r),
counted AS (
  SELECT d.doc_id,
         coalesce((SELECT count(*) FROM w WHERE w.r = d.r), 0) AS n_words,
         CAST(coalesce((SELECT sum(length(w)) FROM w WHERE w.r = d.r), 0) AS BIGINT) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce((SELECT count(*) - count(DISTINCT line) FROM worded WHERE worded.r = d.r), 0) AS n_dup_lines,
         coalesce((SELECT n FROM covered WHERE covered.r = d.r), 0) AS n_repeat_words,
         CAST(coalesce((SELECT words FROM lost WHERE lost.r = d.r), 0) AS BIGINT) AS n_removed_words,
         coalesce((SELECT gone FROM lost WHERE lost.r = d.r), 0) AS n_removed_lines
  FROM d)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND n_words - n_removed_words >= 10 AND 2 * (n_words - n_removed_words) >= n_words AS kept
FROM counted
"""

SUBSTRINGS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
windows AS (
  SELECT r, doc_id, i, array_to_string(list_slice(ws, i + 1, i + 50), ' ') AS win
  FROM (SELECT r, doc_id, ws, unnest(range(len(ws) - 49)) AS i FROM d WHERE len(ws) >= 50)),
hits AS (SELECT r, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY win) < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM hits),
words AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
marked AS (SELECT words.r, i, w, gone.p IS NOT NULL AS removed FROM words LEFT JOIN gone ON words.r = gone.r AND words.i = gone.p),
kept AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
         string_agg(w, ' ' ORDER BY i) FILTER (WHERE NOT removed) AS t FROM marked GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.r = kept.r
"""

def _shingles(ws: str) -> str:
    """Five-word shingles of a list of words; of fewer words, all as one."""
    return (f"CASE WHEN len({ws}) >= 5 THEN list_transform(range(len({ws}) - 4), lambda i: array_to_string({ws}[i + 1:i + 5], ' ')) "
            f"WHEN len({ws}) > 0 THEN [chr(1) || array_to_string({ws}, ' ')] ELSE [] END")


# Every window of an item's size that shares a shingle with it, by brute force.
DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') AS ws FROM documents),
b AS (SELECT row_number() OVER () AS it, item_id, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') AS ws FROM benchmark),
ds AS (
  SELECT r, doc_id, len(hs) AS len, unnest(hs) AS h, unnest(range(len(hs))) AS p
  FROM (SELECT r, doc_id, {_shingles('ws')} AS hs FROM d)),
bs AS (
  SELECT it, item_id, n, h, count(*) AS tf
  FROM (SELECT it, item_id, len(hs) AS n, unnest(hs) AS h FROM (SELECT it, item_id, {_shingles('ws')} AS hs FROM b))
  GROUP BY ALL),
spread AS (
  SELECT r, doc_id, len, it, item_id, n, h, tf,
         unnest(range(least(greatest(p - n + 1, 0), greatest(len - n, 0)), least(p, greatest(len - n, 0)) + 1)) AS s
  FROM ds JOIN bs USING (h)),
shared AS (SELECT r, doc_id, len, it, item_id, n, s, least(count(*), tf) AS c FROM spread GROUP BY r, doc_id, len, it, item_id, n, s, h, tf),
scored AS (
  SELECT doc_id, item_id, n, s, CAST(sum(c) AS BIGINT) AS c, least(n, len) + n AS total
  FROM shared GROUP BY r, doc_id, len, it, item_id, n, s)
SELECT doc_id, item_id, s AS start, n + 4 AS n_words, c / (total - c) AS similarity
FROM scored WHERE c / (total - c) >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY c / (total - c) DESC, s, n) = 1
"""

# Bytes as hexadecimal text, two characters each.
BYTE_STRINGS = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS win
  FROM (SELECT r, doc_id, h, unnest(range(length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
hits AS (SELECT r, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY win) < doc_id),
steps AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50, TRUE) AS new FROM hits),
runs AS (
  SELECT r, min(i) AS a, max(i) + 50 AS e
  FROM (SELECT r, i, sum(CAST(new AS INT)) OVER (PARTITION BY r ORDER BY i) AS run FROM steps) GROUP BY r, run),
pieces AS (
  SELECT d.r, runs.a, substr(h, 2 * coalesce(lag(e) OVER (PARTITION BY d.r ORDER BY a), 0) + 1,
                             2 * (a - coalesce(lag(e) OVER (PARTITION BY d.r ORDER BY a), 0))) AS piece
  FROM runs JOIN d ON runs.r = d.r),
totals AS (SELECT r, sum(e - a) AS n_removed, count(*) AS n_spans, max(e) AS e FROM runs GROUP BY r),
kept AS (SELECT r, string_agg(piece, '' ORDER BY a) AS t FROM pieces GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(t, '') || substr(h, 2 * coalesce(e, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN totals ON d.r = totals.r LEFT JOIN kept ON d.r = kept.r
"""

SPELLING = rf"""
WITH RECURSIVE t AS ({_CRC_TABLE}),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS name, run, count(*) AS n FROM runs WHERE length(run) > 5 GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32("name")} AS h FROM counted, t),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, n, count(*) AS n_near, min({{'n': -other_n, 'w': other}}) AS b FROM near GROUP BY word, n),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= 5 * w.n THEN b.w END AS form,
         CASE WHEN -b.n >= 5 * w.n THEN -b.n END AS form_n
  FROM words w LEFT JOIN best ON w.word = best.word),
chain(word, root) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word AND f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN chain c ON f.word = c.word
WHERE root IN (SELECT word FROM forms WHERE form IS NULL)
"""

MIXING = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
fill(level, n) AS (
  SELECT sum(s) / sum(w), CAST(0 AS BIGINT) FROM sources
  UNION
  SELECT coalesce((SELECT sum(s) FROM sources) - sum(3 * s) FILTER (WHERE level * w > 3 * s), (SELECT sum(s) FROM sources))
         / sum(w) FILTER (WHERE NOT level * w > 3 * s), count(*) FILTER (WHERE level * w > 3 * s)
  FROM fill, sources GROUP BY level),
goals AS (
  SELECT source, s, least(level * w, CAST(3 * s AS DOUBLE)) AS target
  FROM sources, (SELECT max(level) AS level FROM fill)),
plans AS (SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS times FROM goals),
ordered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, r) AS pos FROM d),
picks(source, target, pos, spare, cap, done, took) AS (
  SELECT source, target, CAST(0 AS BIGINT), CAST(floor(target - times * s) AS BIGINT), CAST(floor(target - times * s) AS BIGINT), false, false FROM plans
  UNION ALL
  SELECT p.source, p.target, o.pos,
         CASE WHEN NOT p.done AND o.size <= p.spare THEN p.spare - o.size ELSE p.spare END,
         CASE WHEN o.size > p.spare AND (o.size <= p.cap OR p.pos < 0) THEN p.spare ELSE p.cap END,
         p.done OR (o.size > p.spare AND o.size <= p.cap AND p.spare <= 0.001 * p.target),
         NOT p.done AND o.size <= p.spare
  FROM picks p JOIN ordered o ON o.source IS NOT DISTINCT FROM p.source AND o.pos = p.pos + 1)
SELECT doc_id, size, s AS source_size, plans.target, size * (times + CASE WHEN took THEN 1 ELSE 0 END) AS taken
FROM ordered o JOIN plans ON o.source IS NOT DISTINCT FROM plans.source
JOIN picks p ON o.source IS NOT DISTINCT FROM p.source AND o.pos = p.pos
"""

ORACLE = {
    "op2_chat_formatting": chat.ORACLE_SQL,
    "op3_decontamination": DECONTAMINATION,
    "op4_suffix_array_dedup": BYTE_STRINGS,
    "op5_quality_rules": QUALITY,
    "op7_substring_dedup": SUBSTRINGS,
    "op11_structure_repair": STRUCTURE,
    "op12_spelling_variants": SPELLING,
    "op13_source_mixing": MIXING,
}

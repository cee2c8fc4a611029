"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str) -> str:
    low = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({low}, '{pattern}')"


_ALNUM = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPACED = _words(r"[^\x20\x09-\x0D]+")

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_ALNUM} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, w[s : s + least(13, len(w)) - 1] AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT rid, s, w[s : s + n - 1] AS g
  FROM (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes)
),
hits AS (SELECT rid, s, n, item FROM runs JOIN windows USING (g)),
places AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hits) GROUP BY rid
),
items AS (
  SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hits GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN items USING (rid)
"""


def _escaped(column: str) -> str:
    return rf"replace(replace({column}, '\', '\\'), '<|', '<\|')"


# A block has 12 + 1 + 11 characters beside its role and texts, a mark between two of its texts 10.
CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
placed AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) = role, false) AS same
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_escaped("text")}) + CASE WHEN same THEN 10
    ELSE 24 + length(replace({_escaped("role")}, chr(10), '<\\n')) END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

COMPONENTS = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_SPACED} AS w FROM documents),
shingles AS (
  SELECT DISTINCT rid, s FROM (
    SELECT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
      ELSE list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4]) END) AS s FROM d
  )
),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
common AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT rid, rid AS other FROM d
  UNION SELECT r.rid, l.b FROM reached r JOIN both_ways l ON r.other = l.a
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM reached r JOIN d ON d.rid = r.rid JOIN d o ON o.rid = r.other LEFT JOIN sizes ON sizes.rid = r.rid
GROUP BY r.rid, d.doc_id
"""

FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
f AS (
  SELECT doc_id, part, concat(
    CASE WHEN len(w) < 100 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails
  FROM d
),
m AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails
),
names AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM names a, names b, names c, names d, names e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (SELECT o, s, o[s] AS x, o[1 : s - 1] AS before FROM orders, range(1, 6) r(s)),
counted AS (
  SELECT o, s, x, m.*, contains(fails, x) AS here, translate(fails, before, '') = fails AS reached
  FROM steps, m
)
SELECT part, o AS filter_order, s::INT AS step,
  coalesce(sum(n) FILTER (reached AND NOT here), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (reached AND here), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (here AND NOT reached), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (fails = x), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (reached AND here), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (reached AND here), 0)::BIGINT AS toxic_lost,
  (sum(coalesce(sum(n) FILTER (reached AND here), 0)) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM counted GROUP BY part, o, s, x
"""

EXACT_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
),
k AS (
  SELECT doc_id, body, count(*) OVER (PARTITION BY body) AS n,
    first_value(doc_id) OVER same AS keep_id, row_number() OVER same AS place
  FROM d WINDOW same AS (PARTITION BY body ORDER BY length(t) DESC, doc_id NULLS LAST, rid)
)
SELECT doc_id, keep_id, n AS group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM k
"""

"""DuckDB SQL for the operators that SQL can express, written independently of them."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


OP1 = """
WITH r AS (
  SELECT coalesce(page_id, -1) AS page_id, printf('%08d.warc', CAST(floor(coalesce(page_id, -1) / 1000) AS BIGINT)) AS archive,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id, -1) || '>'
         || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
         || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS payload
  FROM pages),
i AS (SELECT archive, payload, CAST(strlen(payload) AS BIGINT) AS n, sha256(payload) AS d,
             CAST(coalesce(sum(strlen(payload)) OVER (PARTITION BY archive ORDER BY page_id, sha256(payload) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS o FROM r)
SELECT archive, o AS "offset", 'changed' AS status, n AS n_bytes, d AS digest, n AS their_bytes, sha256(left(payload, length(payload) - 1) || 'X') AS their_digest FROM i WHERE d LIKE '00%'
UNION ALL SELECT archive, o, 'missing', n, d, NULL, NULL FROM i WHERE d LIKE '01%'
UNION ALL SELECT archive, o + 1, 'extra', NULL, NULL, n, d FROM i WHERE d LIKE '02%'
"""

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words('text')} AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words('text')} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item, 10 AS m, array_to_string(ws[i:i + 9], ' ') AS w
  FROM (SELECT item, ws, unnest(range(1, len(ws) - 8)) AS i FROM b WHERE len(ws) >= 10)
  UNION
  SELECT DISTINCT item, len(ws) AS m, array_to_string(ws, ' ') AS w FROM b WHERE len(ws) BETWEEN 1 AND 9),
grams AS (
  SELECT rid, i, m, array_to_string(ws[i:i + m - 1], ' ') AS w
  FROM (SELECT rid, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM windows) WHERE len(ws) >= m)),
hit AS (SELECT g.rid, g.i, g.m, x.item FROM grams g JOIN windows x ON g.m = x.m AND g.w = x.w),
places AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN places p USING (rid) LEFT JOIN items t USING (rid)
"""

# The pages' articles hold only h1, p, b and br, and the character references below.
OP5 = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages),
b AS (
  SELECT page_id, url, list_transform(string_split_regex(body, '</?(p|h1)>'), lambda x:
           trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&amp;?', '&amp;', 'g'),
             '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) AS blocks FROM a)
SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)) AS text,
       CAST(length(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10))) AS BIGINT) AS n_chars
FROM b
"""

OP7 = """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS rid, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
windows AS (
  SELECT rid, i, m, array_to_string(ls[i:i + m - 1], chr(10)) AS w
  FROM (SELECT rid, ls, m, unnest(range(1, len(ls) - m + 2)) AS i FROM d, (VALUES (1), (2), (3)) t(m) WHERE len(ls) >= m)
  WHERE m = 3 OR strlen(array_to_string(ls[i:i + m - 1], '')) >= 200),
later AS (SELECT rid, i, m FROM (SELECT rid, i, m, row_number() OVER (PARTITION BY m, w ORDER BY rid, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + m)) AS p FROM later),
lines AS (SELECT rid, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM d WHERE text IS NOT NULL),
left_over AS (
  SELECT l.rid, string_agg(l.line, chr(10) ORDER BY l.p) AS text FROM lines l ANTI JOIN gone g ON l.rid = g.rid AND l.p = g.p GROUP BY l.rid),
counts AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT d.doc_id, CAST(coalesce(len(d.ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_deleted,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(x.text, '') END AS text
FROM d LEFT JOIN counts c USING (rid) LEFT JOIN left_over x USING (rid)
"""

# Windows of every position and length; the parts' counts by joins.
OP11 = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
spots AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
f AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM spots, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(ws))
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, k, f AS a FROM f WHERE k >= 2),
inner_parts AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, ws, k, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k) GROUP BY 1, 2),
kept AS (SELECT c.* FROM c LEFT JOIN inner_parts x USING (lang, phrase) WHERE x.longer IS NULL OR 100 * x.longer < 100 * c.a),
cuts AS (SELECT lang, phrase, a, ws, k, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT u.lang, u.phrase, u.a, l.f AS l, r.f AS r, n.n, u.cut,
         CAST((1000::HUGEINT * u.a * n.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts u JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(u.ws[1:u.cut], ' ')
  JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(u.ws[u.cut + 1:], ' ') JOIN n ON n.lang = u.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

# Each document's failures as one pattern; every order and step reads the patterns.
OP13 = """
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
m AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
firsts AS (SELECT t, min(doc_id) AS first FROM w GROUP BY t),
d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN w.doc_id > f.first THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN m USING (doc_id) JOIN firsts f USING (t)),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS x, filter_order[1:step - 1] AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
pat AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS b FROM d GROUP BY ALL),
r AS (
  SELECT part, filter_order, step, x,
         sum(n) FILTER (length(translate(fails, before || x, '')) = length(fails)) AS kept,
         sum(n) FILTER (contains(fails, x) AND length(translate(fails, before, '')) = length(fails)) AS removed,
         sum(n) FILTER (contains(fails, x) AND length(translate(fails, before, '')) < length(fails)) AS redundant,
         sum(n) FILTER (fails = x) AS unique_fails,
         sum(g) FILTER (contains(fails, x) AND length(translate(fails, before, '')) = length(fails)) AS good_lost,
         sum(b) FILTER (contains(fails, x) AND length(translate(fails, before, '')) = length(fails)) AS toxic_lost
  FROM pat, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""

ORACLE: dict[str, str] = {
    "op1_merkle_fixity": OP1, "op2_benchmark_decontamination": OP2, "op5_line_block": OP5, "op7_line_dedup": OP7,
    "op11_phrase_collocations": OP11, "op13_filter_audit": OP13,
}

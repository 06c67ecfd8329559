"""DuckDB SQL of the queries that SQL can express."""

ORACLES = {
    "op3_decontamination": r"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bp AS (
  SELECT item_id, w, least(10, len(w)) AS size,
         unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM bw WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS win FROM bp),
sizes AS (SELECT DISTINCT size FROM windows),
dp AS (
  SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM dw, sizes
  WHERE len(w) >= size),
hits AS (
  SELECT r, p, dp.size, item_id FROM dp JOIN windows
  ON windows.size = dp.size AND win = array_to_string(w[p:p + dp.size - 1], ' ')),
covered AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (
    SELECT r, unnest(range(p, p + size)) AS q FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (
    SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
""",
    "op7_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first_id IS NOT NULL AND (page_id IS NULL OR page_id > first_id)
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS NULL OR page_id > first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON f.d = p.d
""",
    "op5_suffix_dedup": """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
         octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (
  SELECT r, doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
least AS (SELECT s, min(doc_id) AS first_id FROM p GROUP BY s),
hit AS (SELECT r, i FROM p JOIN least USING (s) WHERE doc_id > first_id),
grown AS (
  SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS span FROM (
    SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh
    FROM hit)),
spans AS (SELECT r, span, min(i) AS a, max(i) + 50 AS b FROM grown GROUP BY r, span),
gaps AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT r, max(b), NULL FROM spans GROUP BY r),
kept AS (
  SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS h
  FROM gaps JOIN d USING (r) GROUP BY r),
counts AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN counts USING (r) LEFT JOIN kept USING (r)
""",
    "op13_level_audit": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
occurrences AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
terms AS (
  SELECT lang, term, count(*) AS n FROM occurrences GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
counts AS (
  SELECT o.lang, o.source, o.term, count(*) AS n
  FROM occurrences o JOIN terms t ON t.lang = o.lang AND t.term = o.term GROUP BY 1, 2, 3),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM terms GROUP BY lang),
group_sizes AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY 1, 2),
groups AS (
  SELECT d.lang, d.source, coalesce(g.total, 0::HUGEINT) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN group_sizes g USING (lang, source)),
shares AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.total + 2 * s.v) AS p,
         1 + 1000000000::HUGEINT * (t.n + 2) // (s.total + 2 * s.v) AS q
  FROM groups g JOIN terms t USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
priced AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source
  GROUP BY 1, 2, 3),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
""",
}

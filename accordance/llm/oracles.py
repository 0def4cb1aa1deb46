"""The queries that SQL can express, for DuckDB."""

URL = r"""
WITH judged AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), outcomes AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), parts AS (
  SELECT host, array_reverse(string_split(host, '.')) AS l, sum(coalesce(bad, 0))::DOUBLE AS k, count(bad)::DOUBLE AS n
  FROM judged LEFT JOIN outcomes USING (page_id) GROUP BY host
), hosts AS (
  SELECT host, k, n, array_to_string(array_reverse(l[1:CASE WHEN two THEN 3 ELSE 2 END]), '.') AS domain,
    array_to_string(array_reverse(l[1:CASE WHEN two THEN 2 ELSE 1 END]), '.') AS suffix
  FROM (SELECT *, coalesce(l[2] || '.' || l[1], '') IN ('ac.uk', 'co.jp', 'co.nz', 'co.uk', 'com.au', 'com.br', 'gov.uk', 'org.uk') AS two FROM parts)
), domains AS (SELECT domain, suffix, sum(k) AS k, sum(n) AS n FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(k) AS k, sum(n) AS n FROM domains GROUP BY ALL),
top AS (SELECT (coalesce(sum(k), 0) + 0.2) / (coalesce(sum(n), 0) + 2) AS m, coalesce(sum(n), 0) + 2 AS w FROM suffixes),
s1 AS (SELECT suffix, k, n, m, w FROM suffixes, top),
t1 AS (SELECT {strength} AS s FROM s1 WHERE n > 0),
r1 AS (SELECT suffix, (k + least(s, w) * m) / (n + least(s, w)) AS m, n + least(s, w) AS w FROM s1, t1),
s2 AS (SELECT domain, k, n, m, w FROM domains JOIN r1 USING (suffix)),
t2 AS (SELECT {strength} AS s FROM s2 WHERE n > 0),
r2 AS (SELECT domain, (k + least(s, w) * m) / (n + least(s, w)) AS m, n + least(s, w) AS w FROM s2, t2),
s3 AS (SELECT host, k, n, m, w FROM hosts JOIN r2 USING (domain)),
t3 AS (SELECT {strength} AS s FROM s3 WHERE n > 0),
r3 AS (SELECT host, (k + least(s, w) * m) / (n + least(s, w)) AS p, n + least(s, w) AS w FROM s3, t3),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM judged
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN p - 1.645 * sqrt(p * (1 - p) / (w + 1)) > m THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN r3 USING (host), (SELECT m FROM top)
""".replace(
    "{strength}",
    """CASE WHEN count(*) > 1 AND sum(n) * sum(n) > sum(n * n) AND sum(n * pow(k / n - m, 2)) > sum(m * (1 - m))
      THEN greatest(2, least(200, sum(n * m * (1 - m)) / sum(n)
        / ((sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n) - sum(n * n) / sum(n))) - 1)) ELSE 200 END""",
)

WINDOWS = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS t, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)
), dw AS (
  SELECT r, s, t, array_to_string(w[s:s + t - 1], ' ') AS win
  FROM (SELECT r, w, t, unnest(range(1, len(w) - t + 2)) AS s FROM d, (SELECT DISTINCT t FROM iw) WHERE len(w) >= t)
), hit AS (SELECT r, s, t, item_id FROM dw JOIN iw USING (t, win)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + t)) AS p FROM hit) GROUP BY r),
g AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN g USING (r)
"""

ARCHIVES = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
    row_number() OVER (PARTITION BY html ORDER BY page_id) AS place, min(page_id) OVER (PARTITION BY html) AS first
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN place > 1 AND payload_bytes >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN place > 1 AND payload_bytes >= 100 THEN first END AS refers_to
FROM p
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT a, c AS p, score AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5
)
SELECT a AS anchor_id, p AS positive_id,
  CAST(row_number() OVER (PARTITION BY a, p ORDER BY score DESC, c) AS INTEGER) AS rank,
  c AS negative_id, ps AS positive_score, score AS negative_score
FROM p JOIN s USING (a) WHERE NOT same AND 30 * ps <= 100 * score AND 100 * score <= 90 * ps
QUALIFY row_number() OVER (PARTITION BY a, p ORDER BY score DESC, c) <= 10
"""

REPEATS = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
), w AS (
  SELECT r, s, md5(b[s:s + 399]) AS h
  FROM (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS s FROM d WHERE octet_length(b) >= 400)
), hit AS (
  SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1
), island AS (
  SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS k
  FROM (SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 400 THEN 0 ELSE 1 END AS fresh FROM hit)
), span AS (SELECT r, min(s) AS a, max(s) + 400 AS z FROM island GROUP BY r, k),
gap AS (
  SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1) AS a, a AS z FROM span
  UNION ALL SELECT r, max(z), NULL FROM span GROUP BY r
), kept AS (
  SELECT r, sha256(unhex(string_agg(hex(CASE WHEN z IS NULL THEN b[g.a:] ELSE b[g.a:z - 1] END), '' ORDER BY g.a))) AS h
  FROM gap g JOIN d USING (r) GROUP BY r
), sums AS (SELECT r, sum(z - a) AS n, count(*) AS k FROM span GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(k, 0) AS n_spans,
  coalesce(kept.h, sha256(b)) AS kept_sha256
FROM d LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)
"""

_CAPITALS = "".join(chr(c) for c in [*range(65, 91), *range(0xC0, 0xDF)] if c != 0xD7)
_SMALL = "".join(chr(ord(c) + 32) for c in _CAPITALS)

CLASSES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_CAPITALS}', '{_SMALL}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), n AS (
  SELECT row_number() OVER () AS id, w, min(doc_id) AS first, count(*) AS n_copies FROM d WHERE len(w) > 0 GROUP BY w
), sh AS (
  SELECT DISTINCT id, array_to_string(w[s:s + 4], ' ') AS x
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM n)
), size AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
common AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM sh a JOIN sh b ON a.x = b.x AND a.id < b.id GROUP BY ALL),
pair AS (
  SELECT a, b FROM common JOIN size p ON p.id = a JOIN size q ON q.id = b WHERE 10 * k >= 8 * (p.n + q.n - k)
), link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach AS (SELECT id, id AS other FROM n UNION SELECT reach.id, link.b FROM reach JOIN link ON link.a = reach.other),
class AS (SELECT reach.id, min(n.first) AS class_id FROM reach JOIN n ON n.id = reach.other GROUP BY reach.id),
degree AS (SELECT a AS id, count(*) AS n_links FROM link GROUP BY a)
SELECT doc_id, CASE WHEN n.id IS NULL THEN doc_id ELSE class_id END AS class_id,
  coalesce(n_links, 0) AS n_links, coalesce(n_copies, 1) AS n_copies
FROM d LEFT JOIN n ON n.w = d.w LEFT JOIN class USING (id) LEFT JOIN degree USING (id)
"""

ORACLES = {
    "op4_url_reputation": URL,
    "op5_winnowing": WINDOWS,
    "op7_arc_to_warc": ARCHIVES,
    "op9_lsh_forest": CLASSES,
    "op10_pivot_topk": TOP_K,
    "op11_hard_negatives": NEGATIVES,
    "op13_suffix_dedup": REPEATS,
}

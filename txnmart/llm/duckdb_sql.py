"""SQL equivalents of the queries that SQL can express, for comparison in another engine."""

OP1 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP7 = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(verdict, rule, host, path) AS (VALUES
  ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
  ('block', 'com/de/', 'com', '/de/')),
fitting AS (
  SELECT page_id, rule, rules.verdict FROM parts, rules
  WHERE (parts.host = rules.host OR parts.host LIKE '%.' || rules.host) AND starts_with(parts.path, rules.path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN regexp_matches(p.host || p.path,
  '(?i)(^|[^0-9a-z])(casino|poker|betting|pills|viagra|spam|warez|torrent|xxx|porn|escort|phishing)($|[^0-9a-z])')
  THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN fitting f USING (page_id)
"""

OP10 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS r
  FROM sized GROUP BY source),
levels(level, step) AS (
  SELECT 0.0::DOUBLE, 0
  UNION ALL
  SELECT (1.5 * (SELECT sum(source_size) FROM sources)
      - coalesce((SELECT sum(2 * source_size) FROM sources WHERE 2 * source_size < level * weight), 0))::DOUBLE
    / (SELECT sum(weight) FROM sources WHERE NOT 2 * source_size < level * weight)::DOUBLE, step + 1
  FROM levels WHERE step < 30),
targets AS (
  SELECT *, least((SELECT max(level) FROM levels) * weight, 2.0 * source_size)::DOUBLE AS target FROM sources),
queued AS (
  SELECT doc_id, size, source_size, target, r, k,
    coalesce(sum(size) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
turns AS (
  SELECT *, CASE WHEN target > 0 THEN ((turn * source_size + ahead)::DOUBLE + 0.5 * size) / target ELSE 0.0 END AS t
  FROM queued, (VALUES (0), (1)) v(turn)),
sent AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY t, r, turn, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    row_number() OVER (ORDER BY t, r, turn, k) AS place FROM turns),
cut AS (
  SELECT coalesce(min(place), 9e18) AS place FROM sent
  WHERE before + 0.5 * size > (SELECT sum(target) FROM targets))
SELECT doc_id, size, source_size, target,
  (size * count(*) FILTER (sent.place < (SELECT cut.place FROM cut)))::BIGINT AS taken
FROM sent GROUP BY doc_id, size, source_size, target
"""

OP11 = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS a, b.id AS b, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INT) AS rank,
  s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
QUALIFY rank <= 10
"""

OP13 = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sized AS (SELECT doc_id, terms, len(terms) AS n FROM low),
whole AS (SELECT count(*) FILTER (n > 0) AS documents, CAST(sum(n) AS BIGINT) AS total FROM sized),
held AS (SELECT doc_id, n, unnest(terms) AS term FROM sized),
counted AS (SELECT doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, whole WHERE term IN (SELECT term FROM asked) GROUP BY term, documents),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // total)))) AS BIGINT) AS score
  FROM asked JOIN weighed USING (term) JOIN counted USING (term), whole GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

ORACLE = {"op1_exact_dedup": OP1, "op7_url_filter": OP7, "op10_mix_sources": OP10, "op11_hard_negatives": OP11, "op13_lexical_search": OP13}

"""DuckDB answers of the queries that SQL can express."""

MIXING = r"""
WITH measured AS (
  SELECT doc_id, source,
         length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS source_no
  FROM measured GROUP BY source),
weighted AS (
  SELECT *, CASE source_no % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM per),
levels AS (
  SELECT *,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - (sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source_no ROWS UNBOUNDED PRECEDING) - cap))
         / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source_no
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
goal AS (
  SELECT source, source_no, source_size,
         CASE WHEN cap::DOUBLE / weight <= level THEN cap::DOUBLE
              ELSE weight * max(CASE WHEN cap::DOUBLE / weight > level THEN level END) OVER () END AS target
  FROM levels),
placed AS (
  SELECT m.doc_id, m.size, m.h, g.source_no, g.source_size, g.target,
         ('0x' || substr(m.h, 1, 8))::BIGINT
           % greatest(1, ceil((SELECT sum(size) FROM measured) / 1000000.0)::BIGINT) AS shard
  FROM measured m JOIN goal g ON m.source IS NOT DISTINCT FROM g.source),
asking AS (
  SELECT source_no, source_size,
         CASE WHEN source_size > 0 THEN target * source_size::DOUBLE / source_size ELSE 0 END / 64 AS q
  FROM goal),
claims AS (
  SELECT source_no, row_number() OVER (ORDER BY q / (2 * k - 1) DESC, source_no, k) AS place
  FROM (SELECT *, unnest(range(1, greatest(2, floor(2 * source_size / 64.0)::BIGINT + 1))) AS k FROM asking) x
  WHERE k <= floor(2 * source_size / 64.0)),
given AS (
  SELECT source_no, count(*) AS blocks FROM claims
  WHERE place <= (SELECT round(sum(least(q, floor(2 * source_size / 64.0)))) FROM asking) GROUP BY source_no),
running AS (
  SELECT shard, source_no, source_size, sum(size)::BIGINT AS words,
         (sum(sum(size)) OVER (PARTITION BY source_no ORDER BY shard ROWS UNBOUNDED PRECEDING))::BIGINT AS upto
  FROM placed GROUP BY shard, source_no, source_size),
reached AS (
  SELECT r.shard, r.source_no, r.words,
         2 * upto + least(0, min(64 * floor(coalesce(blocks, 0) * (upto::DOUBLE / source_size) + 0.5)::BIGINT - 2 * upto)
                               OVER (PARTITION BY r.source_no ORDER BY shard ROWS UNBOUNDED PRECEDING)) AS reached
  FROM running r LEFT JOIN given g ON r.source_no = g.source_no WHERE source_size > 0),
handed AS (
  SELECT shard, source_no, words,
         (reached - lag(reached, 1, 0) OVER (PARTITION BY source_no ORDER BY shard))::BIGINT AS taking
  FROM reached),
passes AS (
  SELECT p.*, (sum(size) OVER (PARTITION BY p.shard, p.source_no ORDER BY h, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start,
         coalesce(h2.words, 0) AS words, coalesce(h2.taking, 0) AS taking,
         CASE WHEN h2.words > 0 THEN h2.taking // h2.words ELSE 0 END AS passes
  FROM placed p LEFT JOIN handed h2 ON p.shard = h2.shard AND p.source_no = h2.source_no)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (passes * size + greatest(0, least(start + size, taking - passes * words) - start))::BIGINT AS taken
FROM passes
"""

URL_FILTER = r"""
WITH split AS (
  SELECT page_id, url,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM split),
judged AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

ANSWERS = {"op3_source_mixing": MIXING, "op10_url_filter": URL_FILTER}

"""DuckDB SQL for the training-data queries that SQL can express."""

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST) AS k,
         count(*) OVER (PARTITION BY h) AS c
  FROM d)
SELECT doc_id, k AS keep_id, c AS group_size, doc_id IS NOT DISTINCT FROM k AS kept, h AS text_sha256 FROM r
"""

SOURCE_MIX = r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS nul, coalesce(source, '') AS src,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT nul, src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL),
w AS (
  SELECT *, list_value(5.0, 2.0, 1.0)[CAST((row_number() OVER (ORDER BY nul, src COLLATE "C") - 1) % 3 + 1 AS INT)]::DOUBLE AS weight
  FROM s),
o AS (  -- in the order in which sources reach their limit
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER before, 0))::DOUBLE
            / sum(weight) OVER (ORDER BY 2.0 * source_size / weight, nul, src
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW before AS (ORDER BY 2.0 * source_size / weight, nul, src
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT nul, src, source_size, least(2.0 * source_size, weight * coalesce(
           (SELECT max(level) FROM o), 0))::DOUBLE AS target
  FROM o),
k AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS r,
         row_number() OVER (PARTITION BY d.nul, d.src ORDER BY size, md5(coalesce(CAST(doc_id AS VARCHAR), '')),
                            doc_id) - 1 AS i,
         ('0x' || substr(md5('mix' || CAST(d.nul AS INT)::VARCHAR || d.src), 1, 6))::INT / 16777216.0::DOUBLE AS u
  FROM d JOIN t USING (nul, src))
SELECT doc_id, size, source_size, target,
       CAST(floor((i + 1) * r + u) - floor(i * r + u) AS BIGINT) * size AS taken
FROM k
"""

FILL_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
  FROM documents),
h AS (
  SELECT doc_id, t, n, ('0x' || substr(x, 1, 8))::BIGINT % (n + 1) AS p, ('0x' || substr(x, 9, 8))::BIGINT % (n + 1) AS q,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || substr(x, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(x, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT doc_id, t, n, form, substr(t, 1, least(p, q)) AS a, substr(t, least(p, q) + 1, abs(p - q)) AS m,
         substr(t, greatest(p, q) + 1) AS z, CASE WHEN form <> 'plain' THEN least(p, q) END AS prefix_chars,
         CASE WHEN form <> 'plain' THEN abs(p - q) END AS middle_chars
  FROM h)
SELECT doc_id, n, form, prefix_chars, middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
              ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""

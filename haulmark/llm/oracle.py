"""SQL counterparts of the operators that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op4_mix_sources"] = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM by_source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY 1.0 * source_size / weight, source NULLS LAST) AS place,
         sum(source_size) OVER ()::HUGEINT AS words
  FROM weighed),
rest AS (
  SELECT *, words - 3 * (sum(source_size) OVER (ORDER BY place) - source_size)::HUGEINT AS remaining,
         sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
           ::HUGEINT AS open_weight
  FROM ranked),
capped AS (
  SELECT *, 3 * source_size::HUGEINT * open_weight < remaining * weight AS is_full FROM rest),
level AS (
  SELECT min(words) - 3 * coalesce(sum(source_size) FILTER (WHERE is_full), 0)::HUGEINT AS remaining,
         sum(weight) FILTER (WHERE NOT is_full)::HUGEINT AS open_weight
  FROM capped),
shares AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN 3.0::DOUBLE * source_size
              ELSE (l.remaining * c.weight)::DOUBLE / l.open_weight::DOUBLE END AS target
  FROM capped c, level l),
placed AS (
  SELECT doc_id, z.source, size, source_size, target,
         row_number() OVER (PARTITION BY z.source ORDER BY size, doc_id)::DOUBLE AS place,
         CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0 END::DOUBLE AS rate,
         ('0x' || md5('mix-1:' || coalesce(z.source, chr(0) || 'null'))[1:8])::BIGINT::DOUBLE
           / 4294967296.0::DOUBLE AS start
  FROM sizes z JOIN shares s ON z.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 THEN (floor(place * rate + start) - floor((place - 1) * rate + start))
         ::BIGINT * size ELSE 0 END::BIGINT AS taken
FROM placed
"""

ORACLE["op5_shards"] = r"""
WITH RECURSIVE walk AS (
  SELECT doc_id, n.shards, 0::BIGINT AS at_shard,
         (4294967296 // (('0x' || md5(doc_id::VARCHAR || ':0')[1:8])::BIGINT + 1))::BIGINT AS next_shard
  FROM documents, (VALUES (8), (9)) AS n(shards)
  UNION ALL
  SELECT doc_id, shards, next_shard,
         ((next_shard + 1) * 4294967296
           // (('0x' || md5(doc_id::VARCHAR || ':' || next_shard)[1:8])::BIGINT + 1))::BIGINT
  FROM walk WHERE next_shard < shards),
dealt AS (
  SELECT doc_id, max(at_shard) FILTER (WHERE shards = 8)::INTEGER AS shard,
         max(at_shard) FILTER (WHERE shards = 9)::INTEGER AS grown_shard
  FROM walk GROUP BY doc_id),
crc_table AS (
  SELECT list(list_reduce([b] || range(8),
      lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) r(b)),
crcs AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         xor(list_reduce([4294967295::BIGINT] || list_transform(
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
               lambda h: ('0x' || h)::BIGINT),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM documents, crc_table)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM dealt JOIN crcs USING (doc_id)
"""

ORACLE["op9_top_k"] = r"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q, vectors c
  WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
           AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE["op13_ranked_search"] = r"""
WITH terms AS (
  SELECT doc_id, row_number() OVER () AS row_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents),
corpus AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(found))::BIGINT AS n_terms
  FROM terms WHERE len(found) > 0),
damped AS (
  SELECT doc_id, row_id, found,
         50 + (50 * len(found)::BIGINT * n_docs) // n_terms AS m
  FROM terms, corpus WHERE len(found) > 0),
counted AS (
  SELECT doc_id, row_id, m, term, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, row_id, m, unnest(found) AS term FROM damped)
  GROUP BY doc_id, row_id, m, term),
weighed AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, corpus GROUP BY term, n_docs),
asked AS (
  SELECT item_id, item, unnest(found) AS term
  FROM (SELECT item_id, row_number() OVER () AS item, list_distinct(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS found
        FROM benchmark)),
scored AS (
  SELECT item, item_id, row_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN counted USING (term)
  GROUP BY item, item_id, row_id, doc_id),
placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank,
         doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
"""

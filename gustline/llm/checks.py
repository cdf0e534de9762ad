"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

#: Base 32 of the SHA-1: its 160 bits in 32 groups of five.
WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS sha FROM p
), b AS (
  SELECT DISTINCT sha, array_to_string(list_transform(string_split(sha, ''),
    lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111',
                4 * (strpos('0123456789abcdef', c) - 1) + 1, 4)), '') AS bits FROM d
), e AS (
  SELECT sha, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
       + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT)::INT, 1)), '') AS payload_digest FROM b
), f AS (
  SELECT sha, payload_bytes, min(page_id) AS first FROM d GROUP BY ALL
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d JOIN e USING (sha) JOIN f USING (sha, payload_bytes)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

EXACT = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
), g AS (
  SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM d JOIN g USING (body)
"""

#: crc32 of the decimal id, from the 256 remainders of its bytes; turns are compared as whole lists.
TRIE = """
WITH t AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS crc
  FROM range(256) r(i)
), own AS (
  SELECT conv_id, list({r: coalesce(role, ''), t: coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, turns,
    (xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
      lambda c, b: xor(c // 256, crc[xor(c, b) % 256 + 1])), 4294967295) % 6)::BIGINT AS h
  FROM own, t
), p AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h], h.turns[h + 1:]) AS path FROM h LEFT JOIN own b ON b.conv_id = h.base
), e AS (
  SELECT conv_id, d, path[1:d] AS path FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM p)
), a AS (
  SELECT e.path, e.d AS depth, min(e.conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(e.conv_id::VARCHAR, ',' ORDER BY e.conv_id) FILTER (len(p.path) = e.d), '')) AS ends_sha256
  FROM e JOIN p USING (conv_id) GROUP BY ALL
), c AS (
  SELECT a.path, count(b.path) AS n_children FROM a LEFT JOIN a b ON b.depth = a.depth + 1 AND b.path[1:a.depth] = a.path GROUP BY a.path
), f AS (
  SELECT a.*, n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].t) END AS saved FROM a JOIN c USING (path)
), u AS (
  SELECT path[1:k] AS path, n_children, saved FROM (SELECT *, unnest(range(depth + 1)) AS k FROM f)
), s AS (
  SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM u GROUP BY path
)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM f JOIN s USING (path) LEFT JOIN f up ON f.depth > 0 AND up.path = f.path[1:f.depth - 1] AND up.depth = f.depth - 1
"""

SQL: dict[str, str] = {"op4_warc": WARC, "op8_top_k": TOP_K, "op12_exact_dedup": EXACT, "op13_prefix_trie": TRIE}

"""SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op4_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, strlen(html) AS payload_bytes,
         min(page_id) OVER (PARTITION BY payload_digest) AS first_id
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f
"""

ORACLE_SQL["op6_url_filters"] = r"""
WITH s AS (
  SELECT page_id, url, strpos(url, '://') AS mark FROM pages
), t AS (
  SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM s
), h AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(coalesce(rest, ''),
                        length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM t
), r AS (
  SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
    v(rule_verdict, rule_host, rule_path)
), j AS (
  SELECT page_id, host, path, rule_verdict, rule_host || rule_path AS rule,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS n
  FROM h LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host))
                     AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM j WHERE n = 1
"""

ORACLE_SQL["op9_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), good AS (
  SELECT vec_id, e FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT a AS node, a AS seen FROM links
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
), comp AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
), n AS (
  SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id = coalesce(component_id, vec_id) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN comp ON comp.node = vec_id
"""

ORACLE_SQL["op2_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_aggregate(words[i:i+4], 'string_agg', ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS i
        FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach AS (
  SELECT a AS node, a AS seen FROM links
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
), comp AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON node = w.doc_id
"""

ORACLE_SQL["op3_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, i, list_aggregate(words[i:i+12], 'string_agg', ' ') AS span
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS i FROM w)
), f AS (
  SELECT *, min(doc_id) OVER (PARTITION BY span) AS first_id FROM win
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(generate_series(0, 12)) AS i FROM f WHERE first_id < doc_id
), t AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS i FROM w
), k AS (
  SELECT t.doc_id, count(*) FILTER (gone.i IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY t.i) FILTER (gone.i IS NULL) AS kept
  FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY t.doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
"""

ORACLE_SQL["op11_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, max(place) AS n FROM t GROUP BY conv_id
), c AS (
  -- crc32 of the decimal id: each byte, then eight shifts (-1)
  SELECT a.conv_id, a.conv_id - a.conv_id % 5 AS base, coalesce(b.n, 0) AS base_n,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
               string_split(a.conv_id::VARCHAR, ''),
               lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda y, x: CASE WHEN x >= 0 THEN xor(y, x)
                               ELSE xor(y >> 1, 3988292384::BIGINT * (y & 1)) END),
             4294967295::BIGINT) % 9 AS h
  FROM ids a LEFT JOIN ids b ON b.conv_id = a.conv_id - a.conv_id % 5
), r AS (
  SELECT c.conv_id, t.place AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, c.base_n) + t.place - c.h, role, text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h
), p AS (
  SELECT conv_id, depth, strlen(text) AS bytes,
         string_agg(sha256(strlen(role) || ':' || role || text), '')
           OVER (PARTITION BY conv_id ORDER BY depth) AS node
  FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), n AS (
  SELECT node, any_value(depth) AS depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id,
         count(*) AS n_convs, CASE WHEN node <> '' THEN left(node, length(node) - 64) END AS parent
  FROM p GROUP BY node
), kids AS (
  SELECT parent, count(*) AS n_children FROM n GROUP BY parent
), sums AS (
  SELECT a.node, count(*) FILTER (kids.parent IS NULL) AS n_leaves,
         sum((n.n_convs - 1) * n.bytes) AS saved_tokens
  FROM n JOIN p a ON a.conv_id = n.conv_id AND a.depth <= n.depth
  LEFT JOIN kids ON kids.parent = n.node
  GROUP BY a.node
), ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, max_by(node, depth) AS node FROM p GROUP BY conv_id) GROUP BY node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n LEFT JOIN n up ON up.node = n.parent LEFT JOIN kids ON kids.parent = n.node
JOIN sums ON sums.node = n.node LEFT JOIN ends ON ends.node = n.node
"""

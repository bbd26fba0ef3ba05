"""DuckDB SQL for those operators of this subpackage that SQL can express."""

OP9_URL_FILTER = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
                       ELSE regexp_extract(substr(url, position('://' IN url) + 3), '^[^?#]*') END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN position('/' IN rest) = 0 THEN '' ELSE substr(rest, position('/' IN rest)) END AS path
  FROM cut)
SELECT page_id, host, path,
       CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
            WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
       CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'block'
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'allow'
            WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'allow'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'block' ELSE 'allow' END AS verdict
FROM parts
"""

OP7_SHINGLE_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM items x JOIN items y ON x.item = y.item AND x.doc_id <> y.doc_id AND x.n * 10 >= y.n * 9 AND y.n * 10 >= x.n * 9
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 90 * (min(x.n) + min(y.n) - count(*))),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT l.b, r.seen FROM reach r JOIN links l ON l.a = r.node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(seen) FROM reach WHERE node = doc_id) AS component_id FROM sets
"""

OP8_NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
reach AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT l.b, r.seen FROM reach r JOIN links l ON l.a = r.node)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, (SELECT min(seen) FROM reach WHERE node = vec_id) AS component_id,
       vec_id = (SELECT min(seen) FROM reach WHERE node = vec_id) AS kept
FROM embeddings
"""

ORACLES: dict[str, str] = {"op7_shingle_join": OP7_SHINGLE_JOIN, "op8_near_vectors": OP8_NEAR_VECTORS, "op9_url_filter": OP9_URL_FILTER}

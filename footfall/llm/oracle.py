"""What DuckDB must find for the queries that SQL can express on whole tables."""

ORACLE: dict[str, str] = {}

_SITES = "adult-x|casino-win|cheap-pills|free-bets|spam-farm"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op1_url_filter"] = rf"""
WITH parts AS (
  SELECT page_id, url,
    coalesce({_LOWER.format(r"regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
keyed AS (
  SELECT *, CASE WHEN host <> '' THEN
    regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') END AS k
  FROM parts),
listed AS (SELECT DISTINCT k FROM keyed WHERE regexp_matches(host, '(^|\.)({_SITES})\.')),
rules(kind, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
judged AS (
  SELECT page_id, url, host, path, k,
    (SELECT struct_pack(rule := rhost || rpath, verdict := kind) FROM rules
     WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
     ORDER BY length(rhost || rpath) DESC LIMIT 1) AS r
  FROM keyed)
SELECT page_id, host, path, r.rule AS rule,
  coalesce(r.verdict, CASE WHEN l.k IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  l.k IS NOT NULL AS listed
FROM judged j LEFT JOIN listed l ON j.k = l.k
"""

_WORDS = r"coalesce(regexp_extract_all({}, '[^\x20\x09-\x0D]+'), [])"

ORACLE["op2_substring_dedup"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS w FROM documents),
windows AS (
  SELECT r, s, array_to_string(w[s:s + 34], ' ') AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM docs WHERE len(w) >= 35)),
repeated AS (SELECT x FROM windows GROUP BY x HAVING count(*) > 1),
starts AS (SELECT r, list(s) AS l FROM windows JOIN repeated USING (x) GROUP BY r),
covered AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS i FROM (SELECT r, unnest(l) AS s FROM starts)),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs)
  ANTI JOIN covered USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

_LOWER_WORDS = _WORDS.format(_LOWER.format("text"))

ORACLE["op3_minhash_dedup"] = f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS sh
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0))),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (
  SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
least AS (SELECT x, min(least(x, y)) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(l.c, d.doc_id) AS component_id,
  d.doc_id = coalesce(l.c, d.doc_id) AS kept
FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.x = d.doc_id
"""

_TEST_WORDS = r"coalesce(regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
_TEST_LOWER = _TEST_WORDS.format(_LOWER.format("text"))

ORACLE["op7_decontamination"] = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_TEST_LOWER} AS w FROM documents),
items AS (SELECT item_id, {_TEST_LOWER} AS w FROM benchmark),
patterns AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)),
found AS MATERIALIZED (
  SELECT r, s, p.n, item_id
  FROM (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS x
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s
              FROM docs, (SELECT DISTINCT n FROM patterns) WHERE len(w) >= n)) d
  JOIN patterns p ON p.n = d.n AND p.x = d.x),
hits AS (SELECT r, count(DISTINCT i) AS n_hit
         FROM (SELECT r, unnest(range(s, s + n)) AS i FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

ORACLE["op5_embedding_dedup"] = """
WITH RECURSIVE usable AS MATERIALIZED (
  SELECT vec_id, label, list_transform(v, lambda x: x / norm) AS u
  FROM (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm
        FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
              WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))
  WHERE norm > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.u) = len(b.u)
  WHERE list_dot_product(a.u, b.u) >= 0.98),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(least(x, y)) AS c FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id,
  vec_id = coalesce(c, vec_id) AS kept
FROM embeddings LEFT JOIN counts ON counts.x = vec_id LEFT JOIN least ON least.x = vec_id
"""

ORACLE["op11_hard_negatives"] = """
WITH points AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS s
  FROM points a JOIN points b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY s DESC, id) AS k FROM scores WHERE same QUALIFY k <= 5),
negatives AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.s AS positive_score, n.s AS negative_score,
    p.k AS k, row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.s DESC, n.id) AS rank
  FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
  WHERE 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score,
  k::INTEGER AS positive_rank
FROM negatives WHERE rank <= 5
"""

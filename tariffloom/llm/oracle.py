"""SQL answers, written from the meaning of each result rather than as the Spark plan."""

URL_FILTER = r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT c.page_id, c.host, c.path, r.verdict, r.rule_host || r.rule_path AS rule,
    row_number() OVER (PARTITION BY c.page_id ORDER BY length(r.rule_host || r.rule_path) DESC, length(r.rule_host) DESC,
      r.verdict DESC) AS place
  FROM cut c LEFT JOIN rules r
    ON (c.host = r.rule_host OR suffix(c.host, '.' || r.rule_host)) AND prefix(c.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

DECONTAMINATION = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS size, array_to_string(words[i:i + 12], ' ') AS phrase
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM item WHERE len(words) > 0)
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), sizes AS (SELECT DISTINCT size FROM win
), place AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM doc, sizes WHERE len(words) >= size)
), hit AS (
  SELECT p.doc_id, w.item_id, p.i, p.size FROM place p JOIN win w ON p.phrase = w.phrase AND p.size = w.size
), word AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.words) AS contaminated
FROM doc d LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: CRC-32 of the bytes of a text, bit by bit.
CRC32 = """xor(list_reduce([4294967295::UBIGINT] || list_transform(regexp_extract_all(hex({0}::VARCHAR), '..'), lambda h: ('0x' || h)::UBIGINT),
    lambda a, b: list_reduce([xor(a, b)] || range(8)::UBIGINT[], lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)"""

IMPORTANCE = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), item AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), in_doc AS (
  SELECT doc_id, unnest(words) AS feature FROM doc
  UNION ALL SELECT doc_id, words[i] || ' ' || words[i + 1] FROM (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM doc)
), in_item AS (
  SELECT unnest(words) AS feature FROM item
  UNION ALL SELECT words[i] || ' ' || words[i + 1] FROM (SELECT words, unnest(range(1, len(words))) AS i FROM item)
), hashed AS (
  SELECT feature, ({CRC32.format('feature')} % 10000)::BIGINT AS bucket
  FROM (SELECT feature FROM in_doc UNION SELECT feature FROM in_item)
), s AS (SELECT bucket, count(*) AS n FROM in_doc JOIN hashed USING (feature) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS n FROM in_item JOIN hashed USING (feature) GROUP BY bucket
), gain AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM in_doc) + 10000)::DOUBLE
      / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM in_item) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)
), summed AS (
  SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM in_doc JOIN hashed USING (feature) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, len(d.words) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
    coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM doc d LEFT JOIN summed USING (doc_id)
), placed AS (
  SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_words >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END::BIGINT AS rank FROM placed
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages
), g AS (SELECT payload, max(page_id) AS kept FROM p WHERE strlen(payload) >= 1000 GROUP BY payload
)
SELECT page_id, strlen(p.payload)::BIGINT AS payload_bytes, sha1(p.payload) AS payload_digest,
  CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < kept THEN kept END AS refers_to
FROM p LEFT JOIN g ON p.payload = g.payload
"""

PREFIX_TRIE = f"""
WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
  FROM conversations
), conv AS (
  SELECT c, c - c % 100 AS base, ({CRC32.format('c')} % 6)::BIGINT AS h FROM (SELECT DISTINCT c FROM own)
), taken AS (
  SELECT conv.c, 0 AS part, own.pos, own.said FROM conv JOIN own ON own.c = conv.base AND own.pos <= conv.h
  UNION ALL SELECT conv.c, 1, own.pos, own.said FROM conv JOIN own ON own.c = conv.c AND own.pos > conv.h
), path AS (
  SELECT conv.c, coalesce(list(said ORDER BY part, pos) FILTER (WHERE said IS NOT NULL), []) AS turns FROM conv LEFT JOIN taken USING (c) GROUP BY conv.c
), member AS (SELECT c, len(turns) AS whole, d, turns[1:d] AS node FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM path)
), node AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE whole = d), '') AS ends,
    CASE WHEN d = 0 THEN 0 ELSE length(node[d].text) END AS size
  FROM member GROUP BY node, d
), related AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM node n LEFT JOIN node p ON p.d = n.d - 1 AND p.node = n.node[1:n.d - 1]
), childed AS (
  SELECT r.node, r.d, count(k.node) AS n_children FROM node r LEFT JOIN node k ON k.d = r.d + 1 AND k.node[1:r.d] = r.node GROUP BY r.node, r.d
), valued AS (SELECT related.*, n_children FROM related JOIN childed USING (node, d)
), above AS (SELECT node, d, n_convs, size, n_children, unnest(range(0, d + 1)) AS up FROM valued
), summed AS (
  SELECT node[1:up] AS node, up AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM above GROUP BY ALL
)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM valued JOIN summed USING (node, d)
"""

ORACLES = {
    "op1_url_filter": URL_FILTER, "op9_decontamination": DECONTAMINATION, "op11_importance": IMPORTANCE, "op12_warc": WARC,
    "op13_prefix_trie": PREFIX_TRIE,
}

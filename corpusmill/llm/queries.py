"""Registered queries of this package, one per operator, over whole tables."""

from __future__ import annotations

from corpusmill.llm import (
    compression,
    divergence,
    langid,
    mixing,
    ngram_join,
    order_minhash,
    packing,
    pitman_yor,
    prefix_trie,
    simhash,
    toxicity,
    warc,
    wrapper,
)

QUERIES = {
    "op1_wrapper": wrapper.op1_wrapper,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_order_minhash": order_minhash.op3_order_minhash,
    "op4_packing": packing.op4_packing,
    "op5_pitman_yor": pitman_yor.op5_pitman_yor,
    "op6_langid": langid.op6_langid,
    "op7_mixing": mixing.op7_mixing,
    "op8_compression": compression.op8_compression,
    "op9_simhash": simhash.op9_simhash,
    "op10_warc": warc.op10_warc,
    "op11_ngram_join": ngram_join.op11_ngram_join,
    "op12_divergence": divergence.op12_divergence,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

#: DuckDB SQL of the queries that SQL can express.
SQL = {
    "op7_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS rn FROM d GROUP BY source
), w AS (
  SELECT *, (CASE (rn - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS w, 2.0::DOUBLE * source_size AS most FROM s
), v AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY most / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT max(level) AS level FROM v WHERE level <= most / w
), g AS (
  SELECT source, source_size, CASE WHEN l.level IS NULL THEN most ELSE least(most, l.level * w) END AS target FROM w, l
), o AS (
  SELECT *, coalesce(sum(size) OVER (
    PARTITION BY source ORDER BY left(md5(concat_ws(':', doc_id::VARCHAR, size::VARCHAR) || ':11'), 15), concat_ws(':', doc_id::VARCHAR, size::VARCHAR)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, round(target) - before)) + greatest(0, least(size, round(target) - source_size - before)))::BIGINT AS taken
FROM o JOIN g ON o.source IS NOT DISTINCT FROM g.source
""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), t AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM t
""",
    "op11_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w
), g AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), l AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS u, doc_id AS v FROM s UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u
), c AS (
  SELECT u, min(v) AS component_id FROM r GROUP BY u
)
SELECT doc_id, len(s) AS n_shingles, component_id FROM s JOIN c ON c.u = s.doc_id
""",
    "op12_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT id, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), n AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT g.lang, g.source, v.v, coalesce(z.size, 0) AS size
  FROM (SELECT DISTINCT lang, source FROM d) g
  JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n)::BIGINT AS size FROM n GROUP BY ALL) z USING (lang, source)
), p AS (
  SELECT s.lang, s.source, k.term, coalesce(n.n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 2)) // (s.size + 2 * s.v))::BIGINT AS p
  FROM sizes s JOIN kept k USING (lang) LEFT JOIN n USING (lang, source, term)
), q AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(n) + 2)) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)))::BIGINT AS q
  FROM p GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER FROM terms
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op13_prefix_trie": """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda s, z: xor(s >> 1, CASE WHEN s % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)
), r AS (
  SELECT own.c, 0 AS part, pos, role, text FROM own JOIN t ON t.c = own.c - own.c % 5 AND pos < h
  UNION ALL
  SELECT own.c, 1, pos, role, text FROM own JOIN t ON t.c = own.c AND pos >= h
), l AS (
  SELECT c, list(md5(strlen(role)::VARCHAR || ':' || role || text) ORDER BY part, pos) AS turns, list(strlen(text) ORDER BY part, pos) AS sizes FROM r GROUP BY c
), a AS (
  SELECT own.c, coalesce(turns, []) AS turns, coalesce(sizes, []) AS sizes FROM own LEFT JOIN l USING (c)
), p AS (
  SELECT c, d, len(turns) AS n, md5(array_to_string(turns[1:d], '')) AS node,
    CASE WHEN d > 0 THEN md5(array_to_string(list_slice(turns, 1, greatest(d - 1, 0)), '')) END AS up, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM a)
), m AS (
  SELECT d, node, any_value(up) AS up, any_value(size) AS size, min(c) AS low, count(*) AS n_convs FROM p GROUP BY d, node
), k AS (
  SELECT d - 1 AS d, up AS node, count(*) AS n_children FROM m WHERE d > 0 GROUP BY ALL
), x AS (
  SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN k USING (d, node)
), b AS (
  SELECT p.d, p.node, sum((x.n_convs - 1) * x.size)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM x JOIN p ON p.c = x.low AND p.d <= x.d GROUP BY ALL
), e AS (
  SELECT d, node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM p WHERE d = n GROUP BY ALL
)
SELECT x.low AS conv_id, x.d::BIGINT AS depth, y.low AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM x JOIN b USING (d, node) LEFT JOIN e USING (d, node) LEFT JOIN m y ON y.d = x.d - 1 AND y.node = x.up
""",
}

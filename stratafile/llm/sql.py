"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), win AS (
  SELECT rid, i, array_to_string(ws[i:i+4], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), pos AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT rid, sum(CASE WHEN nxt IS NULL THEN 5 ELSE least(5, nxt - i) END) AS n FROM pos GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         length(regexp_replace(array_to_string(ws, ''), '[^A-Z]+', '', 'g')) AS n_upper
  FROM w LEFT JOIN rep USING (rid)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CAST(100 * n_symbols > 20 * n_words AS INT) AS s1, CAST(100 * n_dup_lines > 30 * n_lines AS INT) AS s2,
         CAST(word_chars < 3 * n_words OR word_chars > 15 * n_words AS INT) AS s3,
         CAST(100 * n_upper > 50 * word_chars AS INT) AS s4, CAST(100 * n_symbols > 40 * n_words AS INT) AS s5 FROM m
), h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(CAST(base_failed OR s1 + s2 + s3 + s4 > 0 AS INT))::DOUBLE AS f
  FROM f GROUP BY source
), p AS (
  SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) AS v FROM h
), k AS (
  SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 2.0), 1e4) ELSE 1e4 END AS strength FROM p
), bad AS (
  SELECT source, (f + m * strength) / (n + strength) > 0.5 AS distrusted FROM h, k
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND s1 + s2 + s3 + s4 + s5 < CASE WHEN distrusted THEN 1 ELSE 2 END AS kept
FROM f LEFT JOIN bad ON f.source IS NOT DISTINCT FROM bad.source
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, source, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM d GROUP BY source
), o AS (  -- by rising cap per weight: the sources that are capped come first
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS r FROM s
), l AS (
  SELECT *, (SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER before, 0) AS words,
         sum(weight) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM o WINDOW before AS (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cut AS (  -- the first source that its level doesn't lift over its cap sets the level
  SELECT words, share FROM l WHERE weight::DOUBLE * words::DOUBLE / share::DOUBLE <= (3 * source_size)::DOUBLE
  ORDER BY r LIMIT 1
), t AS (
  SELECT source, source_size, least(weight::DOUBLE * words::DOUBLE / share::DOUBLE, (3 * source_size)::DOUBLE) AS target
  FROM s, cut
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole FROM t
), x AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.whole, floor(b.target)::BIGINT - b.whole * b.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM x
"""

OP1 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i+4], ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach(doc_id, to_id) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.to_id
), c AS (
  SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

OP3 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i+19], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)
), later AS (
  SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed, ws, ps FROM d LEFT JOIN gone USING (doc_id)
), k AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t
  FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d) x
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(ps) AS p FROM gone) g WHERE g.doc_id = x.doc_id AND g.p = x.p)
  GROUP BY doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM kept LEFT JOIN k USING (doc_id)
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs
  FROM (SELECT rid, lang, source, unnest(ws) AS term FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3
), langs AS (
  SELECT lang, sum(n) AS size, count(*) AS v FROM kept GROUP BY lang
), g AS (
  SELECT x.lang, x.source, coalesce(sum(c.n) FILTER (k.term IS NOT NULL), 0) AS size
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN c ON c.lang = x.lang AND c.source = x.source
  LEFT JOIN kept k ON k.lang = c.lang AND k.term = c.term GROUP BY ALL
), f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.size + l.v)::HUGEINT)::BIGINT AS p,
         (1 + (1000000000::HUGEINT * (k.n + 1)) // (l.size + l.v)::HUGEINT)::BIGINT AS q
  FROM g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM f WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""

OP13 = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                        lambda x: unicode(x)::BIGINT) AS b FROM conversations
), k AS (  -- crc32, bit by bit
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda x, y: list_reduce(list_prepend(xor(x, y), range(8)),
             lambda z, i: CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384::BIGINT) ELSE z >> 1 END)), 4294967295::BIGINT) % 20 AS k FROM c
), r AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, left(role, 1) AS h FROM r
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE 'f' END AS fault,
         h || lead(h) OVER (PARTITION BY conv_id ORDER BY i) AS two FROM o
), n AS (
  SELECT conv_id, max(i) AS n FROM f GROUP BY conv_id
), w AS (  -- cost and letters from before row i to the end, for each state
  SELECT conv_id, n + 1 AS i, {'c': 0, 'a': ''} AS v0, {'c': 10, 'a': 'II'} AS v1, {'c': 5, 'a': 'I'} AS v2, {'c': 0, 'a': ''} AS v3 FROM n
  UNION ALL
  SELECT conv_id, i, list_sort([x0, {'c': y2.c + 5, 'a': 'I' || y2.a}])[1], list_sort([x1, {'c': y2.c + 5, 'a': 'I' || y2.a}])[1], y2, y3
  FROM (
    SELECT *, list_sort([x2, {'c': x3.c + 5, 'a': 'I' || x3.a}])[1] AS y2, list_sort([x3, {'c': x2.c + 5, 'a': 'I' || x2.a}])[1] AS y3
    FROM (
      SELECT f.conv_id, f.i,
        list_sort([{'c': v0.c + 2, 'a': 'D' || v0.a}, {'c': v2.c + 1 + e, 'a': 'R' || v2.a}, {'c': CASE h WHEN 's' THEN v1.c WHEN 'u' THEN v2.c ELSE 1000000 END + e, 'a': 'K' || CASE h WHEN 's' THEN v1.a ELSE v2.a END}])[1] AS x0,
        list_sort([{'c': v1.c + 2, 'a': 'D' || v1.a}, {'c': v2.c + 1 + e, 'a': 'R' || v2.a}, {'c': CASE h WHEN 'u' THEN v2.c ELSE 1000000 END + e, 'a': 'K' || v2.a}])[1] AS x1,
        list_sort([{'c': v2.c + 2, 'a': 'D' || v2.a}, {'c': v3.c + 1 + e, 'a': 'R' || v3.a}, {'c': CASE h WHEN 'a' THEN v3.c ELSE 1000000 END + e, 'a': 'K' || v3.a}])[1] AS x2,
        list_sort([{'c': v3.c + 2, 'a': 'D' || v3.a}, {'c': v2.c + 1 + e, 'a': 'R' || v2.a}, {'c': CASE h WHEN 'u' THEN v2.c ELSE 1000000 END + e, 'a': 'K' || v2.a}])[1] AS x3
      FROM w JOIN (SELECT *, CASE fault WHEN 'b' THEN 1000000 WHEN 'd' THEN 1000000 WHEN 't' THEN 5 ELSE 0 END AS e FROM f) f
        ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i - 1
    )
  )
), best AS (
  SELECT conv_id, v0.c AS cost, v0.a AS audit FROM w WHERE i = 1
), l AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS place FROM best WHERE audit <> ''
), m AS (
  SELECT *, sum((letter <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY place) AS i,
         sum((letter <> 'D')::INT) OVER (PARTITION BY conv_id ORDER BY place) AS out FROM l
), j AS (
  SELECT m.conv_id, m.out, letter, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text, f.role,
         max((out = 1 AND letter = 'K' AND f.h = 's')::INT) OVER (PARTITION BY m.conv_id) AS s
  FROM m LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.i = m.i WHERE letter <> 'D'
), t AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (out - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY out) AS t
  FROM j GROUP BY conv_id
), q AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum((fault = 'b')::INT) AS blank,
         sum((fault = 'd')::INT) AS duplicate, sum((fault = 't')::INT) AS truncated,
         sum((two IS NOT NULL AND two NOT IN ('su', 'ua', 'au'))::INT) AS illegal FROM f GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM a.conv_id
"""

ORACLES: dict[str, str] = {"op1_near_dups": OP1, "op3_top_k": OP3, "op5_substrings": OP5, "op6_quality_rules": OP6, "op8_mixing": OP8, "op12_divergence": OP12, "op13_conversations": OP13}

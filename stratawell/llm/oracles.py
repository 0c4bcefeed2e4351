"""DuckDB SQL of the operators that SQL can express."""

OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(cast(source AS varchar), '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (
    SELECT doc_id, part,
           (len(w) < 50)::int + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::int
           + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::int
           + 8 * regexp_matches(text, '[#$%&*|]')::int
           + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::int AS m
    FROM w),
lab AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels GROUP BY doc_id),
c AS (
    SELECT part, m, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM f LEFT JOIN lab USING (doc_id) GROUP BY part, m),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM l a, l b, l c, l d, l e
    WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
s AS (
    SELECT filter_order, k AS step, filter_order[k] AS letter, 1 << (ascii(filter_order[k]) - 65) AS bit,
           coalesce(list_sum([1 << (ascii(filter_order[i]) - 65) for i in range(1, k)]), 0)::int AS before
    FROM o, range(1, 6) t(k)),
r AS (
    SELECT part, filter_order, step, letter,
           sum(n) FILTER (WHERE m & (before | bit) = 0) AS kept,
           sum(n) FILTER (WHERE m & bit > 0 AND m & before = 0) AS removed,
           sum(n) FILTER (WHERE m & bit > 0 AND m & before > 0) AS redundant,
           sum(n) FILTER (WHERE m = bit) AS unique_fails,
           sum(good) FILTER (WHERE m & bit > 0 AND m & before = 0) AS good_lost,
           sum(toxic) FILTER (WHERE m & bit > 0 AND m & before = 0) AS toxic_lost
    FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::int AS step, coalesce(kept, 0)::bigint AS kept, coalesce(removed, 0)::bigint AS removed,
       coalesce(redundant, 0)::bigint AS redundant, coalesce(unique_fails, 0)::bigint AS unique_fails,
       coalesce(good_lost, 0)::bigint AS good_lost, coalesce(toxic_lost, 0)::bigint AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::bigint AS shapley
FROM r
"""

# The order of equal sizes is the same on both sides: by least doc_id, the shards of a size in order.
OP12_SQL = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
           octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents),
g AS (
    SELECT text, sum(size)::bigint AS total, row_number() OVER (ORDER BY sum(size) DESC, min(doc_id)) AS pos,
           row_number() OVER (PARTITION BY sum(size) ORDER BY min(doc_id)) AS k
    FROM d GROUP BY text),
run(pos, total, shard, loads) AS (
    SELECT 0::bigint, 0::bigint, 0, [0::bigint for i in range(16)]
    UNION ALL
    SELECT g.pos, g.total, list_position(loads, list_min(loads)) - 1,
           [CASE WHEN i = list_position(loads, list_min(loads)) THEN loads[i] + g.total ELSE loads[i] END for i in range(1, 17)]
    FROM run JOIN g ON g.pos = run.pos + 1),
moves AS (
    SELECT total, shard, sum(n) OVER (PARTITION BY total ORDER BY shard) AS upto, n
    FROM (SELECT total, shard, count(*) AS n FROM run WHERE pos > 0 GROUP BY total, shard)),
placed AS (SELECT g.text, m.shard FROM g JOIN moves m ON m.total = g.total AND g.k <= m.upto AND g.k > m.upto - m.n),
crc(k, b, c) AS (
    SELECT 0, b, b FROM range(256) t(b)
    UNION ALL
    SELECT k + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
lut AS (SELECT list(c ORDER BY b) AS t FROM crc WHERE k = 8),
bytes AS (SELECT rid, hex(encode(text)) AS h FROM d),
sums AS (
    SELECT rid, xor(list_reduce([('0x' || p)::bigint for p in regexp_extract_all(h, '..')],
               lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS crc32
    FROM bytes, lut)
SELECT doc_id, size::bigint AS size, crc32 AS text_crc32, 'bytes' AS law, shard::int AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::int AS grown_shard
FROM d JOIN placed USING (text) JOIN sums USING (rid)
"""

OP11_SQL = r"""
WITH e AS (
    SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::double) for x in embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND list_count(embedding) = len(embedding)
      AND len([x for x in embedding if NOT isfinite(x)]) = 0),
s AS (
    SELECT a.uid, a.vec_id AS anchor_id, b.vec_id, b.uid AS other, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::bigint AS score
    FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.uid <> b.uid AND len(a.v) = len(b.v)),
p AS (
    SELECT uid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER w AS slot
    FROM s WHERE same WINDOW w AS (PARTITION BY uid ORDER BY score DESC, vec_id, other) QUALIFY slot <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.uid = p.uid AND NOT s.same
 AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.uid, p.slot ORDER BY s.score DESC, s.vec_id, s.other) QUALIFY rank <= 5
"""

"""SQL with the same results as the registered queries of this folder, where SQL can express them."""

WORDS = r"'[^\x20\x09-\x0D]+'"
SPACES = r"'[\x20\x09-\x0D]+'"

OP1 = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORDS}) AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM d, unnest(range(1, len(ws) - 1)) AS u(i)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
b AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
l AS (SELECT *, trim(regexp_replace(translate(lower(line), '123456789', '000000000'), {SPACES}, ' ', 'g')) AS norm,
             len(regexp_extract_all(line, {WORDS})) AS words FROM b WHERE regexp_matches(line, {WORDS})),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l GROUP BY doc_id),
h AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source),
f AS (SELECT l.source, norm FROM l JOIN h ON l.source IS NOT DISTINCT FROM h.source
      GROUP BY l.source, norm, h.n HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > h.n * 0.1),
lost AS (SELECT l.doc_id, sum(words) AS n FROM l JOIN f ON l.norm = f.norm AND l.source IS NOT DISTINCT FROM f.source GROUP BY l.doc_id),
c AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, {SPACES}, '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_lost
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost <= n_words * 0.5 AS kept FROM c
"""

OP3 = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORDS})) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
l AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS rest,
             sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weights
      FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (SELECT max({{'level': rest / weights, 'rest': rest, 'weights': weights}}) AS b FROM l),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, (weight * b.rest / b.weights)::DOUBLE) AS target FROM l, best),
c AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, md5('1:' || d.doc_id) AS key,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('1:' || d.doc_id), d.size ROWS UNBOUNDED PRECEDING) AS finished
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, (source_size * turn + finished)::DOUBLE / target AS time FROM c, (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0),
g AS (SELECT doc_id, sum(size) OVER (ORDER BY time, turn, source NULLS LAST, key, size ROWS UNBOUNDED PRECEDING) AS total FROM p),
n AS (SELECT doc_id, count(*) AS passes FROM g WHERE total <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT c.doc_id, c.size::BIGINT AS size, c.source_size::BIGINT AS source_size, c.target,
       (c.size * coalesce(n.passes, 0))::BIGINT AS taken, coalesce(n.passes, 0)::INTEGER AS passes
FROM c LEFT JOIN n USING (doc_id)
"""

OP7 = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, '<turn role="' || replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '">'
             || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</turn>' || chr(10) AS whole FROM m),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role) AS said,
             coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '') AS loss, sum(length(whole)) AS n FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, n::BIGINT AS formatted_chars FROM g
"""

#: crc32 of an ASCII text, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)))))"""

OP11 = rf"""
WITH RECURSIVE o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
           FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS id FROM o),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC32.format("id")} % 9 AS h FROM i),
r AS (SELECT c.conv_id, o.place, 0 AS own, role, text FROM c JOIN o ON o.conv_id = c.base AND o.place <= c.h
      UNION ALL SELECT c.conv_id, o.place, 1, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND o.place > c.h),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth, strlen(text) AS bytes,
             md5(length(role) || ':' || role || text) AS turn FROM r),
p AS (SELECT conv_id, 0::BIGINT AS depth, 0::BIGINT AS bytes, '' AS node, NULL::VARCHAR AS up FROM c
      UNION ALL SELECT t.conv_id, t.depth, t.bytes, md5(p.node || t.turn), p.node FROM p JOIN t ON t.conv_id = p.conv_id AND t.depth = p.depth + 1),
n AS (SELECT node, depth, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM p GROUP BY node, depth),
k AS (SELECT up AS node, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
s AS (SELECT a.node, a.depth, count(*) FILTER (k.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
      FROM n LEFT JOIN k ON k.node = n.node JOIN p a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.node, a.depth),
e AS (SELECT node, depth, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
      FROM (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY node, depth)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves,
       s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n LEFT JOIN n u ON u.node = n.up AND u.depth = n.depth - 1 LEFT JOIN k ON k.node = n.node JOIN s ON s.node = n.node AND s.depth = n.depth
     LEFT JOIN e ON e.node = n.node AND e.depth = n.depth
"""

OP13 = rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
b AS (SELECT *, {CRC32.format("key")} % 20 AS kind FROM k),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
      FROM b, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS initial,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
             NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS unended FROM d),
f AS (SELECT *, again AND NOT blank AS duplicate, unended AND NOT blank AND NOT again AS truncated, blank OR again AS gone,
             lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS following FROM o),
m AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
             count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
             count(*) FILTER (initial || following NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
ins(p, q, cost, ops, said) AS (VALUES
  (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 5, 'I', 'user:' || chr(10)), (1, 2, 5, 'I', 'user:' || chr(10)), (2, 3, 5, 'I', 'assistant:' || chr(10)), (3, 2, 5, 'I', 'user:' || chr(10)),
  (0, 3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
act(p, q, op, cost, initial, role) AS (VALUES
  (0, 0, 'D', 2, NULL, NULL), (1, 1, 'D', 2, NULL, NULL), (2, 2, 'D', 2, NULL, NULL), (3, 3, 'D', 2, NULL, NULL),
  (0, 2, 'R', 1, NULL, 'user'), (1, 2, 'R', 1, NULL, 'user'), (2, 3, 'R', 1, NULL, 'assistant'), (3, 2, 'R', 1, NULL, 'user'),
  (0, 1, 'K', 0, 's', NULL), (0, 2, 'K', 0, 'u', NULL), (1, 2, 'K', 0, 'u', NULL), (3, 2, 'K', 0, 'u', NULL), (2, 3, 'K', 0, 'a', NULL)),
w AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS said FROM f
      UNION ALL
      SELECT w.conv_id, f.i, act.q, w.cost + ins.cost + act.cost + CASE WHEN f.truncated AND act.op <> 'D' THEN 5 ELSE 0 END, w.audit || ins.ops || act.op,
             w.said || ins.said || CASE WHEN act.op = 'D' THEN '' ELSE coalesce(act.role, f.role) || ':' || f.text || chr(10) END
      FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN ins ON ins.p = w.state JOIN act ON act.p = ins.q
      WHERE (act.op = 'D' OR NOT f.gone) AND (act.op <> 'K' OR act.initial = f.initial)
      QUALIFY row_number() OVER (PARTITION BY w.conv_id, act.q ORDER BY w.cost + ins.cost + act.cost + CASE WHEN f.truncated AND act.op <> 'D' THEN 5 ELSE 0 END, w.audit || ins.ops || act.op) = 1),
e AS (SELECT w.conv_id, m.* EXCLUDE (conv_id), w.cost + ins.cost AS cost, w.audit || ins.ops AS audit, w.said || ins.said AS said
      FROM w JOIN m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND w.i = m.n JOIN ins ON ins.p = w.state AND ins.q IN (0, 3)
      QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + ins.cost, w.audit || ins.ops) = 1)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(CASE WHEN said = '' THEN '' ELSE left(said, length(said) - 1) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
"""

LLM_ORACLE = {
    "op1_line_frequency": OP1,
    "op3_weighted_fair_mix": OP3,
    "op7_typed_parts_chat": OP7,
    "op11_euler_tour_trie": OP11,
    "op13_hirschberg_repair": OP13,
}

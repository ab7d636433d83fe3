"""The queries that SQL can express, as SQL over the same tables."""

OP2_TOOL_CALLS = r"""
WITH RECURSIVE turns AS (
  SELECT *, substr(md5(concat_ws(':', conv_id, turn, text)), 1, 12) AS call_id,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n
  FROM conversations
), said AS (SELECT * FROM turns WHERE role = 'assistant'
), calls AS (
  SELECT s.*, p.call_id AS before, substr(md5(s.text), 1, 1) < '8' AS needs,
         ['search', 'count', 'lookup'][s.n % 3 + 1] AS name, to_json(s.text)::VARCHAR AS query
  FROM said s LEFT JOIN said p ON p.conv_id = s.conv_id AND p.turn = s.turn - 2
), placed AS (
  SELECT conv_id, call_id, 0 AS level FROM calls WHERE NOT needs OR before IS NULL
  UNION ALL
  SELECT c.conv_id, c.call_id, p.level + 1 FROM calls c JOIN placed p ON p.conv_id = c.conv_id AND p.call_id = c.before WHERE c.needs
), results AS (
  SELECT h.conv_id, h.turn, h.text AS content, coalesce(s.call_id, h.call_id) AS call_id
  FROM turns h LEFT JOIN said s ON s.conv_id = h.conv_id AND s.turn = h.turn - 1 WHERE h.role <> 'assistant'
), checked AS (
  SELECT c.*, p.level, concat_ws('; ',
           CASE WHEN name = 'search' AND n > 50 OR name = 'count' AND n > 30 THEN 'limit: above maximum' END,
           CASE WHEN name = 'search' AND length(text) < 8 THEN 'query: too short' END,
           CASE WHEN name = 'lookup' THEN 'unknown tool' END) AS errors,
         '{' || CASE WHEN needs THEN '"after":[' || coalesce('"' || before || '"', '') || '],' ELSE '' END
           || '"limit":' || n || ',"query":' || query || '}' AS arguments
  FROM calls c JOIN placed p USING (conv_id, call_id)
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.turn, c.name, r.turn AS result_turn,
       CASE WHEN c.call_id IS NULL THEN 0 ELSE 1 END AS n_calls, CASE WHEN r.call_id IS NULL THEN 0 ELSE 1 END AS n_results,
       CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN c.errors <> '' THEN 'invalid' WHEN r.call_id IS NULL THEN 'no result' ELSE 'linked' END AS status,
       c.errors, c.level,
       '{' || CASE WHEN c.call_id IS NULL THEN '' ELSE '"arguments":' || c.arguments || ',' END
         || '"id":"' || coalesce(c.call_id, r.call_id) || '"' || CASE WHEN c.call_id IS NULL THEN '' ELSE ',"name":"' || c.name || '"' END
         || CASE WHEN r.call_id IS NULL THEN '' ELSE ',"result":' || to_json(r.content) END || '}' AS json
FROM checked c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
"""

OP4_MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), staged AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE * 1.5
           - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights,
         row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS nth
  FROM weighed
), opened AS (
  SELECT *, min(CASE WHEN rest * weight < 2.0::DOUBLE * source_size * weights THEN nth END) OVER () AS first_open FROM staged
), goal AS (
  SELECT o.source, o.source_size,
         CASE WHEN o.first_open IS NULL OR o.nth < o.first_open THEN 2.0::DOUBLE * o.source_size ELSE f.rest * o.weight / f.weights END AS target
  FROM opened o LEFT JOIN opened f ON f.nth = o.first_open
), split AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes,
         greatest(1, ceil(source_size / 65536.0))::BIGINT AS n_blocks FROM goal
), placed AS (
  SELECT s.doc_id, s.source, s.size, g.source_size, g.target, g.passes, g.target - g.passes * g.source_size AS rest, g.n_blocks,
         ('0x' || substr(md5(concat_ws('|', '17', s.doc_id)), 1, 13))::BIGINT AS key
  FROM sized s JOIN split g ON s.source IS NOT DISTINCT FROM g.source
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY
           CASE WHEN size <= least(65536, rest / 8) THEN n_blocks ELSE 0 END + floor(key / 4503599627370496.0 * n_blocks),
           key, doc_id NULLS LAST, size) AS nth
  FROM placed
), walked AS (
  SELECT source, list_reduce(list_concat([{'size': 0::BIGINT, 'room': max(rest), 'fits': []::BOOLEAN[]}],
           list({'size': size, 'room': 0::DOUBLE, 'fits': []::BOOLEAN[]} ORDER BY nth)),
           lambda a, x: {'size': 0::BIGINT, 'room': a.room - CASE WHEN x.size <= a.room THEN x.size ELSE 0 END,
                         'fits': list_append(a.fits, x.size > 0 AND x.size <= a.room)}).fits AS fits
  FROM ordered GROUP BY source
)
SELECT o.doc_id, o.size, o.source_size, o.target, (o.size * (o.passes + CASE WHEN w.fits[o.nth] THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered o JOIN walked w ON o.source IS NOT DISTINCT FROM w.source
"""

# CRC-32 of the decimal id: its digits one after the other, and after each the eight steps of a byte (-1).
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295::BIGINT)"""

OP11_EULER_TOUR = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, md5(coalesce(text, '')) AS digest, length(coalesce(text, '')) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, {_CRC32} % 6 AS h, list(md5(length(role) || ':' || role || ':' || digest) ORDER BY place) AS said,
         list(chars ORDER BY place) AS chars FROM turns GROUP BY conv_id
), built AS (
  SELECT c.conv_id, list_concat(coalesce(b.said[1:c.h], []), c.said[c.h + 1:]) AS path,
         list_concat(coalesce(b.chars[1:c.h], []), c.chars[c.h + 1:]) AS chars
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
  SELECT conv_id, d, array_to_string(path[1:d], '') AS key, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars, d = len(path) AS ends
  FROM built, LATERAL (SELECT unnest(range(len(path) + 1)) AS d)
), nodes AS (
  SELECT key, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY key, d
), below AS (
  SELECT n.*, count(c.key) AS n_children FROM nodes n
  LEFT JOIN nodes c ON c.depth = n.depth + 1 AND c.key[:32 * n.depth] = n.key GROUP BY ALL
), subtrees AS (
  SELECT key[:32 * a] AS key, a AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM below, LATERAL (SELECT unnest(range(depth + 1)) AS a) GROUP BY 1, 2
)
SELECT b.conv_id, b.depth, p.conv_id AS parent_conv_id, b.n_convs, b.n_children, s.n_leaves, s.saved_tokens, b.ends_sha256
FROM below b JOIN subtrees s USING (key, depth) LEFT JOIN nodes p ON p.depth = b.depth - 1 AND p.key = b.key[:32 * (b.depth - 1)]
"""

SQL: dict[str, str] = {
    "op2_tool_calls": OP2_TOOL_CALLS,
    "op4_mixing": OP4_MIXING,
    "op11_euler_tour": OP11_EULER_TOUR,
}

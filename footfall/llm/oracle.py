"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

WORDS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLE["op4_decontaminate"] = f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
docs AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
found AS (
  SELECT d.doc_id, d.i, win.n, win.item
  FROM (SELECT doc_id, i, s.n AS n, array_to_string(w[i : i + s.n - 1], ' ') AS win
        FROM docs, (SELECT DISTINCT n FROM windows) AS s, unnest(range(1, len(w) - s.n + 2)) AS t(i)) AS d
  JOIN windows AS win ON win.win = d.win AND win.n = d.n),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs AS d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE["op6_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sizes AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) AS long_text,
         length(role) + length(regexp_replace(role, '[^\\<#:]', '', 'g')) AS long_role FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + long_role + 2 + long_text + 8) AS BIGINT) AS formatted_chars
FROM sizes GROUP BY conv_id
"""

ORACLE["op9_vector_dedup"] = """
WITH RECURSIVE fit AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit AS a JOIN fit AS b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98),
reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION SELECT r.id, l.b FROM reach AS r JOIN links AS l ON l.a = r.other),
named AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings AS e JOIN named ON named.id = e.vec_id LEFT JOIN degree ON degree.a = e.vec_id
"""

ORACLE["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, w[i : i + k - 1] AS ws, count(*) AS f
  FROM words, unnest(range(1, 6)) AS s(k), unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS t(i)
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT g.lang, g.k, g.ws, g.f AS a, l.f AS l, r.f AS r, n, j, CAST(1000 AS HUGEINT) * g.f * n // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM grams AS g JOIN total USING (lang), unnest(range(1, g.k)) AS t(j)
  JOIN grams AS l ON l.lang = g.lang AND l.ws = g.ws[1 : j]
  JOIN grams AS r ON r.lang = g.lang AND r.ws = g.ws[j + 1 : g.k]),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, j) = 1),
kept AS (
  SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM least AS g
  WHERE NOT EXISTS (
    SELECT 1 FROM grams AS h WHERE h.lang = g.lang AND h.k > g.k AND 100 * h.f >= 100 * g.a
    AND contains(' ' || array_to_string(h.ws, ' ') || ' ', ' ' || array_to_string(g.ws, ' ') || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""

# DuckDB has no CRC-32: its table of 256 entries comes from the polynomial, then one step a character.
ORACLE["op12_prefix_trie"] = """
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS step FROM range(256) AS t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
codes AS (SELECT i, c FROM bits WHERE step = 8),
rows AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(t ORDER BY place) AS ts FROM rows GROUP BY conv_id),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS pos, CAST(4294967295 AS BIGINT) AS c FROM own
  UNION ALL SELECT conv_id, s, pos + 1, xor(codes.c, crc.c >> 8)
  FROM crc JOIN codes ON codes.i = xor(crc.c & 255, ascii(s[pos + 1])) WHERE pos < length(s)),
plans AS (SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM crc WHERE pos = length(s)),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.ts[1 : h], []), o.ts[h + 1 :]) AS ts
  FROM own AS o JOIN plans USING (conv_id) LEFT JOIN own AS b ON b.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (SELECT conv_id, ts, d, ts[1 : d] AS p FROM rebuilt, unnest(range(CAST(len(ts) + 1 AS BIGINT))) AS t(d)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(ts) = d), '')) AS ends_sha256,
         (count(*) - 1) * len(regexp_extract_all(coalesce(p[d].text, ''), '[^\\x20\\x09-\\x0D]+')) AS worth
  FROM prefixes GROUP BY p, d),
children AS (SELECT p[1 : d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
told AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (p, d)),
subtrees AS (
  SELECT a.p, a.d, sum(b.worth) AS saved, count(*) FILTER (b.n_children = 0) AS n_leaves
  FROM (SELECT p, d, n_children, worth, unnest(range(d + 1)) AS u FROM told) AS b
  JOIN told AS a ON a.d = b.u AND a.p = b.p[1 : b.u] GROUP BY a.p, a.d)
SELECT t.conv_id, t.d AS depth, up.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, t.ends_sha256
FROM told AS t JOIN subtrees AS s ON s.p = t.p AND s.d = t.d LEFT JOIN told AS up ON t.d > 0 AND up.d = t.d - 1 AND up.p = t.p[1 : t.d - 1]
"""

ORACLE["op13_top_k"] = """
WITH fit AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row AS query, q.vec_id AS query_id, c.vec_id, c.row, CAST(CASE WHEN len(q.v) = 0 THEN 0 ELSE list_dot_product(q.v, c.v) END AS BIGINT) AS score
  FROM fit AS q JOIN fit AS c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, row) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

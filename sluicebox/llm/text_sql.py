"""DuckDB SQL of the operators on words and conversations."""

# CRC-32 of some bytes, from its polynomial; ``crc.bytes`` has the remainder of each byte.
_CRC = """
crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) AS bytes
)"""


def _crc32(hexadecimal: str) -> str:
    octets = f"list_transform(range(0, length({hexadecimal}) // 2), lambda i: CAST('0x' || substr({hexadecimal}, 2 * i + 1, 2) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, crc.bytes[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295], {octets}), {step}), 4294967295)"


OP13_SQL = rf"""
WITH {_CRC},
turns AS (
    SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
               length(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
numbered AS (SELECT DISTINCT conv_id, hex(CAST(conv_id AS VARCHAR)) AS digits FROM turns),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32("digits")} % 4 AS h FROM numbered, crc),
rebuilt AS (
    SELECT c.conv_id, t.place, 0 AS own, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, t.place, 1 AS own, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
),
whole AS (
    SELECT c.conv_id, COALESCE(r.turns, []) AS turns, COALESCE(r.words, []) AS words
    FROM convs c LEFT JOIN (
        SELECT conv_id, list(length(role) || ':' || role || length(text) || ':' || text ORDER BY own, place) AS turns,
               list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY own, place) AS words
        FROM rebuilt GROUP BY conv_id
    ) r ON r.conv_id = c.conv_id
),
members AS (
    SELECT conv_id, depth, turns[1:depth] AS node, len(turns) = depth AS ended, COALESCE(words[depth], 0) AS words
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM whole)
),
nodes AS (
    SELECT node, depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, ANY_VALUE(words) AS words,
           sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
    FROM members GROUP BY node, depth
),
children AS (SELECT node[1:depth - 1] AS node, COUNT(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
above AS (SELECT n.*, unnest(range(0, n.depth + 1)) AS upto, c.n IS NULL AS leaf FROM nodes n LEFT JOIN children c ON c.node = n.node),
subtrees AS (
    SELECT node[1:upto] AS node, COUNT(*) FILTER (leaf) AS n_leaves, CAST(SUM((n_convs - 1) * words) AS BIGINT) AS saved_tokens
    FROM above GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, COALESCE(c.n, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.node = n.node LEFT JOIN children c ON c.node = n.node
LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
"""

_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS text
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM (SELECT *, LEAST(len(w), 10) AS size FROM items) WHERE size > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS text
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)
),
found AS (SELECT p.r, p.size, p.i, x.item_id FROM places p JOIN windows x ON x.size = p.size AND x.text = p.text),
hit AS (SELECT r, COUNT(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT r, size, i FROM found)) GROUP BY r),
listed AS (
    SELECT r, COUNT(*) AS n_items, sha256(string_agg(name, ',' ORDER BY name)) AS items_sha256
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, len(d.w) AS n_words, COALESCE(h.n_hit, 0) AS n_hit, COALESCE(l.n_items, 0) AS n_items,
       COALESCE(l.items_sha256, sha256('')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit h ON h.r = d.r LEFT JOIN listed l ON l.r = d.r
"""

OP11_SQL = rf"""
WITH RECURSIVE {_CRC},
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
),
counted AS (
    SELECT doc_id, run, COUNT(*) AS k, hex(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run) AS octets FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
),
hashed AS (SELECT run, k, {_crc32("octets")} AS h FROM counted, crc),
words AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(SUM(k) AS BIGINT) AS n
    FROM hashed GROUP BY 1
),
vocabulary AS (SELECT word, n FROM words WHERE length(word) >= 7 AND n >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary),
replaced AS (SELECT word, n, substr(word, 1, i - 1) || '?' || substr(word, i + 1) AS key FROM places),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS key FROM places),
near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM replaced a JOIN replaced b ON a.key = b.key AND a.word <> b.word
    UNION
    SELECT s.word, v.word, v.n FROM shorter s JOIN vocabulary v ON v.word = s.key
    UNION
    SELECT v.word, s.word, s.n FROM shorter s JOIN vocabulary v ON v.word = s.key
),
best AS (
    SELECT word, near, near_n, COUNT(*) OVER (PARTITION BY word) AS n_near FROM near
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
),
forms AS (
    SELECT v.word, v.n, COALESCE(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * v.n THEN b.near END AS form,
           CASE WHEN b.near_n >= 10 * v.n THEN b.near_n END AS form_n
    FROM vocabulary v LEFT JOIN best b ON b.word = v.word
),
steps AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL
    SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.next
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, s.root FROM forms f JOIN steps s ON s.word = f.word AND s.next IS NULL
"""

"""SQL for DuckDB of the operators that it can express."""

from __future__ import annotations

#: CRC-32 (as zlib's) of the text ``{s}`` by the table ``crc_table``: one BIGINT list of 256 entries named t.
CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda x, _:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, b)) AS t)"""


def crc32(s: str) -> str:
    return f"""xor(4294967295, list_reduce(list_transform(range(1, 1 + octet_length(encode({s}))),
        lambda i: ('0x' || substr(hex(encode({s})), 2 * i - 1, 2))::BIGINT),
        lambda x, y: xor(x >> 8, t[1 + (xor(x, y) & 255)]), 4294967295))"""


OP11 = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS named, run, count(*) AS n FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) r
    WHERE length(run) >= 6 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {crc32('named')} AS h FROM runs, crc_table
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
            ELSE run END AS word, n FROM hashed) w
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words) x
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS most, (list(other ORDER BY other_n DESC, encode(other)))[1] AS other
    FROM near GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 5 * w.n THEN b.other END AS form,
        CASE WHEN b.most >= 5 * w.n THEN b.most END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word
), led AS (
    SELECT word, word AS root FROM forms WHERE form IS NULL
    UNION ALL SELECT f.word, l.root FROM led l JOIN forms f ON f.form = l.word
)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n FROM forms f JOIN led l ON l.word = f.word
"""

OP12 = rf"""
WITH {CRC_TABLE}, turns AS (
    SELECT conv_id, md5(octet_length(encode(role))::VARCHAR || ':' || role || text) AS digest,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(octet_length(encode(role))::VARCHAR || ':' || role || text)) AS k
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) c
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS donor, {crc32('conv_id::VARCHAR')} % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns) d, crc_table
), placed AS (
    SELECT c.conv_id, 0 AS own, t.k, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.donor AND t.k <= c.h
    UNION ALL SELECT c.conv_id, 1, t.k, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.h
), whole AS (
    SELECT c.conv_id, coalesce(s.seq, []) AS seq, coalesce(s.words, []) AS words FROM convs c LEFT JOIN (
        SELECT conv_id, list(digest ORDER BY own, k) AS seq, list(words ORDER BY own, k) AS words FROM placed GROUP BY conv_id) s
    ON s.conv_id = c.conv_id
), prefixes AS (
    SELECT conv_id, d, seq[1:d] AS path, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(seq) AS ends
    FROM (SELECT conv_id, seq, words, unnest(range(0, len(seq) + 1)) AS d FROM whole) w
), nodes AS (
    SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM prefixes GROUP BY path, d
), families AS (
    SELECT n.path, n.depth, n.words, n.n_convs, n.conv_id, n.ends_sha256, p.conv_id AS parent_conv_id,
        (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
), above AS (
    SELECT path[1:up] AS path, n_children, n_convs, words
    FROM (SELECT path, n_children, n_convs, words, unnest(range(0, depth + 1)) AS up FROM families) f
), sums AS (
    SELECT path, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens FROM above GROUP BY path
)
SELECT f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM families f JOIN sums s ON s.path = f.path
"""

OP13 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT r, i, md5(array_to_string(words[i:i + 34], ' ')) AS h FROM (
        SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM docs WHERE len(words) >= 35) w
), often AS (
    SELECT h FROM windows GROUP BY h HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT r, i + k AS i FROM windows JOIN often USING (h), (SELECT unnest(range(35)) AS k) ks
), marked AS (
    SELECT r, list(i) AS gone FROM gone GROUP BY r
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(len(m.gone), 0)::BIGINT AS n_removed, sha256(array_to_string(
    CASE WHEN m.gone IS NULL THEN d.words ELSE list_transform(list_filter(list_zip(d.words, range(1, len(d.words) + 1)),
        lambda x: NOT list_contains(m.gone, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM docs d LEFT JOIN marked m ON m.r = d.r
"""

ORACLE = {"op11_spelling": OP11, "op12_prefix_trie": OP12, "op13_passages": OP13}

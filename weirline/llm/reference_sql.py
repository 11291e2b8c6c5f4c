"""SQL of the operators over trees, for DuckDB."""

# CRC-32 of a decimal number, by the reflected polynomial 0xEDB88320 (a fixed value).
CRC = """
crc_bits AS (
    SELECT i, i AS c, 0 AS k FROM (SELECT unnest(range(256)) AS i)
    UNION ALL
    SELECT i, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, k + 1
    FROM crc_bits WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM crc_bits WHERE k = 8),
crc AS (
    SELECT id, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT,
            list_transform(string_split(id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda acc, b: xor(acc // 256, tab[(1 + xor(acc % 256, b))::BIGINT]::BIGINT))) AS value
    FROM (SELECT DISTINCT {id} AS id FROM {table} WHERE {id} IS NOT NULL), crc_table
)"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"


def merkle() -> str:
    fixed = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    cut = "CASE WHEN value % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    return f"""
WITH RECURSIVE {CRC.format(id="doc_id", table="documents")},
listed AS (
    SELECT doc_id, source, sha256({fixed} || {_field("text")}) AS leaf,
        sha256({fixed} || {_field(f"({cut})")}) AS claimed
    FROM documents LEFT JOIN crc ON doc_id = id
),
leaves AS (
    SELECT *, row_number() OVER () AS row, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY source) AS n
    FROM listed
),
low AS (
    SELECT g, 0 AS lvl, i, n, leaf AS h FROM leaves
    UNION ALL
    SELECT g, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
    FROM low WHERE n > 1 GROUP BY g, lvl, n, i // 3
),
subroots AS (SELECT g, h, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
    SELECT 0 AS lvl, g AS i, n, h FROM subroots
    UNION ALL
    SELECT lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
    FROM high WHERE n > 1 GROUP BY lvl, n, i // 3
),
nodes AS (
    SELECT g, lvl, i, n, h FROM low UNION ALL SELECT -1, lvl, i, n, h FROM high
),
siblings AS (
    SELECT a.g, a.lvl, a.i,
        coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
        coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
    FROM nodes a JOIN nodes b ON a.g = b.g AND a.lvl = b.lvl AND a.i // 3 = b.i // 3
    WHERE a.n > 1 GROUP BY ALL
),
up AS (
    SELECT row, g, i, 0 AS lvl, claimed AS h, '' AS proof FROM leaves
    UNION ALL
    SELECT row, g, u.i // 3, u.lvl + 1, sha256(before || h || after), proof || before || after
    FROM up u JOIN siblings s USING (g, lvl, i)
),
within AS (SELECT row, g, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM up GROUP BY row, g),
across AS (
    SELECT row, -1::BIGINT AS g, g AS i, 0 AS lvl, h, proof FROM within
    UNION ALL
    SELECT row, g, u.i // 3, u.lvl + 1, sha256(before || h || after), proof || before || after
    FROM across u JOIN siblings s USING (g, lvl, i)
),
folded AS (SELECT row, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM across GROUP BY row)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256,
    f.h AS folded_root, f.h = r.h AS verified
FROM leaves l JOIN folded f USING (row) JOIN subroots s USING (g),
    (SELECT h FROM high WHERE n = 1) r
"""


def prefix_trie() -> str:
    return f"""
WITH RECURSIVE {CRC.format(id="conv_id", table="conversations")},
ids AS (SELECT id AS c, value % 9 AS h FROM crc),
turns AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
    SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, t) AS n FROM turns
),
spliced AS (
    SELECT ids.c, 0 AS part, n, r, t FROM ids JOIN own ON own.c = ids.c - ids.c % 5 AND n <= h
    UNION ALL
    SELECT ids.c, 1, n, r, t FROM ids JOIN own ON own.c = ids.c AND n > h
),
placed AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, n) AS d,
        sha256(strlen(r)::VARCHAR || ':' || r || t) AS turn, strlen(t) AS b
    FROM spliced
),
paths AS (
    SELECT c, d, b, string_agg(turn, '' ORDER BY d)
        OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS k
    FROM placed
    UNION ALL
    SELECT c, 0, 0, '' FROM ids
),
nodes AS (
    SELECT k, min(d) AS d, min(c) AS conv_id, count(*) AS n_convs, min(b) AS b FROM paths GROUP BY k
),
linked AS (
    SELECT n.*, p.k AS parent, m.conv_id AS parent_conv_id
    FROM nodes n LEFT JOIN paths p ON p.c = n.conv_id AND p.d = n.d - 1 LEFT JOIN nodes m ON m.k = p.k
),
children AS (SELECT parent AS k, count(*) AS n_children FROM linked GROUP BY parent),
counted AS (
    SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (k)
),
totals AS (
    SELECT p.k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * n.b) AS saved
    FROM counted n JOIN paths p ON p.c = n.conv_id AND p.d <= n.d GROUP BY p.k
),
ends AS (
    SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
    FROM (SELECT c, arg_max(k, d) AS k FROM paths GROUP BY c) GROUP BY k
)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM counted JOIN totals USING (k) LEFT JOIN ends USING (k)
"""

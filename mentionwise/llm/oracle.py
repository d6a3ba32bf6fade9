"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id,
           coalesce(regexp_extract_all(translate(text, {LETTERS}), '{WORD}'), []) AS w
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, {LETTERS}), '{WORD}') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS phrase, least(len(w), 10) AS width
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), widths AS (SELECT DISTINCT width FROM windows
), seen AS (
    SELECT k, i, width, array_to_string(w[i:i + width - 1], ' ') AS phrase
    FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM d), widths WHERE i + width - 1 <= len(w)
), hits AS (SELECT k, i, s.width, item FROM seen s JOIN windows USING (phrase)
), n AS (
    SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + width)) AS p FROM (SELECT DISTINCT k, i, width FROM hits))
    GROUP BY k
), items AS (
    SELECT k, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT k, item FROM hits) GROUP BY k
), places AS (SELECT k, unnest(w) AS word, unnest(range(len(w))) AS p FROM d
), counts AS (SELECT word, count(*) AS n FROM places GROUP BY word
), ranked AS (
    SELECT phrase, word, n, row_number() OVER (PARTITION BY phrase ORDER BY coalesce(n, 0), word) AS rank
    FROM (SELECT DISTINCT phrase, unnest(string_split(phrase, ' ')) AS word FROM windows) LEFT JOIN counts USING (word)
), rare AS (
    SELECT phrase, a.word AS word, b.word AS word2
    FROM (FROM ranked WHERE rank = 1 AND n > 0) a LEFT JOIN (FROM ranked WHERE rank = 2) b USING (phrase)
), pairs AS (SELECT DISTINCT word, word2 FROM rare
), met AS (
    SELECT DISTINCT a.k, a.word, c.word2 FROM pairs c JOIN places a USING (word) JOIN places b ON b.k = a.k AND b.word = c.word2
    WHERE abs(a.p - b.p) <= 10
    UNION ALL SELECT DISTINCT k, word, word2 FROM pairs JOIN places USING (word) WHERE word2 IS NULL
), near AS (
    SELECT k, count(item) AS n_near, string_agg(item, ',' ORDER BY item) AS near_names FROM (
        SELECT DISTINCT k, item FROM met JOIN rare ON met.word = rare.word AND met.word2 IS NOT DISTINCT FROM rare.word2
        JOIN windows USING (phrase)
    ) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near, sha256(coalesce(near_names, '')) AS near_sha256
FROM d LEFT JOIN n USING (k) LEFT JOIN items USING (k) LEFT JOIN near USING (k)
"""

URLS = f"""
WITH r(h, p, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), u AS (
    SELECT row_number() OVER () AS k, page_id,
           coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), {LETTERS}), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), best AS (
    SELECT k, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
    FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY k
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (k)
"""

MERKLE = """
WITH RECURSIVE f AS (
    SELECT row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST) AS k, lang, doc_id, n_chars,
           [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS own,
           [CAST(doc_id AS VARCHAR), source, lang, CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR), text] AS other
    FROM documents
), leaves AS (
    SELECT k, lang, doc_id, n_chars,
           sha256(array_to_string([coalesce(strlen(v) || ':' || v, '-') FOR v IN own], '')) AS leaf,
           sha256(array_to_string([coalesce(strlen(v) || ':' || v, '-') FOR v IN other], '')) AS changed
    FROM f
), sums AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) AS v
        FROM (SELECT unnest(range(256)) AS i)
    )
), crcs AS (
    SELECT k, xor(list_reduce(list_concat([4294967295], [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
           lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS crc
    FROM leaves, sums WHERE doc_id IS NOT NULL
), trees AS (
    SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM leaves GROUP BY lang
), placed AS (
    SELECT k, doc_id, tree, n, leaf, CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN changed ELSE leaf END AS shown,
           row_number() OVER (PARTITION BY tree ORDER BY k) - 1 AS i
    FROM leaves JOIN trees ON leaves.lang IS NOT DISTINCT FROM trees.lang LEFT JOIN crcs USING (k)
), nodes AS (
    SELECT tree, 0 AS level, i, n, leaf AS h FROM placed
    UNION ALL
    SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
    FROM nodes WHERE n > 1 GROUP BY tree, level, i // 2, n
), subroots AS (
    SELECT nodes.tree, h, (SELECT count(*) FROM trees) AS n FROM nodes WHERE nodes.n = 1
), tops AS (
    SELECT 0 AS level, tree AS i, n, h FROM subroots
    UNION ALL
    SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 2, n
), steps AS (
    SELECT k, level, h, i AS place FROM (
        SELECT k, p.tree, l.level, xor(CAST(p.i // (1 << l.level) AS BIGINT), 1) AS i
        FROM placed p, (SELECT DISTINCT level FROM nodes) l
    ) s JOIN nodes USING (tree, level, i)
    UNION ALL
    SELECT k, 100 + s.level, h, i AS place FROM (
        SELECT k, l.level, xor(CAST(tree // (1 << l.level) AS BIGINT), 1) AS i
        FROM placed, (SELECT DISTINCT level FROM tops) l
    ) s JOIN tops USING (level, i)
), proofs AS (
    SELECT k, list(h ORDER BY level) AS hs FROM steps GROUP BY k
), alone AS (
    -- a run of one node is hashed without a sibling
    SELECT k, level FROM placed p JOIN nodes USING (tree)
    WHERE nodes.n > 1 AND nodes.i = p.i // (1 << level) AND nodes.i = nodes.n - 1 AND nodes.i % 2 = 0
    UNION ALL
    SELECT k, 100 + level FROM placed p, tops
    WHERE tops.n > 1 AND tops.i = p.tree // (1 << level) AND tops.i = tops.n - 1 AND tops.i % 2 = 0
), path AS (
    SELECT k, row_number() OVER (PARTITION BY k ORDER BY level) AS step, h, side FROM (
        SELECT k, level, h, place % 2 AS side FROM steps UNION ALL SELECT k, level, NULL, NULL FROM alone
    )
), folded AS (
    SELECT k, 0 AS step, shown AS h FROM placed
    UNION ALL
    SELECT k, path.step, sha256(CASE WHEN path.h IS NULL THEN folded.h WHEN side = 0 THEN path.h || folded.h ELSE folded.h || path.h END)
    FROM folded JOIN path USING (k) WHERE path.step = folded.step + 1
), ends AS (SELECT k, arg_max(h, step) AS folded_root FROM folded GROUP BY k)
SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, sha256(coalesce(array_to_string(hs, ''), '')) AS proof_sha256,
       folded_root, folded_root = root.h AS verified
FROM placed JOIN subroots USING (tree) JOIN ends USING (k) LEFT JOIN proofs USING (k), (SELECT h FROM tops WHERE n = 1) root
"""

WARC = """
WITH p AS (
    SELECT page_id, html AS raw, coalesce(html, '') AS body, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), d AS (
    SELECT page_id, payload_bytes, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS first FROM p
)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31 AS INTEGER), 1)
           FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""


def llm_oracle() -> dict[str, str]:
    return {"op4_decontamination": DECONTAMINATION, "op6_urls": URLS, "op12_merkle": MERKLE, "op13_warc": WARC}

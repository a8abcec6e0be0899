"""SQL twins of the queries, for an engine that checks them."""

from __future__ import annotations

SUBSTRINGS = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, start, list_aggregate(words[start : start + 19], 'string_agg', ' ') AS run
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS start FROM texts)
), again AS (
    SELECT doc_id, start
    FROM windows
    QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, start) > 1
), covered AS (
    SELECT DISTINCT doc_id, start + i AS place FROM again, generate_series(0, 19) AS g(i)
), places AS (
    SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM texts
), kept AS (
    SELECT p.doc_id, count(*) AS n_kept, string_agg(p.word, ' ' ORDER BY p.place) AS body
    FROM places p ANTI JOIN covered c ON c.doc_id = p.doc_id AND c.place = p.place
    GROUP BY p.doc_id
)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words,
       (len(t.words) - coalesce(k.n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id
"""

JACCARD = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_aggregate(words[start : start + 2], 'string_agg', ' ') AS token
    FROM (
        SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 2))) AS start
        FROM texts WHERE len(words) > 0
    )
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles x JOIN shingles y ON x.token = y.token AND x.doc_id <> y.doc_id
    GROUP BY ALL
), links AS (
    SELECT a, b
    FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * shared >= 90 * (p.n + q.n - shared)
), reach AS (
    SELECT a, b FROM links
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT t.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles,
       least(t.doc_id, min(reach.b)) AS component_id
FROM texts t LEFT JOIN sizes s ON s.doc_id = t.doc_id LEFT JOIN reach ON reach.a = t.doc_id
GROUP BY t.doc_id
"""

EMBEDDINGS = """
WITH RECURSIVE good AS (
    SELECT vec_id, embedding::DOUBLE[] AS x
    FROM embeddings
    WHERE len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
      AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), links AS (
    SELECT p.vec_id AS a, q.vec_id AS b
    FROM good p JOIN good q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
    WHERE list_cosine_similarity(p.x, q.x) >= 0.9
), reach AS (
    SELECT a, b FROM links
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), own AS (
    SELECT a, count(DISTINCT b) AS n FROM links GROUP BY a
), least_reached AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT e.vec_id, coalesce(o.n, 0)::BIGINT AS n_links,
       least(e.vec_id, r.b) AS component_id,
       e.vec_id = least(e.vec_id, r.b) AS kept
FROM embeddings e LEFT JOIN own o ON o.a = e.vec_id LEFT JOIN least_reached r ON r.a = e.vec_id
"""

EXACT = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(body) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY body)
"""

# crc32 bit by bit; every conversation's path in full, so for small tables only.
CONVERSATIONS = """
WITH src AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id
                              ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns,
           xor(list_reduce(
               list_concat([4294967295::BIGINT],
                           list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda x, y: list_reduce(
                   list_concat([xor(x, y)], [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
                   lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 9 AS h
    FROM src GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(f.turns[1 : c.h], []), c.turns[c.h + 1 :]) AS turns
    FROM convs c LEFT JOIN convs f ON f.conv_id = c.conv_id - c.conv_id % 5
), members AS (
    SELECT conv_id, len(turns) AS n, turns, unnest(generate_series(0, len(turns))) AS depth FROM rebuilt
), paths AS (
    SELECT conv_id, n, depth, turns[1 : depth] AS path FROM members
), nodes AS (
    SELECT path, depth, min(conv_id) AS node, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends,
           CASE WHEN depth = 0 THEN 0 ELSE strlen(path[depth].text) END AS size
    FROM paths GROUP BY path, depth
), within AS (
    SELECT p.conv_id, p.depth, q.node FROM paths p JOIN nodes q ON q.path = p.path
), parents AS (
    SELECT x.node, x.depth, w.node AS parent
    FROM nodes x JOIN within w ON w.conv_id = x.node AND w.depth = x.depth - 1
), kids AS (
    SELECT parent, depth - 1 AS depth, count(*) AS n FROM parents GROUP BY ALL
), below AS (
    SELECT w.node, w.depth, count(*) FILTER (k.n IS NULL) AS n_leaves,
           sum((x.n_convs - 1) * x.size) AS saved
    FROM nodes x JOIN within w ON w.conv_id = x.node AND w.depth <= x.depth
    LEFT JOIN kids k ON k.parent = x.node AND k.depth = x.depth
    GROUP BY ALL
)
SELECT x.node AS conv_id, x.depth::BIGINT AS depth, p.parent AS parent_conv_id, x.n_convs,
       coalesce(k.n, 0)::BIGINT AS n_children, b.n_leaves, b.saved::BIGINT AS saved_tokens,
       sha256(x.ends) AS ends_sha256
FROM nodes x JOIN below b ON b.node = x.node AND b.depth = x.depth
LEFT JOIN parents p ON p.node = x.node AND p.depth = x.depth
LEFT JOIN kids k ON k.parent = x.node AND k.depth = x.depth
"""

DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 3
), own AS (
    SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL
), langs AS (
    SELECT d.lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS n
    FROM (SELECT DISTINCT lang FROM docs) d LEFT JOIN kept k ON k.lang = d.lang GROUP BY d.lang
), sizes AS (
    SELECT g.lang, g.source, l.v, coalesce(sum(o.n), 0) AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g
    JOIN langs l ON l.lang = g.lang
    LEFT JOIN (SELECT own.* FROM own SEMI JOIN kept ON own.lang = kept.lang AND own.term = kept.term) o
        ON o.lang = g.lang AND o.source = g.source
    GROUP BY g.lang, g.source, l.v
), given AS (
    SELECT s.lang, s.source, k.term, coalesce(o.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 1)) // (s.n + s.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 1)) // (l.n + l.v) AS q
    FROM sizes s JOIN langs l ON l.lang = s.lang JOIN kept k ON k.lang = s.lang
    LEFT JOIN own o ON o.lang = s.lang AND o.source = s.source AND o.term = k.term
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM given a JOIN given b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
    UNION ALL
    SELECT a.lang, a.source, 'pair', b.source, 0
    FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value
    FROM given WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

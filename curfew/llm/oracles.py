"""SQL of the queries that SQL can express."""

#: Words of ``text``: A-Z lowered, digits, letters and characters beyond ASCII.
PLAIN_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP4 = f"""
WITH i AS (SELECT item_id, {PLAIN_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, w[s : s + least(10, len(w)) - 1] AS p
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, n, s, w[s : s + n - 1] AS p
      FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT g.doc_id, g.s, g.n, p.item_id FROM g JOIN p ON p.n = g.n AND p.p = g.p),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""

#: Windows are compared by md5 here: 50 words each would not fit.
OP6 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) AS h
      FROM (SELECT *, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
f AS (SELECT h, min(doc_id) AS least FROM g GROUP BY h HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS k FROM g JOIN f USING (h) WHERE doc_id > least)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(r.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(r.kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(gone) AS n_removed,
                         string_agg(CASE WHEN gone IS NULL THEN word END, ' ' ORDER BY i) AS kept
                  FROM (SELECT p.doc_id, p.i, p.word, c.k AS gone
                        FROM (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)) AS p
                        LEFT JOIN c ON c.doc_id = p.doc_id AND c.k = p.i)
                  GROUP BY doc_id) AS r ON r.doc_id = d.doc_id
"""

OP12 = """
WITH RECURSIVE v AS (SELECT DISTINCT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
c AS (SELECT x, min(y) AS least FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id <= coalesce(least, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id
"""

#: crc32 by its table of 256 entries, which eight shifts of each byte give.
OP13 = """
WITH g AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t),
t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS j
      FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 100 AS base,
             xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
                             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 6 AS h
      FROM (SELECT DISTINCT c FROM t), g),
w AS (SELECT h.c, list({'r': u.r, 'x': u.x} ORDER BY u.k, u.j) FILTER (WHERE u.r IS NOT NULL) AS w
      FROM h LEFT JOIN (SELECT h.c, 0 AS k, t.j, t.r, t.x FROM h JOIN t ON t.c = h.base AND t.j < h.h
                        UNION ALL SELECT h.c, 1, t.j, t.r, t.x FROM h JOIN t ON t.c = h.c AND t.j >= h.h) u ON u.c = h.c
      GROUP BY h.c),
p AS (SELECT c, len(coalesce(w, [])) AS n, d, coalesce(w, [])[1:d] AS p
      FROM (SELECT *, unnest(range(0, len(coalesce(w, [])) + 1)) AS d FROM w)),
n AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs,
             string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = n) AS ends FROM p GROUP BY p, d),
k AS (SELECT p[1 : d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
             CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(n.p[d].x) END AS saved FROM n LEFT JOIN k ON k.p = n.p),
s AS (SELECT p[1:e] AS p, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum(saved) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM m) GROUP BY 1)
SELECT m.conv_id, m.d AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN s ON s.p = m.p LEFT JOIN n u ON m.d > 0 AND u.p = m.p[1 : m.d - 1]
"""

ORACLES = {
    "op4_decontamination": OP4,
    "op6_substring_dedup": OP6,
    "op12_embedding_dedup": OP12,
    "op13_prefix_trie": OP13,
}

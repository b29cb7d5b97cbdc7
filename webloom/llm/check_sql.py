"""Check SQL of queries that walk trees, link documents or compare passages, for DuckDB."""

_FRAMED = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}) || ':' || {0} END"


def _leaf(n_chars: str) -> str:
    values = ["doc_id::varchar", "source", "lang", f"({n_chars})::varchar", "text"]
    return "sha256(" + " || ".join(f"({_FRAMED.format(v)})" for v in values) + ")"


_CRC32 = (
    "list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda c: ascii(c)::bigint)), "
    "lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 1, 2, 3, 4, 5, 6, 7]), "
    "lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"
)


def crc32(text: str) -> str:
    """Unsigned crc32 of a short text of ASCII characters."""
    return f"xor(4294967295, {_CRC32.format(text)})"


OP11_SQL = f"""
WITH RECURSIVE
d AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
    CASE WHEN {crc32('doc_id::varchar')} % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS claim,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
nodes AS (
  SELECT lang, 0 AS lvl, idx, n, leaf AS h FROM d
  UNION ALL
  SELECT lang, lvl + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, idx // 2),
subroots AS (SELECT lang, lvl AS height, h AS subroot FROM nodes WHERE n = 1),
t AS (
  SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM subroots),
top AS (
  SELECT 0 AS lvl, idx, n, subroot AS h FROM t
  UNION ALL
  SELECT lvl + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM top WHERE n > 1 GROUP BY lvl, idx // 2),
whole AS (SELECT lvl AS height, h AS root FROM top WHERE n = 1),
siblings AS (
  SELECT d.doc_id, 0 AS part, s.lvl, s.h FROM d JOIN nodes s
    ON s.lang IS NOT DISTINCT FROM d.lang AND s.n > 1 AND s.idx = xor(d.idx >> s.lvl, 1)
  UNION ALL
  SELECT d.doc_id, 1, s.lvl, s.h FROM d JOIN t ON t.lang IS NOT DISTINCT FROM d.lang
    JOIN top s ON s.n > 1 AND s.idx = xor(t.idx >> s.lvl, 1)),
proof AS (SELECT doc_id, sha256(string_agg(h, '' ORDER BY part, lvl)) AS proof FROM siblings GROUP BY doc_id),
f1 AS (
  SELECT doc_id, lang, idx, 0 AS lvl, claim AS h FROM d
  UNION ALL
  SELECT f.doc_id, f.lang, f.idx // 2, f.lvl + 1, sha256(
    CASE WHEN s.idx < f.idx THEN s.h ELSE '' END || f.h || CASE WHEN s.idx > f.idx THEN s.h ELSE '' END)
  FROM f1 f JOIN subroots r ON r.lang IS NOT DISTINCT FROM f.lang AND f.lvl < r.height
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM f.lang AND s.lvl = f.lvl AND s.idx = xor(f.idx, 1)),
f2 AS (
  SELECT f.doc_id, t.idx, 0 AS lvl, f.h FROM f1 f JOIN t ON t.lang IS NOT DISTINCT FROM f.lang AND f.lvl = t.height
  UNION ALL
  SELECT f.doc_id, f.idx // 2, f.lvl + 1, sha256(
    CASE WHEN s.idx < f.idx THEN s.h ELSE '' END || f.h || CASE WHEN s.idx > f.idx THEN s.h ELSE '' END)
  FROM f2 f JOIN whole w ON f.lvl < w.height LEFT JOIN top s ON s.lvl = f.lvl AND s.idx = xor(f.idx, 1))
SELECT d.doc_id, d.leaf, r.subroot, w.root, coalesce(p.proof, sha256('')) AS proof_sha256,
  f.h AS folded_root, f.h = w.root AS verified
FROM d JOIN subroots r ON r.lang IS NOT DISTINCT FROM d.lang CROSS JOIN whole w
  LEFT JOIN proof p ON p.doc_id = d.doc_id JOIN f2 f ON f.doc_id = d.doc_id AND f.lvl = w.height
"""


OP13_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT c, c - c % 20 AS base, {crc32('c::varchar')} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT c.c, t.pos, t.role, t.text FROM c JOIN t ON t.c = c.base AND t.pos < c.h
  UNION ALL SELECT c.c, t.pos, t.role, t.text FROM c JOIN t ON t.c = c.c AND t.pos >= c.h),
p AS (
  SELECT c, row_number() OVER w AS depth, list(role || chr(0) || text) OVER w AS path, text,
    row_number() OVER w = count(*) OVER (PARTITION BY c) AS ends
  FROM r WINDOW w AS (PARTITION BY c ORDER BY pos)),
s AS (
  SELECT c, depth, path, text, ends FROM p UNION ALL
  SELECT c, 0, [], '', NOT EXISTS (FROM r WHERE r.c = c.c) FROM c),
n AS (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * len(list_filter(string_split_regex(min(text), '[ \\t-\\r]+'), lambda w: w <> '')) AS saved,
    sha256(coalesce(string_agg(c::varchar, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM s GROUP BY path, depth),
k AS (
  SELECT n.*, u.conv_id AS parent_conv_id, coalesce(x.n_children, 0) AS n_children
  FROM n LEFT JOIN n u ON u.depth = n.depth - 1 AND u.path = n.path[:n.depth - 1]
    LEFT JOIN (SELECT path[:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1) x
    ON x.path = n.path),
u AS (
  SELECT path[:unnest(range(0, depth + 1))] AS path, saved, (n_children = 0)::bigint AS leaf FROM k),
a AS (SELECT path, sum(leaf)::bigint AS n_leaves, sum(saved)::bigint AS saved_tokens FROM u GROUP BY path)
SELECT conv_id, depth::bigint AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM k JOIN a ON a.path = k.path
"""


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[ \\t-\\r]+'), lambda w: w <> '')"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Shingles are compared as texts; links are followed until no document is new.
OP2_SQL = f"""
WITH RECURSIVE
d AS (SELECT doc_id, {_words(_LOWER)} AS ws FROM documents),
w AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM d),
g AS (
  SELECT doc_id, n, pos, string_agg(w, ' ') OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS shingle FROM w),
s AS (SELECT DISTINCT doc_id, shingle FROM g WHERE pos <= greatest(n - 4, 1)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT r.a, t.b FROM r JOIN both_ways t ON t.a = r.b),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(c.n, 0)::bigint AS n_shingles, m.component_id
FROM d JOIN m ON m.a = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""

# Windows are compared as texts of 50 words, never by a hash.
OP8_SQL = f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')")} AS ws FROM documents),
w AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM d),
g AS (
  SELECT doc_id, n, pos, w, string_agg(w, ' ') OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS words FROM w),
f AS (SELECT words, min(doc_id) AS first_doc FROM g WHERE pos <= n - 49 GROUP BY words),
h AS (
  SELECT g.doc_id, g.pos, g.w, f.first_doc < g.doc_id AS again
  FROM g LEFT JOIN f ON f.words = g.words AND g.pos <= g.n - 49),
k AS (
  SELECT doc_id, pos, w, coalesce(pos - max(pos) FILTER (again) OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) < 50, false) AS covered
  FROM h),
o AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (covered) AS n_removed,
    string_agg(w, ' ' ORDER BY pos) FILTER (NOT covered) AS kept
  FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::bigint AS n_words, coalesce(n_removed, 0)::bigint AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN o ON o.doc_id = d.doc_id
"""

"""DuckDB SQL of the queries that SQL can state."""

ORACLES: dict[str, str] = {}

ORACLES["op8_exact_dedup"] = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

# A document's set: 5-word shingles, or the whole sequence of a shorter text.  Pairs that
# share a shingle are counted; components spread the least id over the links.
ORACLES["op7_ngram_join"] = r"""
WITH RECURSIVE
d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                          ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
l AS (SELECT a AS u, b AS v FROM e UNION ALL SELECT b, a FROM e),
r(u, v) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.v) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.u = d.doc_id GROUP BY d.doc_id
"""

ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, strlen(h) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         list_sum(list_transform(range(5), lambda j: (1 << (4 - j)) * CAST(substr(CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR), CAST(5 * i + j + 1 AS INT), 1) AS INT)))::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f THEN f END AS refers_to, url
FROM g
"""

# Bytes as pairs of hex digits; every window of 100 bytes, its first place, and the
# bytes that a later one covers.
ORACLES["op10_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, unnest(range(len(h) // 2)) AS i, h FROM d),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS c, CASE WHEN 2 * i + 200 <= len(h) THEN substr(h, 2 * i + 1, 200) END AS s FROM b),
f AS (SELECT doc_id, i, c, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS again FROM w),
x AS (SELECT doc_id, i, c, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS 99 PRECEDING) AS gone FROM f),
y AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS opens FROM x),
z AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
             coalesce(string_agg(c, '' ORDER BY i) FILTER (NOT gone), '') AS rest FROM y GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM d LEFT JOIN z USING (doc_id)
"""

# CRC-32 of a row's decimal doc_id: each byte, then eight shifts.
CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
       lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
       lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

# Pairs of equal words at most a quarter of the text apart; neighbours among the pairs
# of one distance are a stretch with that period, and the least period of a stretch is its own.
ORACLES["op11_period_runs"] = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, {CRC} AS h FROM documents),
a AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
t AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) ELSE i END]) ELSE w END AS w FROM a),
x AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS v FROM t),
e AS (SELECT l.doc_id, l.i, r.i - l.i AS p FROM x l JOIN x r ON l.doc_id = r.doc_id AND l.v = r.v AND r.i > l.i AND 4 * (r.i - l.i) <= l.n),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS k FROM e),
s AS (SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM g GROUP BY doc_id, p, k HAVING count(*) + p >= greatest(6, 4 * p)),
r AS (SELECT doc_id, start, length, min(p) AS period FROM s GROUP BY ALL),
b AS (SELECT doc_id, count(*) AS n_runs, max({{'l': length, 's': -start, 'p': -period}}) AS b,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(v, ' ' ORDER BY i) AS rest FROM x
      WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = x.doc_id AND x.i >= r.start + r.period AND x.i < r.start + r.length) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, -b.s AS start, b.l AS length, -b.p AS period, 1000 * b.l // -b.p AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _levels(start: str) -> str:
    """Rows (g, l, h): the nodes of each level of each tree."""
    return f"""SELECT g, 0 AS l, h FROM {start} UNION ALL
  SELECT g, l + 1, list_transform(range(0, len(h), 2), lambda i: sha256(array_to_string(h[i + 1:i + 2], ''))) FROM {{0}} WHERE len(h) > 1"""


# Trees as lists of nodes, level by level; g is a language, or '' for the tree over the languages' roots.
ORACLES["op12_merkle"] = f"""
WITH RECURSIVE
d AS (SELECT doc_id, coalesce('1' || lang, '0') AS g, {_leaf('n_chars')} AS leaf,
             CASE WHEN {CRC} % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS shown FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS i FROM d),
a AS (SELECT g, list(leaf ORDER BY i) AS h FROM p GROUP BY g),
t AS ({_levels('a').format('t')}),
s AS (SELECT g, h[1] AS subroot, l AS height FROM t WHERE len(h) = 1),
c AS (SELECT '' AS g, list(subroot ORDER BY g) AS h FROM s),
u AS ({_levels('c').format('u')}),
q AS (SELECT g, subroot, height, row_number() OVER (ORDER BY g) - 1 AS j FROM s),
z AS (SELECT g, l, h FROM t WHERE len(h) > 1),
y AS (SELECT q.g, q.height + u.l AS l, u.h, q.height FROM u, q WHERE len(u.h) > 1),
w(doc_id, l, proof, node) AS (
  SELECT doc_id, 0, '', shown FROM p
  UNION ALL
  SELECT w.doc_id, w.l + 1,
         w.proof || coalesce(n.h[xor(n.k, 1) + 1], ''),
         sha256(CASE WHEN n.k % 2 = 1 THEN n.h[n.k] || w.node ELSE w.node || coalesce(n.h[n.k + 2], '') END)
  FROM w JOIN (SELECT p.doc_id, z.l, z.h, p.i >> z.l AS k FROM p JOIN z USING (g)
               UNION ALL SELECT p.doc_id, y.l, y.h, q.j >> (y.l - y.height) FROM p JOIN q USING (g) JOIN y USING (g)) n ON n.doc_id = w.doc_id AND n.l = w.l),
e AS (SELECT doc_id, max_by(proof, l) AS proof, max_by(node, l) AS folded_root FROM w GROUP BY doc_id)
SELECT doc_id, leaf, subroot, r.root, sha256(proof) AS proof_sha256, folded_root, folded_root = r.root AS verified
FROM p JOIN q USING (g) JOIN e USING (doc_id), (SELECT h[1] AS root FROM u WHERE len(h) = 1) r
"""

ORACLES["op13_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
l AS (SELECT doc_id, unnest(w) AS line, unnest(range(len(w))) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[ 	-]+', ''), '[ 	-]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
x AS (SELECT k.*, coalesce(s.keep <> k.doc_id, FALSE) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM x GROUP BY doc_id
"""

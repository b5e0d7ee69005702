"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

from ratelake.llm.fair_mix import MAX_EPOCHS, WEIGHTS
from ratelake.llm.line_winnow import RUN, WORDS
from ratelake.llm.prefix_trie import FAMILY, HEADS
from ratelake.llm.subvector_kmeans import LIMIT, SCALE
from ratelake.llm.suffix_lpf import SPAN

_WORD = r"[^\x20\x09-\x0D]+"

# exact shingle sets, all pairs that share a shingle, components by recursion
_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])) END AS s
  FROM words),
classes AS (
  SELECT min(doc_id) AS rep, count(*) AS copies, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT rep, n, copies, unnest(s) AS x FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b, any_value(b.copies) AS copies
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.rep <> b.rep
  GROUP BY a.rep, b.rep HAVING 5 * count(*) >= 4 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(rep, root) AS (
  SELECT rep, rep FROM classes UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.rep),
roots AS (SELECT rep, min(root) AS root FROM reach GROUP BY rep),
degrees AS (SELECT a AS rep, sum(copies) AS docs, count(*) AS texts FROM links GROUP BY a)
SELECT t.doc_id, coalesce(r.root, t.doc_id) AS class_id,
  CAST(coalesce(d.docs, 0) + coalesce(c.copies, 1) - 1 AS BIGINT) AS n_links,
  CAST(coalesce(d.texts, 0) AS BIGINT) AS n_link_texts,
  coalesce(c.rep, t.doc_id) AS copy_id, CAST(coalesce(c.copies, 1) AS BIGINT) AS n_copies
FROM sets t LEFT JOIN classes c ON t.s = c.s LEFT JOIN roots r ON r.rep = c.rep LEFT JOIN degrees d ON d.rep = c.rep
"""

_LINES = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS raw FROM documents),
numbered AS (
  SELECT doc_id, text, raw, list_filter(range(1, len(raw) + 1), lambda k: regexp_matches(raw[k], '{_WORD}')) AS pos FROM split),
starts AS (
  SELECT *, unnest(range(1, len(pos) + 1)) AS i
  FROM (SELECT *, list_transform(pos, lambda k: len(regexp_extract_all(raw[k], '{_WORD}'))) AS words FROM numbered)),
windows AS (
  SELECT doc_id, i, size, list_transform(range(i, i + size), lambda k: raw[pos[k]]) AS w
  FROM starts, (SELECT unnest(range(1, {RUN} + 1)) AS size)
  WHERE i + size <= len(pos) + 1 AND (size = {RUN} OR list_sum(words[i:i + size - 1]) >= {WORDS})),
earliest AS (SELECT w, min((doc_id, i)) AS e FROM windows GROUP BY w),
late AS (SELECT DISTINCT doc_id, i, size FROM windows JOIN earliest USING (w) WHERE (doc_id, i) > e),
cut AS (SELECT doc_id, list_sort(list(DISTINCT k)) AS gone FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM late) GROUP BY doc_id)
SELECT n.doc_id, CAST(len(pos) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  CAST(coalesce(len(list_filter(gone, lambda k: NOT list_contains(gone, k - 1))), 0) AS BIGINT) AS n_runs,
  sha256(CASE WHEN gone IS NULL THEN text ELSE array_to_string(
    list_transform(list_filter(range(1, len(raw) + 1), lambda k: NOT list_contains(list_transform(gone, lambda g: pos[g]), k)), lambda k: raw[k]), chr(10)) END) AS kept_sha256
FROM numbered n LEFT JOIN cut c ON n.doc_id = c.doc_id
"""

_MIX = rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
    coalesce(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 7) AS BIGINT), 0) AS shuffle FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM docs GROUP BY source),
weighted AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][1 + r % {len(WEIGHTS)}] AS w FROM sources),
levels AS (
  SELECT *, sum(source_size) OVER () - {MAX_EPOCHS} * coalesce(sum(source_size) OVER before, 0) AS pool, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS shares
  FROM weighted WINDOW before AS (ORDER BY {MAX_EPOCHS} * source_size / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min(pool, {MAX_EPOCHS} * source_size / w) AS pool, arg_min(shares, {MAX_EPOCHS} * source_size / w) AS shares
  FROM levels WHERE {MAX_EPOCHS} * source_size * shares >= pool * w),
goals AS (
  SELECT source, source_size, r,
    CASE WHEN {MAX_EPOCHS} * source_size * shares < pool * w THEN CAST({MAX_EPOCHS} * source_size AS DOUBLE) ELSE CAST(w * pool AS DOUBLE) / CAST(shares AS DOUBLE) END AS target
  FROM weighted, level),
queued AS (
  SELECT d.*, g.source_size, g.target, g.r,
    CAST(sum(size) OVER (PARTITION BY g.r ORDER BY shuffle, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
entries AS (SELECT *, e, CAST(e * source_size + upto AS DOUBLE) / target AS finish FROM queued, (SELECT unnest(range({MAX_EPOCHS})) AS e) WHERE size > 0),
running AS (SELECT *, sum(size) OVER (ORDER BY finish, r, e, shuffle, doc_id, upto ROWS UNBOUNDED PRECEDING) AS used FROM entries),
taken AS (SELECT doc_id, r, upto, sum(size) AS taken FROM running WHERE used <= (SELECT sum(size) FROM docs) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id IS NOT DISTINCT FROM t.doc_id AND q.r = t.r AND q.upto = t.upto AND q.size > 0
"""

_SUFFIX = rf"""
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, {2 * SPAN}) AS w FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - {SPAN - 1})) AS i FROM raw)),
first AS (SELECT w, min(doc_id) AS d FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i FROM windows JOIN first USING (w) WHERE doc_id > d),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + {SPAN} AS z FROM (
    SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
      SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > {SPAN}, TRUE) AS fresh FROM gone))
  GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM runs GROUP BY doc_id)
SELECT r.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes,
  CAST(coalesce(list_sum(list_transform(range(1, len(a) + 1), lambda k: z[k] - a[k])), 0) AS BIGINT) AS n_removed,
  CAST(coalesce(len(a), 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN a IS NULL THEN h ELSE array_to_string(
    list_transform(range(0, len(a) + 1), lambda k: substr(h, CASE WHEN k = 0 THEN 1 ELSE 2 * z[k] + 1 END,
      (CASE WHEN k = len(a) THEN len(h) ELSE 2 * a[k + 1] END) - (CASE WHEN k = 0 THEN 0 ELSE 2 * z[k] END))), '') END)) AS kept_sha256
FROM raw r LEFT JOIN kept k ON r.doc_id = k.doc_id
"""

# CRC-32 of an id's decimal digits, bit by bit
_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda acc, byte: list_reduce(list_concat([xor(acc, byte)], range(8)), lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END)), CAST(4294967295 AS BIGINT))"""

_TRIE = f"""
WITH keyed AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS nb
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, k, nb, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM keyed),
convs AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {_CRC} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM keyed)),
seq AS (
  SELECT c.conv_id, 1 AS part, t.pos, t.k, t.nb FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT t.conv_id, 2, t.pos, t.k, t.nb FROM turns t JOIN convs c ON t.conv_id = c.conv_id AND t.pos > c.h),
paths AS (SELECT conv_id, list(k ORDER BY part, pos) AS p, list(nb ORDER BY part, pos) AS b FROM seq GROUP BY conv_id),
members AS (
  SELECT conv_id, d, array_to_string(p[1:d], '') AS node, array_to_string(p[1:d - 1], '') AS up, CASE WHEN d = 0 THEN 0 ELSE b[d] END AS nb, d = len(p) AS done
  FROM (SELECT c.conv_id, coalesce(p, []) AS p, coalesce(b, []) AS b, unnest(range(0, len(coalesce(p, [])) + 1)) AS d FROM convs c LEFT JOIN paths USING (conv_id))),
nodes AS (
  SELECT d, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n, any_value(nb) AS nb, bool_and(done) AS leaf,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE done), '') AS ends
  FROM members GROUP BY d, node),
below AS (
  SELECT m.d, m.node, sum((b.n - 1) * b.nb) AS saved, count(*) FILTER (WHERE b.leaf) AS leaves, count(*) FILTER (WHERE b.d = m.d + 1) AS kids
  FROM nodes b JOIN members m ON m.conv_id = b.conv_id AND m.d <= b.d GROUP BY m.d, m.node)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, CASE WHEN x.d > 0 THEN p.conv_id END AS parent_conv_id, CAST(x.n AS BIGINT) AS n_convs,
  CAST(b.kids AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM nodes x JOIN below b ON b.d = x.d AND b.node = x.node LEFT JOIN nodes p ON p.d = x.d - 1 AND p.node = x.up
"""


def _kmeans(k: int = 16, dims: int = 64, rounds: int = 3) -> str:
    square = "CAST(list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - m.v[i]) * (x.v[i] - m.v[i]))) AS BIGINT)"

    def near(r: int) -> str:
        return f"""near{r} AS MATERIALIZED (
  SELECT row_id, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(c, d * {k} + c) AS c, min(d) AS d
  FROM (SELECT x.row_id, x.vec_id, x.v, m.c, {square} AS d FROM kept x, mid{r} m) GROUP BY row_id)"""

    def mid(r: int) -> str:
        return f"""mid{r} AS MATERIALIZED (
  SELECT o.c, coalesce(f.v, o.v) AS v FROM mid{r - 1} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
    FROM (SELECT c, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT c, unnest(range({dims})) AS i, unnest(v) AS x FROM near{r - 1}) GROUP BY c, i)
    GROUP BY c) f ON f.c = o.c)"""

    steps = [near(0)] + [s for r in range(1, rounds + 1) for s in (mid(r), near(r))]
    return f"""
WITH whole AS (
  SELECT vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id,
    list_transform(e, lambda x: CAST(greatest(least(floor({SCALE} * CAST(x AS DOUBLE)), {LIMIT}), -{LIMIT}) AS BIGINT)) AS v FROM whole),
mid0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept WHERE vec_id IS NOT NULL QUALIFY c < {k}),
{", ".join(steps)},
total AS (SELECT c, CAST(sum(d) AS BIGINT) AS s FROM near{rounds} GROUP BY c)
SELECT n.vec_id, CAST(n.c AS INTEGER) AS cluster, CAST(n.d AS BIGINT) AS distance, t.s AS cluster_inertia,
  (SELECT CAST(sum(s) AS BIGINT) FROM total) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM near{rounds} n JOIN total t ON t.c = n.c JOIN mid{rounds} m ON m.c = n.c
"""


ORACLES = {
    "op1_ngram_jaccard": _JACCARD,
    "op5_line_dedup": _LINES,
    "op7_mixing": _MIX,
    "op10_suffix_dedup": _SUFFIX,
    "op12_prefix_trie": _TRIE,
    "op13_clustering": _kmeans(),
}

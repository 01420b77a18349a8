"""What operators 4, 6, 7, 8 and 9 return, as DuckDB SQL over the whole tables; doc_ids are taken to be there and unique."""

from __future__ import annotations

from .pii import PRIOR, SUPPORT, THRESHOLDS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def suffixes_sql(documents: str = "documents", length: int = 100) -> str:
    """Bytes are pairs of hexadecimal digits."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, (length(hex(encode(coalesce(text, '')))) // 2)::BIGINT AS n FROM {documents}),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, {2 * length})) AS k FROM (SELECT doc_id, h, unnest(generate_series(0, n - {length})) AS s FROM d WHERE n >= {length})),
firsts AS (SELECT k, min((doc_id, s)) AS one FROM w GROUP BY k HAVING count(*) > 1),
gone AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS step FROM w JOIN firsts USING (k) WHERE (doc_id, s) > one),
runs AS (SELECT doc_id, s, step, sum(CASE WHEN step IS NULL OR step > {length} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM gone),
cut AS (SELECT doc_id, run, min(s) AS a, max(s) + {length} AS b FROM runs GROUP BY ALL),
pieces AS (SELECT c.doc_id, a, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY c.doc_id ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY c.doc_id ORDER BY a), 0))) AS piece FROM cut c JOIN d ON c.doc_id = d.doc_id),
kept AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS h FROM pieces GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last FROM cut GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN d.h ELSE kept.h || substr(d.h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def minhash_sql(documents: str = "documents", percent: int = 80) -> str:
    """Equal sets are one node; all pairs of nodes that share a shingle are compared, and reach each other in steps."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_BLANK}) AS w FROM {documents}),
sets AS (SELECT doc_id, CASE WHEN len(w) > 1 THEN list_sort(list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) ELSE w END AS items FROM d),
nodes AS (SELECT min(doc_id) AS node, any_value(items) AS items, md5(array_to_string(items, chr(10))) AS k FROM sets WHERE len(items) > 0 GROUP BY k),
each AS (SELECT node, len(items) AS n, unnest(items) AS item FROM nodes),
links AS (
  SELECT a.node AS a, b.node AS b FROM each a JOIN each b ON a.item = b.item AND a.node < b.node AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (SELECT node, node FROM nodes UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON r.node = e.a WHERE r.root < e.b),
label AS (SELECT node, min(root) AS component FROM reach GROUP BY node)
SELECT s.doc_id, len(s.items)::BIGINT AS n_shingles, coalesce(component, s.doc_id) AS component_id, coalesce(component, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN nodes ON len(s.items) > 0 AND k = md5(array_to_string(s.items, chr(10))) LEFT JOIN label ON label.node = nodes.node"""


def decontam_sql(documents: str = "documents", benchmark: str = "benchmark", n: int = 10) -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM {documents}),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM {benchmark}),
wins AS (SELECT DISTINCT item, least({n}, len(w)) AS m, array_to_string(list_slice(w, s, s + least({n}, len(w)) - 1), ' ') AS k FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - {n - 1}))) AS s FROM b WHERE len(w) > 0)),
found AS (
  SELECT doc_id, s, x.m, item FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS s FROM d, (SELECT DISTINCT m FROM wins) WHERE len(w) >= m) x
  JOIN wins ON wins.m = x.m AND wins.k = array_to_string(list_slice(w, s, s + x.m - 1), ' ')),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + m - 1)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


def substrings_sql(documents: str = "documents", length: int = 13) -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_BLANK}) AS w FROM {documents}),
w AS (SELECT doc_id, s, md5(array_to_string(list_slice(w, s, s + {length - 1}), ' ')) AS k FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {length - 1})) AS s FROM d WHERE len(w) >= {length})),
firsts AS (SELECT k, min(doc_id) AS one FROM w GROUP BY k),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(generate_series(s, s + {length - 1})) AS p FROM w JOIN firsts USING (k) WHERE doc_id > one) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(list_filter(generate_series(1, len(w)), lambda i: NOT list_contains(ps, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)"""


_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_bool_and(list_transform(string_split(v, '.'), lambda p: length(ltrim(p, '0')) <= 3 AND coalesce(try_cast(p AS HUGEINT), 256) <= 255))"),
    ("card", r"[0-9]([\x20-]?[0-9])+", "length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(generate_series(1, length(digits)), lambda i: (CASE WHEN i % 2 = 0 THEN list_sum(list_transform(string_split((2 * reverse(digits)[i]::INT)::VARCHAR, ''), lambda c: c::INT)) ELSE reverse(digits)[i]::INT END))) % 10 = 0"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 9 AND 15"),
)
_TERM = r"\p{L}{3,}"


def _placed(pattern: str) -> str:
    """doc_id, v, a, b of the matches of a pattern: before each stands what the text is split into, and the matches before."""
    return f"""SELECT doc_id, v, (a + before)::BIGINT AS a, (a + before + length(v))::BIGINT AS b FROM (
    SELECT doc_id, unnest(vs) AS v, unnest(list_transform(generate_series(1, len(vs)), lambda i: list_sum(list_transform(parts[:i], lambda x: length(x))))) AS a,
      unnest(list_transform(generate_series(1, len(vs)), lambda i: coalesce(list_sum(list_transform(vs[:i - 1], lambda x: length(x))), 0))) AS before
    FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS vs, string_split_regex(text, '{pattern}') AS parts FROM t) WHERE len(vs) > 0)"""


def pii_sql(documents: str = "documents") -> str:
    kinds = ",\n".join(
        f"k{i} AS (SELECT doc_id, {i} AS kind, a, b, v, digits FROM (SELECT *, regexp_replace(v, '[^0-9]', '', 'g') AS digits FROM ({_placed(p)})) WHERE {ok})" for i, (_, p, ok) in enumerate(_KINDS)
    )
    names = " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _, _) in enumerate(_KINDS))
    level = lambda values: "CASE level " + " ".join(f"WHEN {i} THEN {float(v)}::DOUBLE" for i, v in enumerate(values)) + " END"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM {documents}),
{kinds},
base AS (SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2 UNION ALL SELECT * FROM k3),
words AS (SELECT doc_id, lower(v) AS term, a, b FROM ({_placed(_TERM)})),
holds AS (
  SELECT DISTINCT doc_id, 0 AS level, kind || ':' || CASE WHEN kind <= 1 THEN lower(v) ELSE digits END AS entity FROM base
  UNION SELECT DISTINCT doc_id, 1, kind || ':' || CASE kind WHEN 0 THEN lower(string_split(v, '@')[-1]) WHEN 1 THEN array_to_string(string_split(v, '.')[:3], '.') WHEN 2 THEN digits[:6] ELSE digits[:4] END FROM base
  UNION SELECT DISTINCT doc_id, 2, kind::VARCHAR FROM base),
ids AS (SELECT doc_id, md5(text) AS id FROM t),
n AS (SELECT count(*) AS n FROM t),
terms AS (SELECT term, count(DISTINCT doc_id) AS n_term FROM words GROUP BY term),
entities AS (SELECT level, entity, count(*) AS n_entity FROM holds GROUP BY ALL),
pairs AS (SELECT level, entity, term, count(*) AS both_, count(DISTINCT id) AS texts FROM holds JOIN (SELECT DISTINCT doc_id, term FROM words) USING (doc_id) JOIN ids USING (doc_id) GROUP BY ALL HAVING texts >= {SUPPORT}),
told AS (
  SELECT level, entity, term FROM pairs JOIN terms USING (term) JOIN entities USING (level, entity), n
  WHERE n_entity < n AND ln(both_ * n / ((n_term + {level(PRIOR)}) * n_entity)) / ln(n / n_entity) >= {level(THRESHOLDS)}),
clues AS (
  SELECT DISTINCT w.doc_id, 4 AS kind, w.a, w.b FROM words w JOIN holds USING (doc_id) JOIN told USING (level, entity, term)
  WHERE NOT EXISTS (SELECT 1 FROM base s WHERE s.doc_id = w.doc_id AND s.a < w.b AND w.a < s.b)),
spans AS (SELECT doc_id, kind, a, b, CASE kind {names} ELSE 'term' END || ':' || a || ':' || b AS s FROM (SELECT doc_id, kind, a, b FROM base UNION ALL SELECT * FROM clues)),
per_doc AS (
  SELECT doc_id, {', '.join(f"count_if(kind = {i})::BIGINT AS n_{k}" for i, (k, _, _) in enumerate(_KINDS))},
    coalesce(string_agg(s, ',' ORDER BY a, kind) FILTER (kind < 4), '') AS base, string_agg(s, ',' ORDER BY a, kind) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k, _, _ in _KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN per_doc USING (doc_id)"""

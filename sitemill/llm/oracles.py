"""DuckDB SQL with the same rows as the queries, for the operators that SQL can express."""

from __future__ import annotations

from .common import LOWER, UPPER
from .url_filter import ALIKE_Z, DEPTH, FANOUT, PRIOR, REJECT, RULES, SMOOTHING

OP1 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(i, j) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.i, l.j FROM reach r JOIN links l ON l.i = r.j)
SELECT vec_id, (SELECT count(*) FROM links WHERE i = vec_id) AS n_links, (SELECT min(j) FROM reach WHERE i = vec_id) AS component_id,
  vec_id = (SELECT min(j) FROM reach WHERE i = vec_id) AS kept
FROM v"""

OP2 = f"""
WITH split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
tok AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS p FROM split),
g AS (SELECT *, lag(a, 1) OVER d AS b, lag(a, 2) OVER d AS c FROM tok WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
n AS (SELECT count(*) AS total FROM tok),
size AS (SELECT doc_id, greatest(total - len(w), 1) AS size, len(w) AS n_tokens FROM split, n),
c1 AS (SELECT a, count(*) AS k FROM g GROUP BY a), d1 AS (SELECT doc_id, a, count(*) AS m FROM g GROUP BY ALL),
c2 AS (SELECT b, a, count(*) AS k FROM g WHERE b IS NOT NULL GROUP BY ALL), d2 AS (SELECT doc_id, b, a, count(*) AS m FROM g WHERE b IS NOT NULL GROUP BY ALL),
c3 AS (SELECT c, b, a, count(*) AS k FROM g WHERE c IS NOT NULL GROUP BY ALL), d3 AS (SELECT doc_id, c, b, a, count(*) AS m FROM g WHERE c IS NOT NULL GROUP BY ALL),
o AS (
  SELECT g.doc_id, g.p, c1.k - d1.m AS o1, c2.k - d2.m AS o2, c3.k - d3.m AS o3
  FROM g JOIN c1 ON c1.a = g.a JOIN d1 ON d1.doc_id = g.doc_id AND d1.a = g.a
  LEFT JOIN c2 ON c2.b = g.b AND c2.a = g.a LEFT JOIN d2 ON d2.doc_id = g.doc_id AND d2.b = g.b AND d2.a = g.a
  LEFT JOIN c3 ON c3.c = g.c AND c3.b = g.b AND c3.a = g.a LEFT JOIN d3 ON d3.doc_id = g.doc_id AND d3.c = g.c AND d3.b = g.b AND d3.a = g.a),
prior AS (SELECT *, lag(o1) OVER d AS p1, lag(o2) OVER d AS p2 FROM o WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
s1 AS (SELECT *, log10(greatest(o1, 1) / size) + CASE WHEN o1 > 0 THEN 0 ELSE log10(0.4) END AS s FROM prior JOIN size USING (doc_id)),
s2 AS (SELECT * REPLACE (CASE WHEN o2 > 0 AND p1 > 0 THEN log10(o2) - log10(p1) ELSE s + CASE WHEN o2 IS NULL THEN 0 ELSE log10(0.4) END END AS s) FROM s1),
s3 AS (SELECT * REPLACE (CASE WHEN o3 > 0 AND p2 > 0 THEN log10(o3) - log10(p2) ELSE s + CASE WHEN o3 IS NULL THEN 0 ELSE log10(0.4) END END AS s) FROM s2),
sums AS (SELECT doc_id, sum(s) AS s FROM s3 GROUP BY doc_id)
SELECT doc_id, n_tokens, round(coalesce(s, 0), 4) AS log10_score, CASE WHEN n_tokens > 0 THEN round(s / n_tokens, 4) END AS mean_log10
FROM size LEFT JOIN sums USING (doc_id)"""

OP7 = """
WITH a AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '') AS body FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(regexp_replace(body, '<br>', ' ', 'g'), '</?(?:p|h1)>'), lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) AS x FROM a),
c AS (SELECT page_id, url, list_transform(x, lambda t: regexp_replace(replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '&amp([^;a-zA-Z0-9]|$)', '&\\1')) AS x FROM b),
d AS (SELECT page_id, url, array_to_string(list_filter(list_transform(x, lambda t: trim(regexp_replace(t, '\\s+', ' ', 'g'))), lambda t: t <> ''), chr(10)) AS text FROM c)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM d"""

#: crc32 of a line's digits, a byte at a time and a bit at a time.
OP12 = """
WITH parts AS (
  SELECT sale_id, line_no, item_id, CAST(floor(100.0 * CAST(amount AS DOUBLE) + 0.5) AS BIGINT) AS a, CAST(quantity AS BIGINT) AS q FROM sale_lines
  WHERE sale_id IS NOT NULL AND item_id IS NOT NULL AND quantity <> 0 AND amount IS NOT NULL),
l AS (SELECT sale_id, line_no, item_id, CAST(((2 * a + q) - (((2 * a + q) % (2 * q)) + 2 * q) % (2 * q)) // (2 * q) AS BIGINT) AS u, concat(sale_id, ',', line_no, ',', item_id) AS s FROM parts),
crc AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
    lambda c, x: list_reduce(list_prepend(xor(c, x), CAST(range(8) AS BIGINT[])), lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295) AS crc
  FROM l),
i AS (SELECT item_id, CAST(floor(100.0 * CAST(price AS DOUBLE) + 0.5) AS BIGINT) AS p FROM items),
pairs AS (
  SELECT i.item_id, abs(u - p) AS gap, u, sale_id, line_no, l.item_id AS line_item_id, crc
  FROM i JOIN crc l ON u BETWEEN p - 50 - p // 100 AND p + 50 + p // 100 WHERE l.item_id <> i.item_id AND (abs(u - p) <= 50 OR 1000 * abs(u - p) <= 5 * least(u, p))),
first AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY gap, u, sale_id, line_no, line_item_id) AS rank FROM pairs QUALIFY rank <= 10),
sums AS (SELECT item_id, count(*) AS n_pairs, CAST(sum(gap) AS BIGINT) AS gap_sum, CAST(sum(crc) AS BIGINT) AS lines_crc FROM pairs GROUP BY item_id)
SELECT i.item_id, CAST(coalesce(rank, 0) AS INTEGER) AS rank, gap, u, sale_id, CAST(line_no AS BIGINT) AS line_no, line_item_id,
  coalesce(n_pairs, 0) AS n_pairs, coalesce(gap_sum, 0) AS gap_sum, coalesce(lines_crc, 0) AS lines_crc
FROM i LEFT JOIN sums ON sums.item_id = i.item_id LEFT JOIN first ON first.item_id = i.item_id"""

#: Every 400 bytes of every text by digest, then islands of covered bytes.
OP13 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT doc_id, list_transform(range(1, octet_length(b) - 398), lambda s: md5(array_slice(b, s, s + 399))) AS h FROM d),
w AS (SELECT doc_id, unnest(h) AS h, generate_subscripts(h, 1) AS s FROM h),
twice AS (SELECT doc_id, s FROM w QUALIFY count(*) OVER (PARTITION BY h) > 1),
edge AS (SELECT doc_id, s, coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > 400, true) AS opens FROM twice),
island AS (SELECT doc_id, s, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM edge),
span AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS e FROM island GROUP BY doc_id, k),
gone AS (SELECT doc_id, sum(e - a) AS n, count(*) AS k FROM span GROUP BY doc_id),
cuts AS (SELECT doc_id, a, e FROM span UNION ALL SELECT doc_id, octet_length(b) + 1, octet_length(b) + 1 FROM d),
part AS (SELECT doc_id, a, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a, e), 1) AS f FROM cuts),
kept AS (SELECT doc_id, string_agg(CASE WHEN a > f THEN hex(array_slice(b, f, a - 1)) ELSE '' END, '' ORDER BY a, f) AS h FROM part JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(k, 0) AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""


def op4() -> str:
    """The template tree level by level, as nested tables."""
    whens = []
    for what, text in sorted(RULES, key=lambda r: -len(r[1])):
        name, slash, prefix = text.partition("/")
        whens.append((f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + prefix}')", text, what))
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for c, t, _ in whens) + " END"
    fixed = "CASE " + " ".join(f"WHEN {c} THEN '{w}'" for c, _, w in whens) + " END"
    shape = (
        "regexp_replace(regexp_replace(regexp_replace(x, '\\d{4}-\\d{2}-\\d{2}', '{date}', 'g'), "
        "'\\b[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\\b|\\b[0-9a-fA-F]{12,}\\b', '{hex}', 'g'), '\\d+', '{n}', 'g')"
    )
    levels = []
    for k in range(2, DEPTH + 1):
        old, new = f"t{k - 1}", f"t{k}"
        levels.append(f"""
kids{k} AS (SELECT host, template, seg[{k}] AS s, count(*) AS n FROM {old} WHERE len(seg) >= {k} GROUP BY ALL),
wild{k} AS (SELECT host, template FROM kids{k} GROUP BY ALL HAVING count(*) > {FANOUT} AND 2 * count(*) FILTER (n <= 2) > count(*)),
{new} AS (
  SELECT {old}.host, path, n, label, seg, CASE WHEN len(seg) < {k} THEN {old}.template WHEN w.host IS NOT NULL THEN concat({old}.template, '/*') ELSE concat({old}.template, '/', seg[{k}]) END AS template
  FROM {old} LEFT JOIN wild{k} w ON w.host = {old}.host AND w.template = {old}.template)""")
    return f"""
WITH parts AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
base AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
judged AS (SELECT *, {rule} AS rule, {fixed} AS fixed FROM base),
paths AS (SELECT host, path, count(*) AS n, max(fixed) AS label, list_transform(string_split(path, '/'), lambda x: {shape}) AS s FROM judged GROUP BY host, path),
t1 AS (SELECT host, path, n, label, CASE WHEN len(s) > {DEPTH} THEN list_append(s[1:{DEPTH}], array_to_string(s[{DEPTH + 1}:], '/')) ELSE s END AS seg, s[1] AS template FROM paths),{",".join(levels)},
t AS (SELECT host, path, n, label, CASE WHEN len(seg) > {DEPTH} THEN concat(template, '/', seg[{DEPTH + 1}]) ELSE template END AS template FROM t{DEPTH}),
nodes AS (SELECT host, template, coalesce(sum(n) FILTER (label IS NOT NULL), 0) AS n, coalesce(sum(n) FILTER (label = 'block'), 0) AS bad, regexp_replace(template, '^(.*/)?([^/{{}}*]+)((/[^/]*[{{*][^/]*)*/?)$', '\\1?\\3') AS parent FROM t GROUP BY host, template),
family AS (SELECT host, parent, sum(n) AS fn, sum(bad) AS fbad, count(*) AS kin, sum((bad + {SMOOTHING * PRIOR}) / (n + {SMOOTHING})) AS pure FROM nodes WHERE n > 0 GROUP BY ALL),
alike AS (
  SELECT nodes.*, fn, fbad, kin, pure, n = 0 AND kin IS NOT NULL AS joins, n > 0 AND (fbad = 0 OR fbad = fn OR abs(bad - n * (fbad / fn)) / sqrt(n * (fbad / fn) * (1 - fbad / fn)) < {ALIKE_Z}) AS same
  FROM nodes LEFT JOIN family USING (host, parent)),
judged_nodes AS (SELECT host, template, CASE WHEN same OR joins THEN parent ELSE template END AS merged, round(CASE WHEN joins THEN (pure + {SMOOTHING * PRIOR}) / (kin + {SMOOTHING}) ELSE (CASE WHEN same THEN fbad ELSE bad END + {SMOOTHING * PRIOR}) / (CASE WHEN same THEN fn ELSE n END + {SMOOTHING}) END, 9) AS purity FROM alike)
SELECT page_id, j.host, j.path, rule, coalesce(fixed, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, merged AS template, CAST(purity AS DOUBLE) AS purity
FROM judged j JOIN t ON t.host = j.host AND t.path = j.path JOIN judged_nodes p ON p.host = t.host AND p.template = t.template"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_near_dedup": OP1,
        "op2_lm_scoring": OP2,
        "op4_url_filter": op4(),
        "op7_html_extraction": OP7,
        "op12_numeric_band_join": OP12,
        "op13_suffix_array_dedup": OP13,
    }

"""DuckDB SQL of the registered queries, over the driver's views."""

URL_FILTER = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule, rhost, rpath, rverdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
globs(no, pattern, regex, gverdict) AS (VALUES
  (1, '', '', 'block'), (2, '**/login**', '[\s\S]*/login[\s\S]*', 'block'),
  (3, '**/cart/**', '[\s\S]*/cart/[\s\S]*', 'block'), (4, '**/tag?/**', '[\s\S]*/tag[^/]/[\s\S]*', 'block'),
  (5, '*.example.net/de/**', '[^/]*\.example\.net/de/[\s\S]*', 'block'),
  (6, 'ads.**', 'ads\.[\s\S]*', 'block'), (7, 'ads.*/privacy', 'ads\.[^/]*/privacy', 'allow')),
k AS (SELECT row_number() OVER () AS k, * FROM p),
fit AS (
  SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(rverdict, length(rule)) AS rverdict FROM k, rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY k),
own AS (
  SELECT k, arg_max(pattern, no) AS pattern, arg_max(gverdict, no) AS gverdict FROM k, globs
  WHERE regexp_full_match(host || path, regex) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(rverdict, gverdict, 'allow') AS verdict,
       CASE WHEN rule IS NULL THEN pattern END AS pattern
FROM k LEFT JOIN fit USING (k) LEFT JOIN own USING (k)
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_FOLD.format('text')}, '{_ALNUM}') AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_FOLD.format('text')}, '{_ALNUM}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
places AS (
  SELECT k, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win))),
hits AS (SELECT k, places.n, p, item FROM places JOIN win USING (n, g)),
pos AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + n)) AS q FROM hits) GROUP BY k),
its AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
        FROM (SELECT DISTINCT k, item FROM hits) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (k) LEFT JOIN its USING (k)
"""

_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, {a}, 5) AS BIGINT) >> {s}) & 31 AS BIGINT) + 1, 1)"
    for a in range(1, 41, 5) for s in (15, 10, 5, 0))

WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT b, min(page_id) AS first_id FROM p GROUP BY b)
SELECT page_id, CAST(octet_length(p.b) AS BIGINT) AS payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p JOIN g ON p.b = g.b
"""


def license_scan(base, notices, k, gap, least_cover, most_stretch) -> str:
    rows = ", ".join(f"({i}, '{t}', '{label}', {i < len(base)})" for i, (t, label) in enumerate([*base, *notices]))
    gram = " || ' ' || ".join(f"w[p + {j}]" for j in range(k))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_FOLD.format('text')}, '{_ALNUM}') AS w FROM documents),
t AS (SELECT t, string_split(txt, ' ') AS w, label, is_base FROM (VALUES {rows}) v(t, txt, label, is_base)),
dg AS (SELECT d, p - 1 AS p, {gram} AS g FROM (SELECT d, w, unnest(range(1, len(w) - {k} + 2)) AS p FROM d)),
tg AS (SELECT t, len(w) AS n, label, is_base, p - 1 AS q, {gram} AS g
       FROM (SELECT t, w, label, is_base, unnest(range(1, len(w) - {k} + 2)) AS p FROM t)),
hit AS (SELECT d, t, n, label, is_base, p - q AS diag, q FROM dg JOIN tg USING (g)),
vote AS (SELECT d, t, n, label, is_base, diag, count(*) AS votes, min(q + diag) AS lo, max(q + diag) + {k} AS hi FROM hit GROUP BY ALL),
step AS (SELECT *, CASE WHEN diag - lag(diag) OVER (PARTITION BY d, t ORDER BY diag) > {gap} THEN 1 ELSE 0 END AS new FROM vote),
span AS (SELECT *, sum(new) OVER (PARTITION BY d, t ORDER BY diag) AS s FROM step),
covered AS (
  SELECT d, t, s, count(DISTINCT c) AS c FROM (
    SELECT h.d, h.t, s, unnest(range(q, q + {k})) AS c FROM hit h JOIN span USING (d, t, diag)) GROUP BY ALL),
merged AS (
  SELECT d, t, s, any_value(n) AS n, any_value(label) AS label, any_value(is_base) AS is_base, min(lo) AS lo, max(hi) AS hi,
         count(*) FILTER (is_base AND votes = n - {k} + 1) AS places,
         min(diag) FILTER (is_base AND votes = n - {k} + 1) AS first_word,
         max(diag) FILTER (is_base AND votes = n - {k} + 1) AS last_word
  FROM span GROUP BY d, t, s),
judged AS (
  SELECT *, CASE WHEN hi - lo <= {most_stretch} * n THEN c / n END AS cover FROM merged JOIN covered USING (d, t, s)),
per AS (
  SELECT d, sum(places) AS n_base, min(first_word) AS first_word, max(last_word) AS last_word, max(cover) AS score,
    list_sort(list_distinct(list(label) FILTER (is_base AND places > 0))) AS bl,
    list_sort(list_distinct(list(label) FILTER ((is_base AND places > 0) OR (NOT is_base AND cover >= {least_cover})))) AS al
  FROM judged GROUP BY d)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(bl, ','), '') AS base_labels, coalesce(array_to_string(al, ','), '') AS labels,
       coalesce(score, 0.0) AS score
FROM d LEFT JOIN per USING (d)
"""


def _enc(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"


def _climb(nodes: str, rows: str, n: int) -> str:
    """``n`` levels over ``{nodes}0`` (s, i, d), and the rows ``{rows}0`` (r, s, j, proof, f) carried up them."""
    parts = []
    for k in range(n):
        parts.append(f"""{nodes}{k}m AS MATERIALIZED (SELECT s FROM {nodes}{k} GROUP BY s HAVING count(*) > 1),
{nodes}{k + 1} AS MATERIALIZED (SELECT s, i // 3 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d
  FROM {nodes}{k} SEMI JOIN {nodes}{k}m USING (s) GROUP BY s, i // 3),
{rows}{k + 1} AS MATERIALIZED (
  SELECT r, x.s, any_value(x.j) // 3 AS j, any_value(x.proof) || coalesce(string_agg(d, '' ORDER BY i) FILTER (i <> j), '') AS proof,
    sha256(string_agg(CASE WHEN i = j THEN f ELSE d END, '' ORDER BY i)) AS f
  FROM {rows}{k} x JOIN {nodes}{k} y ON x.s = y.s AND x.j // 3 = y.i // 3 SEMI JOIN {nodes}{k}m ON x.s = {nodes}{k}m.s GROUP BY r, x.s
  UNION ALL SELECT r, s, j, proof, f FROM {rows}{k} ANTI JOIN {nodes}{k}m USING (s))""")
    return ",\n".join(parts)


def merkle(levels: int = 12, top_levels: int = 4) -> str:
    """Trees of up to 3 ** ``levels`` leaves a source and 3 ** ``top_levels`` sources. The checksum runs over the id's
    digits bit by bit: each character, then eight shifts."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    crc = """list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
      lambda p: list_prepend(CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(p AS BIGINT), 1)) AS BIGINT), [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)"""
    subs = " UNION ALL ".join(f"SELECT s, d FROM l{k} ANTI JOIN l{k}m USING (s)" for k in range(levels))
    roots = " UNION ALL ".join(f"SELECT d FROM u{k} ANTI JOIN u{k}m USING (s)" for k in range(top_levels))
    tampered = " || ".join(_enc(c) for c in fields[:-1]) + " || " + _enc("cut")
    return rf"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS s,
    sha256({" || ".join(_enc(c) for c in fields)}) AS leaf,
    sha256({tampered}) AS tampered
  FROM (SELECT *, CASE WHEN (xor({crc}, 4294967295)) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut FROM documents)),
n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j FROM e),
l0 AS MATERIALIZED (SELECT s, j AS i, leaf AS d FROM n),
x0 AS MATERIALIZED (SELECT r, s, j, '' AS proof, tampered AS f FROM n),
{_climb('l', 'x', levels)},
sub AS MATERIALIZED ({subs}),
u0 AS MATERIALIZED (SELECT 0 AS s, row_number() OVER (ORDER BY encode(s)) - 1 AS i, d FROM sub),
o AS MATERIALIZED (SELECT s AS src, row_number() OVER (ORDER BY encode(s)) - 1 AS j FROM sub),
y0 AS MATERIALIZED (SELECT r, 0 AS s, o.j, proof, f FROM x{levels} x JOIN o ON x.s = o.src),
{_climb('u', 'y', top_levels)},
root AS MATERIALIZED ({roots})
SELECT n.doc_id, leaf, sub.d AS subroot, root.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = root.d AS verified
FROM n JOIN sub ON n.s = sub.s JOIN y{top_levels} y ON n.r = y.r CROSS JOIN root
"""


MERKLE = merkle()

HARD_NEGATIVES = """
WITH r AS MATERIALIZED (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS MATERIALIZED (
  SELECT a.k AS ak, a.vec_id AS anchor_id, r.k, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r a JOIN r ON a.vec_id % 100 = 0 AND a.k <> r.k),
p AS (SELECT ak, k, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY ak ORDER BY score DESC, vec_id NULLS LAST, k) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM s JOIN p ON s.ak = p.ak AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.ak, p.k ORDER BY score DESC, vec_id NULLS LAST, s.k)
QUALIFY row_number() OVER w <= 10
"""

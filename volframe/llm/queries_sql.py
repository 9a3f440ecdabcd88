"""SQL for DuckDB of the queries op11, op12 and op13."""

from __future__ import annotations

UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

#: CRC-32 as in RFC 1952, from its polynomial: a table of bytes, then a fold over a string's bytes in UTF-8.
CRC32 = """
t AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
b AS (SELECT doc_id, r, n, flatten(list_transform(string_split(doc_id || ':' || r, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END)) AS bytes FROM runs),
h AS (SELECT doc_id, r, n, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, t)"""

OP11 = f"""
WITH RECURSIVE runs AS (SELECT doc_id, r, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents) WHERE length(r) >= 6 GROUP BY 1, 2),
{CRC32.strip()},
v AS (SELECT w, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS w, n FROM h) WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
d AS (SELECT w, i, substr(w, 1, i - 1) || substr(w, i + 1) AS s FROM v, unnest(range(1, length(w) + 1)) u(i)),
p AS (SELECT a.w, b.w AS near FROM d a JOIN d b ON a.s = b.s AND a.i = b.i AND length(a.w) = length(b.w) AND a.w <> b.w
      UNION SELECT d.w, v.w FROM d JOIN v ON d.s = v.w UNION SELECT v.w, d.w FROM d JOIN v ON d.s = v.w),
m AS (SELECT p.w, count(*) AS n_near, min((-q.n, q.w)) AS best FROM p JOIN v q ON q.w = p.near GROUP BY p.w),
f AS (SELECT v.w AS word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 5 * v.n THEN best[2] END AS form, CASE WHEN -best[1] >= 5 * v.n THEN -best[1] END AS form_n FROM v LEFT JOIN m ON m.w = v.w),
s AS (SELECT word, word AS root FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON f.word = s.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM f JOIN s ON s.word = f.word JOIN f g ON g.word = s.root WHERE g.form IS NULL"""

OP12 = f"""
WITH dw AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
iw AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id::VARCHAR AS item, least(len(ws), 10) AS k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g FROM iw, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) u(i) WHERE len(ws) > 0),
gram AS (SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM dw, (SELECT DISTINCT k FROM win), unnest(range(1, len(ws) - k + 2)) u(i)),
hit AS (SELECT doc_id, i, k, item FROM gram JOIN win USING (k, g)),
w AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, i, k FROM hit), unnest(range(i, i + k)) u(j) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT dw.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN w ON w.doc_id = dw.doc_id LEFT JOIN it ON it.doc_id = dw.doc_id"""


def op13(rounds: int = 10) -> str:
    """Each round as two tables: the vectors' nearest centroids, and the centroids moved."""
    parts = ["""WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM v QUALIFY c < 8)"]
    for r in range(rounds + 1):
        parts.append(f"a{r} AS MATERIALIZED (SELECT vec_id, v, min((d, c)) AS m FROM (SELECT vec_id, v.v, c, list_sum(list_transform(list_zip(v.v, k.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{r} k) GROUP BY vec_id, v)")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT k.c, coalesce(n.v, k.v) AS v FROM c{r} k LEFT JOIN (SELECT c, list(x ORDER BY i) AS v FROM
             (SELECT m[2] AS c, i, ((sum(v[i]) - (sum(v[i]) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS x FROM a{r}, range(1, 65) u(i) GROUP BY 1, 2) GROUP BY c) n ON n.c = k.c)""")
    return ",\n".join(parts) + f"""
SELECT vec_id, m[2]::INTEGER AS cluster, m[1] AS distance, sum(m[1]) OVER (PARTITION BY m[2])::BIGINT AS cluster_inertia, sum(m[1]) OVER ()::BIGINT AS inertia, sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} k ON k.c = m[2]"""

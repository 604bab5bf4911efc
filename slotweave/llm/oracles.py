"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import url_filter

OP8 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

OP9 = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
     s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                  CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
           FROM d GROUP BY source),
     r AS (SELECT *, 3 * source_size AS lim, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k FROM s),
     l AS (SELECT *, (SELECT sum(source_size) FROM s) - coalesce(sum(lim) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                     sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w FROM r),
     first AS (SELECT rest, rest_w FROM l WHERE lim * rest_w > rest * weight ORDER BY k LIMIT 1),
     t AS (SELECT r.source, source_size,
                  CASE WHEN f.rest IS NULL OR lim * f.rest_w <= f.rest * weight THEN CAST(lim AS DOUBLE)
                       ELSE CAST(f.rest AS DOUBLE) * weight / f.rest_w END AS target
           FROM r LEFT JOIN first f ON true),
     c AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
           FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN CAST('0x' || substr(md5('mix-1:' || doc_id), 1, 8) AS BIGINT) / 4294967296.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""

OP1 = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
     s AS (SELECT doc_id, list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, greatest(len(w) - 2, 2))]) AS s FROM w WHERE len(w) > 0),
     g AS (SELECT s.*, md5(array_to_string(list_sort(s), chr(10))) AS k FROM s),
     c AS (SELECT k, min(doc_id) AS doc_id, any_value(s) AS s FROM g GROUP BY k),
     u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM c),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id
           GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
     e AS (SELECT a, b FROM p UNION SELECT b, a FROM p UNION SELECT c.doc_id, g.doc_id FROM c JOIN g USING (k) UNION SELECT g.doc_id, c.doc_id FROM c JOIN g USING (k)),
     r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id AND r.root < e.b),
     m AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, CAST(coalesce(len(s.s), 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN s USING (doc_id) JOIN m ON m.id = d.doc_id
"""

OP2 = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
     x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
     f AS (SELECT h, min(doc_id) AS lo FROM x GROUP BY h),
     g AS (SELECT DISTINCT doc_id, i + j AS i FROM (SELECT x.doc_id, x.i, unnest(range(0, 50)) AS j FROM x JOIN f USING (h) WHERE lo < x.doc_id)),
     t AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
     k AS (SELECT t.doc_id, string_agg(x, ' ' ORDER BY t.i) FILTER (WHERE g.i IS NULL) AS kept, count(g.i) AS n FROM t LEFT JOIN g ON g.doc_id = t.doc_id AND g.i = t.i GROUP BY t.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

OP6 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
     r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op5(iterations: int = url_filter.ITERATIONS) -> str:
    """The rounds of the ranks are written out, one common table expression each."""
    a = url_filter.DAMPING
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in rules) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in rules) + " END"
    low = f"'{url_filter.UPPER}', '{url_filter.LOWER}'"
    href = url_filter.HREF.replace("'", "''")
    rounds = "".join(f""",
     f{i} AS (SELECT host, sum(t) AS t, sum(ft) AS ft, sum(d) AS d FROM (SELECT dst AS host, trust * weight AS t, fall * weight AS ft, 0.0 AS d FROM e JOIN s{i} ON host = src
                UNION ALL SELECT src, 0.0, 0.0, distrust * weight FROM e JOIN s{i} ON host = dst) GROUP BY host),
     s{i + 1} AS MATERIALIZED (SELECT s0.host, s0.trust + coalesce(t, 0) * {a} AS trust, 1 + coalesce(ft, 0) * {a} AS fall, s0.distrust + (1 - s0.distrust) * coalesce(d, 0) * {a} AS distrust
                FROM s0 LEFT JOIN f{i} USING (host))""" for i in range(iterations))
    last = iterations - 1
    return f"""
WITH u AS (SELECT page_id, html, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {low}) AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
     p AS MATERIALIZED (SELECT *, {rule} AS rule, {verdict} AS verdict FROM u),
     l AS (SELECT host AS src, unnest(list_distinct(regexp_extract_all(coalesce(html, ''), '{href}', 1))) AS link FROM p),
     k AS (SELECT src, CASE WHEN contains(link, '://') THEN translate(regexp_extract(link, '://([^/?#]*)', 1), {low})
                            WHEN starts_with(link, '//') THEN translate(regexp_extract('x:' || link, '://([^/?#]*)', 1), {low}) ELSE src END AS dst FROM l),
     n AS (SELECT src, dst, count(*) AS n FROM k WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
     e AS MATERIALIZED (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS weight FROM n),
     h AS (SELECT host, avg(CASE WHEN coalesce(verdict, '') = 'allow' THEN 1.0 ELSE 0.0 END) AS t, avg(CASE WHEN coalesce(verdict, '') = 'block' THEN 1.0 ELSE 0.0 END) AS d FROM p WHERE host <> '' GROUP BY host
           UNION ALL SELECT dst, 0.0, 0.0 FROM e),
     s0 AS MATERIALIZED (SELECT host, sum(t) AS trust, sum(d) AS distrust, 1.0 AS fall FROM h GROUP BY host){rounds},
     v AS (SELECT s0.host, greatest(s0.trust, CASE WHEN ft > 0 THEN t / ft ELSE 0 END) AS trust, r.distrust FROM s0 LEFT JOIN f{last} f ON f.host = s0.host JOIN s{iterations} r ON r.host = s0.host)
SELECT page_id, p.host, path, rule,
       coalesce(verdict, CASE WHEN distrust > trust * {url_filter.RATIO} + {url_filter.MARGIN} AND distrust > {url_filter.LEAST} + {url_filter.MARGIN} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN v ON v.host = p.host
"""


SQL = {"op5_url_filter": op5(), "op6_knn_join": OP6, "op1_minhash": OP1, "op2_substring_dedup": OP2, "op8_exact_dedup": OP8, "op9_mixing": OP9}

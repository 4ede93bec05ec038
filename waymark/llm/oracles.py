"""DuckDB SQL for the registered queries that SQL can express."""

ORACLES: dict[str, str] = {
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
}

ORACLES["op10_substring_dedup"] = r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    win AS (SELECT doc_id, i, ws[i:i + 19] AS g FROM w, unnest(range(1, len(ws) - 18)) AS u(i) WHERE len(ws) >= 20),
    f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM win),
    gone AS (SELECT DISTINCT doc_id, j FROM f, unnest(range(i, i + 20)) AS u(j) WHERE r > 1),
    kept AS (SELECT w.doc_id, count(g.j) AS n_removed, string_agg(CASE WHEN g.j IS NULL THEN w.ws[p.j] END, ' ' ORDER BY p.j) AS t
        FROM w, unnest(range(1, len(w.ws) + 1)) AS p(j) LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.j = p.j GROUP BY w.doc_id)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
"""

ORACLES["op2_pq_dedup"] = """
    WITH RECURSIVE v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
        FROM embeddings),
    l AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
        WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
    c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1),
    n AS (SELECT a, count(*) AS n_links FROM l GROUP BY 1)
    SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
    FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""


def _kmeans_sql(clusters: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Plain rounds over all pairs of vectors and centroids, one pair of statements a round."""
    assign = """a{r} AS MATERIALIZED (SELECT vec_id, rn, x, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
        SELECT vec_id, rn, x, k, CAST(list_sum(list_transform(range(1, {dims1}), lambda i : (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d FROM v, c{r}) q GROUP BY vec_id, rn, x)"""
    move = """c{n} AS MATERIALIZED (SELECT c{r}.k, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (SELECT k, list(f ORDER BY i) AS c FROM (
        SELECT k, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS f FROM (SELECT k, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM a{r}, range(1, {dims1}) AS u(i) GROUP BY k, i) t) w GROUP BY k) m ON m.k = c{r}.k)"""
    steps = []
    for r in range(rounds + 1):
        steps.append(assign.format(r=r, dims1=dims + 1))
        if r < rounds:
            steps.append(move.format(r=r, n=r + 1, dims1=dims + 1))
    return f"""WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rn, list_transform(embedding, lambda e : CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
        WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e : e IS NOT NULL AND isfinite(e))) = {dims}),
    c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INT) AS k, x AS c FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h, x LIMIT {clusters}) s),
    {", ".join(steps)}
    SELECT a.vec_id, a.k AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c.c, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.k = a.k"""


ORACLES["op11_ball_kmeans"] = _kmeans_sql()

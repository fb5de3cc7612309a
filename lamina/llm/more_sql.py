"""SQL of the queries on vectors: brute force in exact integers."""

from __future__ import annotations

from lamina.llm import hard_negatives, kmeans


def clusters_sql() -> str:
    """Each round in SQL: all distances, the nearest, and the floor of the means."""
    steps = [
        f"""
        v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({kmeans.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE len(embedding) = {kmeans.DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        w AS (SELECT rid, unnest(range(1, {kmeans.DIMS} + 1)) AS i, unnest(e) AS x FROM v),
        s AS (SELECT row_number() OVER (ORDER BY sha256('{kmeans.SEED}:' || vec_id), e) - 1 AS c, e FROM v QUALIFY c < {kmeans.CENTROIDS}),
        c0 AS (SELECT c, unnest(range(1, {kmeans.DIMS} + 1)) AS i, unnest(e) AS x FROM s)"""
    ]
    for r in range(kmeans.ROUNDS + 1):
        steps.append(f"""
        d{r} AS (SELECT rid, c, sum((w.x - c{r}.x) * (w.x - c{r}.x)) AS d FROM w JOIN c{r} USING (i) GROUP BY rid, c),
        a{r} AS MATERIALIZED (SELECT rid, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < kmeans.ROUNDS:
            steps.append(f"""
        m{r} AS (SELECT c, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM w JOIN a{r} USING (rid) GROUP BY c, i),
        c{r + 1} AS MATERIALIZED (SELECT c, i, coalesce(m{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN m{r} USING (c, i))""")
    last = kmeans.ROUNDS
    return f"""
        WITH {",".join(steps)},
        sha AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY c)
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM a{last} JOIN v USING (rid) JOIN sha USING (c)
    """


def negatives_sql() -> str:
    """All scores of all anchors, ranked and cut to the windows."""
    return f"""
        WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.rid AS arid, a.vec_id AS anchor_id, r.rid, r.vec_id, r.label = a.label AS same, CAST(list_dot_product(a.e, r.e) AS BIGINT) AS score
            FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.rid <> r.rid),
        p AS (SELECT *, row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id) AS place FROM s WHERE same QUALIFY place <= {hard_negatives.POSITIVES})
        SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON p.arid = s.arid AND NOT s.same AND {hard_negatives.LOW} * p.score <= 100 * s.score AND 100 * s.score <= {hard_negatives.HIGH} * p.score
        WINDOW w AS (PARTITION BY p.arid, p.rid ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= {hard_negatives.NEGATIVES}
    """

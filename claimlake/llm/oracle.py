"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

import corpus_pipeline

# words of a text and its set of five-word shingles, for a view t(id, text)
_SHINGLES = r"""
w_{t} AS (
  SELECT id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM {t}),
s_{t} AS (
  SELECT DISTINCT id, s FROM (
    SELECT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM w_{t})),
n_{t} AS (SELECT id, count(*) AS n FROM s_{t} GROUP BY id)"""

OP1 = rf"""
WITH d AS (SELECT doc_id AS id, text FROM documents), b AS (SELECT item_id AS id, text FROM benchmark),
{_SHINGLES.format(t="d")}, {_SHINGLES.format(t="b")}
SELECT s_d.id AS doc_id, s_b.id AS item_id, count(*) AS n_shared, any_value(n) AS n_item,
  count(*) / any_value(n) AS containment
FROM s_d JOIN s_b USING (s) JOIN n_b ON n_b.id = s_b.id
GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * any_value(n)
"""

OP7 = rf"""
WITH RECURSIVE d AS (SELECT doc_id AS id, text FROM documents),
{_SHINGLES.format(t="d")},
pairs AS (
  SELECT a.id AS x, b.id AS y, count(*) AS c FROM s_d a JOIN s_d b ON a.s = b.s AND a.id <> b.id
  GROUP BY 1, 2),
link AS (
  SELECT x, y FROM pairs JOIN n_d p ON p.id = x JOIN n_d q ON q.id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
SELECT x AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id, min(y) = x AS kept
FROM reach LEFT JOIN n_d ON n_d.id = x GROUP BY x
"""

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP12 = r"""
WITH terms AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
sizes AS (SELECT doc_id, len(t) AS n FROM terms WHERE len(t) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM terms) GROUP BY 1, 2),
w AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN sizes USING (doc_id), total GROUP BY 1, 2),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _lloyd(rounds: int = 10, k: int = 8) -> str:
    """Rounds of whole-number Lloyd as a chain of tables."""
    steps = [f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS d, unnest(q) AS x FROM v),
first AS (
  SELECT q, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM v
  QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS d, unnest(q) AS m FROM first)"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, dist, c FROM (
    SELECT vec_id, c, CAST(sum((x - m) * (x - m)) AS BIGINT) AS dist FROM x JOIN c{r} USING (d) GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, c) = 1)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (
  SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{r} USING (vec_id) GROUP BY 1, 2),
c{r + 1} AS MATERIALIZED (
  SELECT c, d, CASE WHEN n IS NULL THEN m ELSE (s - ((s % n) + n) % n) // n END AS m
  FROM c{r} LEFT JOIN s{r} USING (c, d))""")
    return ",".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, dist AS distance,
  CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia,
  centroid_sha256
FROM a{rounds} JOIN (
  SELECT c, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c) USING (c)
"""


ORACLE = {"op1_decontamination": OP1, "op7_near_duplicates": OP7, "op9_top_k": OP9, "op12_ranked_search": OP12,
          "op13_centroids": _lloyd()}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

"""DuckDB SQL of the clustering, the filter audit and the Jaccard join, each written from its contract."""

from __future__ import annotations

from itertools import permutations


def _clusters_sql(k: int = 40, rounds: int = 5, seed: int = 2, dim: int = 64) -> str:
    near = """{n} AS MATERIALIZED (
  SELECT r, min_by(c, [d, c]) AS cluster, min(d) AS distance FROM (
    SELECT p.r, q.c, list_sum(list_transform(list_zip(p.v, q.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM vecs p, {c} q) GROUP BY r)"""
    mean = """{c} AS MATERIALIZED (
  SELECT c, list(m ORDER BY i) AS v FROM (
    SELECT a.cluster AS c, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
    FROM {n} a JOIN (SELECT r, unnest(v) AS x, unnest(range(1, {dim} + 1)) AS i FROM vecs) USING (r) GROUP BY a.cluster, i)
  GROUP BY c UNION ALL SELECT c, v FROM {o} WHERE c NOT IN (SELECT cluster FROM {n}))"""
    parts = [f"""vecs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})""", f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('{seed}:' || vec_id::VARCHAR) AS h, v FROM vecs
                                                           ORDER BY h LIMIT {k}))"""]
    for i in range(rounds):
        parts += [near.format(n=f"n{i}", c=f"c{i}"), mean.format(c=f"c{i + 1}", n=f"n{i}", o=f"c{i}", dim=dim)]
    parts.append(near.format(n="last", c=f"c{rounds}"))
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM last JOIN vecs USING (r) JOIN c{rounds} c ON c.c = cluster"""


def _audit_sql(names: str = "ABCDE") -> str:
    steps = ", ".join(f"('{''.join(o)}', {i + 1})" for o in permutations(names) for i in range(len(names)))
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, list_filter(string_split_regex(t, '[ 	
]+'), lambda w: w <> '') AS w,
                 min(doc_id) OVER (PARTITION BY t) AS first_id FROM texts),
fails AS MATERIALIZED (
  SELECT part, concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
                      CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
                      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END,
                      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                      CASE WHEN first_id < doc_id THEN 'E' ELSE '' END) AS failed,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic FROM words),
classes AS MATERIALIZED (SELECT part, failed, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
                         FROM fails GROUP BY part, failed),
steps(filter_order, step) AS (VALUES {steps}),
named AS (SELECT *, substr(filter_order, step::INT, 1) AS f, substr(filter_order, 1, step::INT - 1) AS prefix FROM steps),
counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT early AND NOT own THEN docs ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT early AND own THEN docs ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN early AND own THEN docs ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN failed = f THEN docs ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT early AND own THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT early AND own THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM (SELECT *, translate(failed, prefix, '') <> failed AS early, contains(failed, f) AS own FROM classes, named)
  GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted"""


OP11_SQL = _clusters_sql()
OP12_SQL = _audit_sql()
OP13_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[ 	
]+'), lambda w: w <> '') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM texts),
classes AS MATERIALIZED (SELECT list_sort(s) AS s, min(r) AS k, len(s) AS n, min(doc_id) AS least FROM sets WHERE len(s) > 0
                         GROUP BY list_sort(s), len(s)),
grams AS MATERIALIZED (SELECT k, n, unnest(s) AS g FROM classes),
links AS MATERIALIZED (SELECT a.k AS u, b.k AS v FROM grams a JOIN grams b ON a.g = b.g AND a.k <> b.k GROUP BY a.k, a.n, b.k, b.n
                       HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT k AS u, k AS v FROM classes UNION SELECT x.u, l.v FROM reach x JOIN links l ON x.v = l.u),
least AS (SELECT x.u AS k, min(c.least) AS component_id FROM reach x JOIN classes c ON x.v = c.k GROUP BY x.u)
SELECT doc_id, len(t.s)::BIGINT AS n_shingles, CASE WHEN len(t.s) = 0 THEN doc_id ELSE component_id END AS component_id
FROM sets t LEFT JOIN classes c ON list_sort(t.s) = c.s LEFT JOIN least USING (k)"""

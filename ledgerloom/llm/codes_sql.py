"""SQL that another engine must agree with: codes of ``embeddings``, every part against every entry."""

from __future__ import annotations


def _assigned(k: int) -> str:
    return f"""assigned{k} AS MATERIALIZED (
  SELECT r, p, min(row(d, e))[2] AS e, min(d) AS d FROM (
    SELECT a.r, a.p, b.e,
      list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts a JOIN book{k} b USING (p)
  ) GROUP BY r, p
)"""


def _moved(k: int) -> str:
    return f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY j) AS x FROM (
      SELECT p, e, j, sum(x[j]) AS s, count(*) AS c
      FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS j FROM parts JOIN assigned{k} USING (r, p))
      GROUP BY p, e, j
    ) GROUP BY p, e
  ) m USING (p, e)
)"""


CODES_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) t(p)
),
book0 AS MATERIALIZED (SELECT p, r AS e, x FROM parts WHERE r < 64),
{_assigned(0)},
{_moved(0)},
{_assigned(1)},
{_moved(1)},
{_assigned(2)},
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM assigned2 GROUP BY r
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""

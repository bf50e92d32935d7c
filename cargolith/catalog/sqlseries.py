"""Smoothing and autoregression in SQL, for a table (series_id, ds, y)."""

from __future__ import annotations

from cargolith.plans.timeseries import WEIGHTS

_GRID = ", ".join(f"({a}::DOUBLE, {b / 2}::DOUBLE, {g / 2}::DOUBLE, {i * 25 + j * 5 + k})"
                  for i, a in enumerate(WEIGHTS) for j, b in enumerate(WEIGHTS) for k, g in enumerate(WEIGHTS))


def smoothing(src: str, horizon: int) -> str:
    """CTEs up to ``smooth(series_id, method, ds, yhat)``."""
    return f"""s0 AS (SELECT series_id, list(y::DOUBLE ORDER BY ds) AS y, count(*) AS n, max(ds) AS last FROM {src} GROUP BY 1),
s1 AS (SELECT *, CASE WHEN n > 24 THEN least(12, n // 3) ELSE 0 END AS p FROM s0),
s2 AS (SELECT *, list_avg(y[1:p]) AS m1, (list_avg(y[p + 1:2 * p]) - list_avg(y[1:p])) / p AS slope FROM s1),
grid(a, b, g, place) AS (VALUES {_GRID}),
fold(series_id, place, i, level, trend, season, err) AS (
  SELECT series_id, place, CASE WHEN p > 1 THEN p ELSE 1 END, CASE WHEN p > 1 THEN m1 + slope * ((p - 1) / 2.0::DOUBLE) ELSE y[1] END,
    CASE WHEN p > 1 THEN slope WHEN n > 1 THEN y[2] - y[1] ELSE 0 END,
    CASE WHEN p > 1 THEN list_transform(y[1:p], lambda v, j: v - m1 - slope * (j - 1 - (p - 1) / 2.0::DOUBLE)) ELSE [0.0::DOUBLE] END, 0.0::DOUBLE
  FROM s2 JOIN grid ON p > 1 OR place % 5 = 0
  UNION ALL SELECT series_id, place, i + 1, nl, b * (nl - level) + (1 - b) * trend,
    list_transform(season, lambda v, j: CASE WHEN j = i % len(season) + 1 THEN g * (v_ - nl) + (1 - g) * own ELSE v END), err + (v_ - (level + trend + own)) * (v_ - (level + trend + own))
  FROM (SELECT *, a * (v_ - own) + (1 - a) * (level + trend) AS nl FROM (
    SELECT f.*, s.y[i + 1] AS v_, season[i % len(season) + 1] AS own, a, b, CASE WHEN p > 1 THEN g ELSE 0 END AS g
    FROM fold f JOIN s2 s USING (series_id) JOIN grid USING (place) WHERE i < n))),
top AS (SELECT f.*, n, last FROM fold f JOIN s2 USING (series_id) WHERE i = greatest(n, CASE WHEN p > 1 THEN p ELSE 1 END)
  QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY err, place) = 1),
smooth AS (SELECT series_id, 'exponential_smoothing' AS method, last + k::INTEGER AS ds, level + trend * k + season[(n - 1 + k) % len(season) + 1] AS yhat
  FROM (SELECT *, unnest(range(1, {horizon + 1})) AS k FROM top))"""


def autoregression(src: str, horizon: int) -> str:
    """CTEs up to ``auto(series_id, method, ds, yhat)``."""
    return f"""a0 AS (SELECT series_id, ds, y::DOUBLE AS y, y - lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS dy FROM {src}),
a1 AS (SELECT series_id, ds, 0 AS d, y AS z FROM a0 UNION ALL SELECT series_id, ds, 1, dy FROM a0 WHERE dy IS NOT NULL),
a2 AS (SELECT *, lag(z, 1) OVER o AS z1, lag(z, 2) OVER o AS z2, row_number() OVER (PARTITION BY series_id, d ORDER BY ds DESC) AS back FROM a1 WINDOW o AS (PARTITION BY series_id, d ORDER BY ds)),
a3 AS (SELECT series_id, d, count(*) AS m, avg(z) AS m0, avg(z1) AS m1, avg(z2) AS m2, var_pop(z) * count(*) AS s00, covar_pop(z, z1) * count(*) AS s01, covar_pop(z, z2) * count(*) AS s02,
  var_pop(z1) * count(*) AS s11, covar_pop(z1, z2) * count(*) AS s12, var_pop(z2) * count(*) AS s22 FROM a2 WHERE z2 IS NOT NULL GROUP BY 1, 2),
a4 AS (SELECT *, 0 AS p, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2 FROM a3 UNION ALL SELECT *, 1, s01 / s11, 0 FROM a3 WHERE s11 > 0
  UNION ALL SELECT *, 2, (s01 * s22 - s02 * s12) / (s11 * s22 - s12 * s12), (s02 * s11 - s01 * s12) / (s11 * s22 - s12 * s12) FROM a3 WHERE s11 * s22 - s12 * s12 > 1e-12 * s11 * s22),
a5 AS (SELECT series_id, d, m0 - w1 * m1 - w2 * m2 AS w0, w1, w2 FROM a4 WHERE m >= p + 3
  QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY m * ln(greatest((s00 - w1 * s01 - w2 * s02) / m, 1e-12)) + 2 * (p + 1), d, p) = 1),
a6 AS (SELECT series_id, max(ds) AS last, max_by(y, ds) AS top, avg(y) AS mean FROM a0 GROUP BY 1),
walk(series_id, k, z1, z2, total) AS (SELECT series_id, 0, z, coalesce(z1, 0), 0.0::DOUBLE FROM a2 JOIN a5 USING (series_id, d) WHERE back = 1
  UNION ALL SELECT series_id, k + 1, w0 + w1 * z1 + w2 * z2, z1, total + w0 + w1 * z1 + w2 * z2 FROM walk JOIN a5 USING (series_id) WHERE k < {horizon}),
auto AS (SELECT series_id, 'autoregressive' AS method, last + k::INTEGER AS ds, CASE WHEN w0 IS NULL THEN mean WHEN d = 1 THEN top + total ELSE z1 END AS yhat
  FROM (SELECT *, unnest(range(1, {horizon + 1})) AS k FROM a6) LEFT JOIN a5 USING (series_id) LEFT JOIN walk USING (series_id, k))"""


def both(src: str, horizon: int) -> str:
    """CTEs up to ``smooth``, ``auto`` and their mean ``ens``."""
    return f"""{smoothing(src, horizon)},
{autoregression(src, horizon)},
ens AS (SELECT series_id, 'ensemble' AS method, ds, avg(yhat) AS yhat FROM (SELECT * FROM smooth UNION ALL SELECT * FROM auto) GROUP BY series_id, ds)"""

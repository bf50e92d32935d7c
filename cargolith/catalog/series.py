"""Time series T01-T12, windows W01, W10, set U04, order L04, L06, band V07."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cargolith.catalog import sqlseries as sq
from cargolith.catalog.evaluate import SERIES, series
from cargolith.catalog.registry import register, tidy
from cargolith.catalog.sqlbase import INV, SHIP, season, sql
from cargolith.functions.dates import season_of
from cargolith.plans import kpis
from cargolith.plans import timeseries as t
from cargolith.sources.marts import invoices, shipments

col, lit = F.col, F.lit
H = 14


def freight_series(s, d):
    """Daily shipment counts per freight type, over the whole span of years."""
    return t.daily_series(shipments(s, d, "ShipmentDate", "FreightTypeKey"), col("FreightTypeKey"), col("ShipmentDate"), lit(1))


FREIGHT = f"""{SHIP},
sums AS (SELECT CAST(FreightTypeKey AS VARCHAR) AS series_id, CAST(ShipmentDate AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y FROM shipments GROUP BY 1, 2),
spans AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM sums GROUP BY 1),
days AS (SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS ds FROM spans),
series AS (SELECT series_id, ds, coalesce(y, 0) AS y FROM days LEFT JOIN sums USING (series_id, ds))"""
register("T01_daily_series", lambda s, d: tidy(series(s, d)), sql(SERIES, "SELECT series_id, ds, round(y, 4) AS y FROM series"))
register("T01b_daily_series_by_freight", lambda s, d: freight_series(s, d), sql(FREIGHT, "SELECT series_id, ds, y FROM series"))
register("L04_dated_order", lambda s, d: tidy(t.numbered(series(s, d)).select("series_id", "i", "ds", "y")),
    sql(SERIES, "SELECT series_id, CAST(row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS INTEGER) AS i, ds, round(y, 4) AS y FROM series"))
register("L06_last_week", lambda s, d: t.last_rows(freight_series(s, d)).select("series_id", "place", "ds", "y"),
    sql(FREIGHT, """SELECT series_id, CAST(7 - r AS INTEGER) AS place, ds, y FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS r FROM series)
WHERE r <= 7"""))
_ROUND = "SELECT series_id, method, ds, round(yhat, 4) AS yhat FROM"
register("T02_smoothing", lambda s, d: tidy(t.smoothing_forecast(freight_series(s, d), H)),
    f"WITH RECURSIVE {FREIGHT},\n{sq.smoothing('series', H)}\n{_ROUND} smooth")
register("T03_autoregression", lambda s, d: tidy(t.autoregressive_forecast(freight_series(s, d), H)),
    f"WITH RECURSIVE {FREIGHT},\n{sq.autoregression('series', H)}\n{_ROUND} auto")
register("T04_naive_forecast", lambda s, d: tidy(t.naive_forecast(series(s, d), H)),
    sql(f"""{SERIES}, w AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS r, count(*) OVER (PARTITION BY series_id) AS n,
  avg(y) OVER (PARTITION BY series_id) AS m, max(ds) OVER (PARTITION BY series_id) AS last FROM series),
st AS (SELECT DISTINCT series_id, n, m, last, CAST(unnest(range(1, {H + 1})) AS INTEGER) AS step FROM (SELECT DISTINCT series_id, n, m, last FROM w))""",
    """SELECT st.series_id, CASE WHEN st.n >= 7 THEN 'seasonal_naive' ELSE 'mean' END AS method, st.last + step AS ds,
  round(CASE WHEN st.n >= 7 THEN y ELSE st.m END, 4) AS yhat FROM st LEFT JOIN w ON st.series_id = w.series_id AND w.r <= 7 AND 7 - w.r = (step - 1) % 7"""))
register("T05_ensemble", lambda s, d: tidy(t.ensemble_forecast(freight_series(s, d), H)),
    f"WITH RECURSIVE {FREIGHT},\n{sq.both('series', H)}\n{_ROUND} ens")
register("T05b_ensemble_of_naive_and_mean", lambda s, d: tidy(t.ensemble(t.naive_forecast(series(s, d), H), t.horizon_days(series(s, d), H).select(
        "series_id", lit("mean").alias("method"), "ds", col("mean").alias("yhat")))),
    sql(f"""{SERIES}, w AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS r FROM series WHERE true),
g AS (SELECT series_id, avg(y) AS m, max(ds) AS last FROM series GROUP BY 1), st AS (SELECT *, CAST(unnest(range(1, {H + 1})) AS INTEGER) AS step FROM g)""",
    """SELECT st.series_id, 'ensemble' AS method, last + step AS ds, round((y + m) / 2, 4) AS yhat
FROM st JOIN w ON st.series_id = w.series_id AND w.r <= 7 AND 7 - w.r = (step - 1) % 7"""))
DEC = """num AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS i FROM series),
tr AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(y) OVER w END AS trend, i % 7 AS phase FROM num
  WINDOW w AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
ph AS (SELECT series_id, phase, avg(y - trend) AS raw FROM tr GROUP BY 1, 2),
dec AS (SELECT series_id, ds, y, trend, raw - avg(raw) OVER (PARTITION BY series_id, ds) AS unused, phase, raw FROM tr JOIN ph USING (series_id, phase)),
mid AS (SELECT series_id, avg(raw) AS mid FROM ph GROUP BY 1),
parts AS (SELECT d.series_id, ds, y, trend, raw - mid AS seasonal, y - trend - (raw - mid) AS resid FROM dec d JOIN mid USING (series_id))"""
register("W10_centred_average", lambda s, d: tidy(t.decomposition(series(s, d)).select("series_id", "ds", "trend", "seasonal", "resid"), 4),
    sql(f"{SERIES}, {DEC}", "SELECT series_id, ds, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal, round(resid, 4) AS resid FROM parts"))
register("T06_seasonality", lambda s, d: tidy(t.seasonality(series(s, d))),
    sql(f"{SERIES}, {DEC}", """SELECT series_id, round(var_pop(seasonal) / var_pop(y), 4) AS seasonal_strength, round(var_pop(trend) / var_pop(y), 4) AS trend_strength,
  round(var_pop(resid), 4) AS residual_variance FROM parts GROUP BY 1"""))
register("T07_trend", lambda s, d: tidy(t.trend(series(s, d), with_p=False).select("series_id", "slope", "intercept", "r_squared", "n", "trend_type", "t_statistic"), 6),
    sql(f"{SERIES}, num AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS i FROM series)", """
SELECT series_id, round(regr_slope(y, i), 6) AS slope, round(regr_intercept(y, i), 6) AS intercept, round(regr_r2(y, i), 6) AS r_squared, count(*) AS n,
  CASE WHEN abs(regr_slope(y, i)) < 0.01 THEN 'stationary' WHEN regr_slope(y, i) > 0 THEN 'increasing' ELSE 'decreasing' END AS trend_type,
  round(sqrt(regr_r2(y, i) * (count(*) - 2) / (1 - regr_r2(y, i))), 6) AS t_statistic FROM num GROUP BY 1"""))
# Student's tail by the continued fraction of the incomplete beta function.
_P = """fit AS (SELECT series_id, regr_r2(y, i) AS r2, count(*) - 2 AS df FROM num GROUP BY 1),
arg AS (SELECT *, df / 2.0::DOUBLE AS a, df / (df + r2 * df / (1 - r2)) AS x FROM fit),
side AS (SELECT *, x < (a + 1) / (a + 2.5) AS direct, exp(lgamma(a + 0.5) - lgamma(a) - ln(pi()) / 2 + a * ln(x) + 0.5 * ln(1 - x)) AS front FROM arg),
swap AS (SELECT *, CASE WHEN direct THEN a ELSE 0.5 END AS p, CASE WHEN direct THEN 0.5 ELSE a END AS q, CASE WHEN direct THEN x ELSE 1 - x END AS z FROM side),
lentz(series_id, k, c, d, h) AS (SELECT series_id, 1, 1.0::DOUBLE, 1 / (1 - (p + q) * z / (p + 1)), 1 / (1 - (p + q) * z / (p + 1)) FROM swap
  UNION ALL SELECT series_id, k, c, d, h * c * d FROM (
    SELECT series_id, k + 1 AS k, h, 1 / (1 + top * d) AS d, 1 + top / c AS c FROM (
      SELECT l.*, (l.k + 1) // 2 AS m, CASE WHEN (l.k + 1) % 2 = 0 THEN ((l.k + 1) // 2) * (q - (l.k + 1) // 2) * z / ((p + 2 * ((l.k + 1) // 2) - 1) * (p + 2 * ((l.k + 1) // 2)))
        ELSE -(p + (l.k + 1) // 2) * (p + q + (l.k + 1) // 2) * z / ((p + 2 * ((l.k + 1) // 2)) * (p + 2 * ((l.k + 1) // 2) + 1)) END AS top
      FROM lentz l JOIN swap USING (series_id) WHERE l.k < 401)))"""
register("T07b_trend_significance", lambda s, d: tidy(t.trend(freight_series(s, d)).select("series_id", "p_value", "is_significant"), 6),
    f"""WITH RECURSIVE {FREIGHT}, num AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS i FROM series), {_P}
SELECT series_id, round(v, 6) AS p_value, v < 0.05 AS is_significant FROM (
  SELECT series_id, CASE WHEN direct THEN front * h / p ELSE 1 - front * h / p END AS v FROM swap JOIN lentz USING (series_id) WHERE k = 401)""")
register("T08_comprehensive_forecast", lambda s, d: tidy(t.comprehensive_forecast(freight_series(s, d), H)),
    f"""WITH RECURSIVE {FREIGHT}, usable AS (SELECT * FROM series WHERE series_id IN (SELECT series_id FROM series GROUP BY 1 HAVING count(*) >= 14)),
{sq.both('usable', H)}
{_ROUND} (SELECT series_id, 'history' AS method, ds, y AS yhat FROM usable UNION ALL SELECT * FROM smooth UNION ALL SELECT * FROM auto UNION ALL SELECT * FROM ens)""")
register("T09_backtest", lambda s, d: tidy(t.best_methods(t.backtest(freight_series(s, d)))),
    f"""WITH RECURSIVE {FREIGHT}, placed AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS back, count(*) OVER (PARTITION BY series_id) AS n FROM series),
train AS (SELECT series_id, ds, y FROM placed WHERE n >= 21 AND back > 7),
{sq.both('train', 7)},
e AS (SELECT series_id, method, avg(abs((y - yhat) / (y + 1e-8))) * 100 AS mape FROM (SELECT * FROM smooth UNION ALL SELECT * FROM auto) f JOIN placed USING (series_id, ds) GROUP BY 1, 2)
SELECT series_id, min_by(method, mape) AS best_method, round(min(mape), 4) AS mape FROM e GROUP BY 1""")


def _held(s, d):
    train, held = t.split_last(series(s, d))
    f = t.naive_forecast(train, 7)
    gap = F.abs((col("y") - col("yhat")) / (col("y") + 1e-8))
    return f.join(held, ["series_id", "ds"]).groupBy("series_id", "method").agg((F.avg(gap) * 100).alias("mape"))


register("T09b_backtest_naive", lambda s, d: tidy(_held(s, d)),
    sql(f"{SERIES}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS r FROM series)", """
SELECT a.series_id, 'seasonal_naive' AS method, round(avg(abs((a.y - b.y) / (a.y + 1e-8))) * 100, 4) AS mape
FROM r a JOIN r b ON a.series_id = b.series_id AND a.r <= 7 AND b.r = a.r + 7 GROUP BY 1"""))
register("T10_forecast_days", lambda s, d: t.horizon_days(freight_series(s, d), H).select("series_id", "step", "ds"),
    sql(FREIGHT, f"SELECT series_id, CAST(unnest(range(1, {H + 1})) AS INTEGER) AS step, max(ds) + CAST(unnest(range(1, {H + 1})) AS INTEGER) AS ds FROM series GROUP BY series_id"))
register("U04_history_and_forecast", lambda s, d: tidy(t.history_and_forecast(series(s, d), t.naive_forecast(series(s, d), H))),
    sql(f"""{SERIES}, w AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS r, max(ds) OVER (PARTITION BY series_id) AS last FROM series),
st AS (SELECT series_id, max(ds) AS last, unnest(range(1, {H + 1}))::INTEGER AS step FROM series GROUP BY series_id)""", """
SELECT series_id, ds, round(y, 4) AS actual, NULL::DOUBLE AS forecast, 'historical' AS type FROM series
UNION ALL SELECT st.series_id, st.last + step, NULL, round(y, 4), 'forecast' FROM st JOIN w ON st.series_id = w.series_id AND w.r <= 7 AND 7 - w.r = (step - 1) % 7"""))
MA = f"{SHIP}, dly AS (SELECT ShipmentDate, count(*) AS Shipments FROM shipments GROUP BY 1)"
for _name in ("W01_moving_average_180", "T11_moving_average_180"):
    register(_name, lambda s, d: tidy(t.moving_average(kpis.daily_demand(shipments(s, d, "ShipmentDate"))), 6),
        sql(MA, "SELECT ShipmentDate, Shipments, round(avg(Shipments) OVER (ORDER BY ShipmentDate ROWS BETWEEN 179 PRECEDING AND CURRENT ROW), 6) AS Forecast FROM dly"))
register("V07_forecast_band", lambda s, d: tidy(t.forecast_band(t.naive_forecast(series(s, d), H), series(s, d))),
    sql(f"""{SERIES}, w AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS r FROM series),
g AS (SELECT series_id, stddev_samp(y) AS sd, max(ds) AS last FROM series GROUP BY 1), st AS (SELECT *, unnest(range(1, {H + 1}))::INTEGER AS step FROM g)""", """
SELECT st.series_id, 'seasonal_naive' AS method, last + step AS ds, round(y, 4) AS yhat, round(y - 1.96::DOUBLE * sd, 4) AS lower, round(y + 1.96::DOUBLE * sd, 4) AS upper,
  isodow(last + step) >= 6 AS is_weekend FROM st JOIN w ON st.series_id = w.series_id AND w.r <= 7 AND 7 - w.r = (step - 1) % 7"""))
register("V07b_ensemble_band", lambda s, d: tidy(t.forecast_spread_band(t.ensemble_forecast(series(s, d), H))),
    f"""WITH RECURSIVE {SERIES}, {sq.both('series', H)}
SELECT series_id, method, ds, round(yhat, 4) AS yhat, round(yhat - sd, 4) AS lower, round(yhat + sd, 4) AS upper FROM (SELECT *, stddev_samp(yhat) OVER (PARTITION BY series_id) AS sd FROM ens)""")


def _projection(s, d):
    ships = shipments(s, d, "ShipmentDate", "ShipmentValue")
    monthly = ships.groupBy(F.trunc("ShipmentDate", "month").alias("month")).agg(F.count(lit(1)).alias("shipments"))
    seasons = kpis.counts_by_season(ships, "ShipmentDate", "n")
    factors = seasons.select("Season", (col("n") / F.avg("n").over(Window.partitionBy())).alias("factor"))
    return t.monthly_projection(monthly, factors, ships.agg(F.avg("ShipmentValue").alias("avg_value")))


register("T12_monthly_projection", lambda s, d: tidy(_projection(s, d), 2, confidence=4, seasonal_factor=4),
    sql(f"""{SHIP}, mon AS (SELECT CAST(date_trunc('month', ShipmentDate) AS DATE) AS month, count(*) AS shipments FROM shipments GROUP BY 1),
idx AS (SELECT *, row_number() OVER (ORDER BY month) - 1 AS i FROM mon),
ln AS (SELECT regr_intercept(shipments, i) AS base, regr_slope(shipments, i) / regr_intercept(shipments, i) AS g, max(month) AS last, count(*) AS n FROM idx),
fa AS (SELECT Season, c / avg(c) OVER () AS factor FROM (SELECT {season('ShipmentDate')} AS Season, count(*) AS c FROM shipments GROUP BY 1)),
k AS (SELECT *, unnest(range(0, 18)) AS k FROM ln), m2 AS (SELECT *, CAST(last + to_months(CAST(k + 1 AS INTEGER)) AS DATE) AS month FROM k),
m3 AS (SELECT *, {season('month')} AS Season FROM m2), av AS (SELECT avg(ShipmentValue) AS v FROM shipments)""", """
SELECT month, CAST(shipments AS DOUBLE) AS actual, NULL::DOUBLE AS forecast, 'Historical' AS type, 1.0::DOUBLE AS confidence, 1.0::DOUBLE AS seasonal_factor,
  round(shipments * v, 2) AS estimated_revenue FROM mon, av
UNION ALL
SELECT month, NULL, round(base * power(1 + g, n + k) * factor, 2), 'Forecast', round(greatest(0.85::DOUBLE - k * 0.02::DOUBLE, 0.7), 4), round(factor, 4),
  round(base * power(1 + g, n + k) * factor * v, 2) FROM m3 JOIN fa USING (Season), av"""))

"""Evaluation G01-G18, model ranks W04, L05, differences W09, distribution steps W12."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from cargolith.catalog.kpis import histogram_sql
from cargolith.catalog.registry import register, tidy
from cargolith.catalog.sqlbase import INV, SHIP, VARIANCE, sql
from cargolith.functions import statistics as st
from cargolith.plans import drift as dr
from cargolith.plans import evaluation as ev
from cargolith.plans import features as f
from cargolith.plans import timeseries as tsr
from cargolith.sources.marts import invoices, shipments
from cargolith.sources.tables import parquet

col, lit, when = F.col, F.lit, F.when

# Three price models: list price by quantity, a flat unit price, and a damped list price.
MODELS = {"list_price": (1.0, 0.0), "damped": (0.5, 25000.0)}


def predictions(s, d):
    """(model, y, p): line value against simple price models."""
    base = parquet(s, d, "lineitem").join(parquet(s, d, "part"), col("l_partkey") == col("p_partkey"))
    listed = col("l_quantity") * col("p_retailprice")
    rows = [F.struct(lit(m).alias("model"), (listed * a + c).alias("p")) for m, (a, c) in MODELS.items()]
    rows.append(F.struct(lit("flat").alias("model"), (col("l_quantity") * 1050.0).alias("p")))
    return base.select(col("l_extendedprice").alias("y"), F.inline(F.array(*rows)))


def one_model(s, d, name="list_price"):
    return predictions(s, d).filter(col("model") == name).select("y", "p")


PRED = """pred AS (
  SELECT 'list_price' AS model, l_extendedprice AS y, l_quantity * p_retailprice AS p FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT 'damped', l_extendedprice, l_quantity * p_retailprice * 0.5::DOUBLE + 25000 FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT 'flat', l_extendedprice, l_quantity * 1050 FROM lineitem JOIN part ON l_partkey = p_partkey)"""
METRICS = f"""{PRED},
metrics AS (
  SELECT model, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2,
    avg(abs((y - p) / (y + 1e-8))) * 100 AS mape, max(abs(y - p)) AS max_error, avg(y - p) AS residual_mean, stddev_pop(y - p) AS residual_std,
    quantile_cont(abs(y - p), 0.5) AS median_ae FROM pred GROUP BY model)"""
_MCOLS = ["rmse", "mae", "r2", "mape", "max_error", "residual_mean", "residual_std", "median_ae"]
_MSEL = "model, n, " + ", ".join(f"round({c}, 4) AS {c}" for c in _MCOLS)
register("G01_regression_metrics", lambda s, d: tidy(ev.regression_metrics(predictions(s, d), ["model"])), sql(METRICS, f"SELECT {_MSEL} FROM metrics"))
register("G07_model_comparison", lambda s, d: tidy(ev.compare_models(ev.regression_metrics(predictions(s, d), ["model"]))),
    sql(METRICS, f"SELECT {_MSEL}, CAST(rank() OVER (ORDER BY metrics.rmse) AS DOUBLE) AS rmse_rank, CAST(rank() OVER (ORDER BY metrics.r2 DESC) AS DOUBLE) AS r2_rank FROM metrics"))
register("W04_model_rank", lambda s, d: ev.regression_metrics(predictions(s, d), ["model"]).select("model", ev.average_rank_over("mae").alias("mae_rank")),
    sql(METRICS, "SELECT model, CAST(rank() OVER (ORDER BY mae) AS DOUBLE) AS mae_rank FROM metrics"))
register("L05_best_model", lambda s, d: ev.best_models(ev.regression_metrics(predictions(s, d), ["model"])),
    sql(METRICS, "SELECT min_by(model, rmse) AS lowest_rmse, max_by(model, r2) AS highest_r2 FROM metrics"))
register("G14_quality_bands", lambda s, d: ev.quality_bands(ev.regression_metrics(predictions(s, d), ["model"])).select("model", "quality", "meets_minimum"),
    sql(METRICS, """SELECT model, CASE WHEN r2 > 0.8 THEN 'excellent' WHEN r2 > 0.6 THEN 'good' ELSE 'low' END AS quality,
  r2 >= 0.45 AND mape <= 35 AS meets_minimum FROM metrics"""))
_Z1 = """y1 AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
  3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta FROM mom),
z1 AS (SELECT *, 1 / sqrt(0.5 * ln(-1 + sqrt(2 * (beta - 1)))) * ln(y / sqrt(2 / (-1 + sqrt(2 * (beta - 1)) - 1)) +
  sqrt(power(y / sqrt(2 / (-1 + sqrt(2 * (beta - 1)) - 1)), 2) + 1)) AS zs FROM y1),
k1 AS (SELECT *, (g2 + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS root FROM z1),
k2 AS (SELECT *, 6 + 8 / root * (2 / root + sqrt(1 + 4 / (root * root))) AS a FROM k1),
k3 AS (SELECT *, (1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))) AS inn FROM k2),
k4 AS (SELECT *, ((1 - 2 / (9 * a)) - sign(inn) * power(abs(inn), 1.0::DOUBLE / 3)) / sqrt(2 / (9 * a)) AS zk FROM k3)"""
register("G02_residual_normality", lambda s, d: tidy(ev.residual_normality(one_model(s, d)).select("n", "g1", "g2", "k2", "residuals_normal"), 4, k2=2),
    sql(f"""{PRED}, e AS (SELECT y - p AS e FROM pred WHERE model = 'list_price'), c AS (SELECT e - (SELECT avg(e) FROM e) AS d FROM e),
mom AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(d * d * d) / power(avg(d * d), 1.5) AS g1, avg(d * d * d * d) / power(avg(d * d), 2) - 3 AS g2 FROM c),
{_Z1}""", "SELECT n, round(g1, 4) AS g1, round(g2, 4) AS g2, round(zs * zs + zk * zk, 2) AS k2, exp(-(zs * zs + zk * zk) / 2) > 0.05 AS residuals_normal FROM k4"))
register("G03_homoscedasticity", lambda s, d: tidy(ev.homoscedasticity(one_model(s, d)), 6),
    sql(f"""{PRED}, r AS (SELECT rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS rp,
  rank() OVER (ORDER BY abs(y - p)) + (count(*) OVER (PARTITION BY abs(y - p)) - 1) / 2 AS ra FROM pred WHERE model = 'list_price')""",
    "SELECT round(corr(rp, ra), 6) AS spearman, abs(corr(rp, ra)) < 0.3 AS homoscedastic FROM r"))


def labels(s, d):
    return invoices(s, d).select(col("PaymentStatus").alias("y"), col("PaymentTermKey").alias("p"))


CLS = f"""{INV},
cells AS (SELECT PaymentStatus AS y, PaymentTermKey AS p, count(*) AS n FROM invoices GROUP BY 1, 2),
rep0 AS (SELECT label, coalesce(support, 0)::BIGINT AS support, coalesce(hits, 0)::BIGINT AS hits, coalesce(called, 0)::BIGINT AS called
  FROM (SELECT y AS label, sum(n) AS support, sum(CASE WHEN y = p THEN n ELSE 0 END) AS hits FROM cells GROUP BY 1) a
  FULL JOIN (SELECT p AS label, sum(n) AS called FROM cells GROUP BY 1) b USING (label)),
rep1 AS (SELECT *, CASE WHEN called > 0 THEN hits / called ELSE 0 END AS "precision", CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall FROM rep0),
rep AS (SELECT *, CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END AS f1 FROM rep1)"""
register("G04_classification_metrics", lambda s, d: tidy(ev.classification_metrics(labels(s, d)), 6),
    sql(CLS, """SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(sum("precision" * support) / sum(support), 6) AS "precision",
  round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1 FROM rep"""))
register("G04b_confusion_matrix", lambda s, d: ev.confusion(labels(s, d)), sql(CLS, "SELECT y, p, n FROM cells"))
register("G04c_class_report", lambda s, d: tidy(ev.class_report(labels(s, d)), 6),
    sql(CLS, """SELECT label, support, hits, called, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1 FROM rep"""))
register("G14b_accuracy_bands", lambda s, d: tidy(ev.accuracy_bands(ev.classification_metrics(labels(s, d))).select("accuracy", "quality", "meets_minimum"), 6),
    sql(CLS, """SELECT round(sum(hits) / sum(support), 6) AS accuracy, CASE WHEN sum(hits) / sum(support) > 0.8 THEN 'good' ELSE 'weak' END AS quality,
  sum(hits) / sum(support) >= 0.65 AS meets_minimum FROM rep"""))


def binary(s, d):
    base = f.delivery_columns(shipments(s, d, "PlannedArrivalDate", "ActualArrivalDate", "TotalWeight"))
    return base.select(col("OnTimeDeliveryFlag").alias("y"), when(col("TotalWeight") > 25, 1).otherwise(0).alias("p"), col("TotalWeight").alias("score"))


BIN = f"""{SHIP}, b AS (SELECT CASE WHEN {VARIANCE} <= 0 THEN 1 ELSE 0 END AS y, CASE WHEN TotalWeight > 25 THEN 1 ELSE 0 END AS p, TotalWeight AS score FROM shipments),
steps0 AS (SELECT score, sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg FROM b GROUP BY 1),
steps AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(neg) OVER (ORDER BY score DESC) AS cn, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM steps0)"""
register("G05_binary_metrics", lambda s, d: tidy(ev.binary_metrics(binary(s, d)), 6),
    sql(BIN, """SELECT tp, tn, fp, fn, round(tn / (tn + fp), 6) AS specificity, round(tn / (tn + fn), 6) AS npv,
  (SELECT round(sum(neg * (cp - pos / 2)) / (max(tp) * max(tn)), 6) FROM steps) AS roc_auc
FROM (SELECT count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp,
  count(*) FILTER (y = 1 AND p = 0) AS fn FROM b)"""))
register("G15_roc_points", lambda s, d: tidy(ev.roc_points(binary(s, d)), 6),
    sql(BIN, "SELECT score AS threshold, round(cp / tp, 6) AS tpr, round(cn / tn, 6) AS fpr FROM steps"))
register("G15b_class_counts", lambda s, d: binary(s, d).groupBy("y").agg(F.count(lit(1)).alias("n")), sql(BIN, "SELECT y, count(*) AS n FROM b GROUP BY 1"))

# ---- series
SERIES = """sums AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS ds, sum(value) AS y FROM events GROUP BY 1, 2),
spans AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM sums GROUP BY 1),
days AS (SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS ds FROM spans),
series AS (SELECT series_id, ds, coalesce(y, 0) AS y FROM days LEFT JOIN sums USING (series_id, ds))"""


def series(s, d):
    e = parquet(s, d, "events")
    return tsr.daily_series(e, col("event_type"), col("ts"), col("value"))


def weekly_naive(s, d):
    """Each day predicted by the day a week before."""
    from pyspark.sql import Window

    w = Window.partitionBy("series_id").orderBy("ds")
    return series(s, d).withColumn("p", F.lag("y", 7).over(w)).filter(col("p").isNotNull())


NAIVE = f"{SERIES}, naive AS (SELECT * FROM (SELECT *, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ds) AS p FROM series) WHERE p IS NOT NULL)"
register("G06_series_metrics", lambda s, d: tidy(ev.series_metrics(weekly_naive(s, d))),
    sql(f"""{NAIVE}, n2 AS (SELECT *, y - lag(y) OVER w AS dy, p - lag(p) OVER w AS dp FROM naive WINDOW w AS (PARTITION BY series_id ORDER BY ds))""",
    """SELECT series_id, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, round(avg(abs((y - p) / (y + 1e-8))) * 100, 4) AS mape,
  round(avg(2 * abs(y - p) / (abs(y) + abs(p) + 1e-8)) * 100, 4) AS smape,
  round(avg(CASE WHEN dy IS NOT NULL THEN CASE WHEN sign(dy) = sign(dp) THEN 1.0::DOUBLE ELSE 0 END END) * 100, 4) AS directional_accuracy,
  round(avg(p - y), 4) AS bias, round(var_pop(p - y), 4) AS variance FROM n2 GROUP BY series_id"""))


def _differences(s, d):
    from pyspark.sql import Window

    w = Window.partitionBy("series_id").orderBy("ds")
    diff = col("y") - F.lag("y").over(w)
    return series(s, d).select("series_id", "ds", diff.alias("Difference"), F.signum(diff).cast("int").alias("Direction"))


register("W09_first_difference", lambda s, d: tidy(_differences(s, d), 6),
    sql(SERIES, """SELECT series_id, ds, round(y - lag(y) OVER w, 6) AS Difference, CAST(sign(y - lag(y) OVER w) AS INTEGER) AS Direction
FROM series WINDOW w AS (PARTITION BY series_id ORDER BY ds)"""))
register("G16_residual_histogram", lambda s, d: tidy(ev.residual_histogram(one_model(s, d)), 4),
    f"WITH {PRED}, r AS (SELECT y - p AS residual FROM pred WHERE model = 'list_price'), {histogram_sql('r', 'residual', 30)}")


def daily_residuals(s, d):
    """Daily demand minus its mean weekday level."""
    from pyspark.sql import Window

    daily = shipments(s, d, "ShipmentDate").groupBy(F.to_date("ShipmentDate").alias("ds")).agg(F.count(lit(1)).alias("y"))
    return daily.select("ds", (col("y") - F.avg("y").over(Window.partitionBy(F.weekday("ds")))).alias("e"))


ACF = f"""{SHIP}, dly AS (SELECT CAST(ShipmentDate AS DATE) AS ds, count(*) AS y FROM shipments GROUP BY 1),
res AS (SELECT ds, y - avg(y) OVER (PARTITION BY isodow(ds)) AS e FROM dly),
cen AS (SELECT row_number() OVER (ORDER BY ds) AS i, e - (SELECT avg(e) FROM res) AS c FROM res)"""
register("G17_autocorrelation", lambda s, d: tidy(ev.autocorrelation(daily_residuals(s, d)), 6),
    sql(ACF, """SELECT CAST(b.i - a.i AS INTEGER) AS lag, round(sum(a.c * b.c) / (SELECT sum(c * c) FROM cen), 6) AS acf
FROM cen a JOIN cen b ON b.i - a.i BETWEEN 1 AND 20 GROUP BY 1"""))
_QQ = ",\n".join(f"({i / 100}::DOUBLE, {NormalDist().inv_cdf(i / 100)!r}::DOUBLE)" for i in range(1, 100))
register("G18_qq_points", lambda s, d: tidy(ev.qq_points(one_model(s, d)), 4),
    sql(f"{PRED}, r AS (SELECT y - p AS e FROM pred WHERE model = 'list_price'), q AS (SELECT quantile_cont(e, [{', '.join(str(i / 100) for i in range(1, 100))}]) AS qs FROM r)",
    f"""SELECT round(probability, 4) AS probability, round(theoretical, 4) AS theoretical, round(qs[CAST(round(probability * 100) AS INTEGER)], 4) AS observed
FROM (VALUES {_QQ}) v(probability, theoretical), q"""))



def _poly(coefficients, x):
    out = repr(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + ({c!r}::DOUBLE))"
    return out


_TAILS = [f"{_poly(st._TAIL_NUMERATOR, r)} / {_poly(st._TAIL_DENOMINATOR, r)}" for r in ("sqrt(-2 * ln(p))", "sqrt(-2 * ln(1 - p))")]
register("G18b_qq_exact", lambda s, d: tidy(ev.qq_exact(predictions(s, d).filter("model = 'list_price'").withColumn("k", col("y")), "k").select("position", "theoretical", "observed"), 4),
    sql(f"""{PRED}, r AS (SELECT y - p AS e, row_number() OVER (ORDER BY y - p) AS i, count(*) OVER () AS n FROM pred WHERE model = 'list_price'),
v AS (SELECT *, CASE WHEN i = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n) WHEN i = 1 THEN 1 - pow(0.5::DOUBLE, 1.0::DOUBLE / n) ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM r)""", f"""
SELECT i AS position, round(CASE WHEN p < 0.02425 THEN {_TAILS[0]} WHEN p > 1 - 0.02425 THEN -({_TAILS[1]})
  ELSE {_poly(st._NUMERATOR, "((p - 0.5) * (p - 0.5))")} * (p - 0.5) / {_poly(st._DENOMINATOR, "((p - 0.5) * (p - 0.5))")} END, 4) AS theoretical, round(e, 4) AS observed FROM v"""))

# ---- drift: first half of the month against the second
COLS = ["value", "user_id"]
CUT = "2024-01-16"


def halves(s, d):
    e = parquet(s, d, "events").select("ts", *COLS)
    cut = lit(CUT).cast("timestamp_ntz")
    return e.filter(col("ts") < cut), e.filter(col("ts") >= cut)


DRIFT = f"""obs AS (
  SELECT 'value' AS "column", value AS x, CASE WHEN ts < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS cur FROM events
  UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE), CASE WHEN ts < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END FROM events),
cnt AS (SELECT "column", x, sum(1 - cur)::BIGINT AS r, sum(cur)::BIGINT AS c FROM obs GROUP BY 1, 2),
st AS (SELECT *, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY "column") AS n1, sum(c) OVER (PARTITION BY "column") AS n2
  FROM cnt WINDOW w AS (PARTITION BY "column" ORDER BY x)),
ks0 AS (SELECT "column", max(abs(cr / n1 - cc / n2)) AS d, max(n1)::BIGINT AS n1, max(n2)::BIGINT AS n2 FROM st GROUP BY 1),
ks AS (SELECT *, sqrt(n1 * n2 / (n1 + n2)) * d AS lam FROM ks0),
ksp AS (SELECT *, CASE WHEN lam < 0.2 THEN 1 ELSE least(1, greatest(0, 2 * list_sum(list_transform(range(1, 101),
  lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * lam * lam))))) END AS p FROM ks),
mw0 AS (SELECT "column", sum(r * (cr + cc - (r + c) + (r + c + 1) / 2)) AS r1, sum(power(r + c, 3) - (r + c)) AS ties, max(n1)::DOUBLE AS n1, max(n2)::DOUBLE AS n2 FROM st GROUP BY 1),
mw1 AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u, sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS sd FROM mw0),
mw2 AS (SELECT *, greatest(abs(u - n1 * n2 / 2) - 0.5, 0) / sd / sqrt(2) AS z FROM mw1),
mw AS (SELECT "column", u, 1 / (1 + z / 2) * exp(-z * z + ({'('.join(f'{c!r} + 1 / (1 + z / 2) * ' for c in st.ERFC_COEFFICIENTS[:-1])}{st.ERFC_COEFFICIENTS[-1]!r}{')' * (len(st.ERFC_COEFFICIENTS) - 1)}) AS p FROM mw2),
ends AS (SELECT "column", min(x) AS lo, max(x) AS hi FROM obs WHERE cur = 0 GROUP BY 1),
bins AS (SELECT "column", greatest(0, least(9, CAST(ceil((x - lo) / (hi - lo) * 10) AS INTEGER) - 1)) AS bin, sum(1 - cur) AS r, sum(cur) AS c
  FROM obs JOIN ends USING ("column") WHERE x BETWEEN lo AND hi GROUP BY 1, 2),
tot AS (SELECT "column", sum(r) AS nr, sum(c) AS nc FROM bins GROUP BY 1),
grid AS (SELECT "column", CAST(unnest(range(10)) AS INTEGER) AS bin FROM ends),
sh AS (SELECT "column", coalesce(r, 0) / nr + 1e-10 AS r, coalesce(c, 0) / nc + 1e-10 AS c FROM grid LEFT JOIN bins USING ("column", bin) JOIN tot USING ("column")),
psi AS (SELECT "column", sum((c - r) * ln(c / r)) AS psi FROM sh GROUP BY 1),
mo AS (SELECT "column", avg(x) FILTER (cur = 0) AS rm, avg(x) FILTER (cur = 1) AS cm, stddev_samp(x) FILTER (cur = 0) AS rs FROM obs GROUP BY 1),
vd AS (SELECT "column", d, ksp.p AS kp, mw.p AS mp, psi, abs(cm - rm) / (rs + 1e-8) AS shift, ksp.p < 0.05 OR mw.p < 0.05 OR psi > 0.2 AS hit
  FROM ksp JOIN mw USING ("column") JOIN psi USING ("column") JOIN mo USING ("column"))"""
register("G08_kolmogorov_smirnov", lambda s, d: tidy(dr.kolmogorov_smirnov(dr.distribution_steps(*halves(s, d), COLS)), 6),
    sql(DRIFT, 'SELECT "column", round(d, 6) AS ks_statistic, n1, n2, round(p, 6) AS ks_pvalue FROM ksp'))
register("W12_distribution_steps", lambda s, d: dr.distribution_steps(*halves(s, d), COLS).select("column", "value", "cum_ref", "cum_cur"),
    sql(DRIFT, 'SELECT "column", x AS "value", cr::BIGINT AS cum_ref, cc::BIGINT AS cum_cur FROM st'))
register("G09_mann_whitney", lambda s, d: tidy(dr.mann_whitney(dr.distribution_steps(*halves(s, d), COLS)), 6),
    sql(DRIFT, 'SELECT "column", round(u, 6) AS mw_statistic, round(p, 6) AS mw_pvalue FROM mw'))
register("G10_stability_index", lambda s, d: tidy(dr.stability_index(*halves(s, d), COLS), 6), sql(DRIFT, 'SELECT "column", round(psi, 6) AS psi FROM psi'))
register("G11_drift_verdict", lambda s, d: tidy(dr.verdicts(*halves(s, d), COLS).select("column", "ks_statistic", "ks_pvalue", "mw_pvalue", "psi", "mean_shift", "drift_detected"), 6),
    sql(DRIFT, """SELECT "column", round(d, 6) AS ks_statistic, round(kp, 6) AS ks_pvalue, round(mp, 6) AS mw_pvalue, round(psi, 6) AS psi,
  round(shift, 6) AS mean_shift, hit AS drift_detected FROM vd"""))
register("G11b_drift_overall", lambda s, d: tidy(dr.overall(dr.verdicts(*halves(s, d), COLS)), 6),
    sql(DRIFT, """SELECT count(*) AS features_checked, count(*) FILTER (hit) AS features_with_drift, round(count(*) FILTER (hit) / count(*), 6) AS drift_score,
  CASE WHEN count(*) FILTER (hit) / count(*) > 0.3 THEN 'significant' WHEN count(*) FILTER (hit) / count(*) > 0.1 THEN 'moderate' ELSE 'low' END AS drift_level,
  CASE WHEN count(*) FILTER (hit) > 5 THEN 'retrain' WHEN count(*) FILTER (hit) > 0 THEN 'watch' ELSE 'healthy' END AS alert_level FROM vd"""))


def degraded(s, d):
    """Models on order lines of the last linestatus against those of the first."""
    def part_of(flag):
        base = parquet(s, d, "lineitem").filter(col("l_linestatus") == flag).join(parquet(s, d, "part"), col("l_partkey") == col("p_partkey"))
        factor = 1.0 if flag == "F" else 1.1
        listed = col("l_quantity") * col("p_retailprice") * factor
        rows = [F.struct(lit("list_price").alias("model"), listed.alias("p")), F.struct(lit("damped").alias("model"), (listed * 0.5 + 25000.0).alias("p"))]
        return ev.regression_metrics(base.select(col("l_extendedprice").alias("y"), F.inline(F.array(*rows))), ["model"])
    return dr.degradation(part_of("O"), part_of("F"))


def _deg(flag: str, factor: str) -> str:
    pieces = "\n  UNION ALL ".join(
        f"SELECT '{m}' AS model, l_extendedprice AS y, {e} AS p FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = '{flag}'"
        for m, e in (("list_price", f"l_quantity * p_retailprice * {factor}::DOUBLE"), ("damped", f"l_quantity * p_retailprice * {factor}::DOUBLE * 0.5::DOUBLE + 25000")))
    return f"(SELECT model, sqrt(avg((y - p) * (y - p))) AS rmse, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM ({pieces}) GROUP BY 1)"


DEG = f"""deg AS (SELECT c.model, c.rmse, c.r2, b.rmse AS baseline_rmse, b.r2 AS baseline_r2, (c.rmse - b.rmse) / b.rmse AS rmse_change, (b.r2 - c.r2) / b.r2 AS r2_change
  FROM {_deg('O', '1.1')} c JOIN {_deg('F', '1.0')} b USING (model))"""
register("G12_degradation", lambda s, d: tidy(degraded(s, d)),
    sql(DEG, "SELECT model, " + ", ".join(f"round({c}, 4) AS {c}" for c in ("rmse", "r2", "baseline_rmse", "baseline_r2", "rmse_change", "r2_change")) +
        ", deg.rmse_change > 0.1 AS rmse_alert, deg.r2_change > 0.1 AS r2_alert FROM deg"))


def accuracies(s, d, flag):
    """Share of order lines that each price model puts on the right side of 30,000."""
    base = parquet(s, d, "lineitem").filter(col("l_linestatus") == flag).join(parquet(s, d, "part"), col("l_partkey") == col("p_partkey"))
    listed = col("l_quantity") * col("p_retailprice") * (1.0 if flag == "F" else 1.1)
    rows = [F.struct(lit("list_price").alias("model"), listed.alias("p")), F.struct(lit("damped").alias("model"), (listed * 0.5 + 15000.0).alias("p"))]
    both = base.select((col("l_extendedprice") > 30000).alias("y"), F.inline(F.array(*rows)))
    return both.groupBy("model").agg(F.avg((col("y") == (col("p") > 30000)).cast("double")).alias("accuracy"))


def _acc(flag, factor):
    listed = f"l_quantity * p_retailprice * {factor}::DOUBLE"
    pieces = " UNION ALL ".join(f"SELECT '{m}' AS model, (l_extendedprice > 30000) = ({e} > 30000) AS hit FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = '{flag}'"
                                for m, e in (("list_price", listed), ("damped", f"({listed} * 0.5::DOUBLE + 15000)")))
    return f"(SELECT model, avg(hit::INTEGER::DOUBLE) AS accuracy FROM ({pieces}) GROUP BY 1)"


register("G12b_accuracy_degradation", lambda s, d: tidy(dr.accuracy_degradation(accuracies(s, d, "O"), accuracies(s, d, "F"))), f"""
SELECT model, round(c.accuracy, 4) AS accuracy, round(b.accuracy, 4) AS baseline_accuracy, round((b.accuracy - c.accuracy) / b.accuracy, 4) AS accuracy_change,
  (b.accuracy - c.accuracy) / b.accuracy > 0.05 AS accuracy_alert FROM {_acc('O', '1.1')} c JOIN {_acc('F', '1.0')} b USING (model)""")
register("G13_alert_summary", lambda s, d: dr.alert_summary(dr.alerts(dr.verdicts(*halves(s, d), COLS), degraded(s, d))),
    sql(f"{DRIFT}, {DEG}, n AS (SELECT (SELECT count(*) FILTER (hit) FROM vd) AS a, (SELECT count(*) FILTER (rmse_change > 0.1) + count(*) FILTER (r2_change > 0.1) FROM deg) AS b)",
    """SELECT a + b AS total_alerts, a AS drift_alerts, b AS performance_alerts,
  CASE WHEN a + b > 5 THEN 'retrain' WHEN a + b > 0 THEN 'watch' ELSE 'healthy' END AS alert_level FROM n"""))

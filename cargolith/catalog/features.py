"""Preprocessing, features and selection E01-E16, A34, A38, A39, L03, percent ranks W03."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolith.catalog import binding as b
from cargolith.catalog import sqlops as o
from cargolith.catalog.registry import register, tidy
from cargolith.catalog.sqlbase import INV, SHIP, VARIANCE, season, sql
from cargolith.operators.ranking import percent_rank_columns
from cargolith.plans import features as f
from cargolith.plans import selection as sel
from cargolith.sources.marts import invoices, shipments

col, lit = F.col, F.lit
_MEAS = ["TotalWeight", "TotalVolume", "ShipmentValue"]


def ship_rows(s, d):
    return b.ship_rows(s, d).drop("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def fences(table: str, columns: list[str], name: str = "fences") -> str:
    rows = "\n  UNION ALL ".join(
        f"""SELECT '{c}' AS "column", quantile_cont({c}, 0.25) AS Q1, quantile_cont({c}, 0.75) AS Q3 FROM {table}""" for c in columns
    )
    return f"""{name} AS (SELECT *, Q1 - (Q3 - Q1) * 1.5::DOUBLE AS Lower, Q3 + (Q3 - Q1) * 1.5::DOUBLE AS Upper FROM ({rows}))"""


def fence(c: str, name: str = "fences") -> str:
    lo, hi = (f"""(SELECT {e} FROM {name} WHERE "column" = '{c}')""" for e in ("Lower", "Upper"))
    return f"CASE WHEN {c} < {lo} THEN {lo} WHEN {c} > {hi} THEN {hi} ELSE {c} END"


_AMT = ["TotalAmount", "NetAmount", "TaxAmount"]
register("E01_winsorise", lambda s, d: tidy(f.winsorise(invoices(s, d).select("InvoiceID", "InvoiceType", *_AMT), _AMT), 6),
    sql(f"{INV}, {fences('invoices', _AMT)}", "SELECT InvoiceID, InvoiceType, " + ", ".join(f"round({fence(c)}, 6) AS {c}" for c in _AMT) + " FROM invoices"))
register("E01b_outlier_counts", lambda s, d: f.outlier_counts(invoices(s, d), _AMT),
    sql(f"{INV}, {fences('invoices', _AMT)}", "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", (SELECT count(*) FROM invoices WHERE {c} < Lower OR {c} > Upper) AS Outliers FROM fences WHERE "column" = '{c}'""" for c in _AMT)))
register("E02_impute", lambda s, d: f.impute(
        ship_rows(s, d).select("ShipmentID", "TotalPackages", "ShipmentValue").join(
            b.invoice_rows(s, d).select((col("InvoiceID") * 10 + 1).alias("ShipmentID"), "CustomerName"), "ShipmentID", "left").groupBy("ShipmentID").agg(
            F.max("TotalPackages").alias("TotalPackages"), F.max("ShipmentValue").alias("ShipmentValue"), F.max("CustomerName").alias("CustomerName")),
        ["TotalPackages", "ShipmentValue"], ["CustomerName"]),
    sql(f"{o.SHIP_ROWS}, {o.INVOICE_ROWS}, " + """g AS (SELECT ShipmentID, max(TotalPackages) AS tp, max(ShipmentValue) AS sv, max(i.CustomerName) AS cn
  FROM ship_rows s LEFT JOIN (SELECT InvoiceID * 10 + 1 AS sid, CustomerName FROM invoice_rows) i ON ShipmentID = sid GROUP BY 1)""",
    """SELECT ShipmentID, CAST(coalesce(tp, (SELECT quantile_cont(tp, 0.5) FROM g)) AS DOUBLE) AS TotalPackages,
  coalesce(sv, (SELECT quantile_cont(sv, 0.5) FROM g)) AS ShipmentValue,
  coalesce(cn, (SELECT cn FROM g WHERE cn IS NOT NULL GROUP BY cn ORDER BY count(*) DESC, cn LIMIT 1)) AS CustomerName FROM g"""))
PRE = f"""{o.SHIP_ROWS}, {fences('ship_rows', _MEAS)},
pre AS (SELECT ShipmentID, CAST(date_diff('day', PlannedArrivalDate, ActualArrivalDate) AS INTEGER) AS v,
  {', '.join(f"{fence(c)} AS {c}" for c in _MEAS)}, TotalPackages FROM ship_rows)"""
register("E03_preprocess_shipments", lambda s, d: tidy(f.preprocess_shipments(ship_rows(s, d)).groupBy("OnTimeDeliveryFlag").agg(
        F.count(lit(1)).alias("n"), *[F.sum(c).alias(c) for c in [*_MEAS, "TotalPackages", "DeliveryVariance"]]), 2),
    sql(PRE, "SELECT CASE WHEN v <= 0 THEN 1 ELSE 0 END AS OnTimeDeliveryFlag, count(*) AS n, " + ", ".join(
        f"round(sum(CAST(coalesce({x}, (SELECT quantile_cont({x}, 0.5) FROM pre)) AS DOUBLE)), 2) AS {c}" for c, x in
        [*[(c, c) for c in _MEAS], ("TotalPackages", "TotalPackages"), ("DeliveryVariance", "v")]) + " FROM pre GROUP BY 1"))
register("E04_preprocess_invoices", lambda s, d: tidy(f.preprocess_invoices(b.invoice_rows(s, d)).select(
        "InvoiceID", "InvoiceType", "TotalAmount", "TaxAmount", "PaymentStatus", "TaxRate"), 6),
    sql(f"{o.INVOICE_ROWS}, {fences('invoice_rows', _AMT)}", f"""SELECT InvoiceID, InvoiceType, round({fence('TotalAmount')}, 6) AS TotalAmount,
  round({fence('TaxAmount')}, 6) AS TaxAmount, {o.STATUS} AS PaymentStatus,
  round(least(greatest(TaxAmount / (NetAmount + 1e-6), 0), 1), 6) AS TaxRate FROM invoice_rows"""))
register("A39_preprocessing_stats", lambda s, d: f.preprocessing_stats(ship_rows(s, d)),
    sql(o.SHIP_ROWS, 'SELECT count(*) AS "Rows", (' + " + ".join(f"count(*) - count({c})" for c in (
        "ShipmentID ShipmentDate PlannedArrivalDate ActualDepartureDate ActualArrivalDate TotalWeight TotalVolume TotalPackages ShipmentValue CustomerName "
        "OriginLocationID DestinationLocationID EquipmentID FreightTypeID IsDelivered DurationDays").split()) +
        ") AS MissingValues, 7 AS NumericColumns, 5 AS TextColumns, 4 AS DateColumns FROM ship_rows"))
_SF = ["ShipmentID", "Month", "Quarter", "DayOfWeek", "Year", "IsWeekend", "DayOfMonth", "WeekOfYear", "Season", "PlannedDuration", "ActualDuration",
       "DeliveryVariance", "OnTimeDeliveryFlag", "ShipmentSize", "ValueCategory", "Month_sin", "DayOfWeek_cos", "ValuePerWeight"]
_WID = "(['Small', 'Medium', 'Large'])[greatest(0, least(2, CAST(ceil((TotalWeight - a) / (b - a) * 3) AS INTEGER) - 1)) + 1]"
_VID = "(['Low', 'Medium', 'High', 'Premium'])[greatest(0, least(3, CAST(ceil((ShipmentValue - c) / (d - c) * 4) AS INTEGER) - 1)) + 1]"
register("E05_shipment_features", lambda s, d: tidy(f.shipment_features(shipments(s, d, "ShipmentID", "ShipmentDate", "PlannedArrivalDate", "ActualArrivalDate",
        *_MEAS, "TotalPackages")).select(*_SF), 6),
    sql(f"{SHIP}, e AS (SELECT min(TotalWeight) AS a, max(TotalWeight) AS b, min(ShipmentValue) AS c, max(ShipmentValue) AS d FROM shipments)", f"""
SELECT ShipmentID, month(ShipmentDate)::INTEGER AS Month, quarter(ShipmentDate)::INTEGER AS Quarter, (isodow(ShipmentDate) - 1)::INTEGER AS DayOfWeek,
  year(ShipmentDate)::INTEGER AS Year, CASE WHEN isodow(ShipmentDate) >= 6 THEN 1 ELSE 0 END AS IsWeekend, day(ShipmentDate)::INTEGER AS DayOfMonth,
  week(ShipmentDate)::INTEGER AS WeekOfYear, {season('ShipmentDate')} AS Season, 30 AS PlannedDuration,
  CAST(date_diff('day', ShipmentDate, ActualArrivalDate) AS INTEGER) AS ActualDuration, {VARIANCE} AS DeliveryVariance,
  CASE WHEN {VARIANCE} <= 0 THEN 1 ELSE 0 END AS OnTimeDeliveryFlag, {_WID} AS ShipmentSize, {_VID} AS ValueCategory,
  round(sin(month(ShipmentDate) * (2 * pi() / 12)), 6) + 0 AS Month_sin, round(cos((isodow(ShipmentDate) - 1) * (2 * pi() / 7)), 6) + 0 AS DayOfWeek_cos,
  round(ShipmentValue / (TotalWeight + 1e-6), 6) AS ValuePerWeight FROM shipments, e"""))
register("E06_invoice_features", lambda s, d: tidy(f.invoice_features(invoices(s, d), b.as_of()).select(
        "InvoiceID", "InvoiceType", "TaxRate", "ProfitMargin", "Month", "IsMonthEnd", "IsQuarterEnd", "Season", "PaymentPeriod", "IsOverdue", "AmountCategory"), 6),
    sql(f"{INV}, e AS (SELECT min(NetAmount) AS a, max(NetAmount) AS b FROM invoices)", f"""
SELECT InvoiceID, InvoiceType, round(TaxAmount / (NetAmount + 1e-6), 6) AS TaxRate, round((NetAmount - TotalAmount) / (NetAmount + 1e-6), 6) AS ProfitMargin,
  month(InvoiceDate)::INTEGER AS Month, CASE WHEN day(InvoiceDate) > 25 THEN 1 ELSE 0 END AS IsMonthEnd,
  CASE WHEN month(InvoiceDate) IN (3, 6, 9, 12) THEN 1 ELSE 0 END AS IsQuarterEnd, {season('InvoiceDate')} AS Season,
  CAST(date_diff('day', InvoiceDate, PaymentDueDate) AS INTEGER) AS PaymentPeriod, CASE WHEN TIMESTAMP '2002-01-01' > PaymentDueDate THEN 1 ELSE 0 END AS IsOverdue,
  (['XS', 'S', 'M', 'L', 'XL'])[greatest(0, least(4, CAST(ceil((NetAmount - a) / (b - a) * 5) AS INTEGER) - 1)) + 1] AS AmountCategory FROM invoices, e"""))

# ---- selection
FEATS = ["TotalWeight", "TotalVolume", "TotalPackages", "ShipmentValue", "Month", "DayOfWeek"]
K = 4


def matrix(s, d):
    base = shipments(s, d, "ShipmentDate", "PlannedArrivalDate", "ActualArrivalDate", *_MEAS, "TotalPackages")
    return f.delivery_columns(base.withColumn("Month", F.month("ShipmentDate")).withColumn("DayOfWeek", F.weekday("ShipmentDate")))


MATRIX = f"""{SHIP},
m AS (SELECT TotalWeight, TotalVolume, TotalPackages, ShipmentValue, month(ShipmentDate) AS Month, isodow(ShipmentDate) - 1 AS DayOfWeek,
  {VARIANCE} AS DeliveryVariance, CASE WHEN {VARIANCE} <= 0 THEN 1 ELSE 0 END AS OnTimeDeliveryFlag FROM shipments),
long AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, DeliveryVariance AS v, OnTimeDeliveryFlag AS y FROM m" for c in FEATS)})"""
FREG = f"""{MATRIX},
freg AS (SELECT feature, power(corr(x, v), 2) / (1 - power(corr(x, v), 2)) * (count(*) - 2) AS score FROM long GROUP BY 1)"""
FCLS = f"""{MATRIX},
grp AS (SELECT feature, y, count(*) AS n, avg(x) AS mean, var_pop(x) AS var FROM long GROUP BY 1, 2),
tot AS (SELECT feature, sum(n) AS N, count(*) AS k, sum(n * mean) / sum(n) AS grand FROM grp GROUP BY 1),
fcls AS (SELECT feature, (sum(n * power(mean - grand, 2)) / (max(k) - 1)) / (sum(n * var) / (max(tot.N) - max(k))) AS score
  FROM grp JOIN tot USING (feature) GROUP BY 1)"""
FCLS = FCLS.replace("sum(n) AS N, count(*) AS k", "sum(n) AS total, count(*) AS k").replace("max(tot.N)", "max(total)")


def ranked_sql(source: str, method: str, k: int = K, digits: int = 6) -> str:
    return f"""SELECT feature, round(score, {digits}) AS score, CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, feature) AS INTEGER) AS rank, '{method}' AS method,
  row_number() OVER (ORDER BY score DESC NULLS LAST, feature) <= {k} AS selected FROM {source}"""


register("E07_f_regression", lambda s, d: tidy(sel.ranked(sel.f_regression(matrix(s, d), FEATS, "DeliveryVariance"), "f_regression", K), 6),
    sql(FREG, ranked_sql("freg", "f_regression")))
register("L03_top_features", lambda s, d: tidy(sel.ranked(sel.f_regression(matrix(s, d), FEATS, "DeliveryVariance"), "f_regression", 3).filter("selected").select("feature", "score"), 6),
    sql(FREG, "SELECT feature, round(score, 6) AS score FROM freg ORDER BY freg.score DESC, feature LIMIT 3"))
register("E08_f_classification", lambda s, d: tidy(sel.ranked(sel.f_classification(matrix(s, d), FEATS, "OnTimeDeliveryFlag"), "f_classification", K), 6),
    sql(FCLS, ranked_sql("fcls", "f_classification")))
_BIN = "greatest(0, least(9, CAST(ceil((x - lo) / (hi - lo) * 10) AS INTEGER) - 1))"
MI = f"""{MATRIX},
edges AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM long GROUP BY 1),
cells AS (SELECT feature, {_BIN} AS xb, y, count(*) AS n FROM long JOIN edges USING (feature) GROUP BY 1, 2, 3),
shares AS (SELECT feature, n / sum(n) OVER (PARTITION BY feature) AS pxy,
  sum(n) OVER (PARTITION BY feature, xb) / sum(n) OVER (PARTITION BY feature) AS px,
  sum(n) OVER (PARTITION BY feature, y) / sum(n) OVER (PARTITION BY feature) AS py FROM cells),
mi AS (SELECT feature, sum(pxy * ln(pxy / (px * py))) AS score FROM shares GROUP BY 1)"""
register("E09_mutual_information", lambda s, d: tidy(sel.ranked(sel.mutual_information(matrix(s, d), FEATS, "OnTimeDeliveryFlag", bin_target=False), "mutual_info", K), 9),
    sql(MI, ranked_sql("mi", "mutual_info", digits=9)))
MIB = MI.replace(f"cells AS (SELECT feature, {_BIN} AS xb, y, count(*) AS n FROM long JOIN edges USING (feature) GROUP BY 1, 2, 3)",
    f"""span AS (SELECT min(v) AS vlo, max(v) AS vhi FROM long),
cells AS (SELECT feature, {_BIN} AS xb, greatest(0, least(9, CAST(ceil((v - vlo) / (vhi - vlo) * 10) AS INTEGER) - 1)) AS y, count(*) AS n FROM long JOIN edges USING (feature), span GROUP BY 1, 2, 3)""")
register("E09b_mutual_information_numeric", lambda s, d: tidy(sel.ranked(sel.mutual_information(matrix(s, d), FEATS, "DeliveryVariance"), "mutual_info", K), 9),
    sql(MIB, ranked_sql("mi", "mutual_info", digits=9)))
register("E10_uncorrelated_features", lambda s, d: tidy(sel.greedy_uncorrelated(matrix(s, d), FEATS, "DeliveryVariance", K), 6),
    sql(f"{MATRIX}, tc AS (SELECT feature, abs(corr(x, v)) AS score FROM long GROUP BY 1)", f"SELECT * FROM ({ranked_sql('tc', 'correlation')}) WHERE selected"))
VARS = f"{MATRIX}, vr AS (SELECT feature, var_samp(x) AS score FROM long GROUP BY 1 HAVING var_pop(x) > 0.01)"
register("E11_variance_selection", lambda s, d: tidy(sel.ranked(sel.variances(matrix(s, d), FEATS), "variance", K), 4, score=2),
    sql(VARS, ranked_sql("vr", "variance", digits=2)))


def rankings(s, d):
    m = matrix(s, d)
    a = sel.ranked(sel.f_regression(m, FEATS, "DeliveryVariance"), "f_regression", K)
    c = sel.ranked(sel.target_correlation(m, FEATS, "DeliveryVariance"), "correlation", K)
    v = sel.ranked(sel.variances(m, FEATS), "variance", K)
    return a.unionByName(c).unionByName(v)


RANKINGS = f"""{FREG}, tc AS (SELECT feature, abs(corr(x, v)) AS score FROM long GROUP BY 1),
vr AS (SELECT feature, var_samp(x) AS score FROM long GROUP BY 1 HAVING var_pop(x) > 0.01),
rk AS ({ranked_sql('freg', 'f_regression')} UNION ALL {ranked_sql('tc', 'correlation')} UNION ALL {ranked_sql('vr', 'variance')})"""
register("E12_ensemble_vote", lambda s, d: tidy(sel.votes(rankings(s, d), K), 6),
    sql(RANKINGS, f"SELECT feature, round(sum(({K} - (rank - 1)) / {K}), 6) AS ensemble_score FROM rk WHERE selected GROUP BY 1"))
register("E13_selection_report", lambda s, d: rankings(s, d).select("method", "feature", "rank", "selected"),
    sql(RANKINGS, "SELECT method, feature, rank, selected FROM rk"))
register("A38_selection_frequency", lambda s, d: sel.report(rankings(s, d)),
    sql(RANKINGS, "SELECT feature, count(*) AS selection_frequency FROM rk WHERE selected GROUP BY 1"))


def importances(s, d):
    """Share of each feature in the total score of two relevance models."""
    m = matrix(s, d)
    parts = [sel.target_correlation(m, FEATS, t).withColumn("model", lit(t)) for t in ("DeliveryVariance", "OnTimeDeliveryFlag")]
    return parts[0].unionByName(parts[1]).withColumnRenamed("score", "importance")


register("A34_importance_consolidation", lambda s, d: tidy(sel.consolidated(importances(s, d)), 6),
    sql(f"{MATRIX}, imp AS (SELECT feature, abs(corr(x, v)) AS importance FROM long GROUP BY 1 UNION ALL SELECT feature, abs(corr(x, y)) FROM long GROUP BY 1)",
    'SELECT feature, round(avg(importance), 6) AS mean, round(stddev_samp(importance), 6) AS std, count(*) AS count FROM imp GROUP BY 1'))


def _scaled(s, d):
    df = shipments(s, d, "ShipmentID", "TotalWeight", "ShipmentValue")
    out = df
    for method in ("robust", "standard", "minmax"):
        out = f.scaled(out, ["ShipmentValue"], method).withColumnRenamed("ShipmentValue_scaled", method)
    return out.select("ShipmentID", "ShipmentValue", "robust", "standard", "minmax")


register("E14_scaling", lambda s, d: tidy(_scaled(s, d), 6),
    sql(SHIP, """SELECT ShipmentID, ShipmentValue, round((ShipmentValue - q2) / (q3 - q1), 6) AS robust, round((ShipmentValue - mu) / sd, 6) AS standard,
  round((ShipmentValue - lo) / (hi - lo), 6) AS minmax FROM shipments, (SELECT quantile_cont(ShipmentValue, 0.25) AS q1, quantile_cont(ShipmentValue, 0.5) AS q2,
    quantile_cont(ShipmentValue, 0.75) AS q3, avg(ShipmentValue) AS mu, stddev_pop(ShipmentValue) AS sd, min(ShipmentValue) AS lo, max(ShipmentValue) AS hi FROM shipments)"""))


def _kinds(s, d):
    frames = {"shipments": shipments(s, d, "ShipmentID", "ShipmentDate", "TotalWeight"), "invoices": invoices(s, d)}
    parts = [df.agg(lit(n).alias("TableName"), lit(f.data_kind(df)).alias("Kind"), F.count(lit(1)).alias("RowsSeen")) for n, df in frames.items()]
    return parts[0].unionByName(parts[1])


register("E15_data_kind", _kinds,
    sql(f"{SHIP}, {INV}", """SELECT 'shipments' AS TableName, 'shipment' AS Kind, count(*) AS RowsSeen FROM shipments
UNION ALL SELECT 'invoices', 'invoice', count(*) FROM invoices"""))
register("E16_derived_targets", lambda s, d: f.derived_targets(shipments(s, d, "ShipmentID", "ShipmentDate", "PlannedArrivalDate", "ActualArrivalDate").select(
        "ShipmentID", F.datediff("PlannedArrivalDate", "ShipmentDate").alias("PlannedDuration"), F.datediff("ActualArrivalDate", "ShipmentDate").alias("ActualDuration"))),
    sql(SHIP, f"""SELECT ShipmentID, 30 AS PlannedDuration, CAST(date_diff('day', ShipmentDate, ActualArrivalDate) AS INTEGER) AS ActualDuration,
  {VARIANCE} AS DeliveryVariance, CASE WHEN {VARIANCE} <= 0 THEN 1 ELSE 0 END AS OnTimeDeliveryFlag FROM shipments"""))
register("W03_percent_rank", lambda s, d: tidy(percent_rank_columns(shipments(s, d, "ShipmentID", "TotalWeight", "ShipmentValue"),
        {"TotalWeight": "WeightRank", "ShipmentValue": "ValueRank"}), 9),
    sql(SHIP, """SELECT ShipmentID, TotalWeight, ShipmentValue,
  round((rank() OVER (ORDER BY TotalWeight) + (count(*) OVER (PARTITION BY TotalWeight) - 1) / 2) / count(*) OVER (), 9) AS WeightRank,
  round((rank() OVER (ORDER BY ShipmentValue) + (count(*) OVER (PARTITION BY ShipmentValue) - 1) / 2) / count(*) OVER (), 9) AS ValueRank FROM shipments"""))

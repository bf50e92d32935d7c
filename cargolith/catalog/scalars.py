"""Scalar functions X, D, M, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolith.catalog import binding as b
from cargolith.catalog import sqlops as o
from cargolith.catalog.registry import register, tidy
from cargolith.catalog.sqlbase import DELIVERY, INV, RFM, SCORES, SHIP, VARIANCE, season, sql
from cargolith.catalog.warehouse import PERF, costs, COSTS, shipment_performance
from cargolith.functions import bins, dates as dt, measures as m, text
from cargolith.operators.stats import with_bounds
from cargolith.plans import customers as cust
from cargolith.plans import features as feat
from cargolith.plans import kpis
from cargolith.sources import operational as op
from cargolith.sources.marts import invoices, shipments
from cargolith.sources.tables import parquet

col, lit, when = F.col, F.lit, F.when

# ---- text
register("X01_trim_case_title", lambda s, d: op.party(s, d).select(
        "ID", "IsClient", text.clean_id(col("CodeClient")).alias("Code"), F.lower(F.trim("RaisonSociale")).alias("Lower"),
        text.title_case(F.trim("RaisonSociale")).alias("Title")),
    sql(o.PARTY, f"""SELECT ID, IsClient, upper(trim(CodeClient)) AS Code, lower(trim(RaisonSociale)) AS Lower, {o.title('trim(RaisonSociale)')} AS Title
FROM party"""))
register("X02_blank_default", lambda s, d: op.materials(s, d).select("ID", F.trim(text.text_or(col("Nom"), "")).alias("Name"), F.trim("Code").alias("Code")),
    sql(o.MATERIALS, "SELECT ID, trim(coalesce(Nom, '')) AS Name, trim(Code) AS Code FROM materials"))
register("X03_cast_unknown", lambda s, d: op.materials(s, d).select(text.text_or(col("ID")).alias("Code"), text.text_or(col("TypeCode")).alias("Category")),
    sql(o.MATERIALS, "SELECT CAST(ID AS VARCHAR) AS Code, coalesce(TypeCode, 'Unknown') AS Category FROM materials"))
register("X04_fiscal_period", lambda s, d: parquet(s, d, "orders").groupBy(dt.fiscal_period(col("o_orderdate")).alias("FiscalPeriod")).agg(F.count(lit(1)).alias("Orders")),
    "SELECT strftime(o_orderdate, '%Y-P%m') AS FiscalPeriod, count(*) AS Orders FROM orders GROUP BY 1")
register("X05_folded_name", lambda s, d: op.party(s, d).select("ID", "IsClient", text.fold_name(col("RaisonSociale")).alias("Name")),
    sql(o.PARTY, f"SELECT ID, IsClient, {o.fold('RaisonSociale')} AS Name FROM party"))

# ---- dates
_K = "o_orderkey"
_RAW = """raw AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 10 = 0 THEN 'bad date' WHEN o_orderkey % 10 = 1 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t,
  CASE WHEN o_orderkey % 50 = 3 THEN TIMESTAMP '1970-05-01' ELSE o_orderdate END AS e FROM orders)"""


def _raw(s, d):
    k = col("o_orderkey")
    return parquet(s, d, "orders").select(
        "o_orderkey", "o_orderdate",
        when(k % 10 == 0, "bad date").when(k % 10 == 1, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("t"),
        when(k % 50 == 3, dt.instant("1970-05-01")).otherwise(col("o_orderdate")).alias("e"))


register("D01_parse", lambda s, d: _raw(s, d).select(_K, dt.parse_instant(col("t")).alias("Parsed")),
    sql(_RAW, "SELECT o_orderkey, TRY_CAST(t AS TIMESTAMP) AS Parsed FROM raw"))
register("D02_date_key", lambda s, d: parquet(s, d, "orders").select(_K, dt.date_key(col("o_orderdate")).alias("DateKey")),
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS DateKey FROM orders")
register("D03_parts", lambda s, d: parquet(s, d, "orders").select(
        _K, F.dayofmonth("o_orderdate").alias("Day"), F.month("o_orderdate").alias("Month"), F.year("o_orderdate").alias("Year"),
        F.quarter("o_orderdate").alias("Quarter"), dt.weekday0(col("o_orderdate")).alias("DayOfWeek"), F.weekofyear("o_orderdate").alias("WeekOfYear")),
    """SELECT o_orderkey, day(o_orderdate)::INTEGER AS Day, month(o_orderdate)::INTEGER AS Month, year(o_orderdate)::INTEGER AS Year,
  quarter(o_orderdate)::INTEGER AS Quarter, (isodow(o_orderdate) - 1)::INTEGER AS DayOfWeek, week(o_orderdate)::INTEGER AS WeekOfYear FROM orders""")
register("D04_flags", lambda s, d: parquet(s, d, "orders").select(
        _K, dt.weekend_flag(col("o_orderdate")).alias("IsWeekend"), dt.month_end_flag(col("o_orderdate")).alias("IsMonthEnd"),
        dt.quarter_end_flag(col("o_orderdate")).alias("IsQuarterEnd")),
    """SELECT o_orderkey, CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS IsWeekend, CASE WHEN day(o_orderdate) > 25 THEN 1 ELSE 0 END AS IsMonthEnd,
  CASE WHEN month(o_orderdate) IN (3, 6, 9, 12) THEN 1 ELSE 0 END AS IsQuarterEnd FROM orders""")
register("D05_season", lambda s, d: _raw(s, d).select(
        _K, dt.season_of(dt.parse_instant(col("t"))).alias("Season"), dt.season_of(col("o_orderdate"), autumn="Autumn").alias("CalendarSeason")),
    sql(_RAW, f"SELECT o_orderkey, {season('TRY_CAST(t AS TIMESTAMP)')} AS Season, {season('o_orderdate', 'Autumn')} AS CalendarSeason FROM raw"))


def _cyclic(s, d):
    month, day = dt.cyclic(F.month("o_orderdate"), 12), dt.cyclic(dt.weekday0(col("o_orderdate")), 7)
    return tidy(parquet(s, d, "orders").select(_K, month[0].alias("Month_sin"), month[1].alias("Month_cos"), day[0].alias("Day_sin"), day[1].alias("Day_cos")), 9)


register("D06_cyclic", _cyclic,
    """SELECT o_orderkey, round(sin(month(o_orderdate) * (2 * pi() / 12)), 9) + 0 AS Month_sin, round(cos(month(o_orderdate) * (2 * pi() / 12)), 9) + 0 AS Month_cos,
  round(sin((isodow(o_orderdate) - 1) * (2 * pi() / 7)), 9) + 0 AS Day_sin, round(cos((isodow(o_orderdate) - 1) * (2 * pi() / 7)), 9) + 0 AS Day_cos FROM orders""")
_MID = "2024-01-15 12:00:00"
register("D07_day_difference", lambda s, d: parquet(s, d, "events").select(
        "event_id", dt.floor_days(col("ts"), dt.instant(_MID)).alias("FloorDays"), dt.midnights(col("ts"), dt.instant(_MID)).alias("Midnights")),
    f"""SELECT event_id, CAST(floor(epoch(ts - TIMESTAMP '{_MID}') / 86400) AS INTEGER) AS FloorDays,
  CAST(date_diff('day', TIMESTAMP '{_MID}', ts) AS INTEGER) AS Midnights FROM events""")
register("D08_add_days", lambda s, d: parquet(s, d, "orders").select(
        _K, dt.plus_days(col("o_orderdate"), col(_K) % 10).alias("Whole"), dt.plus_days(col("o_orderdate"), col(_K) % 10 + 0.5).alias("Fraction")),
    """SELECT o_orderkey, o_orderdate + to_days(CAST(o_orderkey % 10 AS INTEGER)) AS Whole,
  o_orderdate + to_days(CAST(o_orderkey % 10 AS INTEGER)) + INTERVAL 12 HOUR AS Fraction FROM orders""")
register("D09_effective_date", lambda s, d: op.party(s, d).select("ID", "IsClient", dt.effective_date(
        when(col("ID") % 3 != 0, col("LastModifiedOnDate")), when(col("ID") % 2 != 0, col("CreatedOnDate"))).alias("EffectiveDate")),
    sql(o.PARTY, """SELECT ID, IsClient, coalesce(CASE WHEN ID % 3 <> 0 THEN LastModifiedOnDate END, CASE WHEN ID % 2 <> 0 THEN CreatedOnDate END,
  TIMESTAMP '2000-01-01') AS EffectiveDate FROM party"""))
register("D10_epoch_year", lambda s, d: _raw(s, d).select(_K, dt.without_epoch_year(col("e")).alias("Clean")),
    sql(_RAW, "SELECT o_orderkey, CASE WHEN year(e) <> 1970 THEN e END AS Clean FROM raw"))
register("D11_overdue", lambda s, d: invoices(s, d).select("InvoiceID", "InvoiceType", dt.overdue_flag(col("PaymentDueDate"), dt.instant("1999-01-01")).alias("IsOverdue")),
    sql(INV, "SELECT InvoiceID, InvoiceType, CASE WHEN TIMESTAMP '1999-01-01' > PaymentDueDate THEN 1 ELSE 0 END AS IsOverdue FROM invoices"))
register("D12_default_date", lambda s, d: op.dossiers(s, d).select("ID", F.coalesce("DateDepart", b.as_of()).alias("ShipmentDate")),
    sql(o.DOSSIERS, "SELECT ID, coalesce(DateDepart, TIMESTAMP '2002-01-01') AS ShipmentDate FROM dossiers"))

# ---- measures
register("M01_unit_ratios", lambda s, d: tidy(feat.unit_ratios(shipments(s, d, "ShipmentID", "TotalWeight", "TotalVolume", "TotalPackages", "ShipmentValue")).select(
        "ShipmentID", "WeightVolumeDensity", "ValuePerWeight", "ValuePerPackage", "PackageDensity"), 6),
    sql(SHIP, """SELECT ShipmentID, round(TotalWeight / (TotalVolume + 1e-6), 6) AS WeightVolumeDensity, round(ShipmentValue / (TotalWeight + 1e-6), 6) AS ValuePerWeight,
  round(ShipmentValue / (TotalPackages + 1e-6), 6) AS ValuePerPackage, round(TotalPackages / (TotalVolume + 1e-6), 6) AS PackageDensity FROM shipments"""))
register("M02_guarded_ratio", lambda s, d: tidy(costs(s, d).select("ShipmentKey", "ActualFreightCost", m.safe_ratio(col("ActualFreightCost"), col("PlannedFreightCost")).alias("Ratio")), 10),
    sql(COSTS, """SELECT ShipmentKey, ActualFreightCost, round(CASE WHEN PlannedFreightCost <> 0 THEN ActualFreightCost / PlannedFreightCost END, 10) AS Ratio FROM costs"""))
register("M03_clip", lambda s, d: tidy(invoices(s, d).select("InvoiceID", "InvoiceType", m.at_least(col("NetAmount") - 100000, 0.0).alias("Floor"),
        m.clamp(m.per_unit(col("TaxAmount") * 20, col("NetAmount")), 0.0, 1.0).alias("TaxRate")), 6),
    sql(INV, """SELECT InvoiceID, InvoiceType, round(greatest(NetAmount - 100000, 0), 6) AS Floor,
  round(least(greatest(TaxAmount * 20 / (NetAmount + 1e-6), 0), 1), 6) AS TaxRate FROM invoices"""))
register("M04_profit", lambda s, d: tidy(invoices(s, d).select("InvoiceID", "InvoiceType", m.estimated_profit(col("NetAmount")).alias("Profit")), 3),
    sql(INV, "SELECT InvoiceID, InvoiceType, round(NetAmount - NetAmount * 0.7::DOUBLE, 3) AS Profit FROM invoices"))
register("M05_variance_on_time", lambda s, d: shipment_performance(s, d).groupBy("DeliveryVariance", "OnTimeDeliveryFlag").agg(F.count(lit(1)).alias("Shipments")),
    sql(PERF, "SELECT DeliveryVariance, OnTimeDeliveryFlag, count(*) AS Shipments FROM performance GROUP BY 1, 2"))
register("M06_delay_reason", lambda s, d: shipment_performance(s, d).groupBy("DelayReason").agg(F.count(lit(1)).alias("Shipments"), F.min("DeliveryVariance").alias("Lowest"), F.max("DeliveryVariance").alias("Highest")),
    sql(PERF, "SELECT DelayReason, count(*) AS Shipments, min(DeliveryVariance) AS Lowest, max(DeliveryVariance) AS Highest FROM performance GROUP BY 1"))
register("M07_satisfaction", lambda s, d: shipment_performance(s, d).groupBy("CustomerSatisfactionScore").agg(F.count(lit(1)).alias("Shipments"), F.min("DeliveryVariance").alias("Lowest"), F.max("DeliveryVariance").alias("Highest")),
    sql(PERF, "SELECT CustomerSatisfactionScore, count(*) AS Shipments, min(DeliveryVariance) AS Lowest, max(DeliveryVariance) AS Highest FROM performance GROUP BY 1"))
register("M08_cost_variance", lambda s, d: tidy(costs(s, d).withColumn("CostVariance", col("ActualFreightCost") - col("PlannedFreightCost")).select(
        "ShipmentKey", "ActualFreightCost", "CostVariance", m.overrun_flag(col("CostVariance")).alias("VarianceFlag")), 6),
    sql(COSTS, """SELECT ShipmentKey, round(ActualFreightCost, 6) AS ActualFreightCost, round(ActualFreightCost - PlannedFreightCost, 6) AS CostVariance,
  CASE WHEN ActualFreightCost - PlannedFreightCost > 0 THEN 1 ELSE 0 END AS VarianceFlag FROM costs"""))
register("M09_payment_code", lambda s, d: b.invoice_rows(s, d).groupBy("PaymentStatus", m.payment_code(col("PaymentStatus")).alias("Code")).agg(F.count(lit(1)).alias("Invoices")),
    sql(o.INVOICE_ROWS, f"SELECT PaymentStatus, {o.STATUS} AS Code, count(*) AS Invoices FROM invoice_rows GROUP BY 1, 2"))
_YN = """yn AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'True' WHEN 3 THEN 'False' WHEN 4 THEN '1' ELSE 'maybe' END AS t FROM orders)"""
register("M10_yes_no", lambda s, d: parquet(s, d, "orders").select(_K, m.yes_no_flag(F.element_at(F.array(*[lit(x) for x in ("Yes", "No", "True", "False", "1", "maybe")]), (col(_K) % 6 + 1).cast("int"))).alias("Flag")),
    sql(_YN, "SELECT o_orderkey, CASE WHEN t IN ('Yes', 'True', '1') THEN 1 ELSE 0 END AS Flag FROM yn"))
register("M11_equal_width_labels", lambda s, d: feat.size_labels(shipments(s, d, "ShipmentID", "TotalWeight", "ShipmentValue")).groupBy("ShipmentSize", "ValueCategory").agg(
        F.count(lit(1)).alias("Shipments")),
    sql(f"""{SHIP}, e AS (SELECT min(TotalWeight) AS a, max(TotalWeight) AS b, min(ShipmentValue) AS c, max(ShipmentValue) AS d FROM shipments)""",
    """SELECT (['Small', 'Medium', 'Large'])[greatest(0, least(2, CAST(ceil((TotalWeight - a) / (b - a) * 3) AS INTEGER) - 1)) + 1] AS ShipmentSize,
  (['Low', 'Medium', 'High', 'Premium'])[greatest(0, least(3, CAST(ceil((ShipmentValue - c) / (d - c) * 4) AS INTEGER) - 1)) + 1] AS ValueCategory,
  count(*) AS Shipments FROM shipments, e GROUP BY 1, 2"""))


def band(x: str, lo: float, hi: float, names=("Low", "Medium", "High")) -> str:
    return f"CASE WHEN {x} > 0 AND {x} <= {lo} THEN '{names[0]}' WHEN {x} > {lo} AND {x} <= {hi} THEN '{names[1]}' WHEN {x} > {hi} AND {x} <= 1 THEN '{names[2]}' END"


register("M12_risk_bands", lambda s, d: parquet(s, d, "lineitem").groupBy(bins.risk_band(col("l_discount") * 10, 0.3, 0.7).alias("Band")).agg(F.count(lit(1)).alias("Lines")),
    f"SELECT {band('l_discount * 10', 0.3, 0.7)} AS Band, count(*) AS Lines FROM lineitem GROUP BY 1")
register("M13_status_label", lambda s, d: invoices(s, d).select(m.payment_label(col("PaymentStatus") + 2).alias("Label")).groupBy("Label").agg(F.count(lit(1)).alias("Invoices")),
    sql(INV, """SELECT CASE PaymentStatus + 2 WHEN 3 THEN 'Pending' WHEN 4 THEN 'Cancelled' WHEN 5 THEN 'Overdue' ELSE 'Status_' || (PaymentStatus + 2) END AS Label,
  count(*) AS Invoices FROM invoices GROUP BY 1"""))
register("M14_label_encode", lambda s, d: feat.label_encode(parquet(s, d, "part").select("p_partkey", "p_type"), "p_type", "TypeCode").select("p_partkey", "TypeCode"),
    "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS TypeCode FROM part")
register("M15_coerce_number", lambda s, d: op.payment_terms(s, d).select("ID", m.number_or_zero(col("NumOfDays")).cast("int").alias("Days")),
    sql(o.TERMS, "SELECT ID, CAST(coalesce(TRY_CAST(NumOfDays AS DOUBLE), 0) AS INTEGER) AS Days FROM terms_source"))


def _scored(s, d):
    return cust.segments(cust.rfm_scores(cust.rfm_base(invoices(s, d), b.as_of())))


register("W02_rfm_scores", lambda s, d: _scored(s, d).select("CustomerKey", "R_score", "F_score", "M_score"),
    sql(f"{INV}, {SCORES}", "SELECT CustomerKey, R_score, F_score, M_score FROM scores"))
register("M16_rule_segment", lambda s, d: _scored(s, d).select("CustomerKey", "Segment"), sql(f"{INV}, {SCORES}", "SELECT CustomerKey, Segment FROM scores"))
register("M17_customer_value", lambda s, d: tidy(_scored(s, d).select("CustomerKey", "CustomerValue"), 6),
    sql(f"{INV}, {SCORES}", "SELECT CustomerKey, round(CustomerValue, 6) AS CustomerValue FROM scores"))
RISK = f"""{RFM}, risk0 AS (
  SELECT CustomerKey, least(greatest(Recency / 365, 0), 1) AS a, least(greatest(1 / (Frequency + 1), 0), 1) AS f,
    least(greatest((mean - Monetary) / mean, 0), 1) AS c FROM rfm, (SELECT avg(Monetary) AS mean FROM rfm)),
risk AS (SELECT *, a * 0.4::DOUBLE + f * 0.3::DOUBLE + c * 0.3::DOUBLE AS r FROM risk0)"""
register("M18_customer_risk", lambda s, d: tidy(cust.risk_scores(cust.rfm_base(invoices(s, d), b.as_of())).select(
        "CustomerKey", "RecencyRisk", "FrequencyRisk", "MonetaryRisk", "RiskScore", "RiskCategory"), 6),
    sql(f"{INV}, {RISK}", f"""SELECT CustomerKey, round(a, 6) AS RecencyRisk, round(f, 6) AS FrequencyRisk, round(c, 6) AS MonetaryRisk, round(r, 6) AS RiskScore,
  {band('r', 0.3, 0.6, ('Low Risk', 'Medium Risk', 'High Risk'))} AS RiskCategory FROM risk"""))

# ---- customer rankings
register("L01_top_customers", lambda s, d: tidy(cust.top_customers(kpis.customer_analytics(invoices(s, d))).select("CustomerKey", "TotalRevenue", "TotalInvoices"), 2),
    sql(INV, """SELECT CustomerKey, round(sum(NetAmount), 2) AS TotalRevenue, count(*) AS TotalInvoices FROM invoices GROUP BY 1
ORDER BY sum(NetAmount) DESC, CustomerKey LIMIT 20"""))
register("L08_best_customer", lambda s, d: tidy(cust.best_customer(kpis.customer_analytics(invoices(s, d))), 2),
    sql(INV, """SELECT max_by(CustomerKey, r) AS TopCustomer, round(max(r), 2) AS TotalRevenue
FROM (SELECT CustomerKey, sum(NetAmount) AS r FROM invoices GROUP BY 1)"""))
register("W05_revenue_tiers", lambda s, d: tidy(cust.revenue_tiers(kpis.customer_analytics(invoices(s, d))).select("CustomerKey", "TotalRevenue", "RevenueRank", "CustomerTier"), 2),
    sql(INV, """SELECT CustomerKey, round(r, 2) AS TotalRevenue, CAST(k AS DOUBLE) AS RevenueRank,
  CASE WHEN k <= n * 0.15 THEN 'Premium' WHEN k <= n * 0.5 THEN 'Standard' ELSE 'Occasional' END AS CustomerTier
FROM (SELECT *, rank() OVER (ORDER BY r DESC) + (count(*) OVER (PARTITION BY r) - 1) / 2 AS k, count(*) OVER () AS n
  FROM (SELECT CustomerKey, sum(NetAmount) AS r FROM invoices GROUP BY 1))"""))
register("W13_value_quintile", lambda s, d: cust.value_quintile(cust.rfm_base(invoices(s, d), b.as_of()), "Recency", "RecencyScore", reverse=True).select(
        "CustomerKey", "Recency", "RecencyScore"),
    sql(f"""{INV}, {RFM}, e AS (SELECT quantile_cont(Recency, [0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM rfm)""",
    """SELECT CustomerKey, Recency, CAST(6 - greatest(1, len(list_filter(q, lambda x: x < Recency))) AS INTEGER) AS RecencyScore FROM rfm, e"""))

"""Aggregates A01-A44."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolith.catalog.registry import register, tidy
from cargolith.catalog.sqlbase import AS_OF, DELIVERY, INV, ON_TIME, SCORES, SHIP, VARIANCE, season, sql
from cargolith.functions.dates import instant
from cargolith.operators.ranking import quantiles
from cargolith.operators.stats import attach, histogram, null_counts
from cargolith.plans import customers as cust
from cargolith.plans import kpis as k
from cargolith.sources import operational as op
from cargolith.sources.marts import invoices, shipments

DATES = ["ShipmentDate", "PlannedArrivalDate", "ActualArrivalDate"]
TRIP = ["ActualDepartureDate", "ActualArrivalDate"]
MONEY2 = {"TotalRevenue": 2, "TotalProfit": 2, "TotalAmount": 2, "TotalNetAmount": 2, "TotalTax": 2, "NetAmount": 2,
          "Revenue": 2, "SeasonProfit": 2, "TotalVolume": 2, "TotalValue": 2, "TotalWeight": 2, "Monetary": 2,
          "TotalSpent": 2, "EstimatedLTV": 2, "AvgInvoiceValue": 6, "AvgOrderValue": 6, "AvgAmount": 6, "MonetaryMean": 6}


def money(df):
    return tidy(df, **MONEY2)


def margin_safe():
    return "CASE WHEN NetAmount <> 0 THEN (NetAmount - TotalAmount) / NetAmount END"


def scored(spark, d):
    return cust.segments(cust.rfm_scores(cust.rfm_base(invoices(spark, d), instant(AS_OF))))


register("A01_executive_summary", lambda s, d: money(k.executive_summary(shipments(s, d, *TRIP), invoices(s, d))),
    sql(f"{SHIP}, {INV}", f"""
SELECT (SELECT count(*) FROM shipments) AS TotalShipments, (SELECT count(*) FROM invoices) AS TotalInvoices,
  (SELECT round(sum(NetAmount), 2) FROM invoices) AS TotalRevenue,
  (SELECT round(sum(NetAmount - TaxAmount), 2) FROM invoices) AS TotalProfit,
  (SELECT round(avg({DELIVERY}), 4) FROM shipments) AS AvgDeliveryTime"""))
register("A02_financial_trend", lambda s, d: money(k.revenue_and_profit(invoices(s, d), "InvoiceDate")),
    sql(INV, """SELECT InvoiceDate, round(sum(NetAmount), 2) AS TotalRevenue, round(sum(NetAmount - TaxAmount), 2) AS TotalProfit
FROM invoices GROUP BY InvoiceDate"""))
register("A03_customer_analytics", lambda s, d: money(k.customer_analytics(invoices(s, d))),
    sql(INV, """SELECT CustomerKey, count(InvoiceID) AS TotalInvoices, round(sum(NetAmount), 2) AS TotalRevenue,
  round(avg(NetAmount), 6) AS AvgInvoiceValue FROM invoices GROUP BY CustomerKey"""))
register("A04_sales_revenue", lambda s, d: money(k.revenue_and_profit(invoices(s, d), "InvoiceType")),
    sql(INV, """SELECT InvoiceType, round(sum(NetAmount), 2) AS TotalRevenue, round(sum(NetAmount - TaxAmount), 2) AS TotalProfit
FROM invoices GROUP BY InvoiceType"""))
register("A05_operations_metrics",
    lambda s, d: tidy(k.delivery_by(shipments(s, d, "ShipmentID", "CustomerKey", *TRIP), "CustomerKey", "TotalShipments")),
    sql(SHIP, f"""SELECT CustomerKey, round(avg({DELIVERY}), 4) AS AvgDeliveryTime, count(ShipmentID) AS TotalShipments
FROM shipments GROUP BY CustomerKey"""))
register("A06_cash_flow", lambda s, d: money(k.cash_flow(invoices(s, d))),
    sql(INV, """SELECT PaymentStatus, round(sum(NetAmount), 2) AS TotalAmount, count(InvoiceID) AS InvoiceCount
FROM invoices GROUP BY PaymentStatus"""))
register("A07_seasonal_demand", lambda s, d: k.counts_by_season(shipments(s, d, "ShipmentDate"), "ShipmentDate", "Shipments"),
    sql(SHIP, f"SELECT {season('ShipmentDate')} AS Season, count(*) AS Shipments FROM shipments GROUP BY 1"))
register("A08_delivery_capacity",
    lambda s, d: tidy(k.delivery_by(shipments(s, d, "ShipmentID", "EquipmentKey", *TRIP), "EquipmentKey", "Shipments")),
    sql(SHIP, f"""SELECT EquipmentKey, round(avg({DELIVERY}), 4) AS AvgDeliveryTime, count(ShipmentID) AS Shipments
FROM shipments GROUP BY EquipmentKey"""))
register("A09_daily_demand", lambda s, d: k.daily_demand(shipments(s, d, "ShipmentDate")),
    sql(SHIP, "SELECT ShipmentDate, count(*) AS Shipments FROM shipments GROUP BY ShipmentDate"))
register("A10_profit_demand_correlation",
    lambda s, d: tidy(k.profit_demand_correlation(shipments(s, d, "ShipmentDate"), invoices(s, d)), 6),
    sql(f"{SHIP}, {INV}", """
SELECT count(*) AS Days, round(corr(Shipments, Net), 6) AS Correlation
FROM (SELECT ShipmentDate, count(*) AS Shipments FROM shipments GROUP BY 1) a
JOIN (SELECT InvoiceDate, sum(NetAmount) AS Net FROM invoices GROUP BY 1) b ON ShipmentDate = InvoiceDate"""))
register("A11_shipments_by_season",
    lambda s, d: tidy(k.shipments_by_season(shipments(s, d, "ShipmentID", "ShipmentDate", "TotalWeight", "ShipmentValue"))),
    sql(SHIP, f"""SELECT {season('ShipmentDate')} AS Season, count(ShipmentID) AS TotalShipments,
  round(avg(TotalWeight), 4) AS AvgWeight, round(avg(ShipmentValue), 4) AS AvgValue FROM shipments GROUP BY 1"""))
register("A12_invoices_by_season", lambda s, d: money(k.invoices_by_season(invoices(s, d))),
    sql(INV, f"""SELECT {season('InvoiceDate')} AS Season, count(InvoiceID) AS TotalInvoices,
  round(sum(NetAmount), 2) AS TotalNetAmount, round(sum(TaxAmount), 2) AS TotalTax FROM invoices GROUP BY 1"""))
register("A13_seasonal_kpis",
    lambda s, d: money(k.seasonal_kpis(shipments(s, d, "ShipmentDate", "TotalWeight", "TotalVolume"), invoices(s, d))),
    sql(f"{SHIP}, {INV}", f"""
SELECT Season, round(TotalWeight, 2) AS TotalWeight, round(TotalVolume, 2) AS TotalVolume, ShipmentCount,
  round(TotalAmount, 2) AS TotalAmount, round(NetAmount, 2) AS NetAmount, InvoiceCount
FROM (SELECT {season('ShipmentDate')} AS Season, sum(TotalWeight) AS TotalWeight, sum(TotalVolume) AS TotalVolume,
        count(ShipmentDate) AS ShipmentCount FROM shipments GROUP BY 1) a
FULL JOIN (SELECT {season('InvoiceDate')} AS Season, sum(TotalAmount) AS TotalAmount, sum(NetAmount) AS NetAmount,
        count(InvoiceDate) AS InvoiceCount FROM invoices GROUP BY 1) b USING (Season)"""))
register("A14_profit_by_season", lambda s, d: money(k.profit_by_season(invoices(s, d))),
    sql(INV, f"SELECT {season('InvoiceDate')} AS Season, round(sum(NetAmount), 2) AS SeasonProfit FROM invoices GROUP BY 1"))
register("A15_business_report", lambda s, d: money(k.business_report(shipments(s, d, "ShipmentValue", *DATES), invoices(s, d))),
    sql(f"{SHIP}, {INV}", f"""
SELECT * FROM (SELECT count(*) AS TotalShipments, round(avg(ShipmentValue), 4) AS AvgShipmentValue,
    round(avg({ON_TIME}), 4) AS OnTimeDeliveryRate FROM shipments),
  (SELECT count(*) AS TotalInvoices, round(sum(NetAmount), 2) AS TotalRevenue,
    round(avg((NetAmount - TotalAmount) / (NetAmount + 1e-6)), 4) AS AvgProfitMargin FROM invoices)"""))
register("A16_daily_shipment_metrics",
    lambda s, d: money(k.daily_shipment_metrics(shipments(s, d, "TotalPackages", "ShipmentValue", "TotalWeight", *DATES))),
    sql(SHIP, f"""SELECT CAST(ShipmentDate AS DATE) AS Day, count(*) AS Shipments, round(avg({ON_TIME}), 4) AS OnTimeRate,
  round(avg({VARIANCE}), 4) AS AvgVariance, round(sum(ShipmentValue), 2) AS TotalValue, round(sum(TotalWeight), 2) AS TotalWeight,
  sum(TotalPackages)::BIGINT AS TotalPackages FROM shipments GROUP BY 1"""))
register("A17_monthly_revenue", lambda s, d: money(k.monthly_revenue(invoices(s, d))),
    sql(INV, "SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, round(sum(NetAmount), 2) AS Revenue FROM invoices GROUP BY 1"))
_MONTHLY = f"""monthly AS (
  SELECT strftime(ShipmentDate, '%Y-%m') AS YearMonth, count(*) AS Shipments, sum({ON_TIME})::BIGINT AS OnTime,
    sum({ON_TIME}) / count(*) AS OnTimeRate FROM shipments GROUP BY 1),
trend AS (SELECT *, lag(OnTimeRate) OVER (ORDER BY YearMonth) AS PreviousRate FROM monthly),
flagged AS (SELECT *, CASE WHEN OnTimeRate > PreviousRate THEN 'up' WHEN OnTimeRate < PreviousRate THEN 'down' END AS Trend FROM trend)"""
register("A18_on_time_overview", lambda s, d: tidy(k.on_time_overview(shipments(s, d, *DATES))),
    sql(f"{SHIP}, {_MONTHLY}", """
SELECT round(sum(OnTime) / sum(Shipments), 4) AS OverallRate, max(YearMonth) AS CurrentMonth,
  round(max_by(OnTimeRate, YearMonth), 4) AS CurrentRate,
  (SELECT Trend FROM flagged ORDER BY YearMonth DESC LIMIT 1) AS Trend FROM flagged"""))
register("W11_month_over_month", lambda s, d: tidy(k.monthly_on_time(shipments(s, d, *DATES))),
    sql(f"{SHIP}, {_MONTHLY}", """SELECT YearMonth, Shipments, OnTime, round(OnTimeRate, 4) AS OnTimeRate,
  round(PreviousRate, 4) AS PreviousRate, Trend FROM flagged"""))
register("A19_daily_dashboard", lambda s, d: money(k.daily_dashboard(shipments(s, d, *DATES), invoices(s, d))),
    sql(f"{SHIP}, {INV}", f"""
SELECT Day, Volume, round(OnTimePercent, 4) AS OnTimePercent, round(Revenue, 2) AS Revenue
FROM (SELECT CAST(ShipmentDate AS DATE) AS Day, count(*) AS Volume, avg({ON_TIME}) * 100 AS OnTimePercent FROM shipments GROUP BY 1) a
FULL JOIN (SELECT CAST(InvoiceDate AS DATE) AS Day, sum(NetAmount) AS Revenue FROM invoices GROUP BY 1) b USING (Day)"""))
register("A20_payment_distribution", lambda s, d: k.payment_distribution(invoices(s, d)),
    sql(INV, """SELECT PaymentStatus, count(*) AS Invoices,
  CASE PaymentStatus WHEN 0 THEN 'Unpaid' WHEN 1 THEN 'Validated' WHEN 2 THEN 'Paid' WHEN 3 THEN 'Pending' WHEN 4 THEN 'Cancelled'
    WHEN 5 THEN 'Overdue' ELSE 'Status_' || PaymentStatus END AS Label FROM invoices GROUP BY PaymentStatus"""))
register("A21_segment_counts",
    lambda s, d: money(scored(s, d).groupBy("Segment").agg(k.rows().alias("Customers"), F.sum("Monetary").alias("TotalValue"))),
    sql(f"{INV}, {SCORES}", "SELECT Segment, count(*) AS Customers, round(sum(Monetary), 2) AS TotalValue FROM scores GROUP BY Segment"))
register("A22_monthly_volume", lambda s, d: k.monthly_volume(shipments(s, d, "ShipmentDate")),
    sql(SHIP, "SELECT strftime(ShipmentDate, '%Y-%m') AS YearMonth, count(*) AS Shipments FROM shipments GROUP BY 1"))


def histogram_sql(table: str, column: str, bins: int) -> str:
    return f"""ends AS (SELECT min({column}) AS lo, max({column}) AS hi, avg({column}) AS Mean FROM {table})
SELECT CAST(least({bins} - 1, floor(({column} - lo) / (hi - lo) * {bins})) AS INTEGER) AS Bin,
  round(min(lo) + min(least({bins} - 1, floor(({column} - lo) / (hi - lo) * {bins}))) * (min(hi) - min(lo)) / {bins}, 4) AS BinStart,
  count(*) AS Count, round(min(Mean), 4) AS Mean FROM {table}, ends WHERE {column} IS NOT NULL GROUP BY 1"""


register("A23_amount_histogram", lambda s, d: tidy(histogram(invoices(s, d), "NetAmount", 30)),
    f"WITH {INV}, {histogram_sql('invoices', 'NetAmount', 30)}")
register("A24_weight_value_correlation", lambda s, d: tidy(k.pearson(shipments(s, d, "TotalWeight", "ShipmentValue"), "TotalWeight", "ShipmentValue"), 6),
    sql(SHIP, "SELECT round(corr(TotalWeight, ShipmentValue), 6) AS Correlation FROM shipments"))
register("A25_segment_box_plot", lambda s, d: tidy(cust.box_plot(scored(s, d)), 4),
    sql(f"{INV}, {SCORES}", """SELECT Segment, round(quantile_cont(Monetary, 0.0), 4) AS Low, round(quantile_cont(Monetary, 0.25), 4) AS Q1,
  round(quantile_cont(Monetary, 0.5), 4) AS Median, round(quantile_cont(Monetary, 0.75), 4) AS Q3,
  round(quantile_cont(Monetary, 1.0), 4) AS High FROM scores GROUP BY Segment"""))
register("A26_rfm_base", lambda s, d: money(cust.rfm_base(invoices(s, d), instant(AS_OF)).drop("MonetaryStd")),
    sql(f"{INV}, {SCORES}", """
SELECT CustomerKey, FirstPurchase, LastPurchase, Frequency, round(Monetary, 2) AS Monetary, round(MonetaryMean, 6) AS MonetaryMean,
  round(PaymentRate, 4) AS PaymentRate, round(TotalSpent, 2) AS TotalSpent, Recency, CustomerLifetime,
  round(AvgOrderValue, 6) AS AvgOrderValue, round(PurchaseVelocity, 4) AS PurchaseVelocity FROM rfm"""))
register("A27_customer_performance", lambda s, d: tidy(k.customer_performance(invoices(s, d)), AvgInvoiceValue=6, TotalRevenue=2, TotalProfit=3),
    sql(INV, f"""SELECT CustomerKey, count(InvoiceID) AS TotalInvoices, round(sum(NetAmount), 2) AS TotalRevenue,
  round(avg(NetAmount), 6) AS AvgInvoiceValue, round(sum(NetAmount - NetAmount * 0.7::DOUBLE), 3) AS TotalProfit,
  round(avg({margin_safe()}), 4) AS AvgMargin FROM invoices GROUP BY CustomerKey"""))
register("A28_executive_kpis", lambda s, d: tidy(k.executive_kpis(invoices(s, d)), 7),
    sql(INV, f"""SELECT count(DISTINCT CustomerKey) AS UniqueCustomers, count(*) AS Transactions,
  round(avg(NetAmount), 7) AS AvgTransactionValue, round(avg({margin_safe()}), 7) AS AvgMargin FROM invoices"""))
PROFIT = """profit0 AS (
  SELECT CustomerKey, round(sum(NetAmount), 2) AS TotalRevenue,
    CAST(round(CAST(CAST(round(sum(NetAmount), 2) / count(NetAmount) AS VARCHAR) AS DECIMAL(30, 12)), 2) AS DOUBLE) AS AvgOrderValue,
    count(NetAmount) AS OrderCount, round(sum(TaxAmount), 2) AS TotalTax, CAST(round(CAST(CAST(round(sum(NetAmount), 2) * (1 - 0.7::DOUBLE) AS VARCHAR) AS DECIMAL(30, 12)), 2) AS DOUBLE) AS TotalProfit
  FROM invoices GROUP BY CustomerKey),
profit AS (SELECT *, coalesce(TotalProfit / TotalRevenue, 0) AS ProfitMargin FROM profit0)"""
register("A29_customer_profitability", lambda s, d: tidy(cust.profitability(invoices(s, d))),
    sql(f"{INV}, {PROFIT}", """SELECT CustomerKey, TotalRevenue, AvgOrderValue, OrderCount, TotalTax,
  TotalProfit, round(ProfitMargin, 4) AS ProfitMargin FROM profit"""))


def _segment_profit(s, d):
    return cust.segment_profitability(cust.with_segment(cust.profitability(invoices(s, d)), scored(s, d)))


SEGPROFIT = """segprofit AS (
  SELECT Segment, sum(TotalRevenue) AS TotalRevenue, avg(TotalRevenue) AS AvgRevenue, sum(TotalProfit) AS TotalProfit,
    avg(TotalProfit) AS AvgProfit, sum(OrderCount)::BIGINT AS OrderCount, avg(ProfitMargin) AS AvgMargin
  FROM profit LEFT JOIN scores USING (CustomerKey) GROUP BY Segment)"""
_SP = """SELECT Segment, round(TotalRevenue, 2) AS TotalRevenue, round(AvgRevenue, 4) AS AvgRevenue, round(TotalProfit, 2) AS TotalProfit,
  round(AvgProfit, 4) AS AvgProfit, OrderCount, round(AvgMargin, 4) AS AvgMargin FROM segprofit"""
_SPD = {"TotalRevenue": 2, "AvgRevenue": 4, "TotalProfit": 2, "AvgProfit": 4}
register("A30_segment_profitability", lambda s, d: tidy(_segment_profit(s, d), **_SPD),
    sql(f"{INV}, {SCORES}, {PROFIT}, {SEGPROFIT}", _SP))
register("L02_top_segments", lambda s, d: tidy(cust.top_segments(_segment_profit(s, d)), **_SPD),
    sql(f"{INV}, {SCORES}, {PROFIT}, {SEGPROFIT}", f"{_SP} ORDER BY segprofit.TotalProfit DESC, Segment LIMIT 5"))
register("A31_customer_ltv", lambda s, d: money(cust.lifetime_value(invoices(s, d))),
    sql(INV, """
SELECT CustomerKey, round(Spent, 2) AS TotalSpent, round(Aov, 6) AS AvgOrderValue, FirstOrder, LastOrder, OrderCount, CustomerAge,
  round(OrderCount / (CustomerAge + 1), 4) AS PurchaseFrequency, round(CustomerAge * 1.5::DOUBLE, 4) AS PredictedLifespan,
  round(Aov * (OrderCount / (CustomerAge + 1)) * (CustomerAge * 1.5::DOUBLE), 2) AS EstimatedLTV
FROM (SELECT CustomerKey, sum(NetAmount) AS Spent, avg(NetAmount) AS Aov, min(InvoiceDate) AS FirstOrder, max(InvoiceDate) AS LastOrder,
    count(InvoiceDate) AS OrderCount, date_diff('day', min(InvoiceDate), max(InvoiceDate))::INTEGER AS CustomerAge
  FROM invoices GROUP BY CustomerKey)"""))
register("A32_segment_profile", lambda s, d: tidy(cust.segment_profile(scored(s, d)), TotalValue=2, AvgMonetary=2),
    sql(f"{INV}, {SCORES}", """
SELECT Segment, count(*) AS Size, round(avg(Recency), 4) AS AvgRecency, round(avg(Frequency), 4) AS AvgFrequency,
  round(avg(Monetary), 2) AS AvgMonetary, round(avg(PaymentRate), 4) AS AvgPaymentRate, round(sum(Monetary), 2) AS TotalValue,
  sum(CASE WHEN Monetary > p80 THEN 1 ELSE 0 END)::BIGINT AS HighValueCustomers,
  sum(CASE WHEN Frequency > p50 THEN 1 ELSE 0 END)::BIGINT AS FrequentBuyers,
  sum(CASE WHEN Recency < 30 THEN 1 ELSE 0 END)::BIGINT AS RecentActivity,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM scores), 4) AS Percentage
FROM scores JOIN (SELECT Segment, quantile_cont(Monetary, 0.8) AS p80, quantile_cont(Frequency, 0.5) AS p50 FROM scores GROUP BY 1) q
  USING (Segment) GROUP BY Segment"""))
register("A33_monitoring_baseline",
    lambda s, d: tidy(k.monitoring_baseline(shipments(s, d, "TotalWeight", "ShipmentValue", *DATES), invoices(s, d))),
    sql(f"{SHIP}, {INV}", f"""
SELECT * FROM (SELECT round(avg(TotalWeight), 4) AS MeanWeight, round(avg(ShipmentValue), 4) AS MeanValue,
    round(avg({ON_TIME}), 4) AS OnTimeRate FROM shipments),
  (SELECT round(avg(NetAmount), 4) AS MeanAmount, round(avg(PaymentStatus), 4) AS MeanPaymentStatus FROM invoices)"""))
_INVCOLS = ["InvoiceID", "InvoiceDate", "CustomerKey", "SupplierKey", "TotalAmount", "TaxAmount", "NetAmount", "PaymentStatus",
            "PaymentDueDate", "PaymentTermKey", "InvoiceType"]
register("A35_null_counts", lambda s, d: null_counts(invoices(s, d)),
    sql(INV, "\nUNION ALL ".join(f"SELECT '{c}' AS ColumnName, count(*) - count({c}) AS Nulls FROM invoices" for c in _INVCOLS)))
register("A36_distinct_values", lambda s, d: invoices(s, d).select("InvoiceType", "PaymentTermKey").distinct(),
    sql(INV, "SELECT DISTINCT InvoiceType, PaymentTermKey FROM invoices"))
register("A37_median_mode_quantile",
    lambda s, d: tidy(attach(
        quantiles(invoices(s, d), "NetAmount", {"Q10": 0.1, "Median": 0.5, "Q90": 0.9}),
        invoices(s, d).agg(F.mode("PaymentStatus", True).alias("ModeStatus")))),
    sql(INV, """SELECT round(quantile_cont(NetAmount, 0.1), 4) AS Q10, round(quantile_cont(NetAmount, 0.5), 4) AS Median,
  round(quantile_cont(NetAmount, 0.9), 4) AS Q90,
  (SELECT PaymentStatus FROM invoices GROUP BY 1 ORDER BY count(*) DESC, PaymentStatus LIMIT 1) AS ModeStatus FROM invoices"""))
register("A40_seasonal_pattern", lambda s, d: tidy(k.seasonal_pattern(invoices(s, d)), 7),
    sql(INV, f"""
SELECT Season, Transactions, round(Transactions * 100.0::DOUBLE / sum(Transactions) OVER (), 7) AS SharePercentage,
  round(AvgValue, 7) AS AvgTransactionValue, round(Transactions * 100.0::DOUBLE / avg(Transactions) OVER (), 7) AS SeasonalIndex,
  CAST(rank() OVER (ORDER BY Transactions DESC) AS INTEGER) AS Rank
FROM (SELECT {season('InvoiceDate')} AS Season, count(*) AS Transactions, avg(NetAmount) AS AvgValue FROM invoices GROUP BY 1)"""))
register("A41_payment_analytics", lambda s, d: money(k.payment_analytics(invoices(s, d))),
    sql(INV, """SELECT CustomerKey, PaymentStatus, count(*) AS InvoiceCount, round(sum(NetAmount), 2) AS TotalAmount,
  round(avg(NetAmount), 6) AS AvgAmount FROM invoices GROUP BY 1, 2"""))
register("A42_operations_per_customer",
    lambda s, d: tidy(k.operations_per_customer(shipments(s, d, "CustomerKey", "ActualDepartureDate", "PlannedArrivalDate", "ActualArrivalDate"))),
    sql(SHIP, f"""SELECT CustomerKey, count(*) AS TotalShipments, round(avg({DELIVERY}), 4) AS AvgDeliveryTime,
  sum({ON_TIME})::BIGINT AS OnTimeDeliveries,
  round(least(greatest(sum({ON_TIME}) / count(*) * 100, 0), 100), 4) AS OnTimePercentage FROM shipments GROUP BY CustomerKey"""))
register("A43_monthly_finance", lambda s, d: tidy(k.monthly_finance(invoices(s, d)), 7, TotalVolume=2),
    sql(INV, f"""SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, count(*) AS TransactionCount,
  round(avg(NetAmount), 7) AS AvgTransactionValue, round(sum(NetAmount), 2) AS TotalVolume,
  round(avg({margin_safe()}), 7) AS AvgProfitMargin, count(DISTINCT CustomerKey) AS UniqueCustomers FROM invoices GROUP BY 1"""))
register("A44_season_by_year", lambda s, d: tidy(k.season_by_year(invoices(s, d)), 7),
    sql(INV, f"""SELECT {season('InvoiceDate')} AS Season, CAST(year(InvoiceDate) AS INTEGER) AS Year, count(*) AS TransactionCount,
  round(avg(NetAmount), 7) AS AvgTransactionValue, count(DISTINCT CustomerKey) AS UniqueCustomers FROM invoices GROUP BY 1, 2"""))

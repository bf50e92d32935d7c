"""Executive, financial, operational and seasonal indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolith.functions.dates import floor_days, season_of
from cargolith.functions.measures import (
    clamp, delivery_variance, estimated_profit, margin, on_time_flag, payment_label,
)
from cargolith.functions.statistics import correlation
from cargolith.operators.stats import attach

def rows() -> Column:
    return F.count(F.lit(1))


def net() -> Column:
    return F.col("NetAmount")


def tax() -> Column:
    return F.col("TaxAmount")


def zero_sum(c: Column) -> Column:
    """Sum that is 0 for a group without values."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def month_of(c: str) -> Column:
    return F.date_format(c, "yyyy-MM")


def delivery_days() -> Column:
    return floor_days(F.col("ActualArrivalDate"), F.col("ActualDepartureDate"))


def variance_days() -> Column:
    return delivery_variance(F.col("ActualArrivalDate"), F.col("PlannedArrivalDate"))


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with all group keys present."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def executive_summary(shipments: DataFrame, invoices: DataFrame) -> DataFrame:
    s = shipments.agg(rows().alias("TotalShipments"), F.avg(delivery_days()).alias("AvgDeliveryTime"))
    i = invoices.agg(
        rows().alias("TotalInvoices"), zero_sum(net()).alias("TotalRevenue"), zero_sum(net() - tax()).alias("TotalProfit")
    )
    return attach(s, i).select("TotalShipments", "TotalInvoices", "TotalRevenue", "TotalProfit", "AvgDeliveryTime")


def revenue_and_profit(invoices: DataFrame, key: str) -> DataFrame:
    return known(invoices, key).groupBy(key).agg(
        zero_sum(net()).alias("TotalRevenue"), zero_sum(net() - tax()).alias("TotalProfit")
    )


def customer_analytics(invoices: DataFrame) -> DataFrame:
    return known(invoices, "CustomerKey").groupBy("CustomerKey").agg(
        F.count("InvoiceID").alias("TotalInvoices"), zero_sum(net()).alias("TotalRevenue"), F.avg(net()).alias("AvgInvoiceValue")
    )


def delivery_by(shipments: DataFrame, key: str, count_name: str) -> DataFrame:
    return known(shipments, key).groupBy(key).agg(
        F.avg(delivery_days()).alias("AvgDeliveryTime"), F.count("ShipmentID").alias(count_name)
    )


def cash_flow(invoices: DataFrame) -> DataFrame:
    return known(invoices, "PaymentStatus").groupBy("PaymentStatus").agg(
        zero_sum(net()).alias("TotalAmount"), F.count("InvoiceID").alias("InvoiceCount")
    )


def counts_by_season(df: DataFrame, date: str, name: str) -> DataFrame:
    return df.groupBy(season_of(F.col(date)).alias("Season")).agg(rows().alias(name))


def daily_demand(shipments: DataFrame) -> DataFrame:
    return known(shipments, "ShipmentDate").groupBy("ShipmentDate").agg(rows().alias("Shipments"))


def profit_by_demand(shipments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Days with both demand and revenue (inner join of two daily aggregates)."""
    revenue = known(invoices, "InvoiceDate").groupBy("InvoiceDate").agg(zero_sum(net()).alias("NetAmount"))
    demand = daily_demand(shipments)
    return demand.join(revenue, F.col("ShipmentDate") == F.col("InvoiceDate"))


def profit_demand_correlation(shipments: DataFrame, invoices: DataFrame) -> DataFrame:
    return profit_by_demand(shipments, invoices).agg(
        rows().alias("Days"), correlation(F.col("Shipments"), F.col("NetAmount")).alias("Correlation")
    )


def shipments_by_season(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy(season_of(F.col("ShipmentDate")).alias("Season")).agg(
        F.count("ShipmentID").alias("TotalShipments"),
        F.avg("TotalWeight").alias("AvgWeight"),
        F.avg("ShipmentValue").alias("AvgValue"),
    )


def delivery_by_season(shipments: DataFrame) -> DataFrame:
    """Shipments, on-time rate and mean variance per season."""
    v = variance_days()
    return shipments.groupBy(season_of(F.col("ShipmentDate")).alias("Season")).agg(
        rows().alias("Shipments"),
        F.avg(on_time_flag(v)).alias("OnTimeRate"),
        F.avg(v).alias("AvgVariance"),
        F.avg("ShipmentValue").alias("AvgValue"),
    )


def invoices_by_season(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(season_of(F.col("InvoiceDate")).alias("Season")).agg(
        F.count("InvoiceID").alias("TotalInvoices"), zero_sum(net()).alias("TotalNetAmount"), zero_sum(tax()).alias("TotalTax")
    )


def seasonal_kpis(shipments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Shipment and invoice totals of each season side by side."""
    s = shipments.groupBy(season_of(F.col("ShipmentDate")).alias("Season")).agg(
        zero_sum(F.col("TotalWeight")).alias("TotalWeight"),
        zero_sum(F.col("TotalVolume")).alias("TotalVolume"),
        F.count("ShipmentDate").alias("ShipmentCount"),
    )
    i = invoices.groupBy(season_of(F.col("InvoiceDate")).alias("Season")).agg(
        zero_sum(F.col("TotalAmount")).alias("TotalAmount"), zero_sum(net()).alias("NetAmount"), F.count("InvoiceDate").alias("InvoiceCount")
    )
    return s.join(i, "Season", "full_outer")


def profit_by_season(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(season_of(F.col("InvoiceDate")).alias("Season")).agg(zero_sum(net()).alias("SeasonProfit"))


def business_report(shipments: DataFrame, invoices: DataFrame, safe: bool = False) -> DataFrame:
    s = shipments.agg(
        rows().alias("TotalShipments"),
        F.avg("ShipmentValue").alias("AvgShipmentValue"),
        F.avg(on_time_flag(variance_days())).alias("OnTimeDeliveryRate"),
    )
    i = invoices.agg(
        rows().alias("TotalInvoices"),
        zero_sum(net()).alias("TotalRevenue"),
        F.avg(margin(net(), F.col("TotalAmount"), safe)).alias("AvgProfitMargin"),
    )
    return attach(s, i)


def daily_shipment_metrics(shipments: DataFrame) -> DataFrame:
    v = variance_days()
    return shipments.groupBy(F.to_date("ShipmentDate").alias("Day")).agg(
        rows().alias("Shipments"),
        F.avg(on_time_flag(v)).alias("OnTimeRate"),
        F.avg(v).alias("AvgVariance"),
        zero_sum(F.col("ShipmentValue")).alias("TotalValue"),
        zero_sum(F.col("TotalWeight")).alias("TotalWeight"),
        F.sum("TotalPackages").alias("TotalPackages"),
    )


def monthly_revenue(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(month_of("InvoiceDate").alias("YearMonth")).agg(zero_sum(net()).alias("Revenue"))


def monthly_on_time(shipments: DataFrame) -> DataFrame:
    """Rate per month and its direction against the month before."""
    monthly = shipments.groupBy(month_of("ShipmentDate").alias("YearMonth")).agg(
        rows().alias("Shipments"), F.sum(on_time_flag(variance_days())).alias("OnTime")
    )
    monthly = monthly.withColumn("OnTimeRate", F.col("OnTime") / F.col("Shipments"))
    # One row per calendar month: a single ordered window is bounded by the calendar.
    before = F.lag("OnTimeRate").over(Window.orderBy("YearMonth"))
    return monthly.withColumn("PreviousRate", before).withColumn(
        "Trend",
        F.when(F.col("OnTimeRate") > F.col("PreviousRate"), "up").when(F.col("OnTimeRate") < F.col("PreviousRate"), "down"),
    )


def on_time_overview(shipments: DataFrame) -> DataFrame:
    """Overall rate, rate of the last month, and whether it rose."""
    m = monthly_on_time(shipments)
    last = F.struct("YearMonth", "OnTimeRate", "Trend")
    return m.agg(
        (F.sum("OnTime") / F.sum("Shipments")).alias("OverallRate"), F.max_by(last, "YearMonth").alias("last")
    ).select(
        "OverallRate",
        F.col("last.YearMonth").alias("CurrentMonth"),
        F.col("last.OnTimeRate").alias("CurrentRate"),
        F.col("last.Trend").alias("Trend"),
    )


def daily_dashboard(shipments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Daily volume, on-time percentage and revenue; days of either side are kept."""
    s = shipments.groupBy(F.to_date("ShipmentDate").alias("Day")).agg(
        rows().alias("Volume"), (F.avg(on_time_flag(variance_days())) * 100).alias("OnTimePercent")
    )
    i = invoices.groupBy(F.to_date("InvoiceDate").alias("Day")).agg(zero_sum(net()).alias("Revenue"))
    return s.join(i, "Day", "full_outer")


def payment_distribution(invoices: DataFrame) -> DataFrame:
    counted = known(invoices, "PaymentStatus").groupBy("PaymentStatus").agg(rows().alias("Invoices"))
    return counted.withColumn("Label", payment_label(F.col("PaymentStatus")))


def monthly_volume(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy(month_of("ShipmentDate").alias("YearMonth")).agg(rows().alias("Shipments"))


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(correlation(F.col(a), F.col(b)).alias("Correlation"))


def customer_performance(invoices: DataFrame, cost_ratio: float = 0.7) -> DataFrame:
    p = estimated_profit(net(), cost_ratio)
    return known(invoices, "CustomerKey").groupBy("CustomerKey").agg(
        F.count("InvoiceID").alias("TotalInvoices"),
        zero_sum(net()).alias("TotalRevenue"),
        F.avg(net()).alias("AvgInvoiceValue"),
        zero_sum(p).alias("TotalProfit"),
        F.avg(margin(net(), F.col("TotalAmount"), safe=True)).alias("AvgMargin"),
    )


def executive_kpis(invoices: DataFrame) -> DataFrame:
    return invoices.agg(
        F.countDistinct("CustomerKey").alias("UniqueCustomers"),
        rows().alias("Transactions"),
        F.avg(net()).alias("AvgTransactionValue"),
        F.avg(margin(net(), F.col("TotalAmount"), safe=True)).alias("AvgMargin"),
    )


def monitoring_baseline(shipments: DataFrame, invoices: DataFrame) -> DataFrame:
    s = shipments.agg(
        F.avg("TotalWeight").alias("MeanWeight"),
        F.avg("ShipmentValue").alias("MeanValue"),
        F.avg(on_time_flag(variance_days())).alias("OnTimeRate"),
    )
    i = invoices.agg(F.avg(net()).alias("MeanAmount"), F.avg("PaymentStatus").alias("MeanPaymentStatus"))
    return attach(s, i)


def seasonal_pattern(invoices: DataFrame) -> DataFrame:
    """Share, index (100 = mean season) and rank over the four season rows."""
    seasons = invoices.groupBy(season_of(F.col("InvoiceDate")).alias("Season")).agg(
        rows().alias("Transactions"), F.avg(net()).alias("AvgTransactionValue")
    )
    all_rows = Window.partitionBy()
    return seasons.select(
        "Season",
        "Transactions",
        (F.col("Transactions") * 100.0 / F.sum("Transactions").over(all_rows)).alias("SharePercentage"),
        "AvgTransactionValue",
        (F.col("Transactions") * 100.0 / F.avg("Transactions").over(all_rows)).alias("SeasonalIndex"),
        F.rank().over(Window.orderBy(F.col("Transactions").desc())).alias("Rank"),
    )


def payment_analytics(invoices: DataFrame) -> DataFrame:
    return known(invoices, "CustomerKey", "PaymentStatus").groupBy("CustomerKey", "PaymentStatus").agg(
        rows().alias("InvoiceCount"), zero_sum(net()).alias("TotalAmount"), F.avg(net()).alias("AvgAmount")
    )


def operations_per_customer(shipments: DataFrame) -> DataFrame:
    flags = on_time_flag(variance_days())
    grouped = known(shipments, "CustomerKey").groupBy("CustomerKey").agg(
        rows().alias("TotalShipments"), F.avg(delivery_days()).alias("AvgDeliveryTime"), F.sum(flags).alias("OnTimeDeliveries")
    )
    share = F.col("OnTimeDeliveries") / F.col("TotalShipments") * 100
    return grouped.withColumn("OnTimePercentage", clamp(share, 0.0, 100.0))


def monthly_finance(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(month_of("InvoiceDate").alias("YearMonth")).agg(
        rows().alias("TransactionCount"),
        F.avg(net()).alias("AvgTransactionValue"),
        zero_sum(net()).alias("TotalVolume"),
        F.avg(margin(net(), F.col("TotalAmount"), safe=True)).alias("AvgProfitMargin"),
        F.countDistinct("CustomerKey").alias("UniqueCustomers"),
    )


def season_by_year(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(season_of(F.col("InvoiceDate")).alias("Season"), F.year("InvoiceDate").alias("Year")).agg(
        rows().alias("TransactionCount"), F.avg(net()).alias("AvgTransactionValue"), F.countDistinct("CustomerKey").alias("UniqueCustomers")
    )

"""Data-quality rules: all rules of a table are measured in one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.functions.measures import number_or_zero
from cargolith.operators.keyed import duplicate_members

ERROR, WARNING, REPORT = "error", "warning", "report"
# Equipment types that the warehouse knows.
KNOWN_EQUIPMENT = ["Camion", "Tracteur", "Remorque", "Semi-remorque", "Unknown"]


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    measure: Column


def failing(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0))


def nulls(c: str, severity: str = ERROR) -> Rule:
    return Rule(f"null_{c}", severity, failing(F.col(c).isNull()))


def blank(c: str, severity: str = ERROR) -> Rule:
    return Rule(f"empty_{c}", severity, failing(F.trim(F.col(c)) == ""))


def duplicates(c: str, severity: str = ERROR) -> Rule:
    """Surplus rows per id; a NULL id counts as one value."""
    distinct = F.countDistinct(c) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))
    return Rule(f"duplicate_{c}", severity, F.coalesce(F.count(F.lit(1)) - distinct, F.lit(0)))


def violates(name: str, severity: str, test: Column) -> Rule:
    return Rule(name, severity, failing(test))


def require(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Missing columns, known before any job runs."""
    return [c for c in columns if c not in df.columns]


def check(df: DataFrame, table: str, rules: Sequence[Rule], required: Sequence[str] = ()) -> DataFrame:
    """(table, rule, severity, failing_rows), one row per rule."""
    missing = require(df, required)
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    one = df.agg(*[r.measure.cast("long").alias(f"m{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(table).alias("table"), F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"m{i}").alias("failing_rows")
        )
        for i, r in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*rows)))


def enforce(report: DataFrame) -> DataFrame:
    """Raises when an error rule has failing rows (a report holds one row per rule)."""
    broken = report.filter((F.col("severity") == ERROR) & (F.col("failing_rows") > 0)).collect()
    if broken:
        raise ValueError("; ".join(f"{r.table}.{r.rule}: {r.failing_rows}" for r in broken))
    return report


def gated_load(df: DataFrame, report: DataFrame, path: str) -> None:
    """Writes ``df`` unless one of its error rules has failing rows: then nothing is written and the rules are raised."""
    enforce(report)
    df.write.mode("append").parquet(path)


def passed(report: DataFrame) -> DataFrame:
    """Per table: whether no error rule fails, and how many warnings hold."""
    bad = F.col("failing_rows") > 0
    return report.groupBy("table").agg(
        (F.sum(F.when(bad & (F.col("severity") == ERROR), 1).otherwise(0)) == 0).alias("passed"),
        F.sum(F.when(bad & (F.col("severity") == WARNING), 1).otherwise(0)).alias("warnings"),
    )


def product(df):
    return check(df, "DimProduct", [nulls("ProductID"), blank("ProductName"), duplicates("ProductID")])


def customer(df):
    need = ["CustomerID", "CustomerName", "CustomerCountry"]
    return check(df, "DimCustomer", [*map(nulls, need), duplicates("CustomerID", WARNING)], need)


def supplier(df):
    need = ["SupplierID", "SupplierName", "SupplierCountry"]
    return check(df, "DimSupplier", [*map(nulls, need), duplicates("SupplierID", WARNING)], need)


def location(df):
    need = ["LocationID", "LocationName", "LocationType"]
    return check(df, "DimLocation", [*map(nulls, need), duplicates("LocationID", WARNING)], need)


def equipment(df):
    unknown = ~F.col("EquipmentType").isin(KNOWN_EQUIPMENT)
    rules = [
        nulls("EquipmentID"), duplicates("EquipmentID", WARNING), nulls("EffectiveDate", WARNING),
        violates("unknown_EquipmentType", WARNING, unknown),
    ]
    return check(df, "DimEquipment", rules, ["EquipmentID", "EquipmentType", "OperationType", "IsActive", "EffectiveDate"])


def unknown_equipment_types(df):
    return df.filter(~F.col("EquipmentType").isin(KNOWN_EQUIPMENT)).select("EquipmentType").distinct()


def freight_type(df):
    return check(df, "DimFreightType", [nulls("FreightTypeID"), duplicates("FreightTypeID", WARNING)])


def payment_term(df):
    return check(df, "DimPaymentTerm", [duplicates("PaymentTermID")], ["PaymentTermID", "PaymentTermName", "PaymentDays"])


def calendar(df):
    empty = Rule("empty_table", ERROR, F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))
    return check(df, "DimDate", [empty, duplicates("DateKey"), nulls("Date")])


def fact_shipment(df, required):
    return check(df, "FactShipments", [*[nulls(c, WARNING) for c in required], duplicates("ShipmentID")], required)


def fact_invoice(df):
    not_whole = F.col("PaymentStatus").cast("string").try_cast("bigint").isNull()
    rules = [
        *[nulls(c, WARNING) for c in df.columns],
        duplicates("InvoiceID", WARNING),
        violates("status_not_integer", REPORT, not_whole),
        violates("sales_with_supplier", REPORT, (F.col("InvoiceType") == "Sales") & (F.col("SupplierKey") != 0)),
        violates("purchase_with_customer", REPORT, (F.col("InvoiceType") == "Purchase") & (F.col("CustomerKey") != 0)),
    ]
    return check(df, "FactInvoices", rules)


def repair_invoice_status(df):
    return df.withColumn("PaymentStatus", number_or_zero(F.col("PaymentStatus")).cast("int"))


def duplicate_invoices(df):
    return duplicate_members(df, ["InvoiceID"])


def shipment_performance(df):
    v = F.col("DeliveryVariance")
    score = F.col("CustomerSatisfactionScore")
    rules = [
        nulls("ShipmentKey"),
        nulls("PlannedDeliveryDate", WARNING),
        nulls("ActualDeliveryDate", WARNING),
        nulls("DeliveryVariance", WARNING),
        duplicates("ShipmentKey"),
        violates("variance_over_365", WARNING, F.abs(v) > 365),
        violates("flag_not_0_1", ERROR, ~F.coalesce(F.col("OnTimeDeliveryFlag").isin(0, 1), F.lit(False))),
        violates("score_not_1_5", ERROR, ~F.coalesce(score.between(1, 5), F.lit(False))),
    ]
    return check(df, "ShipmentPerformanceMetrics", rules)


def freight_cost(df):
    rules = [
        *[nulls(c, WARNING) for c in df.columns],
        violates("negative_cost", WARNING, (F.col("PlannedFreightCost") < 0) | (F.col("ActualFreightCost") < 0)),
        violates("negative_ratio", WARNING, F.col("CostEfficiencyRatio") < 0),
    ]
    return check(df, "FreightCostAnalysis", rules)


def prediction_input(df, features: Sequence[str], non_negative: Sequence[str] = ("TotalWeight", "TotalVolume", "ShipmentValue")):
    """Missing and non-numeric features at plan time; nulls and negatives in one pass."""
    numeric = {f.name for f in df.schema if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte")}
    rules = []
    for c in features:
        if c not in df.columns:
            rules.append(Rule(f"missing_{c}", WARNING, F.count(F.lit(1))))
            continue
        if c not in numeric:
            rules.append(Rule(f"non_numeric_{c}", WARNING, F.count(F.lit(1))))
        rules.append(nulls(c, WARNING))
        if c in non_negative:
            rules.append(violates(f"negative_{c}", WARNING, F.col(c) < 0))
    return check(df, "PredictionInput", rules)

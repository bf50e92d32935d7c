"""Cleaning and feature columns for shipments and invoices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.functions import bins, dates as dt, measures as m
from cargolith.operators.ranking import long_form, quantiles, row_numbers
from cargolith.operators.stats import attach, with_bounds

col, lit, when = F.col, F.lit, F.when

SHIPMENT_DATES = ["ShipmentDate", "PlannedArrivalDate", "ActualArrivalDate", "ActualDepartureDate"]
# Columns that tell shipments from invoices.
SHIPMENT_MARKS = ["ShipmentID", "ShipmentDate", "TotalWeight", "TotalVolume"]
INVOICE_MARKS = ["InvoiceID", "InvoiceDate", "NetAmount", "TaxAmount"]


def data_kind(df: DataFrame) -> str:
    """``shipment`` or ``invoice`` by indicator columns, decided on the schema."""
    held = set(df.columns)
    scores = {"shipment": len(held & set(SHIPMENT_MARKS)), "invoice": len(held & set(INVOICE_MARKS))}
    best = max(scores, key=scores.get)
    if scores[best] == 0:
        raise ValueError("neither shipment nor invoice columns found")
    return best


def _one_row_map(marks: DataFrame, key: str, values: Sequence[str], name: str) -> DataFrame:
    """Folds a frame with one row per column into a single map cell."""
    entry = F.struct(col(key), F.struct(*values))
    return marks.agg(F.map_from_entries(F.collect_list(entry)).alias(name))


def _marks(df: DataFrame, columns: Sequence[str], probs: dict[str, float], name: str) -> DataFrame:
    found = quantiles(long_form(df, columns), "value", probs, ["column"], few_keys=True)
    return _one_row_map(found, "column", list(probs), name)


def outlier_bounds(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """One row per column: quartiles and the fences around them."""
    q = quantiles(long_form(df, columns), "value", {"Q1": 0.25, "Q3": 0.75}, ["column"], few_keys=True)
    spread = (col("Q3") - col("Q1")) * factor
    return q.withColumn("Lower", col("Q1") - spread).withColumn("Upper", col("Q3") + spread)


def _fenced(df: DataFrame, columns: Sequence[str], factor: float) -> tuple[DataFrame, dict[str, tuple[Column, Column]]]:
    one = _one_row_map(outlier_bounds(df, columns, factor), "column", ["Lower", "Upper"], "__fence")
    return attach(df, one), {c: (col("__fence")[c]["Lower"], col("__fence")[c]["Upper"]) for c in columns}


def winsorise(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Values beyond the interquartile fences are set to the fence."""
    columns = [c for c in columns if c in df.columns]
    rows, fence = _fenced(df, columns, factor)
    return rows.withColumns({c: m.clamp(col(c), *fence[c]) for c in columns}).drop("__fence")


def outlier_counts(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Number of values outside the fences, per column."""
    bounds = outlier_bounds(df, columns, factor)
    values = long_form(df, columns)
    # One row per column name: the fences travel with the values.
    return (
        values.join(F.broadcast(bounds), "column")
        .groupBy("column")
        .agg(F.sum(when((col("value") < col("Lower")) | (col("value") > col("Upper")), 1).otherwise(0)).alias("Outliers"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode) of text columns; the smallest value wins a tie. Counts are
    combined before the choice, so no task holds all values."""
    pairs = F.explode(F.array(*[F.struct(lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]))
    counts = (
        df.select(pairs.alias("p")).select("p.column", "p.value").filter(col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(lit(1)).alias("n"))
    )
    return counts.groupBy("column").agg(F.min(F.struct(-col("n"), col("value"))).alias("best")).select("column", col("best.value").alias("mode"))


def impute(df: DataFrame, numeric: Sequence[str] = (), text: Sequence[str] = (), flags: Sequence[str] = ()) -> DataFrame:
    """Median for numbers, mode (or 'Unknown') for text, False for flags."""
    out = df
    if numeric:
        out = attach(out, _marks(df, numeric, {"p50": 0.5}, "__median"))
        out = out.withColumns(
            {c: F.coalesce(col(c).cast("double"), col("__median")[c]["p50"]) for c in numeric}
        ).drop("__median")
    if text:
        out = attach(out, _one_row_map(modes(df, text), "column", ["mode"], "__mode"))
        out = out.withColumns({c: F.coalesce(col(c), F.try_element_at("__mode", lit(c))["mode"], lit("Unknown")) for c in text}).drop("__mode")
    return out.withColumns({c: F.coalesce(col(c), lit(False)) for c in flags}) if flags else out


def delivery_columns(df: DataFrame) -> DataFrame:
    v = m.delivery_variance(col("ActualArrivalDate"), col("PlannedArrivalDate"))
    return df.withColumn("DeliveryVariance", v).withColumn("OnTimeDeliveryFlag", m.on_time_flag(col("DeliveryVariance")))


def preprocess_shipments(df: DataFrame) -> DataFrame:
    """Dates cleaned, delivery measures, outliers fenced, gaps filled."""
    clean = df.withColumns({c: dt.without_epoch_year(col(c)) for c in SHIPMENT_DATES if c in df.columns})
    if {"PlannedArrivalDate", "ActualArrivalDate"} <= set(df.columns):
        clean = delivery_columns(clean)
    elif "OnTimeDeliveryFlag" in df.columns:
        clean = clean.withColumn("OnTimeDeliveryFlag", m.yes_no_flag(col("OnTimeDeliveryFlag")))
    measured = [c for c in ("TotalWeight", "TotalVolume", "ShipmentValue") if c in df.columns]
    fenced = winsorise(clean, measured)
    numeric = [c for c in ("TotalWeight", "TotalVolume", "TotalPackages", "ShipmentValue", "DeliveryVariance") if c in fenced.columns]
    return impute(fenced, numeric)


def preprocess_invoices(df: DataFrame, cost_ratio: float = 0.7) -> DataFrame:
    """Amounts made non-negative numbers, status codes, profit estimate, tax rate, fences."""
    amounts = ["TotalAmount", "NetAmount", "TaxAmount"]
    clean = df.withColumns({c: m.at_least(m.number_or_zero(col(c)), 0.0) for c in amounts})
    clean = clean.withColumn("PaymentStatus", m.payment_code(col("PaymentStatus")))
    if "InvoiceProfit" not in df.columns:
        clean = clean.withColumn("EstimatedCost", col("NetAmount") * cost_ratio).withColumn(
            "InvoiceProfit", m.estimated_profit(col("NetAmount"), cost_ratio)
        )
    clean = clean.withColumn("TaxRate", m.clamp(m.per_unit(col("TaxAmount"), col("NetAmount")), 0.0, 1.0))
    return winsorise(clean, amounts)


def preprocessing_stats(df: DataFrame) -> DataFrame:
    """Rows, missing cells and columns by kind, in one pass."""
    kinds = [t for _, t in df.dtypes]
    missing = lit(0)
    for c in df.columns:
        missing = missing + F.sum(when(col(c).isNull(), 1).otherwise(0))
    return df.agg(
        F.count(lit(1)).alias("Rows"),
        missing.alias("MissingValues"),
        lit(sum(t in ("int", "bigint", "double") for t in kinds)).alias("NumericColumns"),
        lit(sum(t == "string" for t in kinds)).alias("TextColumns"),
        lit(sum(t.startswith("timestamp") or t == "date" for t in kinds)).alias("DateColumns"),
    )


def unit_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "WeightVolumeDensity": m.per_unit(col("TotalWeight"), col("TotalVolume")),
            "ValuePerWeight": m.per_unit(col("ShipmentValue"), col("TotalWeight")),
            "ValuePerPackage": m.per_unit(col("ShipmentValue"), col("TotalPackages")),
            "PackageDensity": m.per_unit(col("TotalPackages"), col("TotalVolume")),
        }
    )


def size_labels(df: DataFrame) -> DataFrame:
    rows = with_bounds(df, ["TotalWeight", "ShipmentValue"])

    def label(c: str, names: list[str]) -> Column:
        return bins.bin_label(bins.equal_width_bin(col(c), col(f"{c}_min"), col(f"{c}_max"), len(names)), names)

    return rows.withColumn("ShipmentSize", label("TotalWeight", bins.SIZE_LABELS)).withColumn(
        "ValueCategory", label("ShipmentValue", bins.VALUE_LABELS)
    ).drop("TotalWeight_min", "TotalWeight_max", "ShipmentValue_min", "ShipmentValue_max")


def _calendar_columns(date: Column) -> dict[str, Column]:
    month = dt.cyclic(F.month(date), 12)
    return {
        "Month": F.month(date),
        "Quarter": F.quarter(date),
        "DayOfWeek": dt.weekday0(date),
        "Year": F.year(date),
        "Season": dt.season_of(date),
        "Month_sin": month[0],
        "Month_cos": month[1],
    }


def shipment_features(df: DataFrame, labels: bool = True) -> DataFrame:
    """``labels`` adds the size and value categories, which need the extremes of the whole table: a second
    pass over the source that training and scoring do without."""
    d = col("ShipmentDate")
    week = dt.cyclic(dt.weekday0(d), 7)
    out = unit_ratios(df).withColumns(
        {
            **_calendar_columns(d),
            "IsWeekend": dt.weekend_flag(d),
            "DayOfMonth": F.dayofmonth(d),
            "WeekOfYear": F.weekofyear(d),
            "DayOfWeek_sin": week[0],
            "DayOfWeek_cos": week[1],
        }
    )
    if {"PlannedArrivalDate", "ActualArrivalDate"} <= set(df.columns):
        planned, actual = dt.floor_days(col("PlannedArrivalDate"), d), dt.floor_days(col("ActualArrivalDate"), d)
        out = out.withColumns({"PlannedDuration": planned, "ActualDuration": actual}).withColumn(
            "DeliveryVariance", col("ActualDuration") - col("PlannedDuration")
        ).withColumn("OnTimeDeliveryFlag", m.on_time_flag(col("DeliveryVariance")))
    return size_labels(out) if labels else out


def invoice_features(df: DataFrame, as_of: Column, safe: bool = False) -> DataFrame:
    d = col("InvoiceDate")
    out = df.withColumns(
        {
            "TaxRate": m.per_unit(col("TaxAmount"), col("NetAmount")),
            "ProfitMargin": m.margin(col("NetAmount"), col("TotalAmount"), safe),
            **_calendar_columns(d),
            "IsMonthEnd": dt.month_end_flag(d),
            "IsQuarterEnd": dt.quarter_end_flag(d),
            "PaymentPeriod": dt.floor_days(col("PaymentDueDate"), d),
            "IsOverdue": dt.overdue_flag(col("PaymentDueDate"), as_of),
        }
    )
    rows = with_bounds(out, ["NetAmount"])
    index = bins.equal_width_bin(col("NetAmount"), col("NetAmount_min"), col("NetAmount_max"), 5)
    return rows.withColumn("AmountCategory", bins.bin_label(index, bins.AMOUNT_LABELS)).drop("NetAmount_min", "NetAmount_max")


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Alphabetic codes from 0. The vocabulary stays distributed: it is ranked and joined back."""
    codes = row_numbers(df.select(column).filter(col(column).isNotNull()).distinct(), [column], name, start=0)
    return df.join(codes.withColumn(name, col(name).cast("int")), column, "left")


def scaling_marks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: mean, sample deviation, min, max, median and quartile range."""
    values = long_form(df, columns)
    moments = values.groupBy("column").agg(
        F.avg("value").alias("Mean"), F.stddev_pop("value").alias("Std"), F.min("value").alias("Min"), F.max("value").alias("Max")
    )
    q = quantiles(values, "value", {"Q1": 0.25, "Median": 0.5, "Q3": 0.75}, ["column"], few_keys=True)
    return moments.join(F.broadcast(q), "column")


def scaled(df: DataFrame, columns: Sequence[str], method: str = "robust") -> DataFrame:
    """Adds ``<c>_scaled`` by the robust, standard or min-max rule."""
    one = _one_row_map(scaling_marks(df, columns), "column", ["Mean", "Std", "Min", "Max", "Q1", "Median", "Q3"], "__s")
    rows = attach(df, one)

    def shaped(c: str) -> Column:
        mark = col("__s")[c]
        center, width = {
            "robust": (mark["Median"], mark["Q3"] - mark["Q1"]),
            "standard": (mark["Mean"], mark["Std"]),
            "minmax": (mark["Min"], mark["Max"] - mark["Min"]),
        }[method]
        return (col(c) - center) / when(width == 0, lit(1.0)).otherwise(width)

    return rows.withColumns({f"{c}_scaled": shaped(c) for c in columns}).drop("__s")


def derived_targets(df: DataFrame) -> DataFrame:
    """Deterministic targets: variance from durations, on-time flag from variance."""
    out = df
    if "DeliveryVariance" not in df.columns:
        out = out.withColumn("DeliveryVariance", col("ActualDuration") - col("PlannedDuration"))
    return out.withColumn("OnTimeDeliveryFlag", m.on_time_flag(col("DeliveryVariance")))


def aligned(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features in training order; missing ones and NULLs become 0."""
    return df.withColumns({c: F.coalesce(col(c).cast("double"), lit(0.0)) if c in df.columns else lit(0.0) for c in features})

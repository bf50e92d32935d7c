"""Business measures as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from cargolith.functions.dates import floor_days

EPSILON = 1e-6

# Payment-status words and their codes.
PAYMENT_CODES = {
    "Validée": 1,
    "Payée": 2,
    "En attente": 3,
    "Annulée": 4,
    "Paid": 2,
    "Unpaid": 0,
    "Pending": 3,
    "Cancelled": 4,
    "Validated": 1,
    "Partially Paid": 3,
    "Overdue": 5,
}
# Labels shown for status codes.
PAYMENT_LABELS = {0: "Unpaid", 1: "Validated", 2: "Paid", 3: "Pending", 4: "Cancelled", 5: "Overdue"}


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def per_unit(value: Column, unit: Column) -> Column:
    """Ratio kept finite by a small constant in the denominator."""
    return value / (unit + EPSILON)


def safe_ratio(value: Column, base: Column) -> Column:
    """NULL where the base is zero or missing."""
    return F.try_divide(value, base)


def margin(net: Column, total: Column, safe: bool = False) -> Column:
    return safe_ratio(net - total, net) if safe else per_unit(net - total, net)


def at_least(c: Column, low: float) -> Column:
    return F.when(c < low, F.lit(low)).otherwise(c)


def clamp(c: Column, low, high) -> Column:
    """NULL stays NULL (``greatest``/``least`` would skip it)."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def number_or_zero(c: Column, kind: str = "double") -> Column:
    return F.coalesce(c.cast("string").try_cast(kind), F.lit(0).cast(kind))


def estimated_profit(net: Column, cost_ratio: float = 0.7) -> Column:
    return net - net * cost_ratio


def delivery_variance(actual: Column, planned: Column) -> Column:
    return floor_days(actual, planned)


def on_time_flag(variance: Column) -> Column:
    return F.when(variance <= 0, 1).otherwise(0)


def delay_reason(variance: Column) -> Column:
    return (
        F.when(variance.isNull() | (variance <= 0), None)
        .when(variance <= 7, "Late Delivery")
        .when(variance <= 30, "Significantly Delayed")
        .otherwise("Severely Delayed")
    )


def satisfaction_score(variance: Column) -> Column:
    return (
        F.when(variance.isNull(), 3)
        .when(variance <= -1, 5)
        .when(variance <= 0, 4)
        .when(variance <= 3, 3)
        .when(variance <= 7, 2)
        .otherwise(1)
    )


def overrun_flag(variance: Column) -> Column:
    return F.when(variance > 0, 1).otherwise(0)


def payment_code(c: Column) -> Column:
    """Known words by table, plain numbers kept, anything else 0."""
    text = c.cast("string")
    return F.coalesce(
        F.try_element_at(literal_map(PAYMENT_CODES), text), text.try_cast("double").cast("int"), F.lit(0)
    )


def yes_no_flag(c: Column) -> Column:
    text = c.cast("string")
    return (
        F.when(F.lower(text).isin("yes", "true"), 1)
        .when(F.lower(text).isin("no", "false"), 0)
        .otherwise(F.coalesce(text.try_cast("double").cast("int"), F.lit(0)))
    )


def payment_label(code: Column) -> Column:
    return F.coalesce(
        F.try_element_at(literal_map(PAYMENT_LABELS), code.cast("int")), F.concat(F.lit("Status_"), code.cast("string"))
    )


def rule_segment(r: Column, f: Column, m: Column) -> Column:
    """First rule that holds names the segment."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal_Customers")
        .when((r >= 3) & (f <= 2), "New_Customers")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At_Risk")
        .when((r <= 2) & (f <= 2), "Lost_Customers")
        .otherwise("Others")
    )

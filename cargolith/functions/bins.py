"""Bins: equal width, fixed cuts, quintiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the equal-width categories.
SIZE_LABELS = ["Small", "Medium", "Large"]
VALUE_LABELS = ["Low", "Medium", "High", "Premium"]
AMOUNT_LABELS = ["XS", "S", "M", "L", "XL"]


def equal_width_bin(c: Column, low: Column, high: Column, k: int) -> Column:
    """Zero-based bin of ``k`` right-closed, equally wide intervals over [low, high].

    A constant column sits in the middle; values outside the range give NULL.
    """
    middle = -(-k // 2) - 1
    position = F.ceil((c - low) / (high - low) * k).cast("int") - 1
    return (
        F.when((c < low) | (c > high), None)
        .when(low == high, F.lit(middle))
        .when(c.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(k - 1), position)))
    )


def bin_label(index: Column, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), index + 1)


def risk_band(score: Column, low: float, high: float, labels=("Low", "Medium", "High")) -> Column:
    """Left-open, right-closed bands of (0, 1]; 0 and anything above 1 give NULL."""
    return (
        F.when((score > 0) & (score <= low), labels[0])
        .when((score > low) & (score <= high), labels[1])
        .when((score > high) & (score <= 1.0), labels[2])
    )


def quintile_of_rank(rank: Column, n: Column) -> Column:
    """Quintile of a unique rank by interpolated edges (differs from ``ntile``)."""
    return F.greatest(F.lit(1), F.ceil((rank - 1) * 5 / F.greatest(n - 1, F.lit(1)))).cast("int")

"""One-pass statistics over many columns, histograms, attached scalars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.functions.bins import equal_width_bin
from cargolith.session import tiny


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Adds the columns of a global aggregate (exactly one row) to every row."""
    return df.crossJoin(tiny(one_row))


def with_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<c>_min`` and ``<c>_max`` of all columns from a single aggregate."""
    ends = []
    for c in columns:
        ends += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return attach(df, df.agg(*ends))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls) for all columns in one pass."""
    names = list(columns or df.columns)
    one = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in names])
    return unfold(one, names, "ColumnName", "Nulls", "long")


def unfold(one: DataFrame, names: Sequence[str], key: str, value: str, kind: str) -> DataFrame:
    """Turns the columns of a short frame into (name, value) rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias(key), F.col(n).cast(kind).alias(value)) for n in names]))
    return one.select(pairs.alias("p")).select(f"p.{key}", f"p.{value}")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equally wide left-closed bins (the last one closed), with the mean."""
    x = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    ends = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg("x").alias("Mean"))
    place = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int")
    index = F.when(F.col("hi") == F.col("lo"), F.lit(bins // 2)).otherwise(F.least(F.lit(bins - 1), place))
    counted = attach(x, ends).groupBy(index.alias("Bin")).agg(
        F.count(F.lit(1)).alias("Count"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("Mean").alias("Mean")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return counted.select("Bin", (F.col("lo") + F.col("Bin") * width).alias("BinStart"), "Count", "Mean")


def equal_width_counts(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in right-closed equal-width bins."""
    binned = with_bounds(df.select(column), [column])
    index = equal_width_bin(F.col(column), F.col(f"{column}_min"), F.col(f"{column}_max"), bins)
    return binned.filter(F.col(column).isNotNull()).groupBy(index.alias("Bin")).agg(F.count(F.lit(1)).alias("Count"))

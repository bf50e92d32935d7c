"""Row choice per key, key resolution with rejects, duplicate groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, first in ``order`` (total). Spark plans a group limit before
    the shuffle, hence each task sends at most one row per key, however hot."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of key groups with more than one row. Counts first, then a semi join
    on the repeated keys, so no group has to meet in one task."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    return df.join(repeated, list(keys), "left_semi")


def unmatched(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct key values of ``df`` that ``dim`` does not hold; NULL counts as a value."""
    wanted = df.select(*on).distinct()
    held = dim.select(*[F.col(c).alias(f"__d_{c}") for c in on])
    condition = None
    for c in on:
        part = wanted[c].eqNullSafe(held[f"__d_{c}"])
        condition = part if condition is None else condition & part
    return wanted.join(held, condition, "left_anti")


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join that keeps rows without a partner."""
    return df.join(dim, on, "left")


#: Slots that the rows of one group are dealt to: one bit each of a 64-bit number.
SLOTS = 64


def _slot(row_id: str) -> Column:
    return F.pmod(F.xxhash64(row_id), F.lit(SLOTS)).cast("int")


def group_slots(rows: DataFrame, keys: Sequence[str], row_id: str, measures: Sequence[Column]) -> DataFrame:
    """Aggregates per group, combined before the shuffle, once for every slot (``__slot``) that rows of the group fall into."""
    one = F.lit(1).cast("long")
    grouped = rows.groupBy(*keys).agg(*measures, F.bit_or(F.call_function("shiftleft", one, _slot(row_id))).alias("__bits"))
    used = F.filter(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.call_function("shiftrightunsigned", F.col("__bits"), s).bitwiseAND(one) == 1)
    return grouped.withColumn("__slot", F.explode(used)).drop("__bits")


def meet(rows: DataFrame, slots: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """``rows`` with what :func:`group_slots` found for their group: a hot group meets its rows in many tasks."""
    return rows.withColumn("__slot", _slot(row_id)).join(slots, [*keys, "__slot"]).drop("__slot")


def with_group(rows: DataFrame, keys: Sequence[str], row_id: str, measures: Sequence[Column]) -> DataFrame:
    """``rows`` with aggregates of their group, for groups of any size."""
    return meet(rows, group_slots(rows, keys, row_id, measures), keys, row_id)

"""Versioned dimensions: first stamp, merge, surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.functions.dates import OPEN_END, instant
from cargolith.operators.ranking import row_numbers
from cargolith.session import tiny

VERSION_COLUMNS = ["EffectiveDate", "ExpiryDate", "IsCurrent"]


def first_stamp(df: DataFrame, effective: Column) -> DataFrame:
    """Opens a version for every row."""
    return df.withColumns(
        {"EffectiveDate": effective, "ExpiryDate": instant(OPEN_END), "IsCurrent": F.lit(True)}
    )


def classify(current: DataFrame, incoming: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Incoming rows with ``ChangeType`` new / changed / unchanged against the current versions."""
    old = current.select(F.col(key), F.lit(True).alias("__held"), *[F.col(a).alias(f"__old_{a}") for a in attributes])
    differs = F.lit(False)
    for a in attributes:
        differs = differs | ~F.col(a).eqNullSafe(F.col(f"__old_{a}"))
    kind = F.when(F.col("__held").isNull(), "new").when(differs, "changed").otherwise("unchanged")
    return incoming.join(old, key, "left").withColumn("ChangeType", kind).drop(
        "__held", *[f"__old_{a}" for a in attributes]
    )


def merge_versions(
    history: DataFrame, incoming: DataFrame, key: str, attributes: Sequence[str], as_of: Column
) -> DataFrame:
    """Next state of a versioned dimension.

    ``incoming`` holds one row per key with the attributes and ``EffectiveDate``. One
    full outer join on the key decides each pair; the outcome (kept, expired and
    inserted versions) is unfolded from an array, so no side is scanned twice.
    """
    columns = [key, *attributes, *VERSION_COLUMNS]
    old = history.filter("coalesce(IsCurrent, false)").select(*[F.col(c).alias(f"o_{c}") for c in columns])
    new = incoming.select(*[F.col(c).alias(f"n_{c}") for c in [key, *attributes, "EffectiveDate"]])
    pair = old.join(new, F.col(f"o_{key}") == F.col(f"n_{key}"), "full_outer")
    differs = F.lit(False)
    for a in attributes:
        differs = differs | ~F.col(f"o_{a}").eqNullSafe(F.col(f"n_{a}"))
    had, got = F.col(f"o_{key}").isNotNull(), F.col(f"n_{key}").isNotNull()
    opens = got & (~had | differs)
    closes = had & got & differs
    kept = F.struct(
        *[F.col(f"o_{c}").alias(c) for c in [key, *attributes, "EffectiveDate"]],
        F.when(closes, as_of).otherwise(F.col("o_ExpiryDate")).alias("ExpiryDate"),
        (~closes).alias("IsCurrent"),
    )
    added = F.struct(
        *[F.col(f"n_{c}").alias(c) for c in [key, *attributes, "EffectiveDate"]],
        instant(OPEN_END).alias("ExpiryDate"),
        F.lit(True).alias("IsCurrent"),
    )
    versions = F.array_compact(F.array(F.when(had, kept), F.when(opens, added)))
    live = pair.select(F.inline(versions)).select(*columns)
    closed = history.filter("not coalesce(IsCurrent, false)").select(*columns)
    return closed.unionByName(live)


def assign_keys(
    incoming: DataFrame, natural: str, name: str, existing: DataFrame | None = None
) -> DataFrame:
    """Surrogate keys: known natural keys keep theirs, new ones continue after the maximum."""
    if existing is None:
        return row_numbers(incoming, [natural], name)
    held = existing.select(natural, name)
    known = incoming.join(held, natural, "inner")
    fresh = row_numbers(incoming.join(held, natural, "left_anti"), [natural], "__seq")
    top = existing.agg(F.coalesce(F.max(name), F.lit(0)).alias("__top"))
    fresh = fresh.crossJoin(tiny(top)).withColumn(name, F.col("__seq") + F.col("__top")).drop("__seq", "__top")
    return known.unionByName(fresh)

"""Global ranks, running sums and quantiles without a one-partition window.

Each recipe range-partitions the narrow frame, writes it to the checkpoint folder
so that all passes see one partitioning, and combines per-partition totals (one
row per shuffle partition) with positions inside the partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolith.session import materialise, tiny

_PID, _POS, _BASE = "__part", "__pos", "__base"


def _sort_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str = "RowNumber", start=1) -> DataFrame:
    """1-based position in a total order. ``order`` must end in a unique column, so
    that a hot value spreads over partitions and re-runs agree."""
    cols = _sort_columns(order)
    # The generated id holds the partition in its upper bits and the row's index
    # inside the partition in its lower 33: one shuffle yields both.
    tagged = materialise(
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn(_POS, F.monotonically_increasing_id())
        .withColumn(_PID, F.shiftright(_POS, 33))
        .withColumn(_POS, F.col(_POS).bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        tagged.groupBy(_PID)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(_PID, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_BASE))
    )
    return (
        tagged.join(tiny(bases), _PID)
        .withColumn(name, F.col(_BASE) + F.col(_POS) + start)
        .drop(_PID, _POS, _BASE)
    )


def running_sums(
    df: DataFrame, order: Sequence[str | Column], weights: Sequence[str], keys: Sequence[str] = (), few_keys: bool = False
) -> DataFrame:
    """Adds ``cum_<w>`` (inclusive running sum) and ``total_<w>`` per weight, per key.

    ``few_keys`` says that the keys are labels of the plan itself (column, model or
    segment names), hence that the totals may be broadcast; pass False for keys that
    grow with the data, which are then joined by a shuffle.
    """
    keys, cols = list(keys), _sort_columns(order)
    ranged = [F.col(k) for k in keys] + cols
    tagged = materialise(df.repartitionByRange(*ranged).withColumn(_PID, F.spark_partition_id()))
    inside = Window.partitionBy(_PID, *keys).orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    per_key = Window.partitionBy(*keys) if keys else Window.partitionBy()
    before = per_key.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # One row per (key, partition) that meet: at most keys + partitions rows.
    totals = tagged.groupBy(_PID, *keys).agg(*[F.sum(w).alias(w) for w in weights])
    bases = totals.select(
        _PID,
        *keys,
        *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"{_BASE}_{w}") for w in weights],
        *[F.sum(w).over(per_key).alias(f"total_{w}") for w in weights],
    )
    if few_keys or not keys:
        bases = tiny(bases)
    local = tagged.select("*", *[F.sum(w).over(inside).alias(f"cum_{w}") for w in weights])
    out = local.join(bases, [_PID, *keys])
    for w in weights:
        out = out.withColumn(f"cum_{w}", F.col(f"cum_{w}") + F.col(f"{_BASE}_{w}"))
    return out.drop(_PID, *[f"{_BASE}_{w}" for w in weights])


def value_counts(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their counts: copies collapse before any ordering."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt"))


def average_ranks(df: DataFrame, value: str, keys: Sequence[str] = (), descending: bool = False, few_keys: bool = False) -> DataFrame:
    """One row per distinct value: ``cnt``, ``avg_rank`` (ties share the mean) and ``n``."""
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranked = running_sums(value_counts(df, value, keys), [order], ["cnt"], keys, few_keys)
    return ranked.select(
        *keys,
        value,
        "cnt",
        (F.col("cum_cnt") - F.col("cnt") + (F.col("cnt") + 1) / 2).alias("avg_rank"),
        F.col("total_cnt").alias("n"),
    )


def percent_rank_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds average-tie percent ranks (as doubles), ``{source: new name}``, joined back on the value.

    All columns share one count of (column, value), one range partitioning and one checkpoint. Equal values are
    one row by then, so that a column with few values joins back by broadcast.
    """
    ranks = average_ranks(long_form(df, list(columns)), "value", ["column"], few_keys=True)
    out = df
    for source, name in columns.items():
        own = ranks.filter(F.col("column") == source).select(F.col("value").alias("__value"), (F.col("avg_rank") / F.col("n")).alias(name))
        out = out.join(own, F.col(source).cast("double") == F.col("__value"), "left").drop("__value")
    return out


def _bucket(value: Column) -> Column:
    """A whole number that never falls as the value grows: 256 for each power of e, NaN last."""
    x = value.cast("double")
    size = F.floor((F.log(F.abs(x)) + 746) * 256)  # the least positive double has a logarithm of -744.4
    return F.when(F.isnan(x), F.lit(2**63 - 1)).when(x == 0, F.lit(0)).when(x < 0, -size).otherwise(size)


def _near_targets(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str], few_keys: bool, tie: str | None = None
) -> DataFrame:
    """Running counts about the asked-for positions only; ``tie`` orders rows of one value.

    A first pass counts the values per bucket, before the shuffle too: a task holds some thousands of numbers per
    key, whatever the size of the data. The counts say which buckets hold a position. A second pass keeps the values
    of these buckets, equal ones as one row, and orders them. All counts are exact.
    """
    ties, keys = [tie] if tie else [], list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value, *ties, _bucket(F.col(value)).alias("__slot"))
    per_key = Window.partitionBy(*keys)
    upto = per_key.orderBy("__slot").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.groupBy(*keys, "__slot").agg(F.count(F.lit(1)).alias("__size")).select(
        *keys, "__slot", "__size", F.sum("__size").over(upto).alias("__upto"), F.sum("__size").over(per_key).alias("__n"))

    def holds(p: Column) -> Column:
        """One position more on both sides, as callers round p * (n - 1) in their own ways."""
        place = p * (F.col("__n") - 1)
        return (F.col("__upto") - F.col("__size") <= F.ceil(place) + 1) & (F.col("__upto") > F.floor(place) - 1)

    hit = placed.filter(F.exists(F.array(*[F.lit(float(p)) for p in probs]), holds))
    targets = hit.select(*keys, "__slot", "__n", (F.col("__upto") - F.sum("__size").over(upto)).alias("__skipped"))
    if few_keys or not keys:
        targets = tiny(targets)
    kept = rows.join(targets, [*keys, "__slot"])
    counts = kept.groupBy(*keys, "__slot", value, *ties, "__n", "__skipped").agg(F.count(F.lit(1)).alias("cnt"))
    summed = running_sums(counts, ["__slot", value, *ties], ["cnt"], keys, few_keys)
    return summed.withColumns({"cum_cnt": F.col("cum_cnt") + F.col("__skipped"), "total_cnt": F.col("__n")}).drop("__n", "__skipped")


def quintile_cuts(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """One row: per column the array ``cuts_<column>`` of the last (value, key) of the first four fifths.

    Rows are in the order of value, then ``key`` (unique whole numbers), and fifths are those of positions 1 to n
    at equal distances. Only rows about the four cuts are ordered, all columns in one run.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    rows = df.select(F.col(key).cast("long").alias("key"), pairs.alias("p")).select("p.column", "p.value", "key")
    counted = _near_targets(rows, "value", [0.2, 0.4, 0.6, 0.8], ["column"], True, tie="key")
    picks = []
    for c in columns:
        at = [F.floor(1 + (F.col("total_cnt") - 1) * q / 5) for q in range(1, 5)]
        found = [
            F.max(F.when((F.col("column") == c) & (F.col("cum_cnt") - F.col("cnt") < r) & (r <= F.col("cum_cnt")), F.struct("value", "key"))) for r in at
        ]
        picks.append(F.array(*found).alias(f"cuts_{c}"))
    return counted.agg(*picks)


def quintile(column: str, key: str) -> Column:
    """1 to 5 from the cuts of :func:`quintile_cuts`."""
    own = F.struct(F.col(column).cast("double").alias("value"), F.col(key).cast("long").alias("key"))
    return (F.size(F.filter(f"cuts_{column}", lambda cut: cut < own)) + 1).cast("int")


def quantiles(
    df: DataFrame, value: str, probs: dict[str, float], keys: Sequence[str] = (), few_keys: bool = False
) -> DataFrame:
    """Exact interpolated quantiles per key, one column per entry of ``probs``. Neither a
    hot key nor a wide value range has to fit in one task."""
    counted = _near_targets(df, value, list(probs.values()), keys, few_keys)
    first, last = F.col("cum_cnt") - F.col("cnt"), F.col("cum_cnt")

    def at(index: Column) -> Column:
        return F.max(F.when((first <= index) & (index < last), F.col(value)))

    picks = []
    for name, p in probs.items():
        place = (F.col("total_cnt") - 1) * p
        picks += [at(F.floor(place)).alias(f"{name}__lo"), at(F.ceil(place)).alias(f"{name}__hi")]
    grouped = counted.groupBy(*keys).agg(F.max("total_cnt").alias("__n"), *picks)
    out = []
    for name, p in probs.items():
        place = (F.col("__n") - 1) * p
        low, high = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        value_at = F.when(low.isNotNull() & high.isNotNull(), low + (high - low) * (place - F.floor(place)))
        missed = F.raise_error(F.lit(f"{value}: a position lies outside its bracket")).cast("double")
        out.append(F.when(F.col("__n").isNull() | value_at.isNotNull(), value_at).otherwise(missed).alias(name))
    return grouped.select(*keys, *out)


def quantile_rows(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (), few_keys: bool = False
) -> DataFrame:
    """As :func:`quantiles`, in rows (keys, probability, quantile): the choice for many
    probabilities. A distinct value meets only the probabilities whose position it covers."""
    counted = _near_targets(df, value, probs, keys, few_keys)
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    first, last, top = F.col("cum_cnt") - F.col("cnt"), F.col("cum_cnt"), F.col("total_cnt") - 1

    def covers(index: Column) -> Column:
        return (index >= first) & (index < last)

    hit = F.filter(wanted, lambda p: covers(F.floor(p * top)) | covers(F.ceil(p * top)))
    rows = counted.select(*keys, value, first.alias("__f"), last.alias("__l"), top.alias("__t"), F.explode(hit).alias("probability"))
    place = F.col("probability") * F.col("__t")

    def at(index: Column) -> Column:
        return F.max(F.when((index >= F.col("__f")) & (index < F.col("__l")), F.col(value)))

    ends = rows.groupBy(*keys, "probability").agg(at(F.floor(place)).alias("lo"), at(F.ceil(place)).alias("hi"), F.max("__t").alias("__t"))
    part = F.col("probability") * F.col("__t")
    return ends.select(*keys, "probability", (F.col("lo") + (F.col("hi") - F.col("lo")) * (part - F.floor(part))).alias("quantile"))


def long_form(df: DataFrame, columns: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    """(column, value) rows of several numeric columns: one pass instead of one per column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns]))
    return df.select(pairs.alias("p")).select(f"p.{name}", f"p.{value}")

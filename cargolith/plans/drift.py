"""Drift between a reference and a current frame, degradation, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.functions import statistics as st
from cargolith.functions.bins import equal_width_bin
from cargolith.operators.ranking import long_form, running_sums

col, lit, when = F.col, F.lit, F.when


def _both(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    r = long_form(reference, columns).withColumn("cur", lit(0))
    c = long_form(current, columns).withColumn("cur", lit(1))
    return r.unionByName(c).filter(col("value").isNotNull())


def distribution_steps(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: distinct values in order with running counts of both samples."""
    counts = _both(reference, current, columns).groupBy("column", "value").agg(
        F.sum(1 - col("cur")).alias("ref"), F.sum("cur").alias("cur")
    )
    return running_sums(counts, ["value"], ["ref", "cur"], ["column"])


def kolmogorov_smirnov(steps: DataFrame) -> DataFrame:
    gap = F.abs(F.try_divide("cum_ref", "total_ref") - F.try_divide("cum_cur", "total_cur"))
    one = steps.groupBy("column").agg(F.max(gap).alias("ks_statistic"), F.max("total_ref").alias("n1"), F.max("total_cur").alias("n2"))
    x = F.sqrt(col("n1") * col("n2") / (col("n1") + col("n2"))) * col("ks_statistic")
    return one.withColumn("ks_pvalue", st.kolmogorov_tail(x))


def mann_whitney(steps: DataFrame) -> DataFrame:
    """Two-sided rank test with average ranks and tie correction."""
    t = (col("ref") + col("cur")).cast("double")
    before = col("cum_ref") + col("cum_cur") - t
    rank = before + (t + 1) / 2
    one = steps.groupBy("column").agg(
        F.sum(col("ref") * rank).alias("r1"),
        F.sum(t * t * t - t).alias("ties"),
        F.max("total_ref").cast("double").alias("n1"),
        F.max("total_cur").cast("double").alias("n2"),
    )
    n = col("n1") + col("n2")
    u = col("r1") - col("n1") * (col("n1") + 1) / 2
    mean = col("n1") * col("n2") / 2
    sd = F.sqrt(col("n1") * col("n2") / 12 * ((n + 1) - col("ties") / (n * (n - 1))))
    z = F.try_divide(F.greatest(F.abs(u - mean) - 0.5, lit(0.0)), sd)
    return one.select("column", u.alias("mw_statistic"), st.two_sided_normal(z).alias("mw_pvalue"))


def stability_index(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index on equal-width bins of the reference; values outside
    its range do not count towards the current shares."""
    values = _both(reference, current, columns)
    ends = values.filter("cur = 0").groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    # One row per column: bounded by the number of columns compared.
    binned = values.join(F.broadcast(ends), "column").withColumn("bin", equal_width_bin(col("value"), col("lo"), col("hi"), bins))
    cells = binned.filter(col("bin").isNotNull()).groupBy("column", "bin").agg(F.sum(1 - col("cur")).alias("r"), F.sum("cur").alias("c"))
    grid = ends.select("column", F.explode(F.sequence(lit(0), lit(bins - 1))).alias("bin"))
    full = grid.join(cells, ["column", "bin"], "left").na.fill(0, ["r", "c"])
    totals = cells.groupBy("column").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    shares = full.join(F.broadcast(totals), "column").select(
        "column",
        (F.coalesce(F.try_divide("r", "nr"), lit(0.0)) + 1e-10).alias("r"),
        (F.coalesce(F.try_divide("c", "nc"), lit(0.0)) + 1e-10).alias("c"),
    )
    return shares.groupBy("column").agg(F.sum((col("c") - col("r")) * F.log(col("c") / col("r"))).alias("psi"))


def moments(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    x = _both(reference, current, columns)
    ref, cur = when(col("cur") == 0, col("value")), when(col("cur") == 1, col("value"))
    return x.groupBy("column").agg(
        F.avg(ref).alias("ref_mean"), F.avg(cur).alias("curr_mean"), F.stddev_samp(ref).alias("ref_std"), F.stddev_samp(cur).alias("curr_std")
    ).withColumn("mean_shift", F.abs(col("curr_mean") - col("ref_mean")) / (col("ref_std") + 1e-8))


def verdicts(reference: DataFrame, current: DataFrame, columns: Sequence[str], threshold: float = 0.05, psi_limit: float = 0.2) -> DataFrame:
    """All tests per column and whether any of them signals drift."""
    steps = distribution_steps(reference, current, columns)
    joined = (
        kolmogorov_smirnov(steps)
        .join(mann_whitney(steps), "column")
        .join(stability_index(reference, current, columns), "column")
        .join(moments(reference, current, columns), "column")
    )
    drifted = (col("ks_pvalue") < threshold) | (col("mw_pvalue") < threshold) | (col("psi") > psi_limit)
    return joined.withColumn("drift_detected", drifted)


def overall(verdict: DataFrame) -> DataFrame:
    """Share of drifted columns, with the levels they call for."""
    drifted = F.sum(col("drift_detected").cast("int"))
    one = verdict.agg(F.count(lit(1)).alias("features_checked"), drifted.alias("features_with_drift"))
    one = one.withColumn("drift_score", col("features_with_drift") / col("features_checked"))
    return one.withColumn("drift_level", drift_level(col("drift_score"))).withColumn("alert_level", alert_level(col("features_with_drift")))


def drift_level(score: Column) -> Column:
    return when(score > 0.3, "significant").when(score > 0.1, "moderate").otherwise("low")


def alert_level(alerts: Column) -> Column:
    return when(alerts > 5, "retrain").when(alerts > 0, "watch").otherwise("healthy")


def alerts(verdict: DataFrame, degraded: DataFrame) -> DataFrame:
    """One row per alert: drifted columns and degraded model metrics."""
    drift = verdict.filter("drift_detected").select(lit("drift").alias("kind"), col("column").alias("subject"))
    worse = degraded.select("model", F.explode(F.array(
        F.struct(lit("rmse").alias("metric"), col("rmse_alert").alias("on")), F.struct(lit("r2").alias("metric"), col("r2_alert").alias("on"))
    )).alias("a")).filter("a.on").select(lit("performance").alias("kind"), F.concat_ws(" ", "model", "a.metric").alias("subject"))
    return drift.unionByName(worse)


def alert_summary(found: DataFrame) -> DataFrame:
    def count_of(kind: str) -> Column:
        return F.coalesce(F.sum(when(col("kind") == kind, 1).otherwise(0)), lit(0))

    one = found.agg(F.count(lit(1)).alias("total_alerts"), count_of("drift").alias("drift_alerts"), count_of("performance").alias("performance_alerts"))
    return one.withColumn("alert_level", alert_level(col("total_alerts")))


def degradation(current: DataFrame, baseline: DataFrame, error_rise: float = 0.10, fit_drop: float = 0.10) -> DataFrame:
    """Current model metrics against their baseline (one row per model)."""
    b = baseline.select("model", col("rmse").alias("baseline_rmse"), col("r2").alias("baseline_r2"))
    out = current.select("model", "rmse", "r2").join(b, "model")
    out = out.withColumn("rmse_change", F.try_divide(col("rmse") - col("baseline_rmse"), col("baseline_rmse"))).withColumn(
        "r2_change", F.try_divide(col("baseline_r2") - col("r2"), col("baseline_r2"))
    )
    return out.withColumn("rmse_alert", col("rmse_change") > error_rise).withColumn("r2_alert", col("r2_change") > fit_drop)


def accuracy_degradation(current: DataFrame, baseline: DataFrame, drop: float = 0.05) -> DataFrame:
    b = baseline.select("model", col("accuracy").alias("baseline_accuracy"))
    out = current.select("model", "accuracy").join(b, "model")
    out = out.withColumn("accuracy_change", F.try_divide(col("baseline_accuracy") - col("accuracy"), col("baseline_accuracy")))
    return out.withColumn("accuracy_alert", col("accuracy_change") > drop)

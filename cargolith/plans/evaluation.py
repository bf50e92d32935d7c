"""Model evaluation over frames with ``y`` (truth) and ``p`` (prediction)."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolith.functions import statistics as st
from cargolith.operators.ranking import percent_rank_columns, quantile_rows, quantiles, row_numbers, running_sums
from cargolith.operators.stats import attach, histogram
from cargolith.session import tiny

col, lit, when = F.col, F.lit, F.when


def regression_metrics(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All error measures in one pass, plus the exact median of absolute errors. ``keys`` are few (models, folds)."""
    keys = list(keys)
    e = col("y") - col("p")
    rows = df.withColumn("__abs", F.abs(e))
    basic = rows.groupBy(*keys).agg(
        F.count(lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg("__abs").alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(when(e.isNotNull(), col("y"))) * F.count(e))).alias("r2"),
        (F.avg(F.abs(e / (col("y") + 1e-8))) * 100).alias("mape"),
        F.max("__abs").alias("max_error"),
        F.avg(e).alias("residual_mean"),
        F.stddev_pop(e).alias("residual_std"),
    )
    median = quantiles(rows, "__abs", {"median_ae": 0.5}, keys, few_keys=True)
    return basic.join(tiny(median), keys) if keys else attach(basic, median)


def residual_normality(df: DataFrame) -> DataFrame:
    """Omnibus test on skewness and kurtosis of the residuals."""
    e = col("y") - col("p")
    one = df.agg(F.count(lit(1)).cast("double").alias("n"), F.skewness(e).alias("g1"), F.kurtosis(e).alias("g2"))
    # Defined from eight rows on.
    z1, z2 = (when(col("n") >= 8, z) for z in (st.skew_z(col("g1"), col("n")), st.kurtosis_z(col("g2"), col("n"))))
    return one.withColumn("k2", z1 * z1 + z2 * z2).withColumn("p_value", st.chi2_two_tail(col("k2"))).withColumn(
        "residuals_normal", col("p_value") > 0.05
    )


def homoscedasticity(df: DataFrame, limit: float = 0.3) -> DataFrame:
    """Spearman correlation of prediction and absolute residual."""
    rows = df.select("p", F.abs(col("y") - col("p")).alias("a"))
    ranks = percent_rank_columns(rows, {"p": "__rp", "a": "__ra"})
    return ranks.agg(st.correlation(col("__rp"), col("__ra")).alias("spearman")).withColumn("homoscedastic", F.abs("spearman") < limit)


def confusion(df: DataFrame) -> DataFrame:
    return df.groupBy("y", "p").agg(F.count(lit(1)).alias("n"))


def class_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    cells = confusion(df)
    actual = cells.groupBy(col("y").alias("label")).agg(F.sum("n").alias("support"), F.sum(when(col("y") == col("p"), col("n")).otherwise(0)).alias("hits"))
    called = cells.groupBy(col("p").alias("label")).agg(F.sum("n").alias("called"))
    both = actual.join(called, "label", "full_outer").na.fill(0, ["support", "hits", "called"])

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(a, b), lit(0.0))

    out = both.withColumn("precision", ratio("hits", "called")).withColumn("recall", ratio("hits", "support"))
    f1 = F.coalesce(F.try_divide(2 * col("precision") * col("recall"), col("precision") + col("recall")), lit(0.0))
    return out.withColumn("f1", f1)


def classification_metrics(df: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    r, w = class_report(df), col("support") / F.sum("support").over(Window.partitionBy())
    weighted = r.select("hits", "support", *[(col(c) * w).alias(c) for c in ("precision", "recall", "f1")])
    return weighted.agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.sum("precision").alias("precision"),
        F.sum("recall").alias("recall"),
        F.sum("f1").alias("f1"),
    )


def score_steps(df: DataFrame, score: str = "score") -> DataFrame:
    """Distinct scores, best first, with running counts of positives and negatives; rows without a label are left out."""
    counts = df.filter(col("y").isNotNull()).groupBy(score).agg(
        F.sum(when(col("y") == 1, 1).otherwise(0)).alias("pos"), F.sum(when(col("y") == 1, 0).otherwise(1)).alias("neg")
    )
    return running_sums(counts, [col(score).desc()], ["pos", "neg"])


def roc_points(df: DataFrame, score: str = "score") -> DataFrame:
    s = score_steps(df, score)
    return s.select(
        col(score).alias("threshold"), F.try_divide("cum_pos", "total_pos").alias("tpr"), F.try_divide("cum_neg", "total_neg").alias("fpr")
    )


def roc_auc(df: DataFrame, score: str = "score") -> DataFrame:
    """Area under the curve: each negative is passed by the positives above it, ties count half."""
    s = score_steps(df, score)
    area = F.sum(col("neg") * (col("cum_pos") - col("pos") / 2))
    return s.agg(F.try_divide(area, F.max("total_pos") * F.max("total_neg")).alias("roc_auc"))


def binary_metrics(df: DataFrame, score: str = "score") -> DataFrame:
    """tp/tn/fp/fn, specificity, negative predictive value and AUC."""

    def cell(y: int, p: int) -> Column:
        return F.sum(when((col("y") == y) & (col("p") == p), 1).otherwise(0))

    one = df.agg(cell(1, 1).alias("tp"), cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"))
    one = one.withColumn("specificity", F.coalesce(F.try_divide("tn", col("tn") + col("fp")), lit(0.0))).withColumn(
        "npv", F.coalesce(F.try_divide("tn", col("tn") + col("fn")), lit(0.0))
    )
    return attach(one, roc_auc(df, score))


def series_metrics(df: DataFrame, keys: Sequence[str] = ("series_id",), order: str = "ds") -> DataFrame:
    """Errors, directional accuracy, bias and variance per series (windows per series,
    which hold one row per period)."""
    w = Window.partitionBy(*keys).orderBy(order)
    dy, dp = F.signum(col("y") - F.lag("y").over(w)), F.signum(col("p") - F.lag("p").over(w))
    rows = df.withColumn("__same", when(dy.isNotNull(), (dy == dp).cast("double")))
    e = col("y") - col("p")
    return rows.groupBy(*keys).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(e / (col("y") + 1e-8))) * 100).alias("mape"),
        (F.avg(2 * F.abs(e) / (F.abs("y") + F.abs("p") + 1e-8)) * 100).alias("smape"),
        (F.avg("__same") * 100).alias("directional_accuracy"),
        F.avg(-e).alias("bias"),
        F.var_pop(-e).alias("variance"),
    )


def average_rank_over(metric: str, ascending: bool = True) -> Column:
    """Average-tie rank over a frame with one row per model."""
    order = col(metric).asc() if ascending else col(metric).desc()
    ties = F.count(lit(1)).over(Window.partitionBy(metric))
    return F.rank().over(Window.orderBy(order)) + (ties - 1) / 2.0


def compare_models(metrics: DataFrame) -> DataFrame:
    """Metric table with ranks: small errors and large r2 come first."""
    return metrics.withColumn("rmse_rank", average_rank_over("rmse")).withColumn("r2_rank", average_rank_over("r2", ascending=False))


def best_models(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.min_by("model", "rmse").alias("lowest_rmse"), F.max_by("model", "r2").alias("highest_r2"))


def residual_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(df.select((col("y") - col("p")).alias("residual")), "residual", bins)


def autocorrelation(df: DataFrame, column: str = "e", order: str = "ds", max_lags: int = 20) -> DataFrame:
    """Autocorrelation up to min(20, n // 4) lags of one series of daily values. The
    series holds one row per calendar day, so its single ordered window is bounded."""
    w = Window.orderBy(order)
    centred = attach(df.select(order, column), df.agg(F.avg(column).alias("__m"), F.count(column).alias("__n")))
    centred = centred.withColumn("__c", col(column) - col("__m"))
    lagged = centred.select("__n", "__c", *[F.lag("__c", k).over(w).alias(f"l{k}") for k in range(1, max_lags + 1)])
    base = F.sum(col("__c") * col("__c"))
    one = lagged.agg(F.max("__n").alias("n"), *[F.try_divide(F.sum(col("__c") * col(f"l{k}")), base).alias(f"l{k}") for k in range(1, max_lags + 1)])
    pairs = F.explode(F.array(*[F.struct(lit(k).alias("lag"), col(f"l{k}").alias("acf")) for k in range(1, max_lags + 1)]))
    limit = F.least(lit(max_lags), F.floor(col("n") / 4))
    return one.select("n", pairs.alias("q")).filter(col("q.lag") <= limit).select("q.lag", "q.acf")


def qq_points(df: DataFrame, grid: int = 99) -> DataFrame:
    """Normal Q-Q points of the residuals on a fixed grid of probabilities."""
    normal = NormalDist()
    probs = [i / (grid + 1) for i in range(1, grid + 1)]
    found = quantile_rows(df.select((col("y") - col("p")).alias("e")), "e", probs)
    theory = df.sparkSession.createDataFrame([(p, normal.inv_cdf(p)) for p in probs], "probability double, theoretical double")
    return theory.join(found, "probability").select("probability", "theoretical", col("quantile").alias("observed"))


def qq_exact(df: DataFrame, key: str) -> DataFrame:
    """Normal Q-Q points of all residuals, one per row: position, theoretical and observed quantile.

    Positions follow the order of the residual, then ``key``; probabilities are the medians of uniform order
    statistics (Filliben).
    """
    rows = df.select((col("y") - col("p")).alias("observed"), key).filter(col("observed").isNotNull())
    placed = attach(row_numbers(rows, ["observed", key], "position"), rows.agg(F.count(lit(1)).alias("__n")))
    n, i = col("__n"), col("position")
    last = F.pow(lit(0.5), 1 / n)
    p = when(i == n, last).when(i == 1, 1 - last).otherwise((i - 0.3175) / (n + 0.365))
    return placed.select("position", st.normal_quantile(p).alias("theoretical"), "observed")


def quality_bands(metrics: DataFrame, minimum_r2: float = 0.45, maximum_mape: float = 35.0) -> DataFrame:
    """Words for the level of r2 and whether it meets the configured minima."""
    band = when(col("r2") > 0.8, "excellent").when(col("r2") > 0.6, "good").otherwise("low")
    return metrics.withColumn("quality", band).withColumn("meets_minimum", (col("r2") >= minimum_r2) & (col("mape") <= maximum_mape))


def accuracy_bands(metrics: DataFrame, minimum: float = 0.65) -> DataFrame:
    band = when(col("accuracy") > 0.8, "good").otherwise("weak")
    return metrics.withColumn("quality", band).withColumn("meets_minimum", col("accuracy") >= minimum)

"""Feature scores and selection. Every score of every feature comes from one pass;
what follows works on frames with one row per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolith.functions.bins import equal_width_bin
from cargolith.functions.statistics import correlation
from cargolith.operators.ranking import long_form
from cargolith.operators.stats import attach, unfold, with_bounds

col = F.col


def _features_and_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("double").alias("x")) for c in features]))
    return df.select(pairs.alias("p"), col(target).alias("y")).select("p.feature", "p.x", "y")


def f_regression(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """F statistic of each feature's linear relation with a numeric target."""
    one = df.agg(F.count(target).alias("__n"), *[correlation(col(c), col(target)).alias(c) for c in features])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), col(c).alias("r")) for c in features]))
    r2 = col("p.r") * col("p.r")
    # A perfect relation has an infinite score; a constant feature has none.
    score = F.when(r2 >= 1, F.lit(float("inf"))).otherwise(F.try_divide(r2, 1 - r2) * (col("__n") - 2))
    return one.select("__n", pairs.alias("p")).select("p.feature", score.alias("score"))


def f_classification(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One-way analysis of variance: spread between classes over spread within."""
    groups = _features_and_target(df, features, label).groupBy("feature", "y").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var")
    )
    totals = groups.groupBy("feature").agg(
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("k"),
        (F.sum(col("n") * col("mean")) / F.sum("n")).alias("grand"),
    )
    # One row per feature, hence a broadcast bounded by the number of features.
    joined = groups.join(F.broadcast(totals), "feature")
    return joined.groupBy("feature").agg(
        F.try_divide(
            F.try_divide(F.sum(col("n") * F.pow(col("mean") - col("grand"), 2)), F.max("k") - 1),
            F.try_divide(F.sum(col("n") * col("var")), F.max("total") - F.max("k")),
        ).alias("score")
    )


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 10, bin_target: bool = True) -> DataFrame:
    """Mutual information (nats) of equal-width bins, from one contingency count."""
    bounded = with_bounds(df, [*features, target] if bin_target else list(features))

    def binned(c: str) -> Column:
        return equal_width_bin(col(c), col(f"{c}_min"), col(f"{c}_max"), bins)

    y = binned(target) if bin_target else col(target)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), binned(c).alias("x")) for c in features]))
    cells = bounded.select(pairs.alias("p"), y.alias("y")).groupBy("p.feature", "p.x", "y").agg(F.count(F.lit(1)).alias("n"))
    by_feature = Window.partitionBy("feature")
    shares = cells.select(
        "feature",
        (col("n") / F.sum("n").over(by_feature)).alias("pxy"),
        (F.sum("n").over(Window.partitionBy("feature", "x")) / F.sum("n").over(by_feature)).alias("px"),
        (F.sum("n").over(Window.partitionBy("feature", "y")) / F.sum("n").over(by_feature)).alias("py"),
    )
    return shares.groupBy("feature").agg(F.sum(col("pxy") * F.log(col("pxy") / (col("px") * col("py")))).alias("score"))


def target_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    one = df.agg(*[F.abs(correlation(col(c), col(target))).alias(c) for c in features])
    return unfold(one, features, "feature", "score", "double")


def variances(df: DataFrame, features: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Sample variances of features whose population variance exceeds the threshold."""
    grouped = long_form(df, features, "feature", "x").groupBy("feature").agg(F.var_samp("x").alias("score"), F.var_pop("x").alias("v"))
    return grouped.filter(col("v") > threshold).drop("v")


def ranked(scores: DataFrame, method: str, k: int) -> DataFrame:
    """Adds rank, method and whether the feature is among the best ``k`` (ties by name)."""
    w = Window.orderBy(col("score").desc_nulls_last(), "feature")  # one row per feature
    return scores.withColumn("rank", F.row_number().over(w)).withColumn("method", F.lit(method)).withColumn("selected", col("rank") <= k)


def greedy_uncorrelated(df: DataFrame, features: Sequence[str], target: str, k: int, limit: float = 0.8) -> DataFrame:
    """Best features by |correlation with the target|, leaving out those correlated at or
    above ``limit`` with one already chosen. The k x k matrix comes from one aggregate."""
    names = list(features)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]

    def corr(a: str, b: str) -> Column:
        return F.abs(correlation(col(a), col(b)))

    row = df.agg(*[corr(c, target).alias(f"t|{c}") for c in names], *[corr(a, b).alias(f"{a}|{b}") for a, b in pairs]).first().asDict()
    with_target = {c: row[f"t|{c}"] if row[f"t|{c}"] is not None else -1.0 for c in names}
    between = {frozenset(p): row["|".join(p)] or 0.0 for p in pairs}
    chosen: list[str] = []
    for c in sorted(names, key=lambda c: (-with_target[c], c)):
        if len(chosen) < k and all(between[frozenset((c, o))] < limit for o in chosen):
            chosen.append(c)
    rows = [(c, float(with_target[c]), i + 1) for i, c in enumerate(chosen)]
    return df.sparkSession.createDataFrame(rows, "feature string, score double, rank int").withColumn("method", F.lit("correlation")).withColumn("selected", F.lit(True))


def votes(rankings: DataFrame, k: int) -> DataFrame:
    """Rank-weighted vote: a feature at place i of a list gives (k - i) / k, i from 0."""
    return (
        rankings.filter("selected")
        .groupBy("feature")
        .agg(F.sum((k - (col("rank") - 1)) / F.lit(k)).alias("ensemble_score"))
    )


def report(rankings: DataFrame) -> DataFrame:
    """How often each feature was selected."""
    return rankings.filter("selected").groupBy("feature").agg(F.count(F.lit(1)).alias("selection_frequency"))


def consolidated(importances: DataFrame) -> DataFrame:
    """Mean, deviation and count of importances over models, per feature."""
    return importances.groupBy("feature").agg(
        F.avg("importance").alias("mean"), F.stddev_samp("importance").alias("std"), F.count("importance").alias("count")
    )

"""Batch scoring: delivery, payment, intervals, risk, contributions."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.functions.bins import risk_band
from cargolith.functions.dates import plus_days
from cargolith.operators.ranking import percent_rank_columns
from cargolith.plans.features import aligned

col, lit = F.col, F.lit


def batch_predict(model, df: DataFrame, features: Sequence[str], name: str = "prediction") -> DataFrame:
    """Scores rows; features are put in training order, absent ones count as 0. The
    input's own columns come through unchanged."""
    kept = df.columns
    temp = {c: f"__f_{c}" for c in features}
    full = aligned(df.select("*", *[col(c).alias(temp[c]) for c in features if c in df.columns]), list(temp.values()))
    vector = VectorAssembler(inputCols=list(temp.values()), outputCol="features").transform(full)
    out = model.transform(vector)
    extra = ["probability"] if "probability" in out.columns else []
    return out.select(*kept, col("prediction").alias(name), *extra)


def delivery(df: DataFrame, classifier, regressor, features: Sequence[str]) -> DataFrame:
    """On-time flag and probability, variance, predicted arrival."""
    flagged = batch_predict(classifier, df, features, "PredictedOnTimeFlag")
    if "probability" in flagged.columns:
        flagged = flagged.withColumn("OnTimeProbability", vector_to_array("probability")[1]).drop("probability")
    else:
        flagged = flagged.withColumn("OnTimeProbability", col("PredictedOnTimeFlag"))
    out = batch_predict(regressor, flagged, features, "PredictedDeliveryVariance")
    if "PlannedArrivalDate" in out.columns:
        out = out.withColumn("PredictedArrivalDate", plus_days(col("PlannedArrivalDate"), col("PredictedDeliveryVariance")))
    return out


def payment(df: DataFrame, classifier, features: Sequence[str]) -> DataFrame:
    out = batch_predict(classifier, df, features, "PredictedPaymentStatus")
    return out.withColumn("PaymentProbability", F.array_max(vector_to_array("probability"))).drop("probability")


def interval(df: DataFrame, prediction: str, cv_std: float, level: float = 0.95) -> DataFrame:
    z = NormalDist().inv_cdf(1 - (1 - level) / 2)
    return df.withColumn("lower_bound", col(prediction) - z * cv_std).withColumn("upper_bound", col(prediction) + z * cv_std)


def shipment_risk(df: DataFrame, delay_risk: Column | None = None) -> DataFrame:
    """Mean of the delay risk and the percentiles of weight, volume, value and route
    length; absent inputs are left out, an absent delay model counts as 0.5."""
    rows = df.withColumn("DelayRisk", delay_risk if delay_risk is not None else lit(0.5))
    ranked = {c: n for c, n in (("TotalWeight", "WeightRisk"), ("TotalVolume", "VolumeRisk"), ("ShipmentValue", "ValueRisk")) if c in df.columns}
    if {"OriginLocationKey", "DestinationLocationKey"} <= set(df.columns):
        rows = rows.withColumn("RouteLength", F.abs(col("OriginLocationKey") - col("DestinationLocationKey")))
        ranked["RouteLength"] = "RouteRisk"
    out = percent_rank_columns(rows, ranked)
    parts = ["DelayRisk", *ranked.values()]
    total, present = lit(0.0), lit(0)
    for c in parts:
        total = total + F.coalesce(col(c), lit(0.0))
        present = present + F.when(col(c).isNotNull(), 1).otherwise(0)
    return out.withColumn("OverallRisk", total / present).withColumn("RiskCategory", risk_band(col("OverallRisk"), 0.3, 0.7))


def contributions(df: DataFrame, importance: dict[str, float], top: int = 10) -> DataFrame:
    """Adds the ``top`` features by |value x importance| of each row."""
    parts = F.array(
        *[
            F.struct(
                (-F.abs(F.coalesce(col(c).cast("double"), lit(0.0)) * w)).alias("order"),
                lit(c).alias("feature"),
                F.coalesce(col(c).cast("double"), lit(0.0)).alias("value"),
                lit(float(w)).alias("importance"),
                (F.coalesce(col(c).cast("double"), lit(0.0)) * w).alias("contribution"),
            )
            for c, w in importance.items()
        ]
    )
    chosen = F.slice(F.array_sort(parts), 1, top)
    return df.withColumn("contributions", F.transform(chosen, lambda x: F.struct(x["feature"].alias("feature"), x["value"].alias("value"), x["importance"].alias("importance"), x["contribution"].alias("contribution"))))

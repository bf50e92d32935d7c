"""Analytics tables derived from the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.functions import measures as m

col = F.col


def arrived(shipments: DataFrame) -> DataFrame:
    return shipments.filter(col("ActualArrivalDate").isNotNull())


def shipment_performance(shipments: DataFrame, key: str = "ShipmentKey") -> DataFrame:
    """Variance, on-time flag, delay band and satisfaction of arrived shipments."""
    v = col("DeliveryVariance")
    return (
        arrived(shipments)
        .withColumn("DeliveryVariance", m.delivery_variance(col("ActualArrivalDate"), col("PlannedArrivalDate")))
        .select(
            col(key).alias("ShipmentKey"),
            col("PlannedArrivalDate").alias("PlannedDeliveryDate"),
            col("ActualArrivalDate").alias("ActualDeliveryDate"),
            v,
            m.on_time_flag(v).alias("OnTimeDeliveryFlag"),
            m.satisfaction_score(v).alias("CustomerSatisfactionScore"),
            m.delay_reason(v).alias("DelayReason"),
        )
    )


def freight_cost(costs: DataFrame, freight_types: DataFrame) -> DataFrame:
    """Cost variance and efficiency per shipment, with the freight type looked up."""
    rows = costs.withColumnRenamed("ShipmentID", "ShipmentKey") if "ShipmentKey" not in costs.columns else costs
    variance = col("ActualFreightCost") - col("PlannedFreightCost")
    return (
        rows.join(freight_types.select("FreightTypeKey", "FreightTypeName"), "FreightTypeKey", "left")
        .withColumn("CostVariance", variance)
        .select(
            "ShipmentKey",
            "FreightTypeKey",
            "FreightTypeName",
            "PlannedFreightCost",
            "ActualFreightCost",
            "CostVariance",
            m.overrun_flag(col("CostVariance")).alias("VarianceFlag"),
            m.safe_ratio(col("ActualFreightCost"), col("PlannedFreightCost")).alias("CostEfficiencyRatio"),
        )
    )

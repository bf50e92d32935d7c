"""Daily shipment metrics and fact appends, run incrementally with Structured Streaming.

Both reuse the batch expressions; a stream adds a watermark, or a batch id, to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolith.functions.measures import on_time_flag
from cargolith.plans.kpis import rows, variance_days, zero_sum
from cargolith.sources.sinks import conform


def shipment_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """Shipment rows from a folder to which files are added."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def daily_metrics(shipments: DataFrame, lateness: str = "30 days") -> DataFrame:
    """Per shipping day: count, on-time rate and value. A day is final once the watermark
    has passed it; state is one row per open day."""
    v = variance_days()
    event = shipments.withColumn("EventTime", F.col("ShipmentDate").cast("timestamp"))
    return (
        event.withWatermark("EventTime", lateness)
        .groupBy(F.window("EventTime", "1 day").alias("Window"))
        .agg(rows().alias("Shipments"), F.avg(on_time_flag(v)).alias("OnTimeRate"), zero_sum(F.col("ShipmentValue")).alias("TotalValue"))
        .select(F.col("Window.start").alias("Day"), "Shipments", "OnTimeRate", "TotalValue")
    )


def append_facts(stream: DataFrame, path: str, checkpoint: str, schema: T.StructType):
    """Typed appends, exactly once: each micro-batch overwrites its own folder only, so a
    batch that is replayed after a failure leaves no doubles."""

    def write(batch: DataFrame, batch_id: int) -> None:
        conform(batch, schema).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

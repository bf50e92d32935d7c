"""The incremental jobs give what the batch jobs give."""

from conftest import FOLDER
from pyspark.sql import functions as F

from cargolith.plans import kpis
from cargolith.schemas import table
from cargolith.session import scratch_path
from cargolith.sources.marts import shipments
from cargolith.streaming import daily

COLUMNS = ["ShipmentID", "ShipmentDate", "PlannedArrivalDate", "ActualArrivalDate", "ShipmentValue"]
SCHEMA = table(ShipmentID="long", ShipmentDate="ts", PlannedArrivalDate="ts", ActualArrivalDate="ts", ShipmentValue="dbl")


def staged(spark):
    path = scratch_path(spark, "stream")
    shipments(spark, FOLDER, *COLUMNS).repartition(4).write.parquet(path)
    return path


def test_daily_metrics_match_the_batch(spark):
    source = daily.shipment_stream(spark, staged(spark), SCHEMA, 2)
    query = daily.daily_metrics(source, "4000 days").writeStream.outputMode("complete").format("memory").queryName("daily_out").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = {(str(r.Day)[:10], r.Shipments, round(r.TotalValue, 2)) for r in spark.table("daily_out").collect()}
    batch = shipments(spark, FOLDER, *COLUMNS, "TotalWeight", "TotalPackages")
    want = {(str(r.Day), r.Shipments, round(r.TotalValue, 2)) for r in kpis.daily_shipment_metrics(batch).collect()}
    assert got == want


def test_appended_facts_are_whole(spark):
    out, check = scratch_path(spark, "facts"), scratch_path(spark, "check")
    daily.append_facts(daily.shipment_stream(spark, staged(spark), SCHEMA, 2), out, check, SCHEMA).awaitTermination(120)
    written = spark.read.parquet(out)
    assert written.count() == shipments(spark, FOLDER, "ShipmentID").count()
    assert written.agg(F.countDistinct("batch")).first()[0] == 2

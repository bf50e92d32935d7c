"""Sources and sinks S01-S14. Sinks write below the shared checkpoint folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolith.catalog import binding as b
from cargolith.catalog import sqlops as o
from cargolith.catalog.registry import register, tidy
from cargolith.catalog.sqlbase import INV, SHIP, sql
from cargolith.catalog.warehouse import HISTORY, SPAN, fact_span, product_history, product_snapshot
from cargolith.functions.dates import date_key
from cargolith.operators import scd
from cargolith.plans import dims, facts, kpis
from cargolith.schemas import DIM_DATE, FACT_INVOICES
from cargolith.session import scratch_path
from cargolith.sources import operational as op
from cargolith.sources import sinks
from cargolith.sources.marts import invoices, shipments
from cargolith.sources.tables import TableCache, csv_exports, current_keys, limited, parquet, summary

col = F.col

register("S01_query_scan", lambda s, d: op.party(s, d).filter("IsClient = 1").select("ID", "CodeClient", "RaisonSociale", "Ville"),
    sql(o.PARTY, "SELECT ID, CodeClient, RaisonSociale, Ville FROM party WHERE IsClient = 1"))
register("S02_key_scan", lambda s, d: current_keys(product_history(s, d), "ProductID", "ProductName"),
    sql(HISTORY, "SELECT ProductID, ProductName FROM history WHERE IsCurrent"))
_LIM = ["ShipmentID", "ActualArrivalDate", "ShipmentValue", "TotalWeight"]
register("S03_limited_scan", lambda s, d: limited(shipments(s, d, *_LIM), 1000, [col(c) for c in _LIM]),
    sql(SHIP, f"SELECT {', '.join(_LIM)} FROM shipments ORDER BY {', '.join(_LIM)} LIMIT 1000"))
register("L07_sample_limit", lambda s, d: limited(invoices(s, d).select("InvoiceID", "InvoiceType", "NetAmount"), 500, [col("InvoiceID"), col("InvoiceType")]),
    sql(INV, "SELECT InvoiceID, InvoiceType, NetAmount FROM invoices ORDER BY InvoiceID, InvoiceType LIMIT 500"))


def _cached(s, d):
    cache = TableCache(lambda name, limit: parquet(s, d, name) if limit is None else parquet(s, d, name).limit(limit))
    customers = cache.get("customer")
    by_nation = customers.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("Customers"))
    by_segment = cache.get("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("Customers"))
    return by_nation.select(col("c_nationkey").cast("string").alias("Group"), "Customers").unionByName(
        by_segment.select(col("c_mktsegment").alias("Group"), "Customers"))


register("S04_cached_scan", _cached,
    """SELECT CAST(c_nationkey AS VARCHAR) AS "Group", count(*) AS Customers FROM customer GROUP BY 1
UNION ALL SELECT c_mktsegment, count(*) FROM customer GROUP BY 1""")
register("S05_calendar", lambda s, d: dims.calendar_of(fact_span(s, d)), sql(SPAN, "SELECT * FROM calendar"))


def _csv_scan(s, d):
    folder = scratch_path(s, "exports")
    sinks.csv_report(kpis.cash_flow(invoices(s, d)), f"{folder}/cash_flow.csv")
    schema = "PaymentStatus int, TotalAmount double, InvoiceCount bigint"
    found = csv_exports(s, folder, {"cash_flow.csv": schema, "absent.csv": schema})
    assert list(found) == ["cash_flow.csv"]
    return tidy(found["cash_flow.csv"], 2)


_CASH = "SELECT PaymentStatus, round(sum(NetAmount), 2) AS TotalAmount, count(InvoiceID) AS InvoiceCount FROM invoices GROUP BY PaymentStatus"
register("S06_csv_scan", _csv_scan, sql(INV, _CASH))


def _dated(s, d):
    return invoices(s, d).withColumn("DateKey", date_key(col("InvoiceDate")))


def _append(s, d):
    path = scratch_path(s, "fact_invoices")
    for kind in ("Sales", "Purchase"):
        sinks.append_fact(_dated(s, d).filter(col("InvoiceType") == kind), path, FACT_INVOICES)
    return s.read.parquet(path).drop("PartYear")


_FACT_COLUMNS = """SELECT InvoiceID, InvoiceDate, CAST(strftime(InvoiceDate, '%Y%m%d') AS INTEGER) AS DateKey, CustomerKey, SupplierKey,
  TotalAmount, TaxAmount, NetAmount, PaymentStatus, PaymentDueDate, CAST(PaymentTermKey AS BIGINT) AS PaymentTermKey, InvoiceType FROM invoices"""
register("S07_append_sink", _append, sql(INV, _FACT_COLUMNS))


def _refresh(s, d):
    path = scratch_path(s, "dim_date")
    for _ in range(2):
        sinks.refresh(dims.calendar_of(fact_span(s, d)), path, DIM_DATE)
    return s.read.parquet(path)


register("S08_full_refresh", _refresh, sql(SPAN, "SELECT * FROM calendar"))
register("K05_full_refresh", lambda s, d: _refresh(s, d).groupBy("Year").agg(F.count(F.lit(1)).alias("Days")),
    sql(SPAN, "SELECT Year, count(*) AS Days FROM calendar GROUP BY Year"))


def _chunks(s, d):
    path = scratch_path(s, "chunks")
    sinks.write_chunks(invoices(s, d), path, 5000)
    files = s.read.parquet(path).groupBy(col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("Written"), (F.max("n") <= 5000).alias("WithinChunk"))


register("S09_chunked_write", _chunks, sql(INV, "SELECT count(*) AS Written, true AS WithinChunk FROM invoices"))


def _snapshot(s, d):
    path = scratch_path(s, "dim_product")
    sinks.refresh(scd.merge_versions(product_history(s, d), product_snapshot(s, d), "ProductID", dims.PRODUCT_ATTRIBUTES, b.as_of()), path)
    return s.read.parquet(path).groupBy("IsCurrent").agg(F.count(F.lit(1)).alias("Versions"), F.countDistinct("ProductID").alias("Products"))


register("S10_snapshot_sink", _snapshot,
    sql(f"""{HISTORY}, merged AS (
  SELECT ProductID, h.IsCurrent AND NOT coalesce(ChangeType = 'changed', false) AS IsCurrent
  FROM history h LEFT JOIN (SELECT ProductID, ChangeType FROM marked) m USING (ProductID)
  UNION ALL SELECT ProductID, true FROM marked WHERE ChangeType <> 'unchanged')""",
    "SELECT IsCurrent, count(*) AS Versions, count(DISTINCT ProductID) AS Products FROM merged GROUP BY 1"))


def _csv_sink(s, d):
    path = scratch_path(s, "seasons.csv")
    sinks.csv_report(kpis.counts_by_season(shipments(s, d, "ShipmentDate"), "ShipmentDate", "Shipments"), path)
    return s.read.schema("Season string, Shipments bigint").option("header", True).csv(path)


register("S11_csv_sink", _csv_sink,
    sql(SHIP, """SELECT CASE WHEN month(ShipmentDate) IN (12, 1, 2) THEN 'Winter' WHEN month(ShipmentDate) <= 5 THEN 'Spring'
  WHEN month(ShipmentDate) <= 8 THEN 'Summer' ELSE 'Fall' END AS Season, count(*) AS Shipments FROM shipments GROUP BY 1"""))


def _json_sink(s, d):
    path = scratch_path(s, "report.json")
    sinks.json_report(tidy(kpis.executive_kpis(invoices(s, d))), path)
    return s.read.schema("UniqueCustomers bigint, Transactions bigint, AvgTransactionValue double").json(path)


register("S12_json_sink", _json_sink,
    sql(INV, "SELECT count(DISTINCT CustomerKey) AS UniqueCustomers, count(*) AS Transactions, round(avg(NetAmount), 4) AS AvgTransactionValue FROM invoices"))


def _rejects(s, d):
    folder = scratch_path(s, "rejects")
    sinks.write_rejects(facts.invoice_rejects(b.inv_tagged(s, d)), folder)
    read = s.read.option("header", True).option("nullValue", "nan")
    parts = [
        read.schema("value string").csv(f"{folder}/{name}").withColumn("Reject", F.lit(name))
        for name in ("unmatched_customers", "unmatched_suppliers", "unmatched_payment_terms")
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.groupBy("Reject").agg(F.count(F.lit(1)).alias("Values"))


register("S13_reject_sinks", _rejects,
    sql(o.INV_TAGGED, """SELECT 'unmatched_customers' AS Reject, count(DISTINCT PartyName) AS "Values" FROM inv_tagged WHERE RejectReason = 'unmatched_customer'
UNION ALL SELECT 'unmatched_suppliers', count(DISTINCT PartyName) FROM inv_tagged WHERE RejectReason = 'unmatched_supplier' HAVING count(*) > 0
UNION ALL SELECT 'unmatched_payment_terms', count(*) FROM (SELECT DISTINCT TermID FROM inv_tagged WHERE RejectReason IS NULL AND PaymentTermKey IS NULL) HAVING count(*) > 0"""))


def _ship_rejects(name):
    return lambda s, d: facts.shipment_rejects(b.ship_tagged(s, d))[name]


register("S13b_invalid_datekeys", _ship_rejects("invalid_datekeys"),
    sql(o.SHIP_TAGGED, "SELECT ShipmentID, ShipmentDate, DateKey FROM ship_tagged WHERE RejectReason = 'invalid_datekey'"))
register("S13c_duplicates_found", _ship_rejects("duplicates_found"),
    sql(o.SHIP_TAGGED, """SELECT ShipmentID, DateKey, CustomerKey, TotalWeight FROM (SELECT * FROM ship_tagged WHERE RejectReason IS NULL)
QUALIFY count(*) OVER (PARTITION BY ShipmentID) > 1"""))
register("S14_data_summary", lambda s, d: summary(shipments(s, d, "ShipmentID", "ShipmentDate", "ShipmentValue"), "shipments").unionByName(
        summary(invoices(s, d), "invoices")),
    sql(f"{SHIP}, {INV}", """SELECT 'shipments' AS TableName, count(*) AS RowCount, 3 AS ColumnCount, min(ShipmentDate) AS FirstDate, max(ShipmentDate) AS LastDate FROM shipments
UNION ALL SELECT 'invoices', count(*), 11, min(InvoiceDate), max(InvoiceDate) FROM invoices"""))

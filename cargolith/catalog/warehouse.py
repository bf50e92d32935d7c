"""Filters F, joins J, set operations U, table maintenance K, quality Q, key windows W06-W08."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolith.catalog import binding as b
from cargolith.catalog import sqlops as o
from cargolith.catalog.registry import register, tidy
from cargolith.catalog.sqlbase import INV, ON_TIME, SCORES, SHIP, VARIANCE, season, sql
from cargolith.functions import dates as dt
from cargolith.functions import measures as m
from cargolith.functions.text import fold_name
from cargolith.operators import keyed, scd
from cargolith.operators.ranking import row_numbers
from cargolith.operators.stats import attach, unfold
from cargolith.plans import customers as cust
from cargolith.plans import dims, facts, kpis, performance, quality
from cargolith.session import scratch_path, tiny
from cargolith.sources import operational as op
from cargolith.sources.marts import invoices, shipments
from cargolith.sources.tables import current_keys, parquet

col, lit, when = F.col, F.lit, F.when

# ---- filters and projections
register("F01_flag_filter", lambda s, d: dims.with_role(op.party(s, d), "IsSupplier").select("ID", "CodeSupplier", "RaisonSociale"),
    sql(o.PARTY, "SELECT ID, CodeSupplier, RaisonSociale FROM party WHERE IsSupplier = 1"))
register("F02_soft_delete", lambda s, d: facts.purchase_rows(op.purchase_source(s, d)).select("InvoiceID", "SupplierName", "TotalAmount"),
    sql(o.INVOICE_ROWS, "SELECT InvoiceID, SupplierName, TotalAmount FROM invoice_rows WHERE InvoiceType = 'Purchase'"))
register("F03_valid_id", lambda s, d: dims.valid_materials(op.materials(s, d)).select("ID", "Code", "Nom"),
    sql(o.MATERIALS, "SELECT ID, Code, Nom FROM materials WHERE Code IS NOT NULL AND trim(Code) <> ''"))
register("F04_arrived", lambda s, d: performance.arrived(b.ship_rows(s, d)).select("ShipmentID", "ActualArrivalDate", "IsDelivered"),
    sql(o.SHIP_ROWS, "SELECT ShipmentID, ActualArrivalDate, IsDelivered FROM ship_rows WHERE ActualArrivalDate IS NOT NULL"))


def _keyed_rows(s, d):
    return b.ship_rows(s, d).select("ShipmentID", "ShipmentDate", dt.date_key(col("ShipmentDate")).alias("DateKey"))


_KEYED = "keyed AS (SELECT ShipmentID, ShipmentDate, CAST(strftime(ShipmentDate, '%Y%m%d') AS INTEGER) AS DateKey FROM ship_rows)"
register("F05_valid_datekeys", lambda s, d: _keyed_rows(s, d).join(tiny(b.calendar(s).select("DateKey")), "DateKey", "left_semi"),
    sql(f"{o.SHIP_ROWS}, {_KEYED}, {o.FACT_CALENDAR}", "SELECT * FROM keyed WHERE DateKey IN (SELECT DateKey FROM calendar)"))
register("F06_resolved_only", lambda s, d: b.ship_tagged(s, d).filter("RejectReason IS NULL").groupBy("EquipmentKey", "FreightTypeKey").agg(
        F.count(lit(1)).alias("Rows"), F.sum("TotalWeight").alias("Weight")),
    sql(o.SHIP_TAGGED, """SELECT EquipmentKey, FreightTypeKey, count(*) AS "Rows", sum(TotalWeight) AS Weight
FROM ship_tagged WHERE RejectReason IS NULL GROUP BY 1, 2"""))
register("F07_product_type", lambda s, d: op.materials(s, d).select("ID", dims.product_type(col("IsServices")).alias("ProductType")),
    sql(o.MATERIALS, "SELECT ID, CASE WHEN coalesce(IsServices, 0) = 1 THEN 'Service' ELSE 'Goods' END AS ProductType FROM materials"))
register("F08_binary_maps", lambda s, d: op.party(s, d).select(
        "ID", "IsClient", dims.customer_type(col("NatureSociete")).alias("Type"), dims.customer_category(col("NatureSociete")).alias("Category"),
        dims.customer_segment(col("IsClientRegulier")).alias("Segment"), dims.is_one(col("Etat")).alias("IsActive")),
    sql(o.PARTY, """SELECT ID, IsClient, CASE NatureSociete WHEN 0 THEN 'Independant' ELSE 'Entreprise' END AS Type,
  CASE NatureSociete WHEN 0 THEN 'B2C' ELSE 'B2B' END AS Category, CASE WHEN IsClientRegulier THEN 'Regular' ELSE 'Occasional' END AS Segment,
  coalesce(Etat = 1, false) AS IsActive FROM party"""))
register("F09_delivered_flag", lambda s, d: op.dossiers(s, d).select("ID", col("DateArriveeReel").isNotNull().cast("int").alias("IsDelivered")),
    sql(o.DOSSIERS, "SELECT ID, CASE WHEN DateArriveeReel IS NOT NULL THEN 1 ELSE 0 END AS IsDelivered FROM dossiers"))
register("F10_target_columns", lambda s, d: b.ship_rows(s, d).select("ShipmentID", "ActualArrivalDate", "PlannedArrivalDate").withColumnsRenamed(
        {"PlannedArrivalDate": "PlannedDeliveryDate", "ActualArrivalDate": "ActualDeliveryDate", "ShipmentID": "ShipmentKey"}),
    sql(o.SHIP_ROWS, """SELECT ShipmentID AS ShipmentKey, PlannedArrivalDate AS PlannedDeliveryDate, ActualArrivalDate AS ActualDeliveryDate
FROM ship_rows"""))
register("F11_constant_columns", lambda s, d: b.places(s, d).select("LocationID", "LocationType", "IsActive"),
    sql(o.PLACES, "SELECT LocationID, LocationType, IsActive FROM places"))
register("F12_null_defaults", lambda s, d: b.ship_rows(s, d).na.fill(facts.SHIPMENT_DEFAULTS).select(
        "ShipmentID", "ShipmentValue", "TotalPackages", "DurationDays"),
    sql(o.SHIP_ROWS, """SELECT ShipmentID, coalesce(ShipmentValue, 0) AS ShipmentValue, coalesce(TotalPackages, 0) AS TotalPackages,
  coalesce(DurationDays, 0) AS DurationDays FROM ship_rows"""))
register("F13_corrected_net", lambda s, d: facts.purchase_rows(op.purchase_source(s, d)).select(
        "InvoiceID", facts.corrected_net(col("TotalAmount"), col("TaxAmount"), col("NetAmount")).alias("NetAmount")),
    sql(o.INVOICE_ROWS, """SELECT InvoiceID, CASE WHEN TaxAmount = 0 AND NetAmount = 0 AND TotalAmount <> 0 THEN TotalAmount ELSE NetAmount END AS NetAmount
FROM invoice_rows WHERE InvoiceType = 'Purchase'"""))
register("F14_dummy_keys", lambda s, d: b.fact_invoices(s, d).groupBy("InvoiceType").agg(
        F.sum(when(col("CustomerKey") == 0, 1).otherwise(0)).alias("DummyCustomers"),
        F.sum(when(col("SupplierKey") == 0, 1).otherwise(0)).alias("DummySuppliers"),
        F.sum(when(col("PaymentTermKey") == 0, 1).otherwise(0)).alias("DummyTerms")),
    sql(o.FACT_INVOICES, """SELECT InvoiceType, count(*) FILTER (CustomerKey = 0) AS DummyCustomers, count(*) FILTER (SupplierKey = 0) AS DummySuppliers,
  count(*) FILTER (PaymentTermKey = 0) AS DummyTerms FROM fact_invoices GROUP BY 1"""))


def _required(s, d):
    df = op.party(s, d)
    missing = quality.require(df, ["ID", "CodeClient", "RaisonSociale", "Region"])
    return df.agg(lit(",".join(missing)).alias("MissingColumns"), F.count(lit(1)).alias("RowsChecked"))


register("F15_required_columns", _required,
    sql(o.PARTY, "SELECT 'Region' AS MissingColumns, count(*) AS RowsChecked FROM party"))


def _numeric_only(s, d):
    df = invoices(s, d)
    return df.select("InvoiceID", *[c for c, t in df.dtypes if t == "double"])


register("F16_numeric_columns", _numeric_only, sql(INV, "SELECT InvoiceID, TotalAmount, TaxAmount, NetAmount FROM invoices"))

# ---- joins
register("J01_equipment_operation", lambda s, d: b.equipment_source(s, d), sql(o.EQUIPMENT, "SELECT * FROM equip_source"))
register("J02_shipment_dossier", lambda s, d: b.ship_rows(s, d).select("ShipmentID", "ShipmentDate", "PlannedArrivalDate", "DurationDays", "IsDelivered", "FreightTypeID"),
    sql(o.SHIP_ROWS, "SELECT ShipmentID, ShipmentDate, PlannedArrivalDate, DurationDays, IsDelivered, FreightTypeID FROM ship_rows"))
register("J03_invoice_calendar", lambda s, d: b.invoice_rows(s, d).join(
        tiny(b.calendar(s).select(col("Date").alias("InvoiceDate"), "DateKey")), "InvoiceDate", "left").select("InvoiceID", "InvoiceType", "DateKey"),
    sql(f"{o.INVOICE_ROWS}, {o.FACT_CALENDAR}", "SELECT InvoiceID, InvoiceType, DateKey FROM invoice_rows LEFT JOIN calendar ON InvoiceDate = Date"))
register("J04_customer_by_name", lambda s, d: keyed.lookup(
        b.ship_rows(s, d).select("ShipmentID", facts.plain_name(col("CustomerName")).alias("Name")),
        facts.one_key_per_name(b.dim_customer(s, d).select(facts.plain_name(col("CustomerName")).alias("Name"), "CustomerKey"), ["Name"], "CustomerKey"), "Name"),
    sql(f"{o.CUSTOMERS}, {o.SHIP_ROWS}", """SELECT ShipmentID, trim(lower(r.CustomerName)) AS Name, CustomerKey
FROM ship_rows r LEFT JOIN (SELECT trim(lower(CustomerName)) AS name, min(CustomerKey) AS CustomerKey FROM dim_customer GROUP BY 1) c
  ON trim(lower(r.CustomerName)) = c.name AND c.name <> 'unknown'"""))
register("J05_party_by_folded_name", lambda s, d: b.inv_tagged(s, d).select("InvoiceID", "InvoiceType", "PartyName", "PartyKey"),
    sql(o.INV_TAGGED, "SELECT InvoiceID, InvoiceType, PartyName, PartyKey FROM inv_tagged"))
register("J06_term_by_id", lambda s, d: b.inv_tagged(s, d).select("InvoiceID", "InvoiceType", "PaymentTermID", "PaymentTermKey"),
    sql(o.INV_TAGGED, "SELECT InvoiceID, InvoiceType, TermID AS PaymentTermID, PaymentTermKey FROM inv_tagged"))
register("J07_two_role_location", lambda s, d: b.ship_tagged(s, d).groupBy("OriginLocationKey", "DestinationLocationKey").agg(F.count(lit(1)).alias("Shipments")),
    sql(o.SHIP_TAGGED, "SELECT OriginLocationKey, DestinationLocationKey, count(*) AS Shipments FROM ship_tagged GROUP BY 1, 2"))
register("J08_unmatched_customers", lambda s, d: keyed.unmatched(
        b.ship_rows(s, d).select(facts.plain_name(col("CustomerName")).alias("Name")),
        b.dim_customer(s, d).select(facts.plain_name(col("CustomerName")).alias("Name")), ["Name"]),
    sql(f"{o.CUSTOMERS}, {o.SHIP_ROWS}", """SELECT DISTINCT trim(lower(CustomerName)) AS Name FROM ship_rows
WHERE trim(lower(CustomerName)) NOT IN (SELECT trim(lower(CustomerName)) FROM dim_customer)"""))
register("J09_key_in_set", lambda s, d: parquet(s, d, "orders").select("o_orderkey", "o_custkey").join(
        parquet(s, d, "customer").filter("c_acctbal > 0").select(col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi"),
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
register("J10_due_date_fill", lambda s, d: b.inv_tagged(s, d).select(
        "InvoiceID", "InvoiceType", facts.due_date(col("PaymentDueDate"), col("InvoiceDate"), col("PaymentDays")).alias("PaymentDueDate")),
    sql(o.INV_TAGGED, """SELECT InvoiceID, InvoiceType, coalesce(PaymentDueDate, InvoiceDate + to_days(coalesce(PaymentDays, 30))) AS PaymentDueDate
FROM inv_tagged"""))


def product_history(s, d):
    """An earlier state of the product dimension: some products absent, some different, some closed."""
    p = dims.products(op.materials(s, d))
    n = F.substring("ProductID", 2, 20).cast("int")
    base = scd.first_stamp(p.filter(n % 10 != 9), dt.instant("2004-01-01")).drop("LastModifiedOnDate")
    current = base.withColumn("ProductName", when(n % 4 == 0, F.concat(lit("Old "), col("ProductName"))).otherwise(col("ProductName"))).withColumn(
        "ProductCategory", when(n % 6 != 0, col("ProductCategory")))
    closed = base.filter(n % 8 == 0).withColumns(
        {"EffectiveDate": dt.instant("2001-01-01"), "ExpiryDate": dt.instant("2004-01-01"), "IsCurrent": lit(False)})
    return current.unionByName(closed)


def product_snapshot(s, d):
    return dims.products(op.materials(s, d)).withColumnRenamed("LastModifiedOnDate", "EffectiveDate")


_N = "CAST(substr(ProductID, 2) AS INTEGER)"
_PCOLS = "ProductID, ProductName, ProductCategory, ProductType, IsStockable, IsActiveForSale, IsActiveForPurchase, IsActive"
_REST = "ProductType, IsStockable, IsActiveForSale, IsActiveForPurchase, IsActive"
HISTORY = f"""{o.PRODUCTS},
history AS (
  SELECT ProductID, CASE WHEN {_N} % 4 = 0 THEN 'Old ' || ProductName ELSE ProductName END AS ProductName,
    CASE WHEN {_N} % 6 <> 0 THEN ProductCategory END AS ProductCategory, {_REST}, TIMESTAMP '2004-01-01' AS EffectiveDate,
    TIMESTAMP '2099-12-31' AS ExpiryDate, true AS IsCurrent FROM dim_product WHERE {_N} % 10 <> 9
  UNION ALL
  SELECT {_PCOLS}, TIMESTAMP '2001-01-01', TIMESTAMP '2004-01-01', false FROM dim_product WHERE {_N} % 10 <> 9 AND {_N} % 8 = 0),
marked AS (
  SELECT n.*, CASE WHEN h.ProductID IS NULL THEN 'new'
    WHEN n.ProductName IS DISTINCT FROM h.ProductName OR n.ProductCategory IS DISTINCT FROM h.ProductCategory THEN 'changed'
    ELSE 'unchanged' END AS ChangeType
  FROM dim_product n LEFT JOIN (SELECT * FROM history WHERE IsCurrent) h USING (ProductID))"""
register("J11_match_indicator", lambda s, d: scd.classify(
        product_history(s, d).filter("IsCurrent"), product_snapshot(s, d), "ProductID", dims.PRODUCT_ATTRIBUTES).select("ProductID", "ChangeType"),
    sql(HISTORY, "SELECT ProductID, ChangeType FROM marked"))
COSTS = """costs AS (SELECT l_orderkey * 10 + l_linenumber AS ShipmentKey, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS FreightTypeKey,
  CASE WHEN l_linenumber <> 7 THEN l_quantity * 1000 ELSE 0 END AS PlannedFreightCost, l_extendedprice AS ActualFreightCost FROM lineitem)"""


def costs(s, d):
    """Planned cost by weight, actual cost by value."""
    flag = col("l_returnflag")
    return parquet(s, d, "lineitem").select(
        (col("l_orderkey") * 10 + col("l_linenumber")).alias("ShipmentKey"),
        when(flag == "R", 1).when(flag == "A", 2).otherwise(3).alias("FreightTypeKey"),
        when(col("l_linenumber") != 7, col("l_quantity") * 1000).otherwise(0.0).alias("PlannedFreightCost"),
        col("l_extendedprice").alias("ActualFreightCost"))


def freight_cost(s, d):
    return performance.freight_cost(costs(s, d), dim_freight_by_id(s, d))


def dim_freight_by_id(s, d):
    return dims.freight_types(op.freight_types(s, d)).withColumn("FreightTypeKey", col("FreightTypeID").cast("int"))


FREIGHT_COST = f"""{COSTS}, {o.FREIGHT},
freight_cost AS (
  SELECT ShipmentKey, c.FreightTypeKey, FreightTypeName, PlannedFreightCost, ActualFreightCost, ActualFreightCost - PlannedFreightCost AS CostVariance,
    CASE WHEN ActualFreightCost - PlannedFreightCost > 0 THEN 1 ELSE 0 END AS VarianceFlag,
    CASE WHEN PlannedFreightCost <> 0 THEN ActualFreightCost / PlannedFreightCost END AS CostEfficiencyRatio
  FROM costs c LEFT JOIN dim_freight f ON c.FreightTypeKey = CAST(f.FreightTypeID AS INTEGER))"""
register("J12_freight_cost", lambda s, d: tidy(freight_cost(s, d), 10),
    sql(FREIGHT_COST, """SELECT ShipmentKey, FreightTypeKey, FreightTypeName, round(PlannedFreightCost, 10) AS PlannedFreightCost,
  round(ActualFreightCost, 10) AS ActualFreightCost, round(CostVariance, 10) AS CostVariance, VarianceFlag,
  round(CostEfficiencyRatio, 10) AS CostEfficiencyRatio FROM freight_cost"""))
register("J13_season_full_outer", lambda s, d: kpis.counts_by_season(shipments(s, d, "ShipmentDate"), "ShipmentDate", "Shipments").join(
        kpis.counts_by_season(invoices(s, d), "InvoiceDate", "Invoices"), "Season", "full_outer"),
    sql(f"{SHIP}, {INV}", f"""SELECT Season, Shipments, Invoices FROM (SELECT {season('ShipmentDate')} AS Season, count(*) AS Shipments FROM shipments GROUP BY 1) a
FULL JOIN (SELECT {season('InvoiceDate')} AS Season, count(*) AS Invoices FROM invoices GROUP BY 1) b USING (Season)"""))
register("J14_daily_inner_join", lambda s, d: tidy(kpis.profit_by_demand(shipments(s, d, "ShipmentDate"), invoices(s, d)), 2),
    sql(f"{SHIP}, {INV}", """SELECT ShipmentDate, Shipments, InvoiceDate, round(Net, 2) AS NetAmount
FROM (SELECT ShipmentDate, count(*) AS Shipments FROM shipments GROUP BY 1) a
JOIN (SELECT InvoiceDate, sum(NetAmount) AS Net FROM invoices GROUP BY 1) b ON ShipmentDate = InvoiceDate"""))
register("J15_one_pass_aggregates", lambda s, d: tidy(invoices(s, d).groupBy("CustomerKey").agg(
        F.min("InvoiceDate").alias("First"), F.max("InvoiceDate").alias("Last"), F.count("InvoiceID").alias("Invoices"), F.sum("NetAmount").alias("Net")), 2),
    sql(INV, """SELECT CustomerKey, min(InvoiceDate) AS First, max(InvoiceDate) AS Last, count(InvoiceID) AS Invoices, round(sum(NetAmount), 2) AS Net
FROM invoices GROUP BY 1"""))


def _scored(s, d):
    return cust.segments(cust.rfm_scores(cust.rfm_base(invoices(s, d), b.as_of())))


register("J16_customer_segment", lambda s, d: tidy(cust.with_segment(kpis.customer_analytics(invoices(s, d)), _scored(s, d)), 6, TotalRevenue=2),
    sql(f"{INV}, {SCORES}", """SELECT CustomerKey, TotalInvoices, round(TotalRevenue, 2) AS TotalRevenue, round(AvgInvoiceValue, 6) AS AvgInvoiceValue, Segment
FROM (SELECT CustomerKey, count(InvoiceID) AS TotalInvoices, sum(NetAmount) AS TotalRevenue, avg(NetAmount) AS AvgInvoiceValue FROM invoices GROUP BY 1)
LEFT JOIN (SELECT CustomerKey, Segment FROM scores) USING (CustomerKey)"""))


def _profit_demand(s, d):
    days = kpis.profit_by_demand(shipments(s, d, "ShipmentDate"), invoices(s, d)).select("ShipmentDate", "Shipments", "NetAmount")
    return attach(days, kpis.profit_demand_correlation(shipments(s, d, "ShipmentDate"), invoices(s, d)).select("Correlation"))


register("J17_attached_scalar", lambda s, d: tidy(_profit_demand(s, d), 6, NetAmount=2),
    sql(f"{SHIP}, {INV}, " + """days AS (SELECT ShipmentDate, Shipments, Net FROM (SELECT ShipmentDate, count(*) AS Shipments FROM shipments GROUP BY 1) a
  JOIN (SELECT InvoiceDate, sum(NetAmount) AS Net FROM invoices GROUP BY 1) b ON ShipmentDate = InvoiceDate)""",
    "SELECT ShipmentDate, Shipments, round(Net, 2) AS NetAmount, (SELECT round(corr(Shipments, Net), 6) FROM days) AS Correlation FROM days"))

# ---- set operations
register("U01_union_distinct_places", lambda s, d: b.places(s, d), sql(o.PLACES, "SELECT * FROM places"))
register("U02_concat_invoices", lambda s, d: b.invoice_rows(s, d),
    sql(o.INVOICE_ROWS, "SELECT * FROM invoice_rows"))


def _split_union(s, d):
    rows = b.invoice_rows(s, d)
    sales = rows.filter("InvoiceType = 'Sales'").select("InvoiceID", "InvoiceType", fold_name(col("CustomerName")).alias("CustomerName_norm"))
    bought = rows.filter("InvoiceType = 'Purchase'").select("InvoiceID", "InvoiceType", fold_name(col("SupplierName")).alias("SupplierName_norm"))
    return sales.unionByName(bought, allowMissingColumns=True)


register("U03_reunion_of_branches", _split_union,
    sql(o.INVOICE_ROWS, f"SELECT InvoiceID, InvoiceType, {o.fold('CustomerName')} AS CustomerName_norm, {o.fold('SupplierName')} AS SupplierName_norm FROM invoice_rows"))
register("U05_distinct", lambda s, d: op.party(s, d).select("Ville", "NatureSociete").distinct(),
    sql(o.PARTY, "SELECT DISTINCT Ville, NatureSociete FROM party"))


def _column_sets(s, d):
    df, wanted = invoices(s, d), ["NetAmount", "TaxAmount", "TaxRate"]
    missing, extra = sorted(set(wanted) - set(df.columns)), sorted(set(df.columns) - set(wanted))
    return df.agg(lit(",".join(missing)).alias("Missing"), lit(",".join(extra)).alias("Extra"), F.count(lit(1)).alias("RowsChecked"))


register("U06_column_sets", _column_sets,
    sql(INV, """SELECT 'TaxRate' AS Missing,
  'CustomerKey,InvoiceDate,InvoiceID,InvoiceType,PaymentDueDate,PaymentStatus,PaymentTermKey,SupplierKey,TotalAmount' AS Extra,
  count(*) AS RowsChecked FROM invoices"""))

# ---- table maintenance
register("K01_surrogate_keys", lambda s, d: b.dim_customer(s, d).select("CustomerKey", "CustomerID", "CustomerName"),
    sql(o.CUSTOMERS, "SELECT CustomerKey, CustomerID, CustomerName FROM dim_customer"))


def _grown_keys(s, d):
    """Keys of an older dimension stay, new suppliers continue after the maximum."""
    rows = dims.suppliers(op.party(s, d)).select("SupplierID")
    held = assign_old(rows)
    return scd.assign_keys(rows, "SupplierID", "SupplierKey", held)


def assign_old(rows):
    old = rows.filter(F.crc32(col("SupplierID")) % 2 == 0)
    return scd.assign_keys(old, "SupplierID", "SupplierKey")


register("K01b_keys_after_maximum", lambda s, d: _grown_keys(s, d).agg(
        F.count(lit(1)).alias("Keys"), F.countDistinct("SupplierKey").alias("Distinct"), F.max("SupplierKey").alias("Top")),
    sql(f"{o.PARTY}, {o.SUPPLIERS}", 'SELECT count(*) AS Keys, count(*) AS "Distinct", count(*) AS Top FROM dim_supplier'))
register("K02_scd2_merge", lambda s, d: scd.merge_versions(
        product_history(s, d), product_snapshot(s, d), "ProductID", dims.PRODUCT_ATTRIBUTES, b.as_of()),
    sql(HISTORY, f"""
SELECT h.* REPLACE (CASE WHEN h.IsCurrent AND ChangeType = 'changed' THEN TIMESTAMP '2002-01-01' ELSE h.ExpiryDate END AS ExpiryDate,
    h.IsCurrent AND NOT coalesce(ChangeType = 'changed', false) AS IsCurrent)
FROM history h LEFT JOIN (SELECT ProductID, ChangeType FROM marked) m USING (ProductID)
UNION ALL
SELECT {_PCOLS}, LastModifiedOnDate, TIMESTAMP '2099-12-31', true FROM marked WHERE ChangeType <> 'unchanged'"""))
register("K03_global_row_number", lambda s, d: row_numbers(
        parquet(s, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]),
    "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS RowNumber FROM orders")
register("K04_first_stamp", lambda s, d: scd.first_stamp(
        dims.locations(b.places(s, d)), dt.effective_date(col("CreatedOnDate"), default=dt.NEUTRAL_DEFAULT)).drop("CreatedOnDate"),
    sql(o.LOCATIONS, """SELECT LocationID, LocationName, LocationType, IsActive, coalesce(CreatedOnDate, TIMESTAMP '1900-01-01') AS EffectiveDate,
  TIMESTAMP '2099-12-31' AS ExpiryDate, true AS IsCurrent FROM dim_location0"""))
register("K06_expired_by_key", lambda s, d: scd.merge_versions(
        product_history(s, d), product_snapshot(s, d), "ProductID", dims.PRODUCT_ATTRIBUTES, b.as_of()).filter(
        ~col("IsCurrent") & (col("ExpiryDate") == b.as_of())).select("ProductID", "ProductName", "ExpiryDate"),
    sql(HISTORY, """SELECT ProductID, h.ProductName, TIMESTAMP '2002-01-01' AS ExpiryDate FROM history h JOIN marked m USING (ProductID)
WHERE h.IsCurrent AND ChangeType = 'changed'"""))

# ---- whole dimensions and facts
register("K00_dim_customer", lambda s, d: b.dim_customer(s, d), sql(o.CUSTOMERS, "SELECT * FROM dim_customer"))
register("K00_dim_supplier", lambda s, d: b.dim_supplier(s, d), sql(f"{o.PARTY}, {o.SUPPLIERS}", "SELECT * FROM dim_supplier"))
register("K00_dim_product", lambda s, d: dims.products(op.materials(s, d)), sql(o.PRODUCTS, "SELECT * FROM dim_product"))
register("K00_dim_location", lambda s, d: b.dim_location(s, d), sql(o.LOCATIONS, "SELECT * FROM dim_location"))
register("K00_dim_equipment", lambda s, d: b.dim_equipment(s, d), sql(o.EQUIPMENT, "SELECT * FROM dim_equipment"))
register("K00_dim_freight_type", lambda s, d: b.dim_freight(s, d), sql(o.FREIGHT, "SELECT * FROM dim_freight"))
register("K00_dim_payment_term", lambda s, d: b.dim_term(s, d), sql(o.TERMS, "SELECT * FROM dim_term"))
register("K00_fact_shipments", lambda s, d: b.fact_shipments(s, d), sql(o.FACT_SHIPMENTS, "SELECT * FROM fact_shipments"))
register("K00_fact_invoices", lambda s, d: b.fact_invoices(s, d), sql(o.FACT_INVOICES, "SELECT * FROM fact_invoices"))
PERF = f"""{SHIP},
performance AS (
  SELECT ShipmentID AS ShipmentKey, PlannedArrivalDate AS PlannedDeliveryDate, ActualArrivalDate AS ActualDeliveryDate, v AS DeliveryVariance,
    CASE WHEN v <= 0 THEN 1 ELSE 0 END AS OnTimeDeliveryFlag,
    CASE WHEN v IS NULL THEN 3 WHEN v <= -1 THEN 5 WHEN v <= 0 THEN 4 WHEN v <= 3 THEN 3 WHEN v <= 7 THEN 2 ELSE 1 END AS CustomerSatisfactionScore,
    CASE WHEN v <= 0 OR v IS NULL THEN NULL WHEN v <= 7 THEN 'Late Delivery' WHEN v <= 30 THEN 'Significantly Delayed' ELSE 'Severely Delayed' END AS DelayReason
  FROM (SELECT *, {VARIANCE} AS v FROM shipments WHERE ActualArrivalDate IS NOT NULL))"""


def shipment_performance(s, d):
    return performance.shipment_performance(shipments(s, d, "ShipmentID", "PlannedArrivalDate", "ActualArrivalDate"), "ShipmentID")


register("K00_shipment_performance", shipment_performance, sql(PERF, "SELECT * FROM performance"))

# ---- windows over keys
register("W06_latest_per_key", lambda s, d: keyed.first_per_key(
        parquet(s, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), ["o_custkey"],
        [col("o_orderdate").desc(), col("o_orderkey").desc()]),
    """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
register("W07_keep_first", lambda s, d: keyed.first_per_key(
        parquet(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"),
        ["l_orderkey", "l_linenumber"], [col(c) for c in b.TIE]),
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""")
register("W08_duplicate_members", lambda s, d: keyed.duplicate_members(shipments(s, d, "ShipmentID", "TotalWeight", "ShipmentValue"), ["ShipmentID"]),
    sql(SHIP, "SELECT ShipmentID, TotalWeight, ShipmentValue FROM shipments QUALIFY count(*) OVER (PARTITION BY ShipmentID) > 1"))

# ---- quality
def rules_sql(table: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{name}' AS rule, '{severity}' AS severity, CAST({measure} AS BIGINT) AS failing_rows FROM {source}"
        for name, severity, measure in rules
    )


def nul(c: str, severity: str = "error"):
    return (f"null_{c}", severity, f"count(*) - count({c})")


def dup(c: str, severity: str = "error"):
    return (f"duplicate_{c}", severity, f"count(*) - count(DISTINCT {c}) - max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)")


def bad(name: str, severity: str, test: str):
    return (name, severity, f"count(*) FILTER ({test})")


register("Q01_product", lambda s, d: quality.product(dims.products(op.materials(s, d))),
    sql(o.PRODUCTS, rules_sql("DimProduct", "dim_product", [nul("ProductID"), bad("empty_ProductName", "error", "trim(ProductName) = ''"), dup("ProductID")])))
_RAWCUST = "rawc AS (SELECT upper(trim(CodeClient)) AS CustomerID, RaisonSociale AS CustomerName, ID_Pays AS CustomerCountry FROM party WHERE IsClient = 1)"
register("Q02_customer", lambda s, d: quality.customer(dims.with_role(op.party(s, d), "IsClient").select(
        F.upper(F.trim("CodeClient")).alias("CustomerID"), col("RaisonSociale").alias("CustomerName"), col("ID_Pays").alias("CustomerCountry"))),
    sql(f"{o.PARTY}, {_RAWCUST}", rules_sql("DimCustomer", "rawc", [nul("CustomerID"), nul("CustomerName"), nul("CustomerCountry"), dup("CustomerID", "warning")])))
_RAWSUPP = "raws AS (SELECT upper(trim(CodeSupplier)) AS SupplierID, RaisonSociale AS SupplierName, ID_Pays AS SupplierCountry FROM party WHERE IsSupplier = 1)"
register("Q03_supplier", lambda s, d: quality.supplier(dims.with_role(op.party(s, d), "IsSupplier").select(
        F.upper(F.trim("CodeSupplier")).alias("SupplierID"), col("RaisonSociale").alias("SupplierName"), col("ID_Pays").alias("SupplierCountry"))),
    sql(f"{o.PARTY}, {_RAWSUPP}", rules_sql("DimSupplier", "raws", [nul("SupplierID"), nul("SupplierName"), nul("SupplierCountry"), dup("SupplierID", "warning")])))
register("Q04_location", lambda s, d: quality.location(dims.locations(b.places(s, d))),
    sql(o.LOCATIONS, rules_sql("DimLocation", "dim_location0", [nul("LocationID"), nul("LocationName"), nul("LocationType"), dup("LocationID", "warning")])))
register("Q05_equipment", lambda s, d: quality.equipment(dims.equipment(b.equipment_source(s, d)).withColumnRenamed("LastModifiedOnDate", "EffectiveDate")),
    sql(f"{o.EQUIPMENT}, eq AS (SELECT *, LastModifiedOnDate AS EffectiveDate FROM dim_equipment0)", rules_sql("DimEquipment", "eq", [
        nul("EquipmentID"), dup("EquipmentID", "warning"), nul("EffectiveDate", "warning"),
        bad("unknown_EquipmentType", "warning", "EquipmentType NOT IN ('Camion', 'Tracteur', 'Remorque', 'Semi-remorque', 'Unknown')")])))
register("Q05b_unknown_equipment_types", lambda s, d: quality.unknown_equipment_types(dims.equipment(b.equipment_source(s, d))),
    sql(o.EQUIPMENT, "SELECT DISTINCT EquipmentType FROM dim_equipment0 WHERE EquipmentType NOT IN ('Camion', 'Tracteur', 'Remorque', 'Semi-remorque', 'Unknown')"))
register("Q06_freight_type", lambda s, d: quality.freight_type(dims.freight_types(op.freight_types(s, d))),
    sql(o.FREIGHT, rules_sql("DimFreightType", "dim_freight0", [nul("FreightTypeID"), dup("FreightTypeID", "warning")])))
register("Q07_payment_term", lambda s, d: quality.payment_term(dims.payment_terms(op.payment_terms(s, d))),
    sql(o.TERMS, rules_sql("DimPaymentTerm", "dim_term0", [dup("PaymentTermID")])))


def fact_span(s, d):
    return parquet(s, d, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))


SPAN = o.calendar("(SELECT CAST(min(o_orderdate) AS DATE) FROM orders)", "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)")
register("Q08_calendar", lambda s, d: quality.calendar(dims.calendar_of(fact_span(s, d))),
    sql(SPAN, rules_sql("DimDate", "calendar", [("empty_table", "error", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"), dup("DateKey"), nul("Date")])))
_FS = ["ShipmentID", "DateKey", "CustomerKey", "EquipmentKey", "FreightTypeKey", "OriginLocationKey", "DestinationLocationKey", "ShipmentDate",
       "PlannedArrivalDate", "ActualDepartureDate", "ActualArrivalDate", "TotalWeight", "TotalVolume", "TotalPackages", "ShipmentValue",
       "IsDelivered", "DurationDays"]
register("Q09_fact_shipment", lambda s, d: quality.fact_shipment(b.ship_tagged(s, d), _FS),
    sql(o.SHIP_TAGGED, rules_sql("FactShipments", "ship_tagged", [*[nul(c, "warning") for c in _FS], dup("ShipmentID")])))
_FI = ["InvoiceID", "InvoiceDate", "CustomerKey", "SupplierKey", "TotalAmount", "TaxAmount", "NetAmount", "PaymentStatus", "PaymentDueDate",
       "PaymentTermKey", "InvoiceType"]
register("Q10_fact_invoice", lambda s, d: quality.fact_invoice(invoices(s, d)),
    sql(INV, rules_sql("FactInvoices", "invoices", [*[nul(c, "warning") for c in _FI], dup("InvoiceID", "warning"),
        bad("status_not_integer", "report", "PaymentStatus IS NULL"), bad("sales_with_supplier", "report", "InvoiceType = 'Sales' AND SupplierKey <> 0"),
        bad("purchase_with_customer", "report", "InvoiceType = 'Purchase' AND CustomerKey <> 0")])))
_PERF_RULES = [nul("ShipmentKey"), nul("PlannedDeliveryDate", "warning"), nul("ActualDeliveryDate", "warning"), nul("DeliveryVariance", "warning"),
    dup("ShipmentKey"), bad("variance_over_365", "warning", "abs(DeliveryVariance) > 365"),
    bad("flag_not_0_1", "error", "OnTimeDeliveryFlag NOT IN (0, 1)"), bad("score_not_1_5", "error", "CustomerSatisfactionScore NOT BETWEEN 1 AND 5")]
register("Q11_shipment_performance", lambda s, d: quality.shipment_performance(shipment_performance(s, d)),
    sql(PERF, rules_sql("ShipmentPerformanceMetrics", "performance", _PERF_RULES)))
register("Q11b_pass_fail", lambda s, d: quality.passed(quality.shipment_performance(shipment_performance(s, d))),
    sql(f"{PERF}, report AS ({rules_sql('ShipmentPerformanceMetrics', 'performance', _PERF_RULES)})", """
SELECT "table", count(*) FILTER (severity = 'error' AND failing_rows > 0) = 0 AS passed,
  count(*) FILTER (severity = 'warning' AND failing_rows > 0) AS warnings FROM report GROUP BY 1"""))
_FC = ["ShipmentKey", "FreightTypeKey", "FreightTypeName", "PlannedFreightCost", "ActualFreightCost", "CostVariance", "VarianceFlag", "CostEfficiencyRatio"]
register("Q12_freight_cost", lambda s, d: quality.freight_cost(freight_cost(s, d)),
    sql(FREIGHT_COST, rules_sql("FreightCostAnalysis", "freight_cost", [*[nul(c, "warning") for c in _FC],
        bad("negative_cost", "warning", "PlannedFreightCost < 0 OR ActualFreightCost < 0"), bad("negative_ratio", "warning", "CostEfficiencyRatio < 0")])))
_PI = ["TotalWeight", "ShipmentValue", "FreightTypeID", "RouteLength", "TotalPackages"]
register("Q13_prediction_input", lambda s, d: quality.prediction_input(b.ship_rows(s, d), _PI),
    sql(o.SHIP_ROWS, rules_sql("PredictionInput", "ship_rows", [nul("TotalWeight", "warning"), bad("negative_TotalWeight", "warning", "TotalWeight < 0"),
        nul("ShipmentValue", "warning"), bad("negative_ShipmentValue", "warning", "ShipmentValue < 0"), ("non_numeric_FreightTypeID", "warning", "count(*)"),
        nul("FreightTypeID", "warning"), ("missing_RouteLength", "warning", "count(*)"), nul("TotalPackages", "warning")])))


def _worded(s, d):
    """Invoices as a source may send them: every seventh status a word, every fiftieth invoice twice."""
    rows = invoices(s, d).select("InvoiceID", "InvoiceType", F.when(col("InvoiceID") % 7 == 0, "open").otherwise(col("PaymentStatus").cast("string")).alias("PaymentStatus"))
    return rows.unionByName(rows.filter(col("InvoiceID") % 50 == 0))


_WORDED = """w0 AS (SELECT InvoiceID, InvoiceType, CASE WHEN InvoiceID % 7 = 0 THEN 'open' ELSE PaymentStatus::VARCHAR END AS PaymentStatus FROM invoices),
worded AS (SELECT * FROM w0 UNION ALL SELECT * FROM w0 WHERE InvoiceID % 50 = 0)"""
register("Q10b_repaired_status", lambda s, d: quality.repair_invoice_status(_worded(s, d)).groupBy("InvoiceType", "PaymentStatus").agg(F.count(lit(1)).alias("n")),
    sql(f"{INV}, {_WORDED}", "SELECT InvoiceType, coalesce(try_cast(PaymentStatus AS INTEGER), 0) AS PaymentStatus, count(*) AS n FROM worded GROUP BY 1, 2"))
register("Q10c_duplicate_rejects", lambda s, d: quality.duplicate_invoices(_worded(s, d)),
    sql(f"{INV}, {_WORDED}", "SELECT InvoiceID, InvoiceType, PaymentStatus FROM worded WHERE InvoiceID IN (SELECT InvoiceID FROM worded GROUP BY 1 HAVING count(*) > 1)"))


def _gate(s, d):
    """Loads behind their quality rules: which ones were stopped, and how many rows the others wrote."""
    products = dims.products(op.materials(s, d))
    raw = dims.with_role(op.party(s, d), "IsClient").select(
        F.upper(F.trim("CodeClient")).alias("CustomerID"), col("RaisonSociale").alias("CustomerName"), col("ID_Pays").alias("CustomerCountry"))
    out = []
    for name, df, report in (("DimProduct", products, quality.product(products)), ("DimCustomer", raw, quality.customer(raw))):
        path = scratch_path(s, "gated")
        try:
            quality.gated_load(df, report, path)
            out.append((name, True, s.read.parquet(path).count()))
        except ValueError:
            out.append((name, False, 0))
    return s.createDataFrame(out, "table string, loaded boolean, rows long")


_GATED = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", x.ok AS loaded, CASE WHEN x.ok THEN (SELECT count(*) FROM {src}) ELSE 0 END AS "rows" FROM (SELECT count(*) FILTER (severity = 'error' AND failing_rows > 0) = 0 AS ok FROM ({rules_sql(t, src, rules)})) x"""
    for t, src, rules in (
        ("DimProduct", "dim_product", [nul("ProductID"), bad("empty_ProductName", "error", "trim(ProductName) = ''"), dup("ProductID")]),
        ("DimCustomer", "rawc", [nul("CustomerID"), nul("CustomerName"), nul("CustomerCountry"), dup("CustomerID", "warning")])))
register("Q14_gated_load", _gate, sql(f"{o.PRODUCTS}, {o.PARTY}, {_RAWCUST}", _GATED))

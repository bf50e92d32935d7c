"""Shipment and invoice facts. Each build is one lazy plan that tags every source row
with the first rule it breaks; the fact and the reject outputs are filters of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.functions import dates as dt
from cargolith.functions.measures import payment_code
from cargolith.functions.text import fold_name
from cargolith.operators.keyed import duplicate_members, first_per_key
from cargolith.session import stash, tiny

col, when, lit = F.col, F.when, F.lit

SHIPMENT_DEFAULTS = {
    "ShipmentValue": 0.0, "TotalVolume": 0.0, "TotalWeight": 0.0, "TotalPackages": 0, "IsDelivered": 0, "DurationDays": 0,
}


def plain_name(c: Column) -> Column:
    return F.trim(F.lower(c))


def one_key_per_name(parties: DataFrame, name: Sequence[str], key: str) -> DataFrame:
    """The smallest key of each name, so that a look-up never multiplies rows. The last column of ``name``
    is the name itself; "unknown" stands for a missing name and matches nothing."""
    return parties.filter(col(name[-1]) != "unknown").groupBy(*name).agg(F.min(key).alias(key))


def shipment_rows(lines: DataFrame, dossiers: DataFrame, as_of: Column, extra: Sequence[str] = ()) -> DataFrame:
    """Source query: shipment lines with their dossier (left join), delivered flag, duration."""
    d = dossiers.withColumnRenamed("ID", "ID_Dossier")
    return lines.filter(col("ID").isNotNull()).join(d, "ID_Dossier", "left").select(
        col("ID").alias("ShipmentID"),
        F.coalesce("DateDepart", as_of).alias("ShipmentDate"),
        col("DateArrivee").alias("PlannedArrivalDate"),
        col("DateDepartReel").alias("ActualDepartureDate"),
        col("DateArriveeReel").alias("ActualArrivalDate"),
        col("Poids").alias("TotalWeight"),
        col("Volume").alias("TotalVolume"),
        col("nbColis").alias("TotalPackages"),
        col("ValMarchandise").alias("ShipmentValue"),
        F.coalesce(col("Client"), lit("")).alias("CustomerName"),
        col("ID_LieuChargement").cast("string").alias("OriginLocationID"),
        col("ID_LieuLivraison").cast("string").alias("DestinationLocationID"),
        col("ID_Equipement").cast("string").alias("EquipmentID"),
        col("ID_Freight").cast("string").alias("FreightTypeID"),
        col("DateArriveeReel").isNotNull().cast("int").alias("IsDelivered"),
        dt.midnights(col("DateArriveeReel"), col("DateDepart")).alias("DurationDays"),
        *extra,
    )


def tag_shipments(
    rows: DataFrame, calendar: DataFrame, customers: DataFrame, equipment: DataFrame, freight: DataFrame, locations: DataFrame
) -> DataFrame:
    """Resolves all keys by left joins and names the first failing rule in ``RejectReason``."""
    days = tiny(calendar.select("DateKey", lit(True).alias("__day")))
    names = one_key_per_name(
        customers.select(plain_name(col("CustomerName")).alias("CustomerName"), "CustomerKey"), ["CustomerName"], "CustomerKey"
    )

    def place(role: str) -> DataFrame:
        return locations.select(col("LocationID").alias(f"{role}LocationID"), col("LocationKey").alias(f"{role}LocationKey"))

    joined = (
        rows.withColumn("DateKey", dt.date_key(col("ShipmentDate")))
        .withColumn("CustomerName", plain_name(col("CustomerName")))
        .join(days, "DateKey", "left")
        .join(names, "CustomerName", "left")
        .join(equipment.select("EquipmentID", "EquipmentKey"), "EquipmentID", "left")
        .join(freight.select("FreightTypeID", "FreightTypeKey"), "FreightTypeID", "left")
        .join(place("Origin"), "OriginLocationID", "left")
        .join(place("Destination"), "DestinationLocationID", "left")
    )
    reason = (
        when(col("__day").isNull(), "invalid_datekey")
        .when(col("CustomerKey").isNull(), "unmatched_customer")
        .when(col("EquipmentKey").isNull(), "unmatched_equipment")
        .when(col("FreightTypeKey").isNull(), "unmatched_freight_type")
        .when(col("OriginLocationKey").isNull() | col("DestinationLocationKey").isNull(), "unmatched_location")
    )
    return joined.withColumn("RejectReason", reason).drop("__day")


def fact_shipments(tagged: DataFrame, tie_break: Sequence[Column]) -> DataFrame:
    kept = first_per_key(tagged.filter(col("RejectReason").isNull()), ["ShipmentID"], tie_break)
    return kept.na.fill(SHIPMENT_DEFAULTS).select(
        "ShipmentID", "DateKey", "CustomerKey", "EquipmentKey", "FreightTypeKey", "OriginLocationKey",
        "DestinationLocationKey", "ShipmentDate", "PlannedArrivalDate", "ActualDepartureDate", "ActualArrivalDate",
        "TotalWeight", "TotalVolume", "TotalPackages", "ShipmentValue", "DurationDays", "IsDelivered",
    )


def shipment_rejects(tagged: DataFrame) -> dict[str, DataFrame]:
    def failing(reason: str) -> DataFrame:
        return tagged.filter(col("RejectReason") == reason)

    return {
        "invalid_datekeys": failing("invalid_datekey").select("ShipmentID", "ShipmentDate", "DateKey"),
        "unmatched_customers": failing("unmatched_customer").select("CustomerName").distinct(),
        "duplicates_found": duplicate_members(
            tagged.filter(col("RejectReason").isNull()).select("ShipmentID", "DateKey", "CustomerKey", "TotalWeight"), ["ShipmentID"]
        ),
    }


def purchase_rows(source: DataFrame) -> DataFrame:
    """Purchase invoices that are not marked as deleted."""
    return source.filter(F.coalesce("IsDeleted", lit(0)) == 0).select(
        col("ID").alias("InvoiceID"), "InvoiceDate", col("Supplier").alias("SupplierName"), col("TotalTTCAmount").alias("TotalAmount"),
        col("TotalTaxAmount").alias("TaxAmount"), col("TotalNetAmount").alias("NetAmount"), col("Statut").alias("PaymentStatus"),
        col("DueDate").alias("PaymentDueDate"), col("ID_PaymentTerms").alias("PaymentTermID"), lit("Purchase").alias("InvoiceType"),
    )


def sales_rows(source: DataFrame) -> DataFrame:
    """Sales invoices; their net amount is the gross total, as in the source query."""
    return source.filter(col("ID").isNotNull()).select(
        col("ID").alias("InvoiceID"), col("DateFacture").alias("InvoiceDate"), col("RaisonSociale").alias("CustomerName"),
        col("TotalTTC").alias("TotalAmount"), col("TotalTVA").alias("TaxAmount"), col("TotalTTC").alias("NetAmount"),
        col("ID_STATUS").alias("PaymentStatus"), col("EcheanceDate").alias("PaymentDueDate"), col("ID_NATURE").alias("PaymentTermID"),
        lit("Sales").alias("InvoiceType"),
    )


def invoice_rows(purchases: DataFrame, sales: DataFrame) -> DataFrame:
    return purchase_rows(purchases).unionByName(sales_rows(sales), allowMissingColumns=True)


def tag_invoices(
    rows: DataFrame, calendar: DataFrame, customers: DataFrame, suppliers: DataFrame, terms: DataFrame
) -> DataFrame:
    """Calendar, party and payment-term keys; parties of both roles meet in one join on
    (invoice type, folded name), so the branches need no split and re-union."""
    days = tiny(calendar.select(col("Date").alias("InvoiceDate"), "DateKey"))
    parties = customers.select(
        lit("Sales").alias("InvoiceType"), fold_name(col("CustomerName")).alias("PartyName"), col("CustomerKey").alias("PartyKey")
    ).unionByName(
        suppliers.select(
            lit("Purchase").alias("InvoiceType"), fold_name(col("SupplierName")).alias("PartyName"), col("SupplierKey").alias("PartyKey")
        )
    )
    parties = one_key_per_name(parties, ["InvoiceType", "PartyName"], "PartyKey")
    term_keys = terms.select(
        col("PaymentTermID").try_cast("bigint").alias("PaymentTermID"), "PaymentTermKey", "PaymentDays"
    ).filter(col("PaymentTermID").isNotNull())
    sales = col("InvoiceType") == "Sales"
    joined = (
        rows.withColumn("InvoiceDate", F.to_date("InvoiceDate").cast("timestamp_ntz"))
        .withColumn("PartyName", fold_name(when(sales, col("CustomerName")).otherwise(col("SupplierName"))))
        .withColumn("PaymentTermID", col("PaymentTermID").try_cast("bigint"))
        .join(days, "InvoiceDate", "left")
        .join(parties, ["InvoiceType", "PartyName"], "left")
        .join(term_keys, "PaymentTermID", "left")
    )
    reason = (
        when(col("DateKey").isNull(), "invalid_datekey")
        .when(sales & col("PartyKey").isNull(), "unmatched_customer")
        .when(~sales & col("PartyKey").isNull(), "unmatched_supplier")
    )
    return joined.withColumn("RejectReason", reason)


def corrected_net(total: Column, tax: Column, net: Column) -> Column:
    """Net := Total where tax and net are both 0 and the total is not."""
    return when((tax == 0) & (net == 0) & (total != 0), total).otherwise(net)


def due_date(due: Column, invoiced: Column, days: Column, default_days: int = 30) -> Column:
    """Missing due dates follow the payment term, or 30 days."""
    return F.coalesce(due, invoiced + F.make_dt_interval(days=F.coalesce(days, lit(default_days)).cast("int")))


def fact_invoices(tagged: DataFrame, key: Sequence[str] = ("InvoiceID",)) -> DataFrame:
    """Clean invoices, latest per ``key``. The default key spans both invoice types; pass
    (``InvoiceID``, ``InvoiceType``) to keep equal numbers of the two apart."""
    sales = col("InvoiceType") == "Sales"
    rows = tagged.filter(col("RejectReason").isNull()).select(
        "InvoiceID",
        "InvoiceDate",
        "DateKey",
        when(sales, col("PartyKey")).otherwise(lit(0)).alias("CustomerKey"),
        when(sales, lit(0)).otherwise(col("PartyKey")).alias("SupplierKey"),
        "TotalAmount",
        "TaxAmount",
        corrected_net(col("TotalAmount"), col("TaxAmount"), col("NetAmount")).alias("NetAmount"),
        payment_code(col("PaymentStatus")).alias("PaymentStatus"),
        due_date(col("PaymentDueDate").cast("timestamp_ntz"), col("InvoiceDate"), col("PaymentDays")).alias("PaymentDueDate"),
        F.coalesce("PaymentTermKey", lit(0)).alias("PaymentTermKey"),
        "InvoiceType",
    )
    order = [col("InvoiceDate").desc(), col("InvoiceType").desc(), col("CustomerKey"), col("SupplierKey"), col("TotalAmount"), col("TaxAmount")]
    return first_per_key(rows, list(key), order)


def invoice_rejects(tagged: DataFrame) -> dict[str, DataFrame]:
    """Distinct values per reject rule; one scan finds and writes those of all rules."""
    rule = (
        when(col("RejectReason") == "unmatched_customer", "unmatched_customers")
        .when(col("RejectReason") == "unmatched_supplier", "unmatched_suppliers")
        .when(col("RejectReason").isNull() & col("PaymentTermKey").isNull(), "unmatched_payment_terms")
    )
    by_term = col("__rule") == "unmatched_payment_terms"
    found = tagged.withColumn("__rule", rule).filter(col("__rule").isNotNull()).select(
        "__rule", when(~by_term, col("PartyName")).alias("PartyName"), when(by_term, col("PaymentTermID")).alias("PaymentTermID"))
    held = stash(found.distinct(), "rejects")

    def values(name: str, source: str, alias: str) -> DataFrame:
        return held.filter(col("__rule") == name).select(col(source).alias(alias))

    return {
        "unmatched_customers": values("unmatched_customers", "PartyName", "CustomerName_norm"),
        "unmatched_suppliers": values("unmatched_suppliers", "PartyName", "SupplierName_norm"),
        "unmatched_payment_terms": values("unmatched_payment_terms", "PaymentTermID", "PaymentTermID"),
    }

"""Plans bound to the test tables, shared by the catalogue modules."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolith.catalog.sqlops import FACT_START
from cargolith.functions.dates import instant
from cargolith.operators.scd import assign_keys
from cargolith.plans import dims, facts
from cargolith.sources import operational as op

AS_OF = "2002-01-01"
TIE = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def as_of():
    return instant(AS_OF)


def dim_customer(s, d):
    return assign_keys(dims.customers(op.party(s, d)), "CustomerID", "CustomerKey")


def dim_supplier(s, d):
    return assign_keys(dims.suppliers(op.party(s, d)), "SupplierID", "SupplierKey")


def places(s, d):
    return dims.all_places(*[op.places(s, d, kind) for kind in ("Port", "Airport", "City")])


def dim_location(s, d):
    return assign_keys(dims.locations(places(s, d)), "LocationID", "LocationKey")


def equipment_source(s, d):
    return dims.equipment_source(op.equipment(s, d), op.operation_types(s, d))


def dim_equipment(s, d):
    return assign_keys(dims.equipment(equipment_source(s, d)), "EquipmentID", "EquipmentKey")


def dim_freight(s, d):
    return assign_keys(dims.freight_types(op.freight_types(s, d)), "FreightTypeID", "FreightTypeKey")


def dim_term(s, d):
    return assign_keys(dims.payment_terms(op.payment_terms(s, d)), "PaymentTermID", "PaymentTermKey")


def calendar(s):
    return dims.calendar(s, FACT_START, "2099-12-31")


def ship_rows(s, d):
    return facts.shipment_rows(op.shipment_source(s, d), op.dossiers(s, d), as_of(), TIE)


def ship_tagged(s, d):
    return facts.tag_shipments(
        ship_rows(s, d), calendar(s), dim_customer(s, d), dim_equipment(s, d), dim_freight(s, d), dim_location(s, d)
    )


def fact_shipments(s, d):
    return facts.fact_shipments(ship_tagged(s, d), [F.col(c) for c in TIE])


def invoice_rows(s, d):
    return facts.invoice_rows(op.purchase_source(s, d), op.sales_source(s, d))


def inv_tagged(s, d):
    return facts.tag_invoices(invoice_rows(s, d), calendar(s), dim_customer(s, d), dim_supplier(s, d), dim_term(s, d))


def fact_invoices(s, d):
    return facts.fact_invoices(inv_tagged(s, d))

"""Declared schemas of the warehouse tables (money is double, dates carry no zone)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "str": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "dbl": T.DoubleType(),
    "bool": T.BooleanType(),
    "ts": T.TimestampNTZType(),
}


def table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


_VERSION = {"EffectiveDate": "ts", "ExpiryDate": "ts", "IsCurrent": "bool"}

DIM_DATE = table(
    Date="ts", DateKey="int", Day="int", Month="int", Year="int", Quarter="int", DayOfWeek="int",
    IsWeekend="int", IsHoliday="int", Season="str", FiscalPeriod="str",
)
DIM_CUSTOMER = table(
    CustomerKey="long", CustomerID="str", CustomerName="str", CustomerType="str", CustomerCategory="str",
    CustomerCountry="int", CustomerCity="str", CustomerRegion="int", CustomerSegment="str", IsActive="bool", **_VERSION,
)
DIM_SUPPLIER = table(
    SupplierKey="long", SupplierID="str", SupplierName="str", SupplierType="str", SupplierCountry="int",
    SupplierCity="str", SupplierRegion="int", IsActive="bool", **_VERSION,
)
DIM_PRODUCT = table(
    ProductID="str", ProductName="str", ProductCategory="str", ProductType="str", IsStockable="bool",
    IsActiveForSale="bool", IsActiveForPurchase="bool", IsActive="bool", **_VERSION,
)
DIM_LOCATION = table(LocationKey="long", LocationID="str", LocationName="str", LocationType="str", IsActive="bool", **_VERSION)
DIM_EQUIPMENT = table(EquipmentKey="long", EquipmentID="str", EquipmentType="str", OperationType="str", IsActive="bool", **_VERSION)
DIM_FREIGHT_TYPE = table(FreightTypeKey="long", FreightTypeID="str", FreightTypeName="str", IsActive="bool")
DIM_PAYMENT_TERM = table(PaymentTermKey="long", PaymentTermID="str", PaymentTermName="str", IsActive="int", PaymentDays="int")
FACT_SHIPMENTS = table(
    ShipmentID="long", DateKey="int", CustomerKey="long", EquipmentKey="long", FreightTypeKey="long",
    OriginLocationKey="long", DestinationLocationKey="long", ShipmentDate="ts", PlannedArrivalDate="ts",
    ActualDepartureDate="ts", ActualArrivalDate="ts", TotalWeight="dbl", TotalVolume="dbl", TotalPackages="int",
    ShipmentValue="dbl", DurationDays="int", IsDelivered="int",
)
FACT_INVOICES = table(
    InvoiceID="long", InvoiceDate="ts", DateKey="int", CustomerKey="long", SupplierKey="long", TotalAmount="dbl",
    TaxAmount="dbl", NetAmount="dbl", PaymentStatus="int", PaymentDueDate="ts", PaymentTermKey="long", InvoiceType="str",
)
SHIPMENT_PERFORMANCE = table(
    ShipmentKey="long", PlannedDeliveryDate="ts", ActualDeliveryDate="ts", DeliveryVariance="int",
    OnTimeDeliveryFlag="int", CustomerSatisfactionScore="int", DelayReason="str",
)
FREIGHT_COST = table(
    ShipmentKey="long", FreightTypeKey="long", PlannedFreightCost="dbl", ActualFreightCost="dbl", CostVariance="dbl",
    VarianceFlag="int", CostEfficiencyRatio="dbl",
)

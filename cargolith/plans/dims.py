"""Dimensions of the star schema, from operational tables to clean rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolith.functions import dates as dt
from cargolith.functions.measures import number_or_zero
from cargolith.functions.text import clean_id, text_or, title_case
from cargolith.operators.keyed import first_per_key

col, when, lit = F.col, F.when, F.lit


def keep_last(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Last row per key in source order. Rows without an id carry no entity and are dropped."""
    return first_per_key(df.filter(col(key).isNotNull()), [key], [col(c).desc_nulls_last() for c in order])


def with_role(party: DataFrame, flag: str) -> DataFrame:
    return party.filter(col(flag) == 1)


def customer_type(nature: Column) -> Column:
    return when(nature == 0, "Independant").otherwise("Entreprise")


def customer_category(nature: Column) -> Column:
    return when(nature == 0, "B2C").otherwise("B2B")


def customer_segment(regular: Column) -> Column:
    return when(regular, "Regular").otherwise("Occasional")


def is_one(c: Column) -> Column:
    """True for 1, False for anything else and for NULL."""
    return when(c == 1, True).otherwise(False)


def customers(party: DataFrame) -> DataFrame:
    rows = with_role(party, "IsClient").select(
        clean_id(col("CodeClient")).alias("CustomerID"),
        title_case(F.trim(text_or(col("RaisonSociale")))).alias("CustomerName"),
        customer_type(col("NatureSociete")).alias("CustomerType"),
        customer_category(col("NatureSociete")).alias("CustomerCategory"),
        F.coalesce("ID_Pays", lit(0)).alias("CustomerCountry"),
        F.trim(text_or(col("Ville"), "")).alias("CustomerCity"),
        F.coalesce("ID_Departement", lit(0)).alias("CustomerRegion"),
        customer_segment(col("IsClientRegulier")).alias("CustomerSegment"),
        is_one(col("Etat")).alias("IsActive"),
        "LastModifiedOnDate",
        "CreatedOnDate",
        "ID",
    )
    return keep_last(rows, "CustomerID", "ID").drop("ID")


def suppliers(party: DataFrame) -> DataFrame:
    rows = with_role(party, "IsSupplier").select(
        clean_id(col("CodeSupplier")).alias("SupplierID"),
        title_case(F.trim(text_or(col("RaisonSociale")))).alias("SupplierName"),
        customer_type(col("NatureSociete")).alias("SupplierType"),
        F.coalesce("ID_Pays", lit(0)).alias("SupplierCountry"),
        F.trim(text_or(col("Ville"), "")).alias("SupplierCity"),
        F.coalesce("ID_Departement", lit(0)).alias("SupplierRegion"),
        is_one(col("Etat")).alias("IsActive"),
        "LastModifiedOnDate",
        "ID",
    )
    return keep_last(rows, "SupplierID", "ID").drop("ID")


def valid_materials(materials: DataFrame) -> DataFrame:
    """Materials with a code that is neither missing nor blank."""
    return materials.filter(col("Code").isNotNull() & (F.trim("Code") != ""))


def products(materials: DataFrame) -> DataFrame:
    def flag(c: str) -> Column:
        return F.coalesce(col(c), lit(0)) != 0

    rows = valid_materials(materials).select(
        clean_id(col("Code")).alias("ProductID"),
        title_case(F.trim(text_or(col("Nom"), ""))).alias("ProductName"),
        text_or(col("TypeCode")).alias("ProductCategory"),
        product_type(col("IsServices")).alias("ProductType"),
        flag("Stockable").alias("IsStockable"),
        flag("EtatVente").alias("IsActiveForSale"),
        flag("EtatAchat").alias("IsActiveForPurchase"),
        flag("IsFret").alias("IsActive"),
        "LastModifiedOnDate",
        "ID",
    )
    return keep_last(rows, "ProductID", "ID").drop("ID")


PRODUCT_ATTRIBUTES = [
    "ProductName", "ProductCategory", "ProductType", "IsStockable", "IsActiveForSale", "IsActiveForPurchase", "IsActive",
]


def product_type(is_service: Column) -> Column:
    return when(F.coalesce(is_service, lit(0)) == 1, "Service").otherwise("Goods")


def all_places(ports: DataFrame, airports: DataFrame, cities: DataFrame) -> DataFrame:
    """Distinct union of three place tables with a constant type each."""

    def shaped(df: DataFrame, kind: str) -> DataFrame:
        return df.select(
            col("ID").cast("string").alias("LocationID"),
            col("Libelle").alias("LocationName"),
            lit(kind).alias("LocationType"),
            "CreatedOnDate",
            lit(1).alias("IsActive"),
        )

    return shaped(ports, "Port").unionByName(shaped(airports, "Airport")).unionByName(shaped(cities, "City")).distinct()


def locations(places: DataFrame) -> DataFrame:
    rows = places.select(
        F.trim("LocationID").alias("LocationID"),
        title_case(text_or(col("LocationName"))).alias("LocationName"),
        text_or(col("LocationType")).alias("LocationType"),
        is_one(col("IsActive")).alias("IsActive"),
        "CreatedOnDate",
    )
    return keep_last(rows, "LocationID", "LocationType", "LocationName", "CreatedOnDate")


def equipment_source(equipment: DataFrame, operation_types: DataFrame) -> DataFrame:
    types = operation_types.select(col("ID").alias("ID_typeOp"), col("Designation").alias("OperationType"))
    return equipment.join(types, "ID_typeOp", "left").select(
        col("ID").cast("string").alias("EquipmentID"),
        col("Designation").alias("EquipmentType"),
        "OperationType",
        "IsActive",
        "LastModifiedOnDate",
    )


def equipment(source: DataFrame) -> DataFrame:
    rows = source.select(
        clean_id(col("EquipmentID")).alias("EquipmentID"),
        title_case(F.trim(text_or(col("EquipmentType")))).alias("EquipmentType"),
        title_case(F.trim(text_or(col("OperationType")))).alias("OperationType"),
        (F.coalesce("IsActive", lit(0)) != 0).alias("IsActive"),
        "LastModifiedOnDate",
    )
    return keep_last(rows, "EquipmentID", "LastModifiedOnDate", "EquipmentType", "OperationType")


def freight_types(source: DataFrame) -> DataFrame:
    rows = source.select(
        F.trim(col("ID").cast("string")).alias("FreightTypeID"),
        title_case(text_or(col("Designation"))).alias("FreightTypeName"),
        lit(True).alias("IsActive"),
    )
    return keep_last(rows, "FreightTypeID", "FreightTypeName")


def payment_terms(source: DataFrame) -> DataFrame:
    return source.filter(col("ID").isNotNull()).select(
        F.trim(col("ID").cast("string")).alias("PaymentTermID"),
        F.trim(col("Designation").cast("string")).alias("PaymentTermName"),
        number_or_zero(col("NumOfDays")).cast("int").alias("PaymentDays"),
        lit(1).alias("IsActive"),
    )


def calendar(spark: SparkSession, start: str = dt.CALENDAR_START, end: str = dt.CALENDAR_END) -> DataFrame:
    """One row per day of a fixed span."""
    span = spark.range(1).select(lit(start).cast("date").alias("a"), lit(end).cast("date").alias("b"))
    return calendar_of(span)


def calendar_of(span: DataFrame) -> DataFrame:
    """Calendar rows for the one-row frame (a, b) of dates."""
    days = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("d"))
    d = col("d")
    return days.select(
        d.cast("timestamp_ntz").alias("Date"),
        dt.date_key(d).alias("DateKey"),
        F.dayofmonth(d).alias("Day"),
        F.month(d).alias("Month"),
        F.year(d).alias("Year"),
        F.quarter(d).alias("Quarter"),
        dt.weekday1(d).alias("DayOfWeek"),
        dt.weekend_flag(d).alias("IsWeekend"),
        lit(0).alias("IsHoliday"),
        dt.season_of(d, autumn="Autumn").alias("Season"),
        dt.fiscal_period(d).alias("FiscalPeriod"),
    )

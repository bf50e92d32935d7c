"""Operational source tables, shaped from the trade tables.

They carry the defects that the warehouse build has to deal with: padded and
accented names, repeated codes, missing attributes, unreadable numbers, deleted
rows, unknown keys and dates outside the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolith.functions.dates import instant
from cargolith.sources.marts import purchase_invoices as _purchases
from cargolith.sources.marts import sales_invoices as _sales
from cargolith.sources.tables import parquet

col, lit, when = F.col, F.lit, F.when


def _days_after(text: str, days) -> F.Column:
    return instant(text) + F.make_dt_interval(days=days.cast("int"))


def party_name(key, name):
    """Every seventh party carries accents, a company form and odd spacing."""
    return when(key % 7 == 0, F.concat(lit(" Société  "), name, lit(", S.A."))).otherwise(name)


def party(spark: SparkSession, folder: str) -> DataFrame:
    """One table for both roles; ``IsClient`` / ``IsSupplier`` tell them apart."""
    nation = parquet(spark, folder, "nation")
    c = parquet(spark, folder, "customer").join(nation, col("c_nationkey") == col("n_nationkey"))
    k = col("c_custkey")
    created = _days_after("2000-01-01", k % 1000)
    clients = c.select(
        k.alias("ID"),
        F.concat(lit(" c"), (k - when(k % 20 == 19, 1).otherwise(0)).cast("string"), lit(" ")).alias("CodeClient"),
        lit(None).cast("string").alias("CodeSupplier"),
        when(k % 53 != 0, party_name(k, col("c_name"))).alias("RaisonSociale"),
        when(col("c_mktsegment") == "HOUSEHOLD", 0).otherwise(1).alias("NatureSociete"),
        when(col("c_acctbal") >= 0, col("c_nationkey")).alias("ID_Pays"),
        when(k % 11 != 0, F.concat(lit(" "), col("n_name"))).alias("Ville"),
        (k % 97).cast("int").alias("ID_Departement"),
        when(k % 3 != 0, col("c_acctbal") > 5000).alias("IsClientRegulier"),
        when(k % 10 == 0, 2).otherwise(1).alias("Etat"),
        created.alias("CreatedOnDate"),
        when(k % 5 != 0, created + F.expr("INTERVAL '400' DAY")).alias("LastModifiedOnDate"),
        lit(1).alias("IsClient"),
        lit(0).alias("IsSupplier"),
    )
    s = parquet(spark, folder, "supplier").join(nation, col("s_nationkey") == col("n_nationkey"))
    k = col("s_suppkey")
    created = _days_after("2001-01-01", k % 500)
    suppliers = s.select(
        k.alias("ID"),
        lit(None).cast("string").alias("CodeClient"),
        when(k % 29 != 28, F.concat(lit("s"), k.cast("string"), lit(" "))).alias("CodeSupplier"),
        party_name(k, col("s_name")).alias("RaisonSociale"),
        (k % 2).cast("int").alias("NatureSociete"),
        when(col("s_acctbal") >= 0, col("s_nationkey")).alias("ID_Pays"),
        col("n_name").alias("Ville"),
        (k % 97).cast("int").alias("ID_Departement"),
        lit(None).cast("boolean").alias("IsClientRegulier"),
        when(k % 10 == 0, 2).otherwise(1).alias("Etat"),
        created.alias("CreatedOnDate"),
        when(k % 4 != 0, created + F.expr("INTERVAL '90' DAY")).alias("LastModifiedOnDate"),
        lit(0).alias("IsClient"),
        lit(1).alias("IsSupplier"),
    )
    return clients.unionByName(suppliers)


def _type_code(c):
    return F.length(c) * 100 + F.ascii(c)


def operation_types(spark: SparkSession, folder: str) -> DataFrame:
    return (
        parquet(spark, folder, "part")
        .select(_type_code(col("p_type")).alias("ID"), F.lower("p_type").alias("Designation"))
        .distinct()
    )


def equipment(spark: SparkSession, folder: str) -> DataFrame:
    n = F.substring("p_brand", 7, 9).cast("int")
    brands = parquet(spark, folder, "part").groupBy(n.alias("ID")).agg(F.min(_type_code(col("p_type"))).alias("op"))
    k = col("ID")
    return brands.select(
        "ID",
        when(k % 5 == 0, " camion").when(k % 5 == 1, "tracteur").when(k % 5 == 2, "semi-remorque").when(
            k % 5 == 3, "grue d'arc"
        ).alias("Designation"),
        when(k % 5 != 0, col("op")).alias("ID_typeOp"),
        when(k % 9 != 0, (k % 2).cast("int")).alias("IsActive"),
        when(k % 6 != 0, _days_after("2010-01-01", k)).alias("LastModifiedOnDate"),
    )


def freight_types(spark: SparkSession, folder: str) -> DataFrame:
    flag = col("l_returnflag")
    return (
        parquet(spark, folder, "lineitem")
        .select("l_returnflag")
        .distinct()
        .select(
            when(flag == "R", 1).when(flag == "A", 2).otherwise(3).alias("ID"),
            when(flag == "R", "fret maritime").when(flag == "A", "fret aérien").alias("Designation"),
        )
    )


def places(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Ports, airports and cities, by region of the nation."""
    regions = {"Port": [0, 1], "Airport": [2, 3], "City": [4]}[kind]
    k = col("n_nationkey")
    return (
        parquet(spark, folder, "nation")
        .filter(col("n_regionkey").isin(regions))
        .select(
            k.alias("ID"),
            F.concat(F.lower("n_name"), lit("-d'arc")).alias("Libelle"),
            when(k % 4 != 0, _days_after("2001-01-01", k)).alias("CreatedOnDate"),
        )
    )


def payment_terms(spark: SparkSession, folder: str) -> DataFrame:
    digit = F.substring("o_orderpriority", 1, 1)
    return (
        parquet(spark, folder, "orders")
        .select("o_orderpriority")
        .distinct()
        .select(
            digit.cast("int").alias("ID"),
            F.concat(lit(" "), F.substring("o_orderpriority", 3, 30)).alias("Designation"),
            when(digit == "3", "n/a").otherwise(F.concat(digit, lit("0"))).alias("NumOfDays"),
        )
    )


def materials(spark: SparkSession, folder: str) -> DataFrame:
    k = col("p_partkey")
    return parquet(spark, folder, "part").select(
        when(k % 51 == 50, None).when(k % 50 == 49, "  ").otherwise(
            F.concat(lit(" p"), (k - when(k % 40 == 39, 1).otherwise(0)).cast("string"))
        ).alias("Code"),
        when(k % 37 != 0, F.concat(col("p_name"), lit(" "))).alias("Nom"),
        when(k % 41 != 0, col("p_type")).alias("TypeCode"),
        when(col("p_type") == "PROMO", 1).when(k % 2 == 0, 0).alias("IsServices"),
        when(k % 3 != 0, when(col("p_size") > 25, 1).otherwise(0)).alias("Stockable"),
        (k % 2).cast("int").alias("EtatVente"),
        when(k % 7 != 0, 1).alias("EtatAchat"),
        when(k % 13 != 0, 1).otherwise(0).alias("IsFret"),
        _days_after("2005-01-01", k % 2000).alias("LastModifiedOnDate"),
        k.alias("ID"),
    )


def purchase_source(spark: SparkSession, folder: str) -> DataFrame:
    p = _purchases(spark, folder)
    s = parquet(spark, folder, "supplier")
    k = col("s_suppkey")
    return p.join(s, col("SupplierKey") - 1 == k).select(
        col("InvoiceID").alias("ID"),
        "InvoiceDate",
        F.upper(when(k % 31 != 30, party_name(k, col("s_name"))).otherwise(lit("inconnu & fils"))).alias("Supplier"),
        col("TotalAmount").alias("TotalTTCAmount"),
        when(col("PaymentStatus") == 4, 0.0).otherwise(col("TaxAmount")).alias("TotalTaxAmount"),
        when(col("PaymentStatus") == 4, 0.0).otherwise(col("NetAmount")).alias("TotalNetAmount"),
        when(col("PaymentStatus") == 1, "zzz").otherwise(col("PaymentStatus").cast("string")).alias("Statut"),
        col("PaymentDueDate").alias("DueDate"),
        when(k % 17 != 0, col("PaymentTermKey").cast("string")).otherwise("nan").alias("ID_PaymentTerms"),
        when(k % 13 == 0, None).when(k % 11 == 0, 1).otherwise(0).alias("IsDeleted"),
    )


def sales_source(spark: SparkSession, folder: str) -> DataFrame:
    s = _sales(spark, folder)
    c = parquet(spark, folder, "customer")
    k = col("c_custkey")
    return s.join(c, col("CustomerKey") - 1 == k).select(
        when(col("InvoiceID") % 500 != 499, col("InvoiceID")).alias("ID"),
        col("InvoiceDate").alias("DateFacture"),
        F.upper(party_name(k, col("c_name"))).alias("RaisonSociale"),
        col("TotalAmount").alias("TotalTTC"),
        col("TaxAmount").alias("TotalTVA"),
        when(col("PaymentStatus") == 1, "Validée").when(col("PaymentStatus") == 2, "Payée").otherwise(
            "En attente"
        ).alias("ID_STATUS"),
        col("PaymentDueDate").alias("EcheanceDate"),
        col("PaymentTermKey").cast("string").alias("ID_NATURE"),
    )


def dossiers(spark: SparkSession, folder: str) -> DataFrame:
    k, d = col("o_orderkey"), col("o_orderdate")
    left = when(k % 1000 == 7, instant("2203-08-12")).when(k % 100 != 3, d)
    return parquet(spark, folder, "orders").select(
        k.alias("ID"),
        left.alias("DateDepart"),
        (d + F.expr("INTERVAL '30' DAY")).alias("DateArrivee"),
        (d + F.make_dt_interval(days=(k % 3).cast("int"))).alias("DateDepartReel"),
        when(k % 9 != 0, d + F.make_dt_interval(days=(k % 61).cast("int"))).alias("DateArriveeReel"),
        when(k % 19 != 0, col("o_totalprice")).alias("ValMarchandise"),
        (col("o_custkey") % 25).cast("int").alias("ID_LieuChargement"),
        (k % 26).cast("int").alias("ID_LieuLivraison"),
        (k % 3 + 1).cast("int").alias("ID_Freight"),
    )


def shipment_source(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the client's name as typed by hand."""
    line = parquet(spark, folder, "lineitem").join(
        parquet(spark, folder, "part"), col("l_partkey") == col("p_partkey")
    )
    owner = parquet(spark, folder, "orders").join(
        parquet(spark, folder, "customer"), col("o_custkey") == col("c_custkey")
    )
    k = col("c_custkey")
    return line.join(owner, col("l_orderkey") == col("o_orderkey")).select(
        (col("l_orderkey") * 10 + col("l_linenumber")).alias("ID"),
        col("l_quantity").alias("Poids"),
        col("p_size").cast("double").alias("Volume"),
        when(col("l_linenumber") != 7, col("l_linenumber")).alias("nbColis"),
        F.concat(lit(" "), F.upper(party_name(k, col("c_name"))), lit("  ")).alias("Client"),
        F.substring("p_brand", 7, 9).cast("int").alias("ID_Equipement"),
        col("l_orderkey").alias("ID_Dossier"),
        col("l_partkey"),
        col("l_suppkey"),
        col("l_extendedprice"),
        col("l_shipdate"),
    )

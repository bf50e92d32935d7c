"""Common table expressions shared by the SQL counterparts."""

from __future__ import annotations

SHIP = """shipments AS (
  SELECT l_orderkey * 10 + l_linenumber AS ShipmentID, o_orderdate AS ShipmentDate,
    o_orderdate + INTERVAL 30 DAY AS PlannedArrivalDate, o_orderdate + to_days(l_linenumber % 4) AS ActualDepartureDate,
    l_shipdate AS ActualArrivalDate, l_quantity AS TotalWeight, CAST(p_size AS DOUBLE) AS TotalVolume,
    l_linenumber AS TotalPackages, l_extendedprice AS ShipmentValue, o_custkey + 1 AS CustomerKey,
    s_nationkey AS OriginLocationKey, c_nationkey AS DestinationLocationKey,
    CAST(substr(p_brand, 7) AS INTEGER) AS EquipmentKey,
    CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS FreightTypeKey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey)"""

_MONEY = """
    sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)))::BIGINT AS net4,
    sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))
        * CAST(round(l_tax * 100) AS BIGINT))::BIGINT AS tax6"""
_AMOUNTS = """
    CAST((net4 + 50) // 100 + (tax6 + 5000) // 10000 AS DOUBLE) / 100 AS TotalAmount,
    CAST((tax6 + 5000) // 10000 AS DOUBLE) / 100 AS TaxAmount, CAST((net4 + 50) // 100 AS DOUBLE) / 100 AS NetAmount"""

SALES = f"""sales_lines AS (SELECT l_orderkey, {_MONEY} FROM lineitem GROUP BY l_orderkey),
sales_base AS (
  SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS term, {_AMOUNTS}
  FROM sales_lines JOIN orders ON l_orderkey = o_orderkey),
sales AS (
  SELECT o_orderkey AS InvoiceID, o_orderdate AS InvoiceDate, o_custkey + 1 AS CustomerKey, CAST(0 AS BIGINT) AS SupplierKey,
    TotalAmount, TaxAmount, NetAmount, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 3 END AS PaymentStatus,
    CASE WHEN term <> 5 THEN o_orderdate + to_days(term * 10) END AS PaymentDueDate, term AS PaymentTermKey,
    'Sales' AS InvoiceType
  FROM sales_base)"""
PURCHASES = f"""purchase_lines AS (
  SELECT l_suppkey, year(l_shipdate) * 100 + month(l_shipdate) AS ym, {_MONEY} FROM lineitem GROUP BY 1, 2),
purchase_base AS (
  SELECT *, CAST(l_suppkey % 5 + 1 AS INTEGER) AS term,
    CAST(make_date(CAST(ym // 100 AS INTEGER), CAST(ym % 100 AS INTEGER), 1) AS TIMESTAMP) AS d, {_AMOUNTS}
  FROM purchase_lines),
purchases AS (
  SELECT l_suppkey * 1000000 + ym AS InvoiceID, d AS InvoiceDate, CAST(0 AS BIGINT) AS CustomerKey,
    l_suppkey + 1 AS SupplierKey, TotalAmount, TaxAmount, NetAmount, CAST((l_suppkey + ym) % 4 + 1 AS INTEGER) AS PaymentStatus,
    CASE WHEN term <> 5 THEN d + to_days(term * 10) END AS PaymentDueDate, term AS PaymentTermKey, 'Purchase' AS InvoiceType
  FROM purchase_base)"""
INV = f"""{SALES},
{PURCHASES},
invoices AS (SELECT * FROM sales UNION ALL SELECT * FROM purchases)"""


def season(c: str, autumn: str = "Fall") -> str:
    return (
        f"CASE WHEN month({c}) IN (12, 1, 2) THEN 'Winter' WHEN month({c}) IN (3, 4, 5) THEN 'Spring' "
        f"WHEN month({c}) IN (6, 7, 8) THEN 'Summer' WHEN month({c}) IN (9, 10, 11) THEN '{autumn}' ELSE 'Unknown' END"
    )


def days(later: str, earlier: str) -> str:
    """Whole days, rounded down."""
    return f"CAST(floor(epoch({later} - {earlier}) / 86400) AS INTEGER)"


VARIANCE = days("ActualArrivalDate", "PlannedArrivalDate")
DELIVERY = days("ActualArrivalDate", "ActualDepartureDate")
ON_TIME = f"(CASE WHEN {VARIANCE} <= 0 THEN 1 ELSE 0 END)"
AS_OF = "2002-01-01"

RFM = f"""rfm0 AS (
  SELECT CustomerKey, min(InvoiceDate) AS FirstPurchase, max(InvoiceDate) AS LastPurchase,
    count(DISTINCT InvoiceID) AS Frequency, sum(NetAmount) AS Monetary, avg(NetAmount) AS MonetaryMean,
    coalesce(stddev_samp(NetAmount), 0) AS MonetaryStd, avg(CASE WHEN PaymentStatus = 1 THEN 1.0::DOUBLE ELSE 0 END) AS PaymentRate,
    sum(TotalAmount) AS TotalSpent
  FROM invoices WHERE CustomerKey IS NOT NULL GROUP BY CustomerKey),
rfm AS (
  SELECT *, {days(f"TIMESTAMP '{AS_OF}'", "LastPurchase")} AS Recency, {days("LastPurchase", "FirstPurchase")} AS CustomerLifetime,
    TotalSpent / Frequency AS AvgOrderValue, Frequency / ({days("LastPurchase", "FirstPurchase")} + 1) AS PurchaseVelocity
  FROM rfm0)"""
_Q = "CAST(greatest(1, ceil((row_number() OVER (ORDER BY {c}, CustomerKey) - 1) * 5 / greatest(count(*) OVER () - 1, 1))) AS INTEGER)"
SCORES = f"""{RFM},
scores0 AS (
  SELECT *, 6 - {_Q.format(c="Recency")} AS R_score, {_Q.format(c="Frequency")} AS F_score, {_Q.format(c="Monetary")} AS M_score
  FROM rfm),
scores AS (
  SELECT *, F_score * M_score * PaymentRate AS CustomerValue,
    CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Champions'
      WHEN R_score >= 3 AND F_score >= 3 AND M_score >= 3 THEN 'Loyal_Customers'
      WHEN R_score >= 3 AND F_score <= 2 THEN 'New_Customers'
      WHEN R_score <= 2 AND F_score >= 3 AND M_score >= 3 THEN 'At_Risk'
      WHEN R_score <= 2 AND F_score <= 2 THEN 'Lost_Customers' ELSE 'Others' END AS Segment
  FROM scores0)"""


def sql(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body.strip()}"

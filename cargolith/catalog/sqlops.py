"""SQL counterparts of the operational tables, dimensions and facts."""

from __future__ import annotations

from cargolith.catalog.sqlbase import INV, season


def title(x: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({x}, '(\p{{L}}+|[^\p{{L}}]+)'), "
        rf"lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '')"
    )


def fold(x: str) -> str:
    ascii_only = rf"regexp_replace(strip_accents(trim({x})), '[^\x00-\x7F]', '', 'g')"
    return rf"trim(lower(regexp_replace(regexp_replace({ascii_only}, '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')))"


def party_name(k: str, name: str) -> str:
    return f"CASE WHEN {k} % 7 = 0 THEN ' Société  ' || {name} || ', S.A.' ELSE {name} END"


PARTY = f"""party AS (
  SELECT c_custkey AS ID, ' c' || (c_custkey - CASE WHEN c_custkey % 20 = 19 THEN 1 ELSE 0 END) || ' ' AS CodeClient,
    NULL::VARCHAR AS CodeSupplier, CASE WHEN c_custkey % 53 <> 0 THEN {party_name('c_custkey', 'c_name')} END AS RaisonSociale,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 ELSE 1 END AS NatureSociete, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS ID_Pays,
    CASE WHEN c_custkey % 11 <> 0 THEN ' ' || n_name END AS Ville, CAST(c_custkey % 97 AS INTEGER) AS ID_Departement,
    CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal > 5000 END AS IsClientRegulier, CASE WHEN c_custkey % 10 = 0 THEN 2 ELSE 1 END AS Etat,
    TIMESTAMP '2000-01-01' + to_days(CAST(c_custkey % 1000 AS INTEGER)) AS CreatedOnDate,
    CASE WHEN c_custkey % 5 <> 0 THEN TIMESTAMP '2000-01-01' + to_days(CAST(c_custkey % 1000 AS INTEGER) + 400) END AS LastModifiedOnDate,
    1 AS IsClient, 0 AS IsSupplier
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT s_suppkey, NULL, CASE WHEN s_suppkey % 29 <> 28 THEN 's' || s_suppkey || ' ' END, {party_name('s_suppkey', 's_name')},
    CAST(s_suppkey % 2 AS INTEGER), CASE WHEN s_acctbal >= 0 THEN s_nationkey END, n_name, CAST(s_suppkey % 97 AS INTEGER), NULL,
    CASE WHEN s_suppkey % 10 = 0 THEN 2 ELSE 1 END, TIMESTAMP '2001-01-01' + to_days(CAST(s_suppkey % 500 AS INTEGER)),
    CASE WHEN s_suppkey % 4 <> 0 THEN TIMESTAMP '2001-01-01' + to_days(CAST(s_suppkey % 500 AS INTEGER) + 90) END, 0, 1
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

CUSTOMERS = f"""{PARTY},
dim_customer0 AS (
  SELECT upper(trim(CodeClient)) AS CustomerID, {title("trim(coalesce(RaisonSociale, 'Unknown'))")} AS CustomerName,
    CASE NatureSociete WHEN 0 THEN 'Independant' ELSE 'Entreprise' END AS CustomerType,
    CASE NatureSociete WHEN 0 THEN 'B2C' ELSE 'B2B' END AS CustomerCategory, coalesce(ID_Pays, 0) AS CustomerCountry,
    trim(coalesce(Ville, '')) AS CustomerCity, coalesce(ID_Departement, 0) AS CustomerRegion,
    CASE WHEN IsClientRegulier THEN 'Regular' ELSE 'Occasional' END AS CustomerSegment,
    coalesce(Etat = 1, false) AS IsActive, LastModifiedOnDate, CreatedOnDate
  FROM party WHERE IsClient = 1 AND CodeClient IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY upper(trim(CodeClient)) ORDER BY ID DESC) = 1),
dim_customer AS (SELECT row_number() OVER (ORDER BY CustomerID) AS CustomerKey, * FROM dim_customer0)"""
SUPPLIERS = f"""dim_supplier0 AS (
  SELECT upper(trim(CodeSupplier)) AS SupplierID, {title("trim(coalesce(RaisonSociale, 'Unknown'))")} AS SupplierName,
    CASE NatureSociete WHEN 0 THEN 'Independant' ELSE 'Entreprise' END AS SupplierType, coalesce(ID_Pays, 0) AS SupplierCountry,
    trim(coalesce(Ville, '')) AS SupplierCity, coalesce(ID_Departement, 0) AS SupplierRegion,
    coalesce(Etat = 1, false) AS IsActive, LastModifiedOnDate
  FROM party WHERE IsSupplier = 1 AND CodeSupplier IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY upper(trim(CodeSupplier)) ORDER BY ID DESC) = 1),
dim_supplier AS (SELECT row_number() OVER (ORDER BY SupplierID) AS SupplierKey, * FROM dim_supplier0)"""
MATERIALS = """materials AS (
  SELECT CASE WHEN p_partkey % 51 = 50 THEN NULL WHEN p_partkey % 50 = 49 THEN '  '
      ELSE ' p' || (p_partkey - CASE WHEN p_partkey % 40 = 39 THEN 1 ELSE 0 END) END AS Code,
    CASE WHEN p_partkey % 37 <> 0 THEN p_name || ' ' END AS Nom, CASE WHEN p_partkey % 41 <> 0 THEN p_type END AS TypeCode,
    CASE WHEN p_type = 'PROMO' THEN 1 WHEN p_partkey % 2 = 0 THEN 0 END AS IsServices,
    CASE WHEN p_partkey % 3 <> 0 THEN CASE WHEN p_size > 25 THEN 1 ELSE 0 END END AS Stockable, p_partkey % 2 AS EtatVente,
    CASE WHEN p_partkey % 7 <> 0 THEN 1 END AS EtatAchat, CASE WHEN p_partkey % 13 <> 0 THEN 1 ELSE 0 END AS IsFret,
    TIMESTAMP '2005-01-01' + to_days(CAST(p_partkey % 2000 AS INTEGER)) AS LastModifiedOnDate, p_partkey AS ID
  FROM part)"""
PRODUCTS = f"""{MATERIALS},
dim_product AS (
  SELECT upper(trim(Code)) AS ProductID, {title("trim(coalesce(Nom, ''))")} AS ProductName,
    coalesce(TypeCode, 'Unknown') AS ProductCategory, CASE WHEN coalesce(IsServices, 0) = 1 THEN 'Service' ELSE 'Goods' END AS ProductType,
    coalesce(Stockable, 0) <> 0 AS IsStockable, coalesce(EtatVente, 0) <> 0 AS IsActiveForSale,
    coalesce(EtatAchat, 0) <> 0 AS IsActiveForPurchase, coalesce(IsFret, 0) <> 0 AS IsActive, LastModifiedOnDate
  FROM materials WHERE Code IS NOT NULL AND trim(Code) <> ''
  QUALIFY row_number() OVER (PARTITION BY upper(trim(Code)) ORDER BY ID DESC) = 1)"""


def _place(kind: str, regions: str) -> str:
    return f"""SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS LocationID, lower(n_name) || '-d''arc' AS LocationName, '{kind}' AS LocationType,
    CASE WHEN n_nationkey % 4 <> 0 THEN TIMESTAMP '2001-01-01' + to_days(n_nationkey) END AS CreatedOnDate, 1 AS IsActive
  FROM nation WHERE n_regionkey IN ({regions})"""


PLACES = f"""places AS ({_place('Port', '0, 1')} UNION {_place('Airport', '2, 3')} UNION {_place('City', '4')})"""
LOCATIONS = f"""{PLACES},
dim_location0 AS (
  SELECT trim(LocationID) AS LocationID, {title('LocationName')} AS LocationName, LocationType, true AS IsActive, CreatedOnDate FROM places),
dim_location AS (SELECT row_number() OVER (ORDER BY LocationID) AS LocationKey, * FROM dim_location0)"""
EQUIPMENT = f"""optypes AS (SELECT DISTINCT length(p_type) * 100 + ascii(p_type) AS ID, lower(p_type) AS Designation FROM part),
equip AS (
  SELECT ID, CASE ID % 5 WHEN 0 THEN ' camion' WHEN 1 THEN 'tracteur' WHEN 2 THEN 'semi-remorque' WHEN 3 THEN 'grue d''arc' END AS Designation,
    CASE WHEN ID % 5 <> 0 THEN op END AS ID_typeOp, CASE WHEN ID % 9 <> 0 THEN ID % 2 END AS IsActive,
    CASE WHEN ID % 6 <> 0 THEN TIMESTAMP '2010-01-01' + to_days(ID) END AS LastModifiedOnDate
  FROM (SELECT CAST(substr(p_brand, 7) AS INTEGER) AS ID, min(length(p_type) * 100 + ascii(p_type)) AS op FROM part GROUP BY 1)),
equip_source AS (
  SELECT CAST(e.ID AS VARCHAR) AS EquipmentID, e.Designation AS EquipmentType, t.Designation AS OperationType, IsActive, LastModifiedOnDate
  FROM equip e LEFT JOIN optypes t ON e.ID_typeOp = t.ID),
dim_equipment0 AS (
  SELECT upper(trim(EquipmentID)) AS EquipmentID, {title("trim(coalesce(EquipmentType, 'Unknown'))")} AS EquipmentType,
    {title("trim(coalesce(OperationType, 'Unknown'))")} AS OperationType, coalesce(IsActive, 0) <> 0 AS IsActive, LastModifiedOnDate
  FROM equip_source),
dim_equipment AS (SELECT row_number() OVER (ORDER BY EquipmentID) AS EquipmentKey, * FROM dim_equipment0)"""
FREIGHT = f"""freight_source AS (
  SELECT DISTINCT CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS ID,
    CASE l_returnflag WHEN 'R' THEN 'fret maritime' WHEN 'A' THEN 'fret aérien' END AS Designation FROM lineitem),
dim_freight0 AS (
  SELECT CAST(ID AS VARCHAR) AS FreightTypeID, {title("coalesce(Designation, 'Unknown')")} AS FreightTypeName, true AS IsActive FROM freight_source),
dim_freight AS (SELECT row_number() OVER (ORDER BY FreightTypeID) AS FreightTypeKey, * FROM dim_freight0)"""
TERMS = """terms_source AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS ID, ' ' || substr(o_orderpriority, 3) AS Designation,
    CASE WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'n/a' ELSE substr(o_orderpriority, 1, 1) || '0' END AS NumOfDays FROM orders),
dim_term0 AS (
  SELECT CAST(ID AS VARCHAR) AS PaymentTermID, trim(Designation) AS PaymentTermName,
    CAST(coalesce(TRY_CAST(NumOfDays AS DOUBLE), 0) AS INTEGER) AS PaymentDays, 1 AS IsActive FROM terms_source),
dim_term AS (SELECT row_number() OVER (ORDER BY PaymentTermID) AS PaymentTermKey, * FROM dim_term0)"""


def calendar(start: str, end: str) -> str:
    return f"""calendar AS (
  SELECT CAST(d AS TIMESTAMP) AS Date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, CAST(day(d) AS INTEGER) AS Day,
    CAST(month(d) AS INTEGER) AS Month, CAST(year(d) AS INTEGER) AS Year, CAST(quarter(d) AS INTEGER) AS Quarter,
    CAST(isodow(d) AS INTEGER) AS DayOfWeek, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS IsWeekend, 0 AS IsHoliday,
    {season('d', 'Autumn')} AS Season, strftime(d, '%Y-P%m') AS FiscalPeriod
  FROM (SELECT unnest(generate_series({start}, {end}, INTERVAL 1 DAY)) AS d))"""


FACT_START = "1996-01-01"
FACT_CALENDAR = calendar(f"DATE '{FACT_START}'", "DATE '2099-12-31'")
DOSSIERS = """dossiers AS (
  SELECT o_orderkey AS ID, CASE WHEN o_orderkey % 1000 = 7 THEN TIMESTAMP '2203-08-12' WHEN o_orderkey % 100 <> 3 THEN o_orderdate END AS DateDepart,
    o_orderdate + INTERVAL 30 DAY AS DateArrivee, o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS DateDepartReel,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 61 AS INTEGER)) END AS DateArriveeReel,
    CASE WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS ValMarchandise, CAST(o_custkey % 25 AS INTEGER) AS ID_LieuChargement,
    CAST(o_orderkey % 26 AS INTEGER) AS ID_LieuLivraison, CAST(o_orderkey % 3 + 1 AS INTEGER) AS ID_Freight FROM orders)"""
SHIP_ROWS = f"""{DOSSIERS},
ship_source AS (
  SELECT l_orderkey * 10 + l_linenumber AS ID, l_quantity AS Poids, CAST(p_size AS DOUBLE) AS Volume,
    CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS nbColis, ' ' || upper({party_name('c_custkey', 'c_name')}) || '  ' AS Client,
    CAST(substr(p_brand, 7) AS INTEGER) AS ID_Equipement, l_orderkey AS ID_Dossier, l_partkey, l_suppkey, l_extendedprice, l_shipdate
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
ship_rows AS (
  SELECT b.ID AS ShipmentID, coalesce(DateDepart, TIMESTAMP '2002-01-01') AS ShipmentDate, DateArrivee AS PlannedArrivalDate,
    DateDepartReel AS ActualDepartureDate, DateArriveeReel AS ActualArrivalDate, Poids AS TotalWeight, Volume AS TotalVolume,
    nbColis AS TotalPackages, ValMarchandise AS ShipmentValue, coalesce(Client, '') AS CustomerName,
    CAST(ID_LieuChargement AS VARCHAR) AS OriginLocationID, CAST(ID_LieuLivraison AS VARCHAR) AS DestinationLocationID,
    CAST(ID_Equipement AS VARCHAR) AS EquipmentID, CAST(ID_Freight AS VARCHAR) AS FreightTypeID,
    CASE WHEN DateArriveeReel IS NOT NULL THEN 1 ELSE 0 END AS IsDelivered,
    CAST(date_diff('day', DateDepart, DateArriveeReel) AS INTEGER) AS DurationDays, l_partkey, l_suppkey, l_extendedprice, l_shipdate
  FROM ship_source b LEFT JOIN dossiers d ON b.ID_Dossier = d.ID WHERE b.ID IS NOT NULL)"""
SHIP_TAGGED = f"""{CUSTOMERS}, {EQUIPMENT}, {FREIGHT}, {LOCATIONS}, {FACT_CALENDAR}, {SHIP_ROWS},
ship_tagged AS (
  SELECT r.*, CAST(strftime(ShipmentDate, '%Y%m%d') AS INTEGER) AS DateKey, CustomerKey, EquipmentKey, FreightTypeKey,
    o.LocationKey AS OriginLocationKey, t.LocationKey AS DestinationLocationKey,
    CASE WHEN k.DateKey IS NULL THEN 'invalid_datekey' WHEN CustomerKey IS NULL THEN 'unmatched_customer'
      WHEN EquipmentKey IS NULL THEN 'unmatched_equipment' WHEN FreightTypeKey IS NULL THEN 'unmatched_freight_type'
      WHEN o.LocationKey IS NULL OR t.LocationKey IS NULL THEN 'unmatched_location' END AS RejectReason
  FROM ship_rows r LEFT JOIN calendar k ON CAST(strftime(ShipmentDate, '%Y%m%d') AS INTEGER) = k.DateKey
    LEFT JOIN (SELECT trim(lower(CustomerName)) AS name, min(CustomerKey) AS CustomerKey FROM dim_customer GROUP BY 1) c
      ON trim(lower(r.CustomerName)) = c.name AND c.name <> 'unknown'
    LEFT JOIN dim_equipment e ON r.EquipmentID = e.EquipmentID LEFT JOIN dim_freight f ON r.FreightTypeID = f.FreightTypeID
    LEFT JOIN dim_location o ON r.OriginLocationID = o.LocationID LEFT JOIN dim_location t ON r.DestinationLocationID = t.LocationID)"""
FACT_SHIPMENTS = f"""{SHIP_TAGGED},
fact_shipments AS (
  SELECT ShipmentID, DateKey, CustomerKey, EquipmentKey, FreightTypeKey, OriginLocationKey, DestinationLocationKey, ShipmentDate,
    PlannedArrivalDate, ActualDepartureDate, ActualArrivalDate, coalesce(TotalWeight, 0) AS TotalWeight,
    coalesce(TotalVolume, 0) AS TotalVolume, coalesce(TotalPackages, 0) AS TotalPackages, coalesce(ShipmentValue, 0) AS ShipmentValue,
    coalesce(DurationDays, 0) AS DurationDays, IsDelivered
  FROM ship_tagged WHERE RejectReason IS NULL
  QUALIFY row_number() OVER (PARTITION BY ShipmentID ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1)"""
INVOICE_ROWS = f"""{INV},
invoice_rows AS (
  SELECT InvoiceID, InvoiceDate, upper(CASE WHEN s_suppkey % 31 <> 30 THEN {party_name('s_suppkey', 's_name')} ELSE 'inconnu & fils' END) AS SupplierName,
    NULL::VARCHAR AS CustomerName, TotalAmount, CASE PaymentStatus WHEN 4 THEN 0 ELSE TaxAmount END AS TaxAmount,
    CASE PaymentStatus WHEN 4 THEN 0 ELSE NetAmount END AS NetAmount, CASE PaymentStatus WHEN 1 THEN 'zzz' ELSE CAST(PaymentStatus AS VARCHAR) END AS PaymentStatus,
    PaymentDueDate, CASE WHEN s_suppkey % 17 <> 0 THEN CAST(PaymentTermKey AS VARCHAR) ELSE 'nan' END AS PaymentTermID, InvoiceType
  FROM purchases JOIN supplier ON SupplierKey - 1 = s_suppkey WHERE s_suppkey % 13 = 0 OR s_suppkey % 11 <> 0
  UNION ALL
  SELECT InvoiceID, InvoiceDate, NULL, upper({party_name('c_custkey', 'c_name')}), TotalAmount, TaxAmount, TotalAmount,
    CASE PaymentStatus WHEN 1 THEN 'Validée' WHEN 2 THEN 'Payée' ELSE 'En attente' END, PaymentDueDate, CAST(PaymentTermKey AS VARCHAR), InvoiceType
  FROM sales JOIN customer ON CustomerKey - 1 = c_custkey WHERE InvoiceID % 500 <> 499)"""
INV_TAGGED = f"""{CUSTOMERS}, {SUPPLIERS}, {TERMS}, {FACT_CALENDAR}, {INVOICE_ROWS},
parties AS (
  SELECT InvoiceType, PartyName, min(PartyKey) AS PartyKey FROM (
    SELECT 'Sales' AS InvoiceType, {fold('CustomerName')} AS PartyName, CustomerKey AS PartyKey FROM dim_customer
    UNION ALL SELECT 'Purchase', {fold('SupplierName')}, SupplierKey FROM dim_supplier)
  WHERE PartyName <> 'unknown' GROUP BY 1, 2),
named AS (SELECT *, {fold("CASE InvoiceType WHEN 'Sales' THEN CustomerName ELSE SupplierName END")} AS PartyName,
  TRY_CAST(PaymentTermID AS BIGINT) AS TermID FROM invoice_rows),
inv_tagged AS (
  SELECT n.*, k.DateKey, PartyKey, PaymentTermKey, PaymentDays,
    CASE WHEN k.DateKey IS NULL THEN 'invalid_datekey' WHEN PartyKey IS NULL AND n.InvoiceType = 'Sales' THEN 'unmatched_customer'
      WHEN PartyKey IS NULL THEN 'unmatched_supplier' END AS RejectReason
  FROM named n LEFT JOIN calendar k ON n.InvoiceDate = k.Date
    LEFT JOIN parties p ON n.InvoiceType = p.InvoiceType AND n.PartyName = p.PartyName
    LEFT JOIN dim_term t ON n.TermID = CAST(t.PaymentTermID AS BIGINT))"""
STATUS = """CASE PaymentStatus WHEN 'Validée' THEN 1 WHEN 'Payée' THEN 2 WHEN 'En attente' THEN 3 WHEN 'Annulée' THEN 4
      ELSE coalesce(CAST(TRY_CAST(PaymentStatus AS DOUBLE) AS INTEGER), 0) END"""
FACT_INVOICES = f"""{INV_TAGGED},
fact_invoices0 AS (
  SELECT InvoiceID, InvoiceDate, DateKey, CASE InvoiceType WHEN 'Sales' THEN PartyKey ELSE 0 END AS CustomerKey,
    CASE InvoiceType WHEN 'Sales' THEN 0 ELSE PartyKey END AS SupplierKey, TotalAmount, TaxAmount,
    CASE WHEN TaxAmount = 0 AND NetAmount = 0 AND TotalAmount <> 0 THEN TotalAmount ELSE NetAmount END AS NetAmount,
    {STATUS} AS PaymentStatus, coalesce(PaymentDueDate, InvoiceDate + to_days(coalesce(PaymentDays, 30))) AS PaymentDueDate,
    coalesce(PaymentTermKey, 0) AS PaymentTermKey, InvoiceType
  FROM inv_tagged WHERE RejectReason IS NULL),
fact_invoices AS (SELECT * FROM fact_invoices0 QUALIFY row_number() OVER (PARTITION BY InvoiceID
  ORDER BY InvoiceDate DESC, InvoiceType DESC, CustomerKey, SupplierKey, TotalAmount, TaxAmount) = 1)"""

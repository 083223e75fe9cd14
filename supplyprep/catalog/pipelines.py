"""Queries of the feed pipelines on stand-in feeds made from order lines and parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.catalog.registry import query
from supplyprep.catalog.tables import RUN, Tables, day, qty
from supplyprep.plans import asn, inventory, movements, source_map
from supplyprep.sources.writers import append

# Site of an order line by its two flags: flags, site, feed, monitor flag.
SITES = (
    ("AF", "QUANTA", "SCC", "N"),
    ("AO", "LCFC", "SCC", "Y"),
    ("NF", "WISTRON", "SCC", "N"),
    ("NO", "COMPAL", "FTP", "N"),
    ("RF", "PTSN", "FTP", "N"),
    ("RO", "BITLAND", "FTP", "N"),
)
SITE_CASE = "CASE l_returnflag || l_linestatus " + " ".join(
    f"WHEN '{flags}' THEN '{site}'" for flags, site, _, _ in SITES
) + " END"
FTP_SITES = "('COMPAL', 'PTSN', 'BITLAND')"


def site_conf(t: Tables, *more: tuple) -> DataFrame:
    rows = [
        ("ODM_CODE", "SITE", site, site[:3], feed, feed, feed, monitor)
        for _, site, feed, monitor in SITES
    ]
    columns = "pdomain, pname, pvalue, pattribute, bom_source, inv_source, asn_source, monitor_flag"
    return t.values(columns, *rows, *more)


def lines(t: Tables) -> DataFrame:
    """Order lines with their part, as site rows."""
    part = t.part.select("p_partkey", "p_brand", "p_type", "p_size", "p_name")
    joined = t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    size = F.col("p_size").cast("string")
    item = (
        F.when(F.col("p_size") == 7, "N/A")
        .when(F.col("p_size") > 25, F.concat("p_brand", F.lit("X"), size))
        .otherwise(F.col("p_brand"))
    )
    bu = F.expr(
        "CASE p_type WHEN 'SMALL' THEN 'T-NB' WHEN 'LARGE' THEN 'ISG' WHEN 'PROMO' THEN 'Mobile1' "
        "WHEN 'MEDIUM' THEN 'SD' WHEN 'ECONOMY' THEN 'L-DT' END"
    )
    order = F.expr("CASE WHEN l_linenumber <= 3 THEN 'LBG' WHEN l_linenumber <= 5 THEN 'TBG' ELSE 'X' END")
    return joined.select(
        F.expr(SITE_CASE).alias("odm"),
        item.alias("item"),
        F.concat("p_brand", F.lit("Y"), size).alias("site_pn"),
        bu.alias("bu"),
        order.alias("cto_po"),
        F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("location"),
        F.when(F.col("l_tax") < 0.05, "20010802").otherwise("20010801").alias("version"),
        day("l_shipdate").alias("created"),
        "l_quantity",
        "l_discount",
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
        "p_type",
        "p_size",
        "p_brand",
        "p_name",
    )


LINES_SQL = f"""f AS (SELECT {SITE_CASE} AS odm,
    CASE WHEN p_size = 7 THEN 'N/A' WHEN p_size > 25 THEN p_brand || 'X' || p_size ELSE p_brand END AS item,
    p_brand || 'Y' || p_size AS site_pn,
    CASE p_type WHEN 'SMALL' THEN 'T-NB' WHEN 'LARGE' THEN 'ISG' WHEN 'PROMO' THEN 'Mobile1'
      WHEN 'MEDIUM' THEN 'SD' WHEN 'ECONOMY' THEN 'L-DT' END AS bu,
    CASE WHEN l_linenumber <= 3 THEN 'LBG' WHEN l_linenumber <= 5 THEN 'TBG' ELSE 'X' END AS cto_po,
    'L' || l_linenumber AS location, CASE WHEN l_tax < 0.05 THEN '20010802' ELSE '20010801' END AS version,
    CAST(l_shipdate AS DATE) AS created, l_quantity, l_discount, l_orderkey, l_linenumber, l_suppkey,
    l_partkey, p_type, p_size, p_brand, p_name
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""
KNOWN_SQL = "(SELECT p_brand FROM part)"
PREFIX_SQL = f"""CASE WHEN item IN {KNOWN_SQL} THEN item
    WHEN substr(site_pn, 1, 7) IN {KNOWN_SQL} THEN substr(site_pn, 1, 7)
    WHEN substr(site_pn, 1, 10) IN {KNOWN_SQL} THEN substr(site_pn, 1, 10) ELSE item END"""


def components(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_brand").alias("component")).distinct()


def inventory_feeds(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = lines(t).withColumns(
        {"inv_qty": qty("l_quantity"), "create_time": F.col("created").cast("timestamp_ntz")}
    )
    main, monitored = rows.filter("l_quantity <= 30"), rows.filter("l_quantity > 30")
    item = F.when(F.col("odm") == "COMPAL", F.concat("item", F.lit("/Z"))).when(
        F.col("odm") == "BITLAND", F.concat("item", F.lit("ForLCFC"))
    )
    files = rows.filter("l_discount > 0.05").withColumns(
        {
            "item": item,
            "eff_start": F.col("create_time"),
            "src_created_at": F.col("create_time"),
        }
    )
    return main, monitored, files


SOURCE_SQL = f"""{LINES_SQL},
g AS (SELECT * FROM f WHERE bu NOT IN ('ISG', 'FCCL') AND bu NOT LIKE 'Mobile%' AND item NOT IN ('N/A', ' ')),
src AS (
  SELECT odm, item, site_pn, sum(l_quantity) AS q, max(created) AS eff_start, cto_po, bu FROM g
  WHERE l_quantity <= 30 AND version = '20010802' AND odm IN ('QUANTA', 'WISTRON') GROUP BY ALL
  UNION ALL
  SELECT odm, item, site_pn, sum(l_quantity), max(created), cto_po, bu FROM g
  WHERE l_quantity > 30 AND odm = 'PTSN' AND location IN ('L1', 'L2')
    AND version = (SELECT max(version) FROM f WHERE l_quantity > 30 AND odm = 'PTSN') GROUP BY ALL
  UNION ALL
  SELECT odm, item, site_pn, sum(l_quantity), max(created), cto_po, bu FROM g
  WHERE l_quantity > 30 AND version = '20010802' AND odm = 'LCFC' GROUP BY ALL
  UNION ALL
  SELECT odm, CASE odm WHEN 'COMPAL' THEN item || '/Z' WHEN 'BITLAND' THEN item || 'ForLCFC' END,
    site_pn, l_quantity, created, cto_po, bu FROM f WHERE l_discount > 0.05 AND odm IN {FTP_SITES}),
inv AS (
  SELECT odm, CASE odm WHEN 'WISTRON' THEN {PREFIX_SQL}
      WHEN 'BITLAND' THEN replace(item, 'ForLCFC', '')
      WHEN 'COMPAL' THEN split_part(item, '/', 1) ELSE coalesce(item, site_pn) END AS item,
    site_pn, q, eff_start, cto_po,
    CASE odm WHEN 'QUANTA' THEN CASE cto_po WHEN 'LBG' THEN 'IDEANB' WHEN 'TBG' THEN 'THINKNB' ELSE bu END
      WHEN 'LCFC' THEN CASE bu WHEN 'T-NB' THEN 'THINKNB' WHEN 'L-DT' THEN 'IDEADT' WHEN 'SD' THEN 'NOUSE' ELSE bu END
      ELSE bu END AS bu FROM src)"""


def built_inventory(t: Tables) -> DataFrame:
    locations = t.values(
        "odm, odm_location, status, location_type",
        ("PTSN", "L1", "Active", "inspection"),
        ("PTSN", "L2", "Active", "unrestricted"),
        ("PTSN", "L3", "Closed", "inspection"),
        ("PTSN", "L4", "Active", "blocked"),
    )
    main, monitored, files = inventory_feeds(t)
    return inventory.build_inventory(
        main, monitored, files, locations, site_conf(t), components(t), RUN
    )


@query(
    "q_inventory",
    f"""WITH {SOURCE_SQL}
SELECT odm, item, site_pn, CAST(q AS DOUBLE) AS inv_qty, eff_start, cto_po, bu FROM inv""",
)
def q_inventory(t: Tables) -> DataFrame:
    return built_inventory(t).select(
        "odm",
        "item",
        "site_pn",
        F.col("inv_qty").cast("double").alias("inv_qty"),
        F.to_date("eff_start").alias("eff_start"),
        "cto_po",
        "bu",
    )


@query(
    "q_inventory_history",
    f"""WITH {SOURCE_SQL},
h AS (SELECT odm, CASE WHEN length(item) = 7 THEN lpad(item, 12, '0') ELSE item END AS item,
    CASE WHEN length(site_pn) = 7 THEN lpad(site_pn, 12, '0') ELSE site_pn END AS site_pn, q, cto_po, bu FROM inv),
p AS (SELECT p_brand AS product, min(p_name) AS bu, CASE WHEN min(p_size) > 1 THEN 'OPTION' ELSE 'NB' END AS c
  FROM part WHERE p_brand > 'Brand#3' GROUP BY 1)
SELECT odm, item, site_pn, CAST(q AS DOUBLE) AS inv_qty, CASE WHEN odm = 'QUANTA' THEN cto_po
  WHEN odm <> 'WISTRON' THEN bu
  WHEN item IN (SELECT product FROM p WHERE c = 'OPTION') THEN 'THINKNB'
  WHEN item IN (SELECT product FROM p) THEN (SELECT p.bu FROM p WHERE product = item)
  WHEN item <> site_pn THEN 'THINKNB'
  WHEN item = site_pn AND item IN {KNOWN_SQL} THEN 'IDEANB'
  ELSE coalesce(h.bu, (SELECT min(p_type) FROM part WHERE p_brand || 'Y' || p_size = site_pn)) END AS bu
FROM h""",
)
def q_inventory_history(t: Tables) -> DataFrame:
    product = (
        t.part.filter("p_brand > 'Brand#3'")
        .groupBy(F.col("p_brand").alias("product"))
        .agg(
            F.min("p_name").alias("bu"),
            F.when(F.min("p_size") > 1, "OPTION").otherwise("NB").alias("hier6_code"),
            F.lit("OTHER").alias("brand"),
        )
    )
    comp_bu = t.part.select(
        F.concat("p_brand", F.lit("Y"), F.col("p_size").cast("string")).alias("comp"),
        F.lit("WISTRON").alias("werks"),
        F.col("p_type").alias("bu"),
    )
    rows = inventory.inventory_history(built_inventory(t), components(t), product, comp_bu)
    return rows.select(
        "odm", "item", "site_pn", F.col("inv_qty").cast("double").alias("inv_qty"), "bu"
    )


# --- shipment notices -------------------------------------------------------------------------------


def suppliers(t: Tables) -> DataFrame:
    kind = F.when(F.col("s_acctbal") > 3000, "INHOUSE").otherwise("ODM")
    return t.supplier.select(
        (F.col("s_suppkey") % 40).cast("string").alias("supplierid"),
        F.lower(F.concat("s_name", F.lit("-"), "s_nationkey")).alias("supplierdesc"),
        kind.alias("flag"),
    )


SUPPLIER_SQL = """sup AS (
  SELECT CAST(s_suppkey % 40 AS VARCHAR) AS id, upper(s_name || '-' || s_nationkey) AS name,
    CASE WHEN s_acctbal > 3000 THEN 'INHOUSE' ELSE 'ODM' END AS flag FROM supplier),
site AS (SELECT upper(s_name || '-' || s_nationkey) AS name, 'V' || s_suppkey AS code FROM supplier WHERE s_acctbal < 5000),
smap AS (
  SELECT id AS supplierid, name AS supplierdesc, flag FROM (
    SELECT id, name, flag FROM sup WHERE flag = 'INHOUSE'
    UNION SELECT coalesce(sup.id, code), site.name, 'ODM' FROM site
    LEFT JOIN sup ON sup.name = site.name AND sup.flag = 'ODM')
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY name) = 1)"""


def supplier_conf(t: Tables) -> DataFrame:
    """Configuration rows: suppliers of small balance are sites; half of them are monitored."""
    return t.supplier.filter("s_acctbal < 5000").select(
        F.lit("ODM_CODE").alias("pdomain"),
        F.lit("SITE").alias("pname"),
        F.upper(F.concat("s_name", F.lit("-"), "s_nationkey")).alias("pvalue"),
        F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("pattribute"),
        F.lit("SCC").alias("asn_source"),
        F.when(F.col("s_nationkey") < 12, "N").otherwise("Y").alias("monitor_flag"),
    )


@query("q_supplier_map", f"WITH {SUPPLIER_SQL} SELECT * FROM smap")
def q_supplier_map(t: Tables) -> DataFrame:
    return asn.supplier_map(suppliers(t), supplier_conf(t))


def notice_view(t: Tables, linestatus: str) -> DataFrame:
    rows = t.lineitem.filter(F.col("l_linestatus") == linestatus)
    supplier = t.supplier.select("s_suppkey", "s_acctbal", "s_nationkey")
    joined = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        t.orders.select("o_orderkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    code = F.when(F.col("s_acctbal") < 5000, F.concat(F.lit("V"), F.col("l_suppkey"))).otherwise(
        (F.col("l_suppkey") % 40).cast("string")
    )
    return joined.select(
        F.col("l_orderkey").cast("string").alias("asn_no"),
        F.col("l_linenumber").cast("string").alias("asn_line"),
        F.col("l_orderkey").cast("string").alias("po"),
        F.col("l_linenumber").cast("string").alias("po_line"),
        code.alias("vendor_code"),
        F.lit("ignored").alias("vendor_name"),
        F.expr("CASE WHEN l_linenumber = 7 THEN 'H301' ELSE 'P' || l_linenumber END").alias("plant_code"),
        day("l_shipdate").alias("ship_date"),
        F.lit("v").alias("vendor_pn"),
        F.lit("item").alias("item"),
        F.lit("d").alias("delivery_no"),
        F.lit("1").alias("delivery_line"),
        qty("l_quantity").alias("delivery_qty"),
        F.when(F.col("o_orderstatus") == "O", "Open").otherwise("Closed").alias("status"),
        F.lit("Standard po").alias("order_type_desc"),
        F.when(F.col("l_tax") < 0.07, "IDG").otherwise("ISG").alias("bu"),
        F.lit("g").alias("purchase_group"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'LOI' WHEN 'N' THEN 'SOI' END").alias("procurement_mode"),
        F.when(F.col("s_nationkey") < 6, "HUB A").otherwise("x").alias("incoterms_location"),
        F.lit(None).cast("timestamp").alias("sys_created_date"),
        # The part key makes the newest row of a notice unique.
        F.timestamp_micros(F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("sys_modify_date"),
    )


NOTICE_SQL = f"""{SUPPLIER_SQL},
v AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN s_acctbal < 5000 THEN 'V' || l_suppkey ELSE CAST(l_suppkey % 40 AS VARCHAR) END AS vendor,
    CASE WHEN l_linenumber = 7 THEN 'H301' ELSE 'P' || l_linenumber END AS plant, l_quantity, l_returnflag,
    s_nationkey, s_acctbal, l_linestatus, l_partkey * 1000 + l_suppkey AS changed
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderstatus = 'O' AND l_tax < 0.07 AND s_acctbal < 5000
    AND CASE l_linestatus WHEN 'F' THEN s_nationkey < 12 ELSE s_nationkey >= 12 END),
n AS (
  SELECT * FROM v WHERE plant <> 'H301' QUALIFY row_number() OVER (
    PARTITION BY l_linestatus, plant, l_orderkey, l_linenumber ORDER BY changed DESC) = 1),
m AS (
  SELECT n.*, supplierdesc, flag, CASE l_returnflag WHEN 'A' THEN 'LOI' WHEN 'N' THEN 'SOI'
    ELSE CASE WHEN flag = 'INHOUSE' THEN 'LOI' WHEN s_nationkey < 6 THEN 'SOI' ELSE 'LOI' END END AS mode
  FROM n JOIN smap ON supplierid = vendor)"""


@query(
    "q_asn",
    f"""WITH {NOTICE_SQL}
SELECT CAST(l_orderkey AS VARCHAR) AS po, vendor AS supplier_id, supplierdesc AS supplier_name, plant AS ship_to,
  CASE WHEN flag = 'INHOUSE' OR mode = 'LOI' THEN plant ELSE supplierdesc END AS plant_code,
  CAST(l_quantity AS DOUBLE) AS delivery_qty, mode AS procurement_mode,
  CASE WHEN flag = 'INHOUSE' THEN 'INHOUSE TO INHOUSE' ELSE 'ODM TO INHOUSE' END AS trans_type, 'SFG' AS measure FROM m
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), '0001000338', 'LCFC', odm, odm, CAST(l_quantity AS DOUBLE), 'SOI', 'ODM TO ODM', 'SFG'
FROM (SELECT CASE l_returnflag WHEN 'A' THEN 'AVC' WHEN 'N' THEN 'QUANTA' ELSE 'OTHER' END AS odm, l_orderkey,
    l_quantity, strftime(l_shipdate, '%Y%m%d') AS version FROM lineitem WHERE l_linestatus = 'O')
WHERE odm = 'QUANTA' OR odm = 'AVC' AND version = (SELECT max(strftime(l_shipdate, '%Y%m%d')) FROM lineitem
  WHERE l_returnflag = 'A' AND l_linestatus = 'O')
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), 'H', 'Hub', site.name, 'HP',
  CASE WHEN l_returnflag = 'A' THEN l_quantity
    ELSE greatest(coalesce(nullif(l_quantity, 1), 0) - coalesce(nullif(l_linenumber * 5, 10), 0), 0) END,
  'LOI', 'HUB TO ODM', 'PN'
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN site ON site.name = upper(s_name || '-' || s_nationkey)
WHERE l_returnflag IN ('A', 'N')""",
)
def q_asn(t: Tables) -> DataFrame:
    version = F.date_format("l_shipdate", "yyyyMMdd")
    between = t.lineitem.filter("l_linestatus = 'O'").select(
        F.expr("CASE l_returnflag WHEN 'A' THEN 'AVC' WHEN 'N' THEN 'QUANTA' ELSE 'OTHER' END").alias("odm"),
        F.col("l_orderkey").cast("string").alias("po"),
        F.col("l_linenumber").cast("string").alias("po_line"),
        qty("l_quantity").alias("delivery_qty"),
        version.alias("version"),
        F.lit("open").alias("status"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in ("asn", "asn_line", "odm_pn", "item", "delivery_note", "delivery_line", "bu")
        ],
        day("l_shipdate").alias("ship_date"),
        F.lit(None).cast("timestamp").alias("create_time"),
    )
    supplier = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    hub_lines = t.lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    hub = hub_lines.select(
        F.col("l_orderkey").cast("string").alias("odm_po"),
        F.lit("H").alias("vendor_code"),
        F.lit("Hub").alias("vendor_name"),
        F.lower(F.concat("s_name", F.lit("-"), "s_nationkey")).alias("customer_name"),
        F.lit("HP").alias("plant"),
        day("l_shipdate").alias("new_eta"),
        F.nullif(qty("l_quantity"), F.lit(1)).alias("asn_qty"),
        F.nullif(F.col("l_linenumber") * 5, F.lit(10)).alias("gr_qty"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'In transit late' WHEN 'N' THEN 'mismatch' ELSE 'done' END").alias("status"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in ("item", "supplier_delivery_no", "supplier_delivery_line", "bu")
        ],
        F.lit(None).cast("timestamp").alias("sys_created_date"),
        F.lit(None).cast("timestamp").alias("sys_modify_date"),
    ).withColumn(
        "asn_qty",
        F.when(F.col("status").startswith("In"), F.coalesce("asn_qty", F.lit(1))).otherwise(F.col("asn_qty")),
    )
    sites = t.values(
        "pdomain, pname, pvalue, pattribute, asn_source, monitor_flag",
        ("INTRANSIT", "TO_ODM", None, "AVC", "SCC", "N"),
        ("INTRANSIT", "TO_ODM", None, "QUANTA", "SCC", "N"),
    )
    conf = supplier_conf(t).unionByName(sites, allowMissingColumns=True)
    result = asn.build_asn(
        notice_view(t, "F"), notice_view(t, "O"), between, hub, suppliers(t), conf, ["HUB A"]
    )
    return result.select(
        "po",
        "supplier_id",
        "supplier_name",
        "ship_to",
        "plant_code",
        F.col("delivery_qty").cast("double").alias("delivery_qty"),
        "procurement_mode",
        "trans_type",
        "measure",
    )


# --- movements -------------------------------------------------------------------------------------


def text_place() -> Column:
    return F.concat(F.lit("to "), F.lower("p_name"), F.lit(" hall"))


@query(
    "q_shipment",
    f"""WITH {LINES_SQL},
s AS (SELECT odm, site_pn, coalesce(nullif(item, 'N/A'), site_pn) AS item, created AS ship_date,
    'to ' || p_name || ' hall' AS ship_to, sum(l_quantity) AS q
  FROM (SELECT CASE WHEN odm = 'COMPAL' THEN 'LITEON' ELSE odm END AS odm, * EXCLUDE (odm) FROM f)
  WHERE odm IN ('LITEON', 'PTSN', 'BITLAND') AND length(coalesce(nullif(item, 'N/A'), site_pn)) <= 30 GROUP BY ALL)
SELECT odm, site_pn, item, ship_date, CAST(q AS DOUBLE) AS ship_qty, CASE WHEN odm <> 'LITEON' THEN ship_to
  WHEN contains(ship_to, 'ring') THEN 'ring' WHEN contains(ship_to, 'red') THEN 'red'
  WHEN contains(ship_to, 'bolt') THEN 'bolt' ELSE ship_to END AS ship_to FROM s""",
)
def q_shipment(t: Tables) -> DataFrame:
    conf = site_conf(
        t,
        ("ODM_CODE", "SITE", "LITEON", "LIT", "FTP", "FTP", "FTP", "N"),
        *[("INTRANSIT", "DESTINATION", None, w, None, None, None, "N") for w in ("red", "ring", "bolt")],
    )
    feed = lines(t).select(
        F.when(F.col("odm") == "COMPAL", "LITEON").otherwise(F.col("odm")).alias("odm"),
        "site_pn",
        F.nullif("item", F.lit("N/A")).alias("item"),
        qty("l_quantity").alias("ship_qty"),
        F.col("created").alias("ship_date"),
        text_place().alias("ship_to"),
        F.col("created").alias("src_created_at"),
    )
    rows = movements.build_shipment(feed, conf, RUN)
    return rows.select(
        "odm", "site_pn", "item", "ship_date", F.col("ship_qty").cast("double").alias("ship_qty"), "ship_to"
    )


WIP_CONF = tuple(
    ("ODM_CODE", "SITE", site, site, "FTP", "FTP", "FTP", "N") for _, site, _, _ in SITES
)


def all_file_conf(t: Tables) -> DataFrame:
    columns = "pdomain, pname, pvalue, pattribute, bom_source, inv_source, asn_source, monitor_flag"
    return t.values(columns, *WIP_CONF)


FAMILY_SQL = """fam AS (SELECT p_brand AS comp, CASE WHEN count(*) = 1 THEN max(p_type) ELSE 'IdeaNB' END AS bu
  FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size > 47) GROUP BY 1)"""


def family(t: Tables, *sites: str) -> DataFrame:
    rows = t.part.filter("p_size > 47").select(F.col("p_brand").alias("comp"), F.col("p_type").alias("bu"))
    return rows.withColumn("werks", F.explode(F.array(*[F.lit(s) for s in sites])))


@query(
    "q_wip",
    f"""WITH {LINES_SQL}, {FAMILY_SQL},
w AS (SELECT odm, CASE WHEN odm = 'WISTRON' THEN {PREFIX_SQL} ELSE item END AS item, site_pn, l_quantity, bu, l_orderkey, l_linenumber FROM f)
SELECT odm, CASE WHEN length(w.item) = 7 THEN lpad(w.item, 12, '0') ELSE w.item END AS item, site_pn, l_quantity AS wip_qty,
  CASE WHEN odm IN ('WISTRON', 'QUANTA') AND length(w.item) <> 7 THEN coalesce(
      (SELECT min(p_name) FROM part WHERE p_brand = w.item AND p_size = 1),
      (SELECT fam.bu FROM fam WHERE comp = w.item), w.bu) ELSE w.bu END AS bu, l_orderkey
FROM w""",
)
def q_wip(t: Tables) -> DataFrame:
    feed = lines(t).withColumns(
        {"wip_qty": F.col("l_quantity"), "src_created_at": F.col("created")}
    )
    # The order key travels in the load time so that rows stay apart.
    feed = feed.withColumn("src_created_at", F.col("l_orderkey"))
    wip = movements.build_wip(feed, all_file_conf(t), components(t), RUN)
    product = t.part.filter("p_size = 1").groupBy(F.col("p_brand").alias("product")).agg(
        F.min("p_name").alias("hier6_code")
    )
    rows = movements.wip_history(wip, family(t, "WISTRON", "QUANTA"), product)
    return rows.select("odm", "item", "site_pn", "wip_qty", "bu", F.col("src_created_at").alias("l_orderkey"))


@query(
    "q_reservation",
    f"""WITH {LINES_SQL}, {FAMILY_SQL},
r AS (SELECT CASE WHEN odm = 'BITLAND' THEN 'LITEON' ELSE odm END AS odm, site_pn,
    CASE WHEN item = 'N/A' THEN site_pn WHEN length(item) = 7 THEN lpad(item, 12, '0') ELSE item END AS item,
    l_quantity, CASE WHEN odm = 'BITLAND' THEN CASE cto_po WHEN 'TBG' THEN 'ThinkDT' WHEN 'LBG' THEN 'IdeaDT' ELSE cto_po END END AS bu,
    l_orderkey FROM f),
k AS (SELECT odm, CASE WHEN odm = 'WISTRON' THEN {PREFIX_SQL} ELSE item END AS item, site_pn, l_quantity, bu, l_orderkey FROM r),
b AS (SELECT *, coalesce((SELECT min(p_name) FROM part WHERE p_brand = item AND p_size = 1), bu) AS bu1 FROM k)
SELECT odm, item, site_pn AS site_item, l_quantity AS res_qty, l_orderkey, CASE
  WHEN odm = 'WISTRON' THEN CASE WHEN item <> site_pn THEN 'ThinkNB' WHEN item IN {KNOWN_SQL} THEN 'IdeaNB'
      ELSE coalesce(bu1, (SELECT min(p_type) FROM part WHERE p_brand = site_pn AND p_size > 47)) END
  WHEN odm = 'QUANTA' THEN coalesce((SELECT fam.bu FROM fam WHERE comp = item), bu1) ELSE bu1 END AS bu FROM b""",
)
def q_reservation(t: Tables) -> DataFrame:
    feed = lines(t).select(
        F.when(F.col("odm") == "BITLAND", "LITEON").otherwise(F.col("odm")).alias("odm"),
        F.col("site_pn").alias("odm_item"),
        F.when(F.col("item") == "N/A", " ").otherwise(F.concat("item", F.lit("-"))).alias("item"),
        F.col("l_quantity").alias("res_qty"),
        F.col("l_orderkey").alias("res_date"),
        F.concat("cto_po", F.lit("\r\n")).alias("bu"),
    )
    conf = append(
        all_file_conf(t),
        t.values(
            "pdomain, pname, pvalue, pattribute, bom_source, inv_source, asn_source, monitor_flag",
            ("ODM_CODE", "SITE", "LITEON", "LIT", "FTP", "FTP", "FTP", "N"),
        ),
    )
    product = t.part.filter("p_size = 1").groupBy(F.col("p_brand").alias("product")).agg(
        F.min("p_name").alias("hier6_code")
    )
    rows = movements.build_reservation(feed, conf, components(t), product, RUN)
    rows = movements.reservation_history(rows, components(t), family(t, "WISTRON", "QUANTA"))
    return rows.select("odm", "item", "site_item", "res_qty", F.col("res_date").alias("l_orderkey"), "bu")


@query(
    "q_fru",
    "SELECT upper(lower(p_type)) AS odm, p_brand AS site_pn, p_name AS item, p_size AS basicname FROM part",
)
def q_fru(t: Tables) -> DataFrame:
    feed = t.part.select(
        F.lower("p_type").alias("odm"),
        F.col("p_brand").alias("site_pn"),
        F.col("p_name").alias("item"),
        F.col("p_size").alias("basicname"),
    )
    return movements.build_fru(feed, RUN).drop("created_by", "created_at")


@query(
    "q_fru_forecast",
    f"""WITH {LINES_SQL},
w AS (SELECT upper(odm) AS odm, CASE WHEN odm = 'WISTRON' THEN {PREFIX_SQL} ELSE item END AS item, site_pn, l_quantity, l_orderkey
  FROM f WHERE date_trunc('week', created) = DATE '2001-07-30')
SELECT odm, item, site_pn AS site_item, l_quantity AS fru_qty, l_orderkey, CASE WHEN odm = 'WISTRON' THEN CASE
  WHEN item <> site_pn THEN 'ThinkNB' WHEN item IN {KNOWN_SQL} AND length(item) <> 7 THEN 'IdeaNB' END END AS bu FROM w""",
)
def q_fru_forecast(t: Tables) -> DataFrame:
    feed = lines(t).select(
        F.lower("odm").alias("odm"),
        F.col("site_pn").alias("odm_item"),
        "item",
        F.col("l_quantity").alias("fru_qty"),
        F.col("l_orderkey").alias("req_date"),
        F.col("created").alias("sys_created_date"),
    )
    rows = movements.build_fru_forecast(feed, components(t), components(t), family(t, "WISTRON"), RUN)
    return rows.select("odm", "item", "site_item", "fru_qty", F.col("req_date").alias("l_orderkey"), "bu")


@query(
    "q_intransit",
    f"""WITH {LINES_SQL},
a AS (SELECT odm, nullif(site_pn, 'x') AS odm_pn, nullif(item, 'N/A') AS item, l_quantity, created, version,
    p_type IN ('SMALL', 'LARGE', 'MEDIUM') AS open FROM f),
n AS (SELECT * FROM a WHERE version = (SELECT max(version) FROM a m WHERE m.odm = a.odm) AND open),
pm AS (SELECT DISTINCT p_brand || 'Y' || p_size AS code, p_name AS packing FROM part WHERE p_size < 4),
u AS (
  SELECT odm, site_pn, item, created AS ship_date, 'dock' AS ship_to, sum(l_quantity) AS q FROM (
    SELECT odm, site_pn, coalesce(nullif(item, 'N/A'), site_pn) AS item, created, l_quantity FROM f WHERE odm IN {FTP_SITES})
  GROUP BY ALL
  UNION ALL
  SELECT odm, odm_pn, coalesce(item, odm_pn), created, odm, sum(l_quantity) FROM n WHERE odm IN ('WISTRON', 'LCFC') GROUP BY ALL
  UNION ALL
  SELECT odm, odm_pn, packing, created, odm, sum(l_quantity) FROM n JOIN pm ON odm_pn = code WHERE odm = 'COMPAL' GROUP BY ALL)
SELECT odm, site_pn, CASE WHEN odm = 'WISTRON' AND item NOT IN {KNOWN_SQL} AND substr(site_pn, 1, 10) IN {KNOWN_SQL}
  THEN substr(site_pn, 1, 10) ELSE item END AS item, ship_date, ship_to, CAST(q AS DOUBLE) AS ship_qty FROM u""",
)
def q_intransit(t: Tables) -> DataFrame:
    rows = lines(t)
    item = F.nullif("item", F.lit("N/A"))
    files = rows.select(
        "odm", "site_pn", item.alias("item"), qty("l_quantity").alias("ship_qty"),
        F.col("created").alias("ship_date"), F.lit("dock").alias("ship_to"), F.col("created").alias("src_created_at"),
    )
    open_types = F.col("p_type").isin("SMALL", "LARGE", "MEDIUM")
    moves = rows.select(
        "odm", F.col("site_pn").alias("odm_pn"), item.alias("item"), qty("l_quantity").alias("delivery_qty"),
        F.col("created").alias("ship_date"), F.col("created").alias("create_time"), "version",
        F.when(open_types, "open").otherwise("closed").alias("status"),
        F.lit("ODM Internal Rebalance").alias("procurement_mode"), F.lit("x-nb").alias("bu"),
    )
    source = t.part.select(
        F.lit("COMPAL_VN").alias("from_odm"),
        F.concat("p_brand", F.lit("Y"), F.col("p_size").cast("string")).alias("odmpn_instransit"),
        F.lit("any").alias("odm_pn"),
        F.col("p_name").alias("item"),
        F.when(F.col("p_size") < 4, "2").otherwise("1").alias("version"),
        F.lit(RUN.run_date).alias("odm_created_date"),
    )
    moved = movements.build_intransit(files, moves, source, site_conf(t), components(t), RUN)
    return moved.select(
        "odm", "site_pn", "item", "ship_date", "ship_to", F.col("ship_qty").cast("double").alias("ship_qty")
    )


@query(
    "q_pass",
    f"""WITH {LINES_SQL}
SELECT 'shipment' AS feed, odm, site_pn, item, l_quantity AS quantity FROM f
UNION ALL SELECT 'receipt', lower(odm), site_pn, item, l_quantity FROM f WHERE l_linenumber NOT IN (1, 2)""",
)
def q_pass(t: Tables) -> DataFrame:
    rows = lines(t)
    columns = ["site_pn", "item", F.col("l_quantity").alias("quantity")]
    low = F.lower("odm").alias("odm")
    shipped = movements.pass_through(rows.select(low, *columns), RUN)
    flag = F.expr("CASE WHEN l_linenumber IN (1, 2) THEN '1' WHEN l_linenumber = 3 THEN '0' END")
    received = movements.goods_receipts(rows.select(low, *columns, flag.alias("flag")), RUN)
    return append(
        shipped.select(F.lit("shipment").alias("feed"), "odm", "site_pn", "item", "quantity"),
        received.select(F.lit("receipt").alias("feed"), "odm", "site_pn", "item", "quantity"),
    )


# --- source map ---------------------------------------------------------------------------------------


def source_feed(t: Tables) -> DataFrame:
    return t.part.select(
        F.lower("p_type").alias("odm"),
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("odm_pn"),
        F.when(F.col("p_size") < 20, F.col("p_name")).alias("item"),
        F.expr("CASE WHEN p_size > 40 THEN 'lcfc_vn' WHEN p_size > 10 THEN 'LCFC' ELSE 'NOWHERE' END").alias("from_odm"),
        F.expr("CASE WHEN p_size > 30 THEN 'wistronzs' ELSE 'compal' END").alias("to_odm"),
        F.lit(RUN.run_date).alias("odm_created_date"),
        F.lit(None).cast("string").alias("sbb"),
        F.when(F.col("p_brand") > "Brand#2", "2").otherwise("1").alias("version"),
    )


SOURCE_MAP_SQL = """e AS (
  SELECT 3 * (((p_partkey // 3) - 1) // 2) + p_partkey % 3 AS father, p_partkey AS son, p_partkey % 3 AS grp
  FROM part WHERE p_partkey // 3 > 0),
up(node, ancestor, distance) AS (
  SELECT son, father, 1 FROM e UNION ALL
  SELECT node, e.father, distance + 1 FROM up JOIN e ON e.son = up.ancestor
  JOIN part ON p_partkey = up.ancestor AND p_type <> 'PROMO'),
anc AS (SELECT node, ancestor FROM up JOIN part ON p_partkey = ancestor WHERE p_type = 'PROMO'),
s AS (SELECT upper(p_type) AS odm, 'C' || p_partkey AS site_pn, coalesce(CASE WHEN p_size < 20 THEN p_name END, 'I' || ancestor) AS item,
    CASE WHEN p_size > 40 THEN 'LCFC_VN' ELSE 'LCFC' END AS from_odm,
    CASE WHEN p_size > 40 THEN 'WISTRONZS' WHEN p_size > 30 THEN 'WISTRON ZS' ELSE 'COMPAL' END AS to_odm
  FROM part LEFT JOIN anc ON node = p_partkey WHERE p_size > 10
    AND (p_size <= 40 OR p_brand > 'Brand#2'))"""


def built_source_map(t: Tables) -> DataFrame:
    sites = t.values("loc", ("LCFC",), ("lcfc_vn",))
    code = [F.concat(F.lit(p), F.col(c).cast("string")) for p, c in (("C", "father"), ("C", "son"), ("I", "father"))]
    edges = t.edges.select(
        F.concat(F.lit("S"), F.col("grp").cast("string")).alias("odm"),
        code[0].alias("father_site_pn"),
        code[1].alias("son_site_pn"),
        code[2].alias("father_pn"),
    )
    subs = t.part.filter("p_type = 'PROMO'").select(
        F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("sbb")
    )
    feed = source_feed(t)
    # Every site kind has rows of the newest version, so the newest is the same for all.
    return source_map.build_source_map(feed, feed, sites, sites, edges, subs, RUN)


@query("q_source_map", f"WITH RECURSIVE {SOURCE_MAP_SQL} SELECT * FROM s")
def q_source_map(t: Tables) -> DataFrame:
    return built_source_map(t).select("odm", "site_pn", "item", "from_odm", "to_odm")


@query(
    "q_outsourcing",
    """WITH s AS (SELECT p_type AS odm, 'C' || p_partkey AS site_pn, p_name AS item,
  CASE WHEN p_size > 25 THEN 'LCFC_VN' ELSE 'LCFC' END AS from_odm FROM part),
d AS (SELECT p_name AS item, max(p_brand) AS measure FROM part WHERE p_name LIKE 'red%' GROUP BY 1)
SELECT s.*, measure FROM s JOIN d ON d.item = s.item WHERE from_odm = 'LCFC_VN'
UNION ALL
SELECT s.*, 'VN_BAREBONE' FROM s WHERE from_odm = 'LCFC_VN' AND item NOT LIKE 'red%'""",
)
def q_outsourcing(t: Tables) -> DataFrame:
    mapped = t.part.select(
        F.col("p_type").alias("odm"),
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("site_pn"),
        F.col("p_name").alias("item"),
        F.when(F.col("p_size") > 25, "LCFC_VN").otherwise("LCFC").alias("from_odm"),
    )
    described = t.part.filter("p_name LIKE 'red%'").groupBy(F.col("p_name").alias("item")).agg(
        F.max("p_brand").alias("measure")
    )
    return source_map.outsourcing_bom(mapped, described, t.values("loc", ("LCFC_VN",)))

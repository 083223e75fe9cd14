"""Shipment notices: vendor to plant (two feeds), site to site and hub to site."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.operators.groups import keep_first, keep_latest
from supplyprep.operators.joins import exists_in
from supplyprep.plans import rules
from supplyprep.plans.common import shape_like
from supplyprep.schemas import OUTPUTS
from supplyprep.sources.readers import configured_sites, latest_version_for_subset
from supplyprep.sources.writers import append

NOTICE_KEYS = ["plant_code", "delivery_no", "po", "po_line", "item"]


def supplier_map(suppliers: DataFrame, conf: DataFrame) -> DataFrame:
    """One description per supplier id: in-house suppliers and configured sites.

    A site takes the id of the supplier that carries its name, else its configured code.
    """
    inhouse = suppliers.filter(F.col("flag") == "INHOUSE").select(
        "supplierid", F.upper("supplierdesc").alias("supplierdesc"), "flag"
    )
    named = (
        suppliers.filter(
            (F.col("flag") == "ODM") & (F.col("supplierid") != rules.ASN_EXCLUDED_SUPPLIER)
        )
        .select(F.col("supplierid").alias("id"), F.upper("supplierdesc").alias("name"))
        .distinct()
    )
    sites = conf.filter(
        (F.col("pdomain") == rules.CONF_SITES) & (F.col("asn_source") == "SCC")
    ).select("pattribute", "pvalue")
    site_rows = sites.join(named, F.col("pvalue") == F.col("name"), "left").select(
        F.coalesce("id", "pattribute").alias("supplierid"),
        F.col("pvalue").alias("supplierdesc"),
        F.lit("ODM").alias("flag"),
    )
    both = inhouse.unionByName(site_rows).distinct()
    return keep_first(both, ["supplierid"], ["supplierdesc"])


def open_notices(
    view: DataFrame,
    conf: DataFrame,
    monitor: str,
    always: Sequence[str] = (),
    never: Sequence[str] = (),
) -> DataFrame:
    """Open purchase notices of the configured vendors, newest row per notice.

    The rows are filtered before the newest is chosen.
    """
    chosen = view.filter(
        (F.col("bu") == rules.ASN_BU)
        & (F.upper("status") == "OPEN")
        & F.upper("order_type_desc").endswith(rules.ASN_ORDER_SUFFIX)
        & ~F.col("plant_code").isin(*rules.ASN_EXCLUDED_PLANTS)
    )
    vendors = configured_sites(
        conf, "asn_source", "SCC", monitor, always, never, key="pattribute"
    )
    routed = exists_in(chosen, vendors, [("vendor_code", "site_code")])
    return keep_latest(routed, NOTICE_KEYS, ["sys_modify_date"])


def vendor_notices(
    notices: DataFrame, suppliers: DataFrame, hub_locations: Sequence[str]
) -> DataFrame:
    """Vendor notices with supplier name, procurement mode and kind of transport."""
    inhouse = F.col("flag") == "INHOUSE"
    hub = F.col("incoterms_location").isin(*hub_locations)
    mode = F.coalesce(
        F.col("procurement_mode"),
        F.when(inhouse, F.lit("LOI")).when(hub, F.lit("SOI")).otherwise(F.lit("LOI")),
    )
    joined = notices.join(suppliers, F.col("vendor_code") == F.col("supplierid")).withColumn(
        "procurement_mode", mode
    )
    to_plant = inhouse | (F.col("procurement_mode") == "LOI")
    return joined.select(
        *[c for c in notices.columns if c not in ("plant_code", "bu", "vendor_code")],
        F.col("vendor_code").alias("supplier_id"),
        F.col("supplierdesc").alias("supplier_name"),
        F.col("plant_code").alias("ship_to"),
        F.when(to_plant, F.col("plant_code")).otherwise(F.col("supplierdesc")).alias("plant_code"),
        F.when(inhouse, "INHOUSE TO INHOUSE").otherwise("ODM TO INHOUSE").alias("trans_type"),
        F.lit("SFG_ASN").alias("inv_type"),
        F.lit("SFG").alias("measure"),
    )


def site_notices(feed: DataFrame, conf: DataFrame) -> DataFrame:
    """Open notices between sites; one site counts with its newest version only."""
    newest = latest_version_for_subset(
        feed, F.col("odm") == rules.ASN_LATEST_ONLY_SITE, "version"
    )
    receivers = conf.filter(
        (F.col("pdomain") == "INTRANSIT")
        & (F.col("pname") == "TO_ODM")
        & (F.col("asn_source") == "SCC")
    ).select("pattribute")
    routed = exists_in(
        newest.filter(F.upper("status") == "OPEN"), receivers, [("odm", "pattribute")]
    )
    vendor, name = rules.ASN_SITE_VENDOR
    return routed.select(
        F.col("asn").alias("asn_no"),
        F.col("asn_line").cast("string").alias("asn_line"),
        "po",
        "po_line",
        F.lit(vendor).alias("supplier_id"),
        F.lit(name).alias("supplier_name"),
        F.upper("odm").alias("ship_to"),
        F.upper("odm").alias("plant_code"),
        "ship_date",
        F.col("odm_pn").alias("vendor_pn"),
        "item",
        F.col("delivery_note").alias("delivery_no"),
        "delivery_line",
        "delivery_qty",
        "status",
        "bu",
        F.lit("SOI").alias("procurement_mode"),
        F.lit("ODM TO ODM").alias("trans_type"),
        F.lit("SFG_ASN").alias("inv_type"),
        F.lit("SFG").alias("measure"),
        F.col("create_time").alias("sys_created_date"),
    )


def hub_notices(feed: DataFrame, conf: DataFrame) -> DataFrame:
    """Goods from the hub: all of it while in transit, later what is not yet received."""
    moving = F.col("status").startswith(rules.IN_TRANSIT_PREFIX)
    zero = F.lit(0)
    rest = F.greatest(F.coalesce("asn_qty", zero) - F.coalesce("gr_qty", zero), zero)
    sites = conf.filter(
        (F.col("pdomain") == rules.CONF_SITES) & (F.col("asn_source") == "SCC")
    ).select("pvalue")
    chosen = feed.filter(
        (moving | (F.col("status") == rules.HUB_STATUS_MISMATCH))
        & (F.upper("vendor_name") == "HUB")
    )
    routed = exists_in(chosen, sites, [(F.upper("customer_name"), "pvalue")])
    return routed.select(
        F.col("odm_po").alias("po"),
        F.col("vendor_code").alias("supplier_id"),
        F.col("vendor_name").alias("supplier_name"),
        F.upper("customer_name").alias("ship_to"),
        F.col("plant").alias("plant_code"),
        F.col("new_eta").alias("ship_date"),
        "item",
        F.col("supplier_delivery_no").alias("delivery_no"),
        F.col("supplier_delivery_line").alias("delivery_line"),
        F.when(moving, F.col("asn_qty")).otherwise(rest).alias("delivery_qty"),
        "status",
        "bu",
        F.lit("LOI").alias("procurement_mode"),
        F.lit("HUB TO ODM").alias("trans_type"),
        F.lit("PN_ASN").alias("inv_type"),
        F.lit("PN").alias("measure"),
        "sys_created_date",
        "sys_modify_date",
    )


def build_asn(
    view: DataFrame,
    monitored_view: DataFrame,
    site_feed: DataFrame,
    hub_feed: DataFrame,
    suppliers: DataFrame,
    conf: DataFrame,
    hub_locations: Sequence[str],
) -> DataFrame:
    """All four branches; ``hub_locations`` are the delivery places that mean supplier-owned stock."""
    notices = open_notices(view, conf, "N", always=rules.OVERRIDE_SITES).unionByName(
        open_notices(monitored_view, conf, "Y", never=rules.OVERRIDE_SITES)
    )
    vendor = vendor_notices(notices, supplier_map(suppliers, conf), hub_locations)
    result = append(vendor, site_notices(site_feed, conf), hub_notices(hub_feed, conf))
    return shape_like(result, OUTPUTS["asn"])

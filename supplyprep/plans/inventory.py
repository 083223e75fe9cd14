"""Inventory reported by the sites: routed feeds, conformed codes, weekly business-unit rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.context import RunContext
from supplyprep.functions.clean import (
    clean_text,
    conform_material,
    fallback,
    first_token,
    site_alias,
    site_code_map,
    strip_chars,
)
from supplyprep.operators.joins import exists_in
from supplyprep.operators.rows import update_lookup, update_where
from supplyprep.plans import rules
from supplyprep.plans.common import (
    audited,
    bu_by_codes,
    bu_from_components,
    with_known_item,
)
from supplyprep.sources.readers import latest_version_per_key, route_by_source, version_is_today

KEYS = ["odm", "item", "site_pn", "cto_po", "bu"]
SOURCE_COLUMNS = [
    "odm", "item", "site_pn", "inv_qty", "eff_start", "cto_po", "bu", "src_created_at"
]


def wanted_rows(bu: str = "bu", item: str = "item") -> Column:
    """Business units in scope and a real item code; rows with a missing value drop out."""
    return (
        ~F.col(bu).isin(*rules.EXCLUDED_BU)
        & ~F.col(bu).startswith(rules.EXCLUDED_BU_PREFIX)
        & ~F.col(item).isin(*rules.NO_ITEM)
    )


def summed(feed: DataFrame) -> DataFrame:
    totals = feed.groupBy(*KEYS).agg(
        F.sum("inv_qty").alias("inv_qty"), F.max("create_time").alias("eff_start")
    )
    return totals.withColumn("src_created_at", F.col("eff_start")).select(*SOURCE_COLUMNS)


def inventory_source(
    main: DataFrame,
    monitored: DataFrame,
    files: DataFrame,
    locations: DataFrame,
    conf: DataFrame,
    ctx: RunContext,
) -> DataFrame:
    """The four feeds: today's rows of both systems, one site's newest rows, and the text drops."""
    today = version_is_today(main.filter(wanted_rows()), "version", ctx)
    first = route_by_source(
        today, conf, "inv_source", "SCC", monitor="N", always=rules.OVERRIDE_SITES
    )
    site = F.col("odm") == rules.INVENTORY_LATEST_SITE
    newest = latest_version_per_key(monitored.filter(site), ["odm"], "version")
    active = locations.filter(
        site
        & (F.col("status") == "Active")
        & F.col("location_type").isin(*rules.INVENTORY_LOCATION_TYPES)
    )
    second = exists_in(
        newest.filter(wanted_rows()), active, ["odm", ("location", "odm_location")]
    )
    today = version_is_today(monitored.filter(wanted_rows()), "version", ctx)
    third = route_by_source(
        today, conf, "inv_source", "SCC", monitor="Y", never=rules.OVERRIDE_SITES
    )
    fourth = route_by_source(files, conf, "inv_source", "FTP", fold=False)
    result = fourth.select(*SOURCE_COLUMNS)
    for feed in (first, second, third):
        result = result.unionByName(summed(feed))
    return result


def conform_inventory(source: DataFrame, component: DataFrame, ctx: RunContext) -> DataFrame:
    rows = audited(
        source,
        ctx,
        site_alias("odm").alias("odm"),
        fallback("item", "site_pn").alias("item"),
        "site_pn",
        "inv_qty",
        "eff_start",
        "cto_po",
        clean_text("bu").alias("bu"),
        "src_created_at",
    )
    rows = rows.withColumn("bu", site_code_map("odm", rules.INVENTORY_BU_RULES, "bu"))
    rows = with_known_item(rows, component, "item", "site_pn", rules.PREFIX_SITES_INVENTORY)
    site, suffix = rules.ITEM_SUFFIX_RULE
    item = F.when(
        F.col("odm") == site, F.replace(F.col("item"), F.lit(suffix), F.lit(""))
    ).when(
        (F.col("odm") == rules.FIRST_TOKEN_SITE) & F.col("item").contains("/"),
        first_token("item", "/"),
    )
    return rows.withColumn("item", F.coalesce(item, F.col("item")))


def build_inventory(
    main: DataFrame,
    monitored: DataFrame,
    files: DataFrame,
    locations: DataFrame,
    conf: DataFrame,
    component: DataFrame,
    ctx: RunContext,
) -> DataFrame:
    source = inventory_source(main, monitored, files, locations, conf, ctx)
    return conform_inventory(source, component, ctx)


def inventory_history(
    inventory: DataFrame,
    component: DataFrame,
    product: DataFrame,
    comp_bu: DataFrame,
) -> DataFrame:
    """The weekly copy: codes in material form and the business unit by ordered rules."""
    rows = inventory.withColumns(
        {"item": conform_material("item"), "site_pn": conform_material("site_pn")}
    )
    rows = update_where(
        rows,
        F.col("odm") == rules.BU_FROM_ORDER_SITE,
        {"bu": strip_chars("cto_po", "\r")},
    )
    known = component.filter(~F.col("component").startswith(rules.SUB_ASSEMBLY_PREFIX))
    rows = bu_by_codes(rows, known, "site_pn", "item", ("THINKNB", "IDEANB"))
    here = F.col("odm") == rules.BU_RULE_SITE
    rows = update_lookup(rows, product, [("item", "product")], "bu", "bu", condition=here)
    option = product.filter(F.col("hier6_code") == rules.OPTION_CLASS).select(
        "product",
        F.when(F.col("brand") == rules.OPTION_BRAND, "IDEANB").otherwise("THINKNB").alias("label"),
    )
    rows = update_lookup(rows, option, [("item", "product")], "bu", "label", condition=here)
    return bu_from_components(rows, comp_bu, "site_pn")

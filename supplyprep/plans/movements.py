"""Goods that leave or travel between sites, work in progress, reservations and service parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.context import RunContext
from supplyprep.functions.clean import (
    blank_or_conform,
    clean_text,
    code_map,
    conform_material,
    fallback,
    na_to_null,
    site_alias,
    strip_chars,
    strip_line_breaks,
)
from supplyprep.operators.joins import contained_best, exists_in
from supplyprep.operators.rows import update_lookup, update_where
from supplyprep.plans import rules
from supplyprep.plans.common import (
    audited,
    bu_by_codes,
    bu_from_components,
    bu_from_family,
    with_known_item,
)
from supplyprep.sources.readers import latest_version_per_key, route_by_source, same_iso_week

MOVE_KEYS = ["odm", "site_pn", "item", "ship_date", "ship_to"]


def destinations(conf: DataFrame) -> DataFrame:
    return conf.filter(
        (F.col("pdomain") == "INTRANSIT") & (F.col("pname") == "DESTINATION")
    ).select(F.col("pattribute").alias("alias"))


def build_shipment(feed: DataFrame, conf: DataFrame, ctx: RunContext) -> DataFrame:
    """Summed shipments; free-text destinations of one site become the alias they contain."""
    item = fallback("item", "site_pn")
    routed = route_by_source(
        feed.filter(F.length(item) <= rules.MAX_ITEM_LENGTH),
        conf,
        "asn_source",
        "FTP",
        fold=False,
    )
    rows = routed.select(
        site_alias("odm").alias("odm"),
        "site_pn",
        item.alias("item"),
        "ship_date",
        "ship_to",
        "ship_qty",
        "src_created_at",
    )
    totals = rows.groupBy(*MOVE_KEYS).agg(
        F.sum("ship_qty").alias("ship_qty"), F.max("src_created_at").alias("src_created_at")
    )
    here = F.col("odm") == rules.DESTINATION_SITE
    text = F.when(here, clean_text("ship_to"))
    found = contained_best(totals, text, destinations(conf), "alias", "alias", "__place")
    found = update_where(
        found, here & F.col("__place").isNotNull(), {"ship_to": F.col("__place")}
    )
    prefix, place = rules.DESTINATION_PREFIX
    found = update_where(
        found,
        here & F.upper(clean_text("ship_to")).startswith(prefix),
        {"ship_to": F.lit(place)},
    )
    return audited(
        found, ctx, "odm", "site_pn", "item", "ship_qty", "ship_date", "ship_to", "src_created_at"
    )


def build_wip(feed: DataFrame, conf: DataFrame, component: DataFrame, ctx: RunContext) -> DataFrame:
    """Work in progress of the sites that send text drops."""
    routed = route_by_source(feed, conf, "inv_source", "FTP", fold=False)
    rows = audited(
        routed,
        ctx,
        site_alias("odm").alias("odm"),
        "item",
        "site_pn",
        "wip_qty",
        "src_created_at",
        strip_chars("bu", "\r").alias("bu"),
    )
    return with_known_item(rows, component, "item", "site_pn", rules.PREFIX_SITES_WIP)


def wip_history(wip: DataFrame, comp_bu: DataFrame, product: DataFrame) -> DataFrame:
    """The weekly copy with the business unit of the component, then of the product."""
    rows = wip.withColumns(
        {"item": conform_material("item"), "site_pn": conform_material("site_pn")}
    )
    rows = bu_from_family(rows, comp_bu, "item", rules.WIP_FAMILY_SITES)
    return update_lookup(
        rows,
        product,
        [("item", "product")],
        "bu",
        "hier6_code",
        condition=F.col("odm").isin(*rules.WIP_FAMILY_SITES),
    )


def build_reservation(
    feed: DataFrame, conf: DataFrame, component: DataFrame, product: DataFrame, ctx: RunContext
) -> DataFrame:
    """Reserved parts; only two sites send a usable business unit, products overwrite it."""
    routed = route_by_source(feed, conf, "inv_source", "FTP", fold=False)
    translated = code_map(strip_line_breaks("bu"), rules.RESERVATION_BU_MAP)
    sends_bu = F.col("odm").isin(*rules.RESERVATION_BU_SITES)
    rows = audited(
        routed.filter(F.col("odm").isNotNull()),
        ctx,
        site_alias("odm").alias("odm"),
        F.col("odm_item").alias("site_item"),
        blank_or_conform("item", "odm_item").alias("item"),
        "res_qty",
        "res_date",
        F.when(sends_bu, translated).alias("bu"),
    )
    rows = with_known_item(rows, component, "item", "site_item", rules.PREFIX_SITES)
    return update_lookup(rows, product, [("item", "product")], "bu", "hier6_code", pick="error")


def reservation_history(
    reservation: DataFrame, component: DataFrame, comp_bu: DataFrame
) -> DataFrame:
    rows = bu_by_codes(reservation, component, "site_item", "item", ("ThinkNB", "IdeaNB"))
    rows = bu_from_components(rows, comp_bu, "site_item")
    return bu_from_family(rows, comp_bu, "item", rules.RESERVATION_FAMILY_SITES)


def build_fru(feed: DataFrame, ctx: RunContext) -> DataFrame:
    """Service parts with the site code in upper case."""
    return audited(
        feed,
        ctx,
        F.upper("odm").alias("odm"),
        *[c for c in feed.columns if c != "odm"],
    )


def build_fru_forecast(
    feed: DataFrame, component: DataFrame, known: DataFrame, comp_bu: DataFrame, ctx: RunContext
) -> DataFrame:
    """This week's service part forecast, conformed, with the business unit by ordered rules."""
    current = same_iso_week(feed, "sys_created_date", ctx)
    rows = audited(
        current,
        ctx,
        "fru_qty",
        "item",
        F.upper("odm").alias("odm"),
        F.col("odm_item").alias("site_item"),
        "req_date",
        F.lit(None).cast("string").alias("bu"),
    )
    rows = with_known_item(rows, component, "item", "site_item", rules.PREFIX_SITES)
    rows = bu_by_codes(rows, known, "site_item", "item", ("ThinkNB", "IdeaNB"))
    return bu_from_components(rows, comp_bu, "site_item")


def rebalance_moves(feed: DataFrame, sites: tuple[str, ...]) -> DataFrame:
    """Open internal moves of the newest version of each site."""
    newest = latest_version_per_key(feed, ["odm"], "version")
    return newest.filter(
        (F.upper("status") == "OPEN")
        & (F.col("procurement_mode") == rules.REBALANCE_MODE)
        & F.upper("odm").isin(*sites)
        & F.upper("bu").contains(rules.REBALANCE_BU_PART)
    )


def part_map(source_feed: DataFrame) -> DataFrame:
    """Codes in transit and the packing items they stand for, newest version of one site.

    Several loads of a mapping are one; the map is rebuilt in every run.
    """
    newest = latest_version_per_key(source_feed, ["from_odm"], "version")
    rows = newest.filter(
        F.col("odmpn_instransit").isNotNull() & (F.upper("from_odm") == rules.PART_MAP_SITE)
    )
    return rows.groupBy(
        "odmpn_instransit", "odm_pn", F.col("item").alias("packing_pn"), "from_odm"
    ).agg(F.max("odm_created_date").alias("odm_created_date"))


def build_intransit(
    files: DataFrame,
    site_feed: DataFrame,
    source_feed: DataFrame,
    conf: DataFrame,
    component: DataFrame,
    ctx: RunContext,
) -> DataFrame:
    """Text drops, open internal moves, and moves whose code is translated to a packing item."""
    alias = site_alias("odm")
    routed = route_by_source(files, conf, "asn_source", "FTP", alias, fold=False)
    file_rows = routed.select(
        F.col("odm").alias("__odm"),
        alias.alias("odm"),
        fallback("site_pn", "item").alias("site_pn"),
        fallback("item", "site_pn").alias("item"),
        "ship_date",
        "ship_to",
        "ship_qty",
        "src_created_at",
    )
    totals = [
        file_rows.groupBy("__odm", *MOVE_KEYS)
        .agg(F.sum("ship_qty").alias("ship_qty"), F.max("src_created_at").alias("src_created_at"))
        .drop("__odm")
    ]

    def moved(rows: DataFrame, item, site_pn) -> DataFrame:
        named = rows.select(
            F.upper("odm").alias("odm"),
            site_pn.alias("site_pn"),
            item.alias("item"),
            "ship_date",
            F.upper("odm").alias("ship_to"),
            "delivery_qty",
            "create_time",
        )
        return named.groupBy(*MOVE_KEYS).agg(
            F.sum("delivery_qty").alias("ship_qty"), F.max("create_time").alias("src_created_at")
        )

    internal = rebalance_moves(site_feed, rules.REBALANCE_SITES)
    totals.append(moved(internal, fallback("item", "odm_pn"), fallback("odm_pn", "item")))
    mapping = part_map(source_feed).select(
        F.col("odmpn_instransit").alias("__code"), F.col("packing_pn").alias("__packing")
    )
    translated = rebalance_moves(site_feed, rules.MAPPED_MOVE_SITES).join(
        mapping, F.col("odm_pn") == F.col("__code")
    )
    totals.append(moved(translated, F.col("__packing"), F.col("odm_pn")))

    result = totals[0].select(*MOVE_KEYS, "ship_qty", "src_created_at")
    for part in totals[1:]:
        result = result.unionByName(part)
    result = with_known_item(
        result, component, "item", "site_pn", rules.PREFIX_SITES_INVENTORY, (10,)
    )
    result = update_where(
        result,
        F.col("odm").isin(*rules.NO_ITEM_SITES),
        {"item": na_to_null("item", ("NA", "N/A"))},
    )
    return audited(
        result, ctx, "odm", "site_pn", "item", "ship_qty", "ship_date", "ship_to", "src_created_at"
    )


def pass_through(feed: DataFrame, ctx: RunContext, upper_site: bool = True) -> DataFrame:
    """Copy a feed; the site code is upper-cased."""
    site = F.upper("odm").alias("odm") if upper_site else F.col("odm")
    return audited(feed, ctx, site, *[c for c in feed.columns if c != "odm"])


def goods_receipts(feed: DataFrame, ctx: RunContext) -> DataFrame:
    """Receipts that have not been taken over yet."""
    waiting = F.coalesce(F.col("flag"), F.lit("0")) == "0"
    return pass_through(feed.filter(waiting).drop("flag"), ctx, upper_site=False)


def site_exists(df: DataFrame, sites: DataFrame, column: str, site: str) -> DataFrame:
    """Rows whose site is in the site table, compared without regard to case."""
    return exists_in(df, sites, [(F.upper(column), F.upper(site))])

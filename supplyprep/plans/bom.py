"""Second stage of the bill of material: the conformed edge table of all sites."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.context import RunContext
from supplyprep.functions.clean import (
    NA_TOKENS_BOM,
    na_to_null,
    null_if_empty,
    site_alias,
)
from supplyprep.functions.dates import normalize_eff_start
from supplyprep.operators.graph import (
    bypass_level,
    clone_site,
    drop_by_allow_list,
    drop_edges_to_both,
    drop_fathers_in,
    drop_forbidden_edges,
    drop_redundant_suffix_edges,
    drop_self_loops,
    exception_list,
    expand_compound_father,
    insert_dummy_level,
    null_child_by_dims,
    prefer_prefix_mapping,
    readmit_edges,
    split_multi_mapped_father,
)
from supplyprep.operators.groups import blank_where_count_is_one, dedup_subset, multi_mapped
from supplyprep.operators.joins import canonical_prefix, exists_in
from supplyprep.operators.rows import apply_corrections, delete_where, holds, update_where
from supplyprep.operators.split import split_tokens
from supplyprep.plans import rules
from supplyprep.plans.common import shape_like
from supplyprep.schemas import OUTPUTS
from supplyprep.sources.readers import route_by_source
from supplyprep.sources.storage import staged

SCHEMA = OUTPUTS["bom"]


@dataclass(frozen=True)
class Dimensions:
    """Reference tables of the edge rules."""

    component: DataFrame
    product: DataFrame
    sub_assembly: DataFrame
    forecast: DataFrame
    product_bom: DataFrame
    share: DataFrame
    stock_history: DataFrame
    """(odm, item) pairs of this week's inventory history."""
    region_feed: DataFrame
    shells: DataFrame | None = None
    open_orders: DataFrame | None = None


def bom_source(
    init: DataFrame, files: DataFrame, conf: DataFrame, ctx: RunContext
) -> DataFrame:
    """Edges of the first stage and of the text drops, with the hand-kept fixes."""
    from_init = init.filter(F.col("odm_father_item").isNotNull()).select(
        "odm",
        F.col("father_item").alias("father_pn"),
        F.col("odm_father_item").alias("father_site_pn"),
        F.col("child_item").alias("son_pn"),
        F.col("odm_child_item").alias("son_site_pn"),
        F.col("quantity_per").alias("qtyper"),
        F.col("alternative_code").alias("alt_group"),
        F.col("priority").alias("alt_priority"),
        F.col("effective_start_date").alias("eff_start"),
        F.col("effective_end_date").alias("eff_end"),
        F.col("create_time").alias("src_created_at"),
        F.lit("SCC").alias("created_by"),
        F.lit(ctx.run_ts).alias("created_at"),
    )
    dropped = route_by_source(
        files.filter(F.col("father_site_pn").isNotNull()), conf, "bom_source", "FTP"
    ).withColumns({"created_by": F.lit("FTP"), "created_at": F.lit(ctx.run_ts)})
    both = shape_like(from_init, SCHEMA).unionByName(shape_like(dropped, SCHEMA))
    return correct_source(both)


def correct_source(source: DataFrame) -> DataFrame:
    rows = apply_corrections(source, rules.SOURCE_CORRECTIONS)
    looped = F.col("son_pn").isin(*rules.LOOPED_CODES) & F.col("father_pn").startswith(
        rules.SUB_ASSEMBLY_PREFIX
    )
    rows = update_where(rows, looped, {"son_site_pn": F.col("son_pn")})
    rows = dedup_subset(
        rows,
        F.col("father_pn").isin(*rules.LOOPED_CODES),
        ["odm", "father_pn"],
        ["father_site_pn"],
    )
    rows = blank_where_count_is_one(
        rows, ["odm", "father_site_pn", "alt_group"], "son_site_pn", "alt_group"
    )

    def no_slash(column: str) -> Column:
        return null_if_empty(F.translate(column, "/", ""))

    rows = update_where(
        rows,
        F.col("odm") == rules.SLASH_SITE,
        {c: no_slash(c) for c in ("father_pn", "son_pn")},
    )
    wrong = ~F.col("alt_group").isin(*rules.GROUP_CORRECTION_KEPT)
    for column, codes in rules.GROUP_CORRECTION.items():
        wrong &= F.col(column).isin(*codes)
    return apply_corrections(delete_where(rows, wrong), rules.SOURCE_CORRECTIONS_LATE)


def conformed(rows: DataFrame, ctx: RunContext) -> DataFrame:
    """Distinct rows with trimmed codes, short priority and the start moved to Monday."""
    codes = ("father_pn", "father_site_pn", "son_pn", "son_site_pn")
    start = normalize_eff_start("eff_start", "created_at")
    return rows.withColumns(
        {
            "odm": site_alias("odm"),
            **{c: null_if_empty(F.trim(c)) for c in codes},
            "alt_priority": F.substring("alt_priority", 1, 4),
            "eff_start": start,
            "created_by": F.lit(ctx.created_by),
            "created_at": F.lit(ctx.run_ts),
        }
    ).distinct()


def expand_codes(
    source: DataFrame, early: DataFrame | None, ctx: RunContext
) -> DataFrame:
    """Conformed edges together with the edges of compound and multi-valued codes."""
    single = holds(F.instr("son_pn", "_") == 0) | F.col("son_pn").isNull()
    rows = source.filter(single)
    if early is not None:
        rows = rows.unionByName(
            early.filter(single & (F.col("odm") != rules.ZERO_GROUP_SITE))
        )
    edges = conformed(rows, ctx).unionByName(
        expand_compound_father(source, ctx, rules.COMPOUND_MARKS)
    )
    edges = apply_corrections(edges, rules.BOM_CORRECTIONS)

    multi = source.filter(~single).withColumns(
        {
            "odm": site_alias("odm"),
            **{c: F.trim(c) for c in ("father_pn", "father_site_pn", "son_pn", "son_site_pn")},
            "alt_priority": F.substring("alt_priority", 1, 4),
            "created_by": F.lit(ctx.created_by),
            "created_at": F.lit(ctx.run_ts),
        }
    )
    edges = edges.unionByName(split_tokens(multi, "son_pn", "_"))
    wanted = ~F.col("father_pn").contains(rules.SUB_ASSEMBLY_PREFIX)
    prefixed = F.lit(False)
    for prefix in rules.MULTI_CODE_FATHER_PREFIXES:
        prefixed |= F.col("father_pn").startswith(prefix)
    fathers = exists_in(edges.filter(wanted & prefixed), multi, [("father_pn", "son_pn")])
    fathers = fathers.withColumns(
        {"created_by": F.lit(ctx.created_by), "created_at": F.lit(ctx.run_ts)}
    )
    return edges.unionByName(split_tokens(fathers, "father_pn", "_"))


def conform_sons(edges: DataFrame, dims: Dimensions) -> DataFrame:
    """Suffixed and prefixed son codes, placeholders and self loops."""
    suffixed = F.col("odm").isin(*rules.SUFFIX_SITES)
    edges = drop_redundant_suffix_edges(edges, dims.component, "component", suffixed)
    edges = staged(edges, "bom_short_codes")
    before = edges.withColumn("__old", F.col("son_pn"))
    edges = canonical_prefix(
        before,
        "son_pn",
        "__old",
        dims.component,
        "component",
        rules.PREFIX_LENGTHS_BOM,
        suffixed & F.col("flag").isNull(),
    )
    edges = update_where(
        edges, F.col("son_pn") != F.col("__old"), {"flag": F.lit("Y")}
    ).drop("__old")
    edges = edges.withColumns(
        {c: na_to_null(c, NA_TOKENS_BOM) for c in ("son_pn", "father_pn")}
    )
    edges = staged(edges, "bom_known_sons")
    return drop_self_loops(
        edges, ["odm"], "father_pn", "son_pn", same="son", only=F.col("son_site_pn").isNotNull()
    )


def allowed_fathers(dims: Dimensions) -> DataFrame:
    mine = dims.forecast.filter(F.col("bu") == rules.EXCEPTION_BU)
    direct = mine.filter(F.col("itemtype") == rules.EXCEPTION_DIRECT_TYPE).select("item")
    products = mine.filter(F.col("itemtype") == rules.EXCEPTION_PRODUCT_TYPE)
    derived = exists_in(dims.product_bom, products, [("product", "planning_item_id")])
    return exception_list(direct, derived.select("sbb"))


def apply_edge_rules(
    edges: DataFrame,
    source: DataFrame,
    raw_files: DataFrame,
    dims: Dimensions,
    ctx: RunContext,
) -> DataFrame:
    """Forbidden edges, the bypassed middle level and the allow lists."""
    father = F.coalesce("father_pn", "father_site_pn")
    if dims.open_orders is not None:
        barebone = dims.component.filter(F.col("hier5_code") == rules.BAREBONE_CLASS)
        edges = null_child_by_dims(
            edges,
            F.col("odm").isin(*rules.NULL_CHILD_SITES),
            "son_pn",
            dims.sub_assembly,
            "sbb",
            father,
            barebone,
            "component",
        )
    service = dims.component.filter(F.col("hier1_code").isin(*rules.SERVICE_CLASSES))
    edges = drop_forbidden_edges(
        edges,
        F.col("son_pn").startswith(rules.SUB_ASSEMBLY_PREFIX)
        & (F.col("odm") != rules.FORBIDDEN_EXEMPT_SITE),
        [(dims.product, "product"), (service, "component")],
        father,
        (allowed_fathers(dims), "item", F.col("father_pn")),
    )
    here = F.col("odm") == rules.BYPASS_SITE
    if dims.open_orders is not None:
        orders = dims.open_orders.filter(F.col("brand") == rules.READMIT_BRAND)
        edges = readmit_edges(
            edges,
            raw_files.filter(here),
            orders,
            "item",
            dims.sub_assembly,
            "sbb",
            "father_pn",
            "son_pn",
        )
    edges = staged(edges, "bom_allowed")
    upper = (
        here
        & F.col("son_pn").startswith(rules.SUB_ASSEMBLY_PREFIX)
        & ~F.col("father_pn").startswith(rules.SUB_ASSEMBLY_PREFIX)
    )
    short = source.withColumns(
        {
            "alt_priority": F.substring("alt_priority", 1, 4),
            "created_by": F.lit(ctx.created_by),
            "created_at": F.lit(ctx.run_ts),
        }
    )
    edges = staged(bypass_level(edges, short, upper), "bom_bypassed")
    shells = None
    if dims.shells is not None:
        shells = dims.shells.filter(F.col("siteid") == rules.BYPASS_SITE)
    return drop_by_allow_list(
        edges,
        here,
        dims.component,
        "component",
        dims.sub_assembly,
        "sbb",
        "father_pn",
        "son_pn",
        allow=shells,
        allow_code="shellpn",
        son_else=F.coalesce("son_pn", "son_site_pn"),
    )


def resolve_mappings(edges: DataFrame, dims: Dimensions, ctx: RunContext) -> DataFrame:
    """Items with several site codes: preferred codes first, then one level per code."""
    own = F.col("created_by") == ctx.created_by
    current = own & (F.col("eff_end") >= F.lit(ctx.plan_version))
    mapping = multi_mapped(edges.filter(current), "odm", "father_pn", "father_site_pn")
    here = F.col("odm") == rules.BYPASS_SITE
    edges = prefer_prefix_mapping(
        edges,
        mapping.filter(here),
        dims.stock_history.select("odm", F.col("item").alias("father_pn")),
        here,
        rules.PREFERRED_ITEM_PREFIX,
        rules.PREFERRED_CODE_PREFIX,
    )
    edges = staged(edges, "bom_preferred")
    mapping = multi_mapped(edges.filter(current), "odm", "father_pn", "father_site_pn")
    return split_multi_mapped_father(edges, ctx, own, mapping=staged(mapping, "bom_mapping"))


def finish(edges: DataFrame, dims: Dimensions, ctx: RunContext) -> DataFrame:
    """Expired edges, last fixes, regional levels, the cloned site and the share list."""
    edges = delete_where(edges, F.col("eff_end") < F.lit(ctx.plan_version))
    edges = apply_corrections(edges, rules.BOM_CORRECTIONS_LAST)
    edges = insert_dummy_level(
        edges, dims.region_feed, ctx, rules.REGION_LEVELS, flag=rules.REGION_FLAG
    )
    edges = clone_site(edges, "odm", *rules.CLONED_SITE)
    listed = dims.share.filter(
        ~F.col("display_type").isin(*rules.SHARE_DISPLAY_EXEMPT)
        & (F.col("commodity") == rules.SHARE_COMMODITY)
    )
    return drop_fathers_in(
        edges, F.col("odm") == rules.BYPASS_SITE, "father_pn", listed, "item"
    )


def build_bom(
    init: DataFrame,
    files: DataFrame,
    conf: DataFrame,
    dims: Dimensions,
    ctx: RunContext,
    early_files: DataFrame | None = None,
) -> DataFrame:
    """The edge table of all sites. ``early_files`` is a feed whose edges are taken over directly."""
    source = staged(bom_source(init, files, conf, ctx), "bom_source")
    early = None if early_files is None else shape_like(early_files, SCHEMA)
    edges = expand_codes(source, early, ctx)
    edges = drop_edges_to_both(
        edges,
        F.col("odm") == rules.BYPASS_SITE,
        "son_pn",
        [(dims.sub_assembly, "sbb"), (dims.product, "product")],
    )
    edges = apply_corrections(edges, rules.BOM_CORRECTIONS_SPLIT)
    edges = staged(edges, "bom_expanded")
    edges = staged(conform_sons(edges, dims), "bom_sons")
    edges = apply_edge_rules(edges, source, shape_like(files, SCHEMA), dims, ctx)
    edges = staged(edges, "bom_rules")
    return finish(staged(resolve_mappings(edges, dims, ctx), "bom_mapped"), dims, ctx)

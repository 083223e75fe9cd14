"""First stage of the bill of material: feeds, splitting of multi-valued codes, graph repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.functions.clean import (
    all_zero_to_null,
    na_to_null,
    pad_len,
    pad_numeric,
    short_group_code,
    site_alias,
    strip_chars,
)
from supplyprep.operators.graph import (
    delete_cycle_edges,
    drop_redundant_suffix_edges,
    drop_self_loops,
    drop_variant_fathers,
    find_cycle_edges,
)
from supplyprep.operators.groups import dedup_subset, dense_rank_within
from supplyprep.operators.joins import flag_exists
from supplyprep.operators.rows import blank_singletons, update_where
from supplyprep.operators.split import union_unsplit_and_split
from supplyprep.plans import rules
from supplyprep.sources.readers import route_by_source
from supplyprep.sources.storage import staged

CYCLE_KEYS = ["bu", "odm", "odm_father_item", "odm_child_item"]
DEDUP_KEYS = [
    "father_item",
    "child_item",
    "odm_father_item",
    "odm_child_item",
    "alternative_code",
    "priority",
    "split",
]


def conform_feed(rows: DataFrame) -> DataFrame:
    """Placeholders to null, blanks out of child codes, long group codes of one site shortened.

    The rank behind a shortened code counts the distinct (father, group code) of the rows of one
    feed within business unit and site.
    """
    group = ["bu", "odm"]
    here = F.col("odm") == rules.GROUP_CODE_SITE
    order = ["odm_father_item", "alternative_code"]
    ranks = dense_rank_within(rows.filter(here), group, order, "__rank").select(
        *[F.col(c).alias(f"__k_{c}") for c in [*group, *order]], "__rank"
    )
    match = here
    for column in [*group, *order]:
        match &= F.col(column).eqNullSafe(F.col(f"__k_{column}"))
    ranked = rows.join(ranks, match, "left")
    code = F.when(
        here, short_group_code("alternative_code", "odm_father_item", "__rank")
    ).otherwise(na_to_null("alternative_code", ("NA", "N/A")))
    values = {
        "alternative_code": code,
        "child_item": na_to_null(strip_chars("child_item")),
        "father_item": na_to_null("father_item"),
    }
    return ranked.select(*[values[c].alias(c) if c in values else F.col(c) for c in rows.columns])


def raw_edges(main: DataFrame, monitored: DataFrame, conf: DataFrame) -> DataFrame:
    """The three feed cases: configured sites, override sites and monitored sites."""
    in_scope = ~F.col("bu").isin(*rules.EXCLUDED_BU) & ~F.col("bu").startswith(
        rules.EXCLUDED_BU_PREFIX
    )
    main, monitored = main.filter(in_scope), monitored.filter(in_scope)
    left_out = (F.col("bu") == rules.BOM_EXCLUDED_BU) & F.col("odm").isin(
        *rules.BOM_EXCLUDED_BU_SITES
    )
    configured = route_by_source(
        main.filter(~F.coalesce(left_out, F.lit(False))), conf, "bom_source", "SCC", monitor="N"
    )
    override = main.filter(F.upper("odm").isin(*rules.OVERRIDE_SITES))
    watched = route_by_source(
        monitored, conf, "bom_source", "SCC", monitor="Y", never=rules.OVERRIDE_SITES
    )
    result = conform_feed(configured)
    for feed in (override, watched):
        result = result.unionByName(conform_feed(feed))
    return result.withColumn("odm", site_alias("odm", rules.BOM_SITE_ALIASES))


def repair_codes(edges: DataFrame) -> DataFrame:
    """Self loops, padding of numbers and short codes, codes of zeros only."""
    looped = drop_self_loops(edges, ["bu", "odm"], "father_item", "child_item")
    values = {
        c: all_zero_to_null(pad_len(pad_numeric(c))) for c in ("father_item", "child_item")
    }
    return looped.withColumns(values)


def build_bom_init(
    main: DataFrame,
    monitored: DataFrame,
    conf: DataFrame,
    sub_dim: DataFrame,
    component: DataFrame,
    legacy_share: bool = False,
    cascade: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The repaired edges and the edges removed because they close a cycle."""
    raw = staged(raw_edges(main, monitored, conf), "bom_raw")
    unkeyed = F.col("bu").isNull() | F.col("odm").isNull()
    split = union_unsplit_and_split(
        raw,
        "father_item",
        "child_item",
        legacy_share=legacy_share,
        cascade=cascade,
        first_only=unkeyed if legacy_share else None,
    )
    edges = staged(repair_codes(staged(split, "bom_split")), "bom_init")
    roots = sub_dim.filter(F.col("sbb").startswith(rules.SUB_ASSEMBLY_PREFIX))
    marked = flag_exists(edges, roots, [("father_item", "sbb")], "__root")
    cycles = find_cycle_edges(
        marked, F.col("__root"), "odm_father_item", "odm_child_item", group=["bu", "odm"]
    )
    # A reported edge is removed only where both company codes are known as well.
    coded = F.col("father_item").isNotNull() & F.col("child_item").isNotNull()
    kept = edges.filter(~coded).unionByName(
        delete_cycle_edges(edges.filter(coded), cycles, CYCLE_KEYS)
    )
    kept = staged(kept, "bom_acyclic")
    kept = drop_redundant_suffix_edges(
        kept,
        component,
        "component",
        F.col("odm").isin(*rules.SUFFIX_SITES_FIRST),
        "odm",
        "father_item",
        "child_item",
    )
    kept = staged(kept, "bom_short_codes")
    kept = dedup_subset(
        kept,
        (F.col("odm") == rules.DEDUP_SITE) & F.col("bu").isNull(),
        DEDUP_KEYS,
        ["create_time", "id"],
    )
    kept = blank_singletons(
        kept, ["bu", "odm", "odm_father_item", "alternative_code"], "alternative_code"
    )
    kept = staged(kept, "bom_groups")
    kept = drop_variant_fathers(kept, "odm", "father_item", "odm_father_item")
    zero = (F.col("alternative_code") == "0") & (F.col("odm") == rules.ZERO_GROUP_SITE)
    return update_where(kept, zero, {"alternative_code": F.lit(None)}), cycles

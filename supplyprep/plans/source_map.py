"""Which site builds a part for which other site, and the outsourced parts among them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.context import RunContext
from supplyprep.functions.clean import code_map
from supplyprep.operators.graph import flagged_ancestor
from supplyprep.operators.groups import keep_latest
from supplyprep.operators.joins import exists_in, flag_exists, not_exists_in
from supplyprep.operators.rows import apply_corrections
from supplyprep.plans import rules
from supplyprep.plans.common import audited
from supplyprep.plans.movements import site_exists
from supplyprep.sources.readers import latest_version_per_key

COLUMNS = ["odm", "site_pn", "item", "from_odm", "to_odm", "src_created_at", "sbb"]


def source_rows(
    files: DataFrame, region_feed: DataFrame, sites: DataFrame, region_sites: DataFrame
) -> DataFrame:
    """Mappings of the text drops, and of the regional sites from the newest feed version."""
    listed = site_exists(files, sites, "from_odm", "loc").select(
        F.upper("odm").alias("odm"),
        F.col("odm_pn").alias("site_pn"),
        "item",
        F.upper("from_odm").alias("from_odm"),
        code_map(F.upper("to_odm"), rules.TO_SITE_ALIASES).alias("to_odm"),
        F.col("odm_created_date").alias("src_created_at"),
        "sbb",
    )
    regional = F.upper("from_odm").isin(*rules.REGION_SITES)
    listed = listed.filter(~F.coalesce(regional, F.lit(False)))
    newest = latest_version_per_key(region_feed, ["odm"], "version").filter(regional)
    newest = site_exists(newest, region_sites, "from_odm", "loc")
    keys = ["odm", "odm_pn", "item", "from_odm", "to_odm", "odm_created_date", "sbb"]
    once = keep_latest(newest.select(*keys, "version"), keys, ["version"])
    return listed.unionByName(
        once.select(
            F.upper("odm").alias("odm"),
            F.col("odm_pn").alias("site_pn"),
            "item",
            F.upper("from_odm").alias("from_odm"),
            F.upper("to_odm").alias("to_odm"),
            F.col("odm_created_date").alias("src_created_at"),
            "sbb",
        )
    )


def fill_unknown_items(
    rows: DataFrame, edges: DataFrame, sub_dim: DataFrame, max_depth: int | None = None
) -> DataFrame:
    """An unknown item becomes the nearest known sub-assembly above its site code.

    Of several sites that build the code, the nearest ancestor wins, then the smallest.
    ``max_depth=1`` looks at the direct fathers only.
    """
    wanted = rows.filter(F.col("item").isNull()).select("site_pn").distinct()
    flagged = flag_exists(edges, sub_dim, [("father_pn", "sbb")], "__is_sub")
    label = F.when(F.col("__is_sub"), F.col("father_pn"))
    above = flagged_ancestor(
        flagged, "father_site_pn", "son_site_pn", ["odm"], label, max_depth, wanted
    )
    best = above.groupBy(F.col("son_site_pn").alias("__code")).agg(
        F.min(F.struct("distance", "ancestor")).alias("__best")
    )
    joined = rows.join(best, F.col("site_pn") == F.col("__code"), "left")
    item = F.coalesce(F.col("item"), F.col("__best.ancestor"))
    return joined.withColumn("item", item).drop("__code", "__best")


def build_source_map(
    files: DataFrame,
    region_feed: DataFrame,
    sites: DataFrame,
    region_sites: DataFrame,
    edges: DataFrame,
    sub_dim: DataFrame,
    ctx: RunContext,
    max_depth: int | None = None,
) -> DataFrame:
    rows = source_rows(files, region_feed, sites, region_sites)
    rows = fill_unknown_items(rows, edges, sub_dim, max_depth)
    return apply_corrections(audited(rows, ctx, *COLUMNS), rules.SOURCE_CORRECTIONS_MAP)


def outsourcing_bom(
    source_map: DataFrame, item_desc: DataFrame, sites: DataFrame
) -> DataFrame:
    """Mapped parts with the measure of their item; regional parts not yet there get a default."""
    described = source_map.join(
        item_desc.select(F.col("item").alias("__item"), "measure"), F.col("item") == F.col("__item")
    ).drop("__item")
    listed = exists_in(described, sites, [("from_odm", "loc")])
    regional = source_map.filter(F.upper("from_odm").isin(*rules.REGION_SITES))
    regional = site_exists(regional, sites, "from_odm", "loc")
    rest = not_exists_in(regional, listed, ["odm", "site_pn"]).withColumn(
        "measure", F.lit(rules.REGION_MEASURE)
    )
    return listed.unionByName(rest)

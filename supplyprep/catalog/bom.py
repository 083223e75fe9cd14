"""Queries of the two bill-of-material pipelines on the stand-in graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.catalog.graphs import item_edges
from supplyprep.catalog.registry import query
from supplyprep.catalog.tables import C_SQL, RUN, Tables
from supplyprep.plans.bom import Dimensions, build_bom
from supplyprep.plans.bom_init import build_bom_init
from supplyprep.schemas import INPUTS

RAW_SQL = (
    "WITH RECURSIVE "
    + C_SQL
    + """,
raw AS (
  SELECT CASE grp WHEN 0 THEN 'QUANTA' WHEN 1 THEN 'BOE' ELSE 'LCFC' END AS odm, 'C' || father AS fs, 'C' || son AS ss,
    CASE WHEN father < 3 THEN 'SBB' || father WHEN f.p_size = 30 THEN 'I' || father || '&J' || father
      WHEN f.p_size = 31 THEN 'I' || father || ', J' || father WHEN f.p_size = 32 THEN 'I' || father || '/J' || father
      ELSE 'I' || father END AS fi,
    CASE s.p_size WHEN 3 THEN NULL WHEN 40 THEN 'I' || son || ',J' || son WHEN 41 THEN 'I' || son || '&J' || son
      WHEN 20 THEN lpad(CAST(son AS VARCHAR), 18, '0') WHEN 21 THEN NULL ELSE 'I' || son END AS ci,
    CASE WHEN s.p_size > 45 THEN NULL ELSE 'g' || s.p_size % 2 END AS alt
  FROM c JOIN part f ON f.p_partkey = father JOIN part s ON s.p_partkey = son WHERE s.p_size <> 2),
parts AS (
  SELECT odm, fs, ss, fi, ci, alt, NULL AS ratio FROM raw
  WHERE NOT regexp_matches(fi, '[&,/]') AND NOT regexp_matches(coalesce(ci, ''), '[&,]')
  UNION ALL
  SELECT odm, fs, ss, replace(unnest(regexp_split_to_array(fi, '[&,/]')), ' ', ''), ci, alt, 0.5 FROM raw
  WHERE regexp_matches(fi, '[&,/]') AND NOT regexp_matches(coalesce(ci, ''), '[&,]')
  UNION ALL
  SELECT odm, fs, ss, fi, unnest(regexp_split_to_array(ci, '[&,]')), alt, 0.5 FROM raw
  WHERE NOT regexp_matches(fi, '[&,/]') AND regexp_matches(ci, '[&,]')),
padded AS (
  SELECT odm, fs, ss, CASE WHEN length(fi) = 7 THEN lpad(fi, 12, '0') ELSE fi END AS fi,
    CASE WHEN length(ci) = 7 THEN lpad(ci, 12, '0') ELSE ci END AS ci, alt, ratio FROM parts),
links AS (SELECT DISTINCT odm, fs, ss FROM padded),
w(odm, fs, ss, path) AS (
  SELECT DISTINCT odm, fs, ss, [fs] FROM padded WHERE fi IN ('SBB0', 'SBB1', 'SBB2')
  UNION ALL
  SELECT l.odm, l.fs, l.ss, list_append(w.path, l.fs) FROM w JOIN links l ON l.fs = w.ss AND l.odm = w.odm
  WHERE NOT list_contains(w.path, w.ss)),
found AS (SELECT DISTINCT odm, fs, ss FROM w WHERE list_contains(path, ss)),
kept AS (SELECT * FROM padded p WHERE fi IS NULL OR ci IS NULL OR NOT EXISTS (
  SELECT 1 FROM found WHERE found.odm = p.odm AND found.fs = p.fs AND found.ss = p.ss))
SELECT odm, fi AS father_item, ci AS child_item, fs AS odm_father_item, ss AS odm_child_item,
  CASE WHEN count(*) OVER (PARTITION BY odm, fs, alt) > 1 THEN alt END AS alternative_code,
  CAST(ratio AS DOUBLE) AS ratio FROM kept"""
)


def raw_bom(t: Tables) -> DataFrame:
    """Raw edges of three sites with multi-valued codes, placeholders and numbers."""
    part = t.part.select("p_partkey", "p_size")
    edges = (
        t.cyclic_edges.join(part.withColumnsRenamed({"p_partkey": "f", "p_size": "f_size"}), F.expr("f = father"))
        .join(part.withColumnsRenamed({"p_partkey": "s", "p_size": "s_size"}), F.expr("s = son"))
    )
    father = F.expr(
        "CASE WHEN father < 3 THEN 'SBB' || father WHEN f_size = 30 THEN 'I' || father || '&J' || father "
        "WHEN f_size = 31 THEN 'I' || father || ', J' || father "
        "WHEN f_size = 32 THEN 'I' || father || '/J' || father ELSE 'I' || father END"
    )
    child = F.expr(
        "CASE s_size WHEN 3 THEN 'N/A' WHEN 40 THEN 'I_' || son || ',J' || son "
        "WHEN 41 THEN 'I' || son || '&J' || son WHEN 20 THEN CAST(son AS string) WHEN 21 THEN '00-0' "
        "ELSE 'I' || son END"
    )
    values = {
        "odm": F.expr("CASE grp WHEN 0 THEN 'QUANTA' WHEN 1 THEN 'BOE' ELSE 'LCFC' END"),
        "bu": F.when(F.col("s_size") == 2, "ISG").otherwise("ThinkNB"),
        "odm_father_item": F.expr("'C' || father"),
        "odm_child_item": F.expr("'C' || son"),
        "father_item": father,
        "child_item": child,
        "alternative_code": F.expr("CASE WHEN s_size > 45 THEN 'N/A' ELSE 'g' || s_size % 2 END"),
        "quantity_per": F.col("qty"),
    }
    return edges.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in INPUTS["bom_raw"].fields
        ]
    )


@query("q_bom_init", RAW_SQL)
def q_bom_init(t: Tables) -> DataFrame:
    conf = t.values(
        "pdomain, pname, pvalue, bom_source, monitor_flag",
        ("ODM_CODE", "SITE", "QUANTA", "SCC", "N"),
        ("ODM_CODE", "SITE", "LCFC", "SCC", "Y"),
        ("ODM_CODE", "SITE", "BOE", "FTP", "Y"),
    )
    roots = t.values("sbb", ("SBB0",), ("SBB1",), ("SBB2",))
    component = t.part.select(F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("component"))
    raw = raw_bom(t)
    edges, _ = build_bom_init(raw, raw, conf, roots, component)
    return edges.select(
        "odm", "father_item", "child_item", "odm_father_item", "odm_child_item", "alternative_code", "ratio"
    )


@query("q_bom")
def q_bom(t: Tables) -> DataFrame:
    """The second stage over item edges of three sites, as counts per site and origin."""
    sites = F.expr("CASE odm WHEN 'S0' THEN 'LCFC' WHEN 'S1' THEN 'HUAQIN' ELSE 'WISTRON' END")
    edges = item_edges(t).withColumns(
        {
            "odm": sites,
            "eff_start": F.date_sub("eff_end", 700),
            "alt_group": F.concat(F.lit("g"), F.substring("father_pn", 1, 1)),
            "alt_priority": F.lit("12345"),
            "son_pn": F.when(
                F.col("son_site_pn") == "Brand#4", F.concat("son_pn", F.lit("_"), "son_site_pn")
            ).otherwise(F.col("son_pn")),
        }
    )
    init = edges.filter("odm <> 'WISTRON'").select(
        "odm",
        F.col("father_pn").alias("father_item"),
        F.col("father_site_pn").alias("odm_father_item"),
        F.col("son_pn").alias("child_item"),
        F.col("son_site_pn").alias("odm_child_item"),
        F.col("qtyper").alias("quantity_per"),
        F.col("alt_group").alias("alternative_code"),
        F.col("alt_priority").alias("priority"),
        F.col("eff_start").alias("effective_start_date"),
        F.col("eff_end").alias("effective_end_date"),
        F.col("created_at").alias("create_time"),
    )
    conf = t.values(
        "pdomain, pname, pvalue, bom_source, monitor_flag", ("ODM_CODE", "SITE", "WISTRON", "FTP", "N")
    )
    names = t.part.select(F.col("p_name").alias("name"), "p_type", "p_brand", "p_size").distinct()
    region = t.part.select(
        F.when(F.col("p_size") > 25, "COMPAL_VN").otherwise("LCFC_VN").alias("from_odm"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("36"), "p_brand"))
        .otherwise(F.concat(F.lit("PV"), "p_brand"))
        .alias("item"),
        F.col("p_name").alias("odm_pn"),
        F.to_date(F.lit("2001-07-01")).alias("odm_created_date"),
        F.lit(RUN.run_ts).alias("create_time"),
        F.when(F.col("p_type") == "PROMO", "20010802").otherwise("20010801").alias("version"),
    )
    dims = Dimensions(
        component=names.filter("p_type = 'PROMO'").select(
            F.col("name").alias("component"), F.lit("ZERS").alias("hier1_code"), F.lit("x").alias("hier5_code")
        ),
        product=names.filter("p_type = 'SMALL'").select(F.col("name").alias("product")),
        sub_assembly=names.filter("p_size > 48").select(F.col("name").alias("sbb")),
        forecast=names.filter("p_size = 1").select(
            F.lit("IdeaNB").alias("bu"),
            F.lit("MTM").alias("itemtype"),
            F.col("name").alias("item"),
            F.col("name").alias("planning_item_id"),
        ),
        product_bom=names.select(F.col("name").alias("product"), F.col("p_brand").alias("sbb")),
        share=names.filter("p_size = 3").select(
            F.col("name").alias("item"), F.lit("NX").alias("display_type"), F.lit("Touchpanel").alias("commodity")
        ),
        stock_history=edges.filter("qtyper > 2").select("odm", F.col("father_pn").alias("item")),
        region_feed=region,
    )
    files = edges.filter("odm = 'WISTRON'").drop("flag")
    built = build_bom(init, files, conf, dims, RUN)
    return built.groupBy("odm", "created_by", "flag").agg(
        F.count(F.lit(1)).alias("edges"),
        F.count("father_pn").alias("with_father"),
        F.count("son_pn").alias("with_son"),
        F.countDistinct("father_site_pn").alias("father_sites"),
    )

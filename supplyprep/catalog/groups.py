"""Queries of the aggregates and per-group choices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.catalog.registry import query
from supplyprep.catalog.tables import Tables, day
from supplyprep.functions.clean import join_text, short_group_code
from supplyprep.operators import groups
from supplyprep.operators.graph import part_list
from supplyprep.operators.joins import exists_in
from supplyprep.operators.rows import blank_singletons

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "q_sum_having",
    """SELECT l_partkey, l_suppkey, sum(l_quantity) AS qty FROM lineitem
GROUP BY ALL HAVING sum(l_quantity) > 60""",
)
def q_sum_having(t: Tables) -> DataFrame:
    summed = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    return summed.filter("qty > 60")


@query(
    "q_hull",
    """SELECT l_returnflag || '-' || l_suppkey AS code, min(CAST(l_shipdate AS DATE)) AS eff_start,
  max(CAST(l_shipdate AS DATE)) AS eff_end FROM lineitem GROUP BY 1""",
)
def q_hull(t: Tables) -> DataFrame:
    code = join_text("l_returnflag", F.lit("-"), "l_suppkey")
    return t.lineitem.groupBy(code.alias("code")).agg(
        F.min(day("l_shipdate")).alias("eff_start"), F.max(day("l_shipdate")).alias("eff_end")
    )


@query(
    "q_singletons",
    "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) = 1",
)
def q_singletons(t: Tables) -> DataFrame:
    return groups.singletons(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "q_blank_singletons",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN l_returnflag END AS code
FROM lineitem""",
)
def q_blank_singletons(t: Tables) -> DataFrame:
    rows = t.lineitem.select(*LINE_KEY, F.col("l_returnflag").alias("code"))
    return blank_singletons(rows, ["l_orderkey", "l_linenumber"], "code")


@query(
    "q_distinct",
    """SELECT DISTINCT l_returnflag AS a, l_linestatus AS b FROM lineitem
UNION ALL SELECT DISTINCT p_brand, p_type FROM part""",
)
def q_distinct(t: Tables) -> DataFrame:
    flags = t.lineitem.select(F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b"))
    return flags.distinct().union(t.part.select("p_brand", "p_type").distinct())


@query(
    "q_one_or_default",
    """SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN max(l_returnflag)
  ELSE 'MIXED' END AS flag FROM lineitem GROUP BY l_orderkey""",
)
def q_one_or_default(t: Tables) -> DataFrame:
    return groups.one_or_default(t.lineitem, ["l_orderkey"], "l_returnflag", "MIXED", "flag")


@query(
    "q_two_stage",
    """SELECT l_returnflag, sum(q) AS qty FROM (
  SELECT l_returnflag, l_linestatus, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)
GROUP BY l_returnflag""",
)
def q_two_stage(t: Tables) -> DataFrame:
    """A sum of sums is one aggregate."""
    return t.lineitem.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("qty"))


@query(
    "q_signed_sum",
    """SELECT l_partkey, sum(CASE l_returnflag WHEN 'N' THEN l_quantity WHEN 'R' THEN -l_quantity END)
  AS net FROM lineitem GROUP BY l_partkey""",
)
def q_signed_sum(t: Tables) -> DataFrame:
    net = groups.signed_sum("l_quantity", "l_returnflag", ("N",), ("R",))
    return t.lineitem.groupBy("l_partkey").agg(net.alias("net"))


@query(
    "q_max_attr",
    """SELECT l_suppkey, max(CAST(l_shipdate AS DATE)) AS last_day, max(l_returnflag) AS flag
FROM lineitem GROUP BY l_suppkey""",
)
def q_max_attr(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(
        F.max(day("l_shipdate")).alias("last_day"), F.max("l_returnflag").alias("flag")
    )


@query(
    "q_rn_latest",
    """SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def q_rn_latest(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    return groups.keep_latest(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "q_rn_version",
    """SELECT o_custkey, o_orderpriority, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
  ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def q_rn_version(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate")
    keys = ["o_custkey", "o_orderpriority"]
    return groups.keep_latest(rows, keys, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "q_rn_null_newest",
    """SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY nullif(o_orderpriority, '3-MEDIUM') DESC NULLS FIRST,
  o_orderkey DESC) = 1""",
)
def q_rn_null_newest(t: Tables) -> DataFrame:
    """A missing version counts as the newest."""
    version = F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("version")
    rows = t.orders.select("o_custkey", "o_orderkey", version)
    return groups.keep_latest(rows, ["o_custkey"], ["version", "o_orderkey"]).drop("version")


@query(
    "q_rn_first_text",
    "SELECT s_nationkey, min(s_name) AS s_name FROM supplier GROUP BY s_nationkey",
)
def q_rn_first_text(t: Tables) -> DataFrame:
    return groups.keep_first(t.supplier.select("s_nationkey", "s_name"), ["s_nationkey"], ["s_name"])


@query(
    "q_dedup_subset",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem
WHERE l_returnflag <> 'R'
UNION ALL (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem
WHERE l_returnflag = 'R' QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1)""",
)
def q_dedup_subset(t: Tables) -> DataFrame:
    rows = t.lineitem.select(*LINE_KEY, "l_returnflag")
    return groups.dedup_subset(
        rows,
        F.col("l_returnflag") == "R",
        ["l_orderkey", "l_linenumber"],
        ["l_partkey", "l_suppkey"],
    )


@query(
    "q_dense_rank",
    """SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_brand
    WHEN octet_length(encode(p_brand || '-' || p_size)) < 10 THEN p_brand || '-' || p_size
    ELSE p_type || '-' || dense_rank() OVER (PARTITION BY p_type ORDER BY p_brand, p_size) END AS code
FROM part""",
)
def q_dense_rank(t: Tables) -> DataFrame:
    ranks = groups.dense_rank_within(t.part, ["p_type"], ["p_brand", "p_size"], "rank").select(
        F.col("p_type").alias("t"), F.col("p_brand").alias("b"), F.col("p_size").alias("s"), "rank"
    )
    joined = t.part.join(
        ranks,
        (F.col("p_type") == F.col("t")) & (F.col("p_brand") == F.col("b")) & (F.col("p_size") == F.col("s")),
    )
    long_code = join_text("p_brand", F.lit("-"), "p_size")
    return joined.select(
        "p_partkey",
        F.when(F.col("p_type") == "SMALL", F.col("p_brand"))
        .otherwise(short_group_code(long_code, "p_type", "rank"))
        .alias("code"),
    )


@query(
    "q_count_over",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE
  WHEN l_returnflag <> 'A' AND count(l_suppkey) OVER (
    PARTITION BY l_orderkey, l_returnflag) = 1 THEN NULL
  ELSE nullif(l_returnflag, 'A') END AS flag FROM lineitem""",
)
def q_count_over(t: Tables) -> DataFrame:
    rows = t.lineitem.select(*LINE_KEY, F.nullif("l_returnflag", F.lit("A")).alias("flag"))
    return groups.blank_where_count_is_one(rows, ["l_orderkey", "flag"], "l_suppkey", "flag")


@query(
    "q_multi_map",
    """WITH m AS (SELECT p_type AS site, p_name AS item, nullif(p_brand, 'Brand#7') AS code,
  count(*) OVER (PARTITION BY p_type, p_name) AS rows_of_item,
  count(*) OVER (PARTITION BY p_type, p_name, nullif(p_brand, 'Brand#7')) AS rows_of_code FROM part)
SELECT DISTINCT site, item, code FROM m
WHERE rows_of_item > rows_of_code AND code IS NOT NULL""",
)
def q_multi_map(t: Tables) -> DataFrame:
    rows = t.part.select(
        F.col("p_type").alias("site"),
        F.col("p_name").alias("item"),
        F.nullif("p_brand", F.lit("Brand#7")).alias("code"),
    )
    return groups.multi_mapped(rows, "site", "item", "code")


@query(
    "q_part_list",
    """SELECT DISTINCT p_type AS odm, p_brand AS father_site_pn FROM part WHERE EXISTS (
  SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)""",
)
def q_part_list(t: Tables) -> DataFrame:
    used = exists_in(t.part, t.lineitem, [("p_partkey", "l_partkey")])
    return part_list(used, "p_type", "p_brand").withColumnsRenamed(
        {"p_type": "odm", "p_brand": "father_site_pn"}
    )

"""Queries of the row-change operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.catalog.registry import query
from supplyprep.catalog.tables import Tables, day
from supplyprep.functions.clean import strip_chars
from supplyprep.operators import rows as changes
from supplyprep.operators.groups import keep_latest
from supplyprep.operators.rows import Correction, Lookup

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "q_update_where",
    """SELECT p_partkey, CASE WHEN p_type = 'PROMO' AND p_brand IN ('Brand#3', 'Brand#5') THEN NULL
    WHEN p_brand = 'Brand#9' THEN 'Brand#90' ELSE p_brand END AS p_brand,
  CASE WHEN p_type = 'SMALL' AND p_brand = 'Brand#9' THEN 'TINY' ELSE p_type END AS p_type
FROM part WHERE NOT (p_brand = 'Brand#4' AND p_type IN ('LARGE', 'MEDIUM'))""",
)
def q_update_where(t: Tables) -> DataFrame:
    """Conditional rewrite and hand-kept corrections as rule data."""
    corrections = (
        Correction({"p_brand": ("Brand#4",), "p_type": ("LARGE", "MEDIUM")}),
        Correction({"p_type": ("PROMO",), "p_brand": ("Brand#3", "Brand#5")}, {"p_brand": None}),
        Correction({"p_brand": ("Brand#9",)}, {"p_brand": "Brand#90"}),
    )
    small = changes.update_where(
        t.part.select("p_partkey", "p_brand", "p_type"),
        (F.col("p_type") == "SMALL") & (F.col("p_brand") == "Brand#9"),
        {"p_type": F.lit("TINY")},
    )
    return changes.apply_corrections(small, corrections)


@query(
    "q_update_from",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE
    WHEN l_linestatus = 'O' THEN (SELECT p_type FROM part WHERE p_partkey = l_partkey)
    ELSE l_returnflag END AS class FROM lineitem""",
)
def q_update_from(t: Tables) -> DataFrame:
    rows = t.lineitem.select(*LINE_KEY, "l_linestatus", F.col("l_returnflag").alias("class"))
    changed = changes.update_from(
        rows,
        t.part,
        [("l_partkey", "p_partkey")],
        {"class": "p_type"},
        F.col("l_linestatus") == "O",
    )
    return changed.drop("l_linestatus")


@query(
    "q_update_lookup",
    """SELECT c_custkey, coalesce((SELECT min(s_name) FROM supplier
  WHERE s_nationkey = c_nationkey AND s_acctbal > 6000), c_name) AS name FROM customer""",
)
def q_update_lookup(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_nationkey", F.col("c_name").alias("name"))
    rich = t.supplier.filter("s_acctbal > 6000")
    return changes.update_lookup(
        rows, rich, [("c_nationkey", "s_nationkey")], "name", "s_name"
    ).drop("c_nationkey")


@query(
    "q_upsert",
    """WITH newest AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
old AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0)
SELECT coalesce(c_custkey, o_custkey) AS custkey,
  CASE WHEN c_custkey IS NULL THEN 'new' ELSE c_name END AS name,
  CASE WHEN o_custkey IS NULL THEN 'none' ELSE o_orderstatus END AS status
FROM old FULL JOIN newest ON c_custkey = o_custkey""",
)
def q_upsert(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    newest = keep_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        F.col("o_custkey").alias("custkey"),
        F.lit("new").alias("name"),
        F.col("o_orderstatus").alias("status"),
    )
    old = t.customer.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.lit("none").alias("status")
    )
    return changes.upsert(old, newest, ["custkey"], update=["status"])


@query(
    "q_delete_exists",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'P')
  AND NOT coalesce(nullif(l_tax, 0.0) > 0.05, FALSE)""",
)
def q_delete_exists(t: Tables) -> DataFrame:
    rows = t.lineitem.select(*LINE_KEY, "l_tax")
    closed = t.orders.filter("o_orderstatus = 'P'")
    kept = changes.delete_exists(rows, closed, [("l_orderkey", "o_orderkey")])
    return changes.delete_where(kept, F.nullif("l_tax", F.lit(0.0)) > 0.05).drop("l_tax")


@query(
    "q_fill_cascade",
    """WITH s AS (SELECT s_nationkey, n_regionkey, s_name, s_acctbal FROM supplier
  JOIN nation ON n_nationkey = s_nationkey)
SELECT c_custkey, coalesce(
  (SELECT max(s_name) FROM s WHERE s_nationkey = c_nationkey AND s_acctbal > c_limit),
  (SELECT max(s_name) FROM s WHERE s_nationkey = c_nationkey),
  (SELECT max(s_name) FROM s WHERE s.n_regionkey = c.n_regionkey), 'X') AS supplier
FROM (SELECT c_custkey, c_nationkey, n_regionkey, 8000 AS c_limit FROM customer
  JOIN nation ON n_nationkey = c_nationkey) c""",
)
def q_fill_cascade(t: Tables) -> DataFrame:
    """Rich supplier of the nation, any supplier of the nation, any supplier of the region."""
    suppliers = t.supplier.join(
        t.nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_nationkey", F.col("n_regionkey").alias("s_regionkey"), "s_name", "s_acctbal")
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_nationkey", "n_regionkey", F.lit("X").alias("supplier")
    )
    filled = changes.fill_cascade(
        customers,
        [
            Lookup(suppliers.filter("s_acctbal > 8000"), [("c_nationkey", "s_nationkey")]),
            Lookup(suppliers, [("c_nationkey", "s_nationkey")]),
            Lookup(suppliers, [("n_regionkey", "s_regionkey")]),
        ],
        {"supplier": "s_name"},
    )
    return filled.select("c_custkey", "supplier")


@query(
    "q_rewrite",
    """SELECT p_partkey, replace(replace(replace(p_name || '_a-b', ' ', ''), '_', ''), '-', '') AS name,
  nullif(replace(p_brand, '#', ''), '') AS brand FROM part""",
)
def q_rewrite(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return changes.self_update(
        rows,
        {
            "name": strip_chars(F.concat("name", F.lit("_a-b"))),
            "brand": strip_chars("brand", "#"),
        },
    )


@query(
    "q_ship_upsert",
    """SELECT user_id, event_type, event_id, CAST(ts AS DATE) AS day, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def q_ship_upsert(t: Tables) -> DataFrame:
    """Two net-change windows applied one after the other equal one full pass."""
    rows = t.events.select("user_id", "event_type", "event_id", day("ts").alias("day"), "value", "ts")
    keys = ["user_id", "event_type"]
    half = F.lit("2024-01-16").cast("timestamp_ntz")

    def newest(part: DataFrame) -> DataFrame:
        return keep_latest(part, keys, ["ts", "event_id"]).drop("ts")

    first = newest(rows.filter(F.col("ts") < half))
    second = newest(rows.filter(F.col("ts") >= half))
    return changes.upsert(first, second, keys, update=["event_id", "day", "value"])

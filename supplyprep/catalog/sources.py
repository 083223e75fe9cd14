"""Queries of the scan and write-mode operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyprep.catalog.registry import query
from supplyprep.catalog.tables import CFG_SQL, RUN, Tables, day
from supplyprep.context import RunContext
from supplyprep.functions.dates import calendar_week, week_start, year_start
from supplyprep.operators.split import explode_counter
from supplyprep.sources import readers, writers
from supplyprep.sources.storage import new_path


@query(
    "q_route_semi",
    f"""WITH {CFG_SQL}
SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (
  SELECT 1 FROM cfg WHERE upper(c_mktsegment) = pvalue AND source = 'SCC'
    AND (monitor = 'N' OR pvalue IN ('MACHINERY')))""",
)
def q_route_semi(t: Tables) -> DataFrame:
    routed = readers.route_by_source(
        t.customer, t.conf, "inv_source", "SCC", "c_mktsegment", monitor="N", always=("MACHINERY",)
    )
    return routed.select("c_custkey", "c_mktsegment")


@query(
    "q_latest_global",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month FROM orders
WHERE strftime(o_orderdate, '%Y%m') = (SELECT max(strftime(o_orderdate, '%Y%m')) FROM orders)""",
)
def q_latest_global(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("month"))
    return readers.latest_version_global(rows, "month")


@query(
    "q_latest_per_key",
    """SELECT event_id, user_id, event_type FROM events e WHERE CAST(ts AS DATE) =
  (SELECT max(CAST(ts AS DATE)) FROM events m WHERE m.user_id = e.user_id)""",
)
def q_latest_per_key(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", day("ts").alias("version"))
    return readers.latest_version_per_key(rows, ["user_id"], "version").drop("version")


@query(
    "q_latest_subset",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' OR o_orderdate =
  (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F')""",
)
def q_latest_subset(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    chosen = F.col("o_orderstatus") == "F"
    return readers.latest_version_for_subset(rows, chosen, "o_orderdate").drop("o_orderdate")


@query(
    "q_iso_week",
    """SELECT event_id, user_id FROM events
WHERE date_trunc('week', ts) = date_trunc('week', TIMESTAMP '2024-01-17')""",
)
def q_iso_week(t: Tables) -> DataFrame:
    ctx = RunContext(run_ts=datetime(2024, 1, 17))
    return readers.same_iso_week(t.events.select("event_id", "user_id", "ts"), "ts", ctx).drop("ts")


@query(
    "q_net_window",
    """SELECT event_id, event_type FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'""",
)
def q_net_window(t: Tables) -> DataFrame:
    low = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    high = F.lit("2024-01-12 12:00:00").cast("timestamp_ntz")
    rows = t.events.select("event_id", "event_type", "ts")
    return readers.net_change_window(rows, "ts", low, high).drop("ts")


@query(
    "q_lookback",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ordered FROM orders
WHERE CAST(o_orderdate AS DATE) > DATE '2001-08-02' - 365""",
)
def q_lookback(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", day("o_orderdate").alias("ordered"))
    return readers.rolling_lookback(rows, "ordered", RUN, 365)


@query(
    "q_version_day",
    "SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y%m%d') = '19970115'",
)
def q_version_day(t: Tables) -> DataFrame:
    ctx = RunContext(run_ts=datetime(1997, 1, 15))
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("version"))
    return readers.version_is_today(rows, "version", ctx).drop("version")


@query(
    "q_history_prefix",
    """SELECT o_orderkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS version_year,
  lpad(CAST((dayofyear(o_orderdate) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS version_week,
  CAST(date_trunc('week', o_orderdate) AS DATE) AS monday,
  dayofweek(o_orderdate) = 4 AS is_thursday FROM orders""",
)
def q_history_prefix(t: Tables) -> DataFrame:
    ordered = day("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        year_start(ordered).alias("version_year"),
        calendar_week(ordered).alias("version_week"),
        week_start(ordered).alias("monday"),
        (F.dayofweek(ordered) == RUN.snapshot_weekday).alias("is_thursday"),
    )


@query(
    "q_weekly_history",
    """SELECT CAST(version_year AS DATE) AS version_year, version_week, l_returnflag, n, q FROM (
  SELECT '2001-01-01' AS version_year, '31' AS version_week, l_returnflag, count(*) AS n,
         CAST(sum(l_quantity) AS DOUBLE) AS q FROM lineitem GROUP BY ALL)
UNION ALL
SELECT DATE '2001-01-01', '32', l_returnflag, count(*), CAST(sum(l_quantity) AS DOUBLE)
FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL""",
)
def q_weekly_history(t: Tables) -> DataFrame:
    """Two weeks written, the second one twice: the last write of a week is what stays."""
    path = new_path(t.spark, "history")
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    first = RUN
    second = RunContext(run_ts=datetime(2001, 8, 9, 6, 0))
    writers.weekly_history(rows, path, first)
    writers.weekly_history(rows, path, second)
    writers.weekly_history(rows.filter("l_linestatus = 'F'"), path, second)
    kept = t.spark.read.schema(
        "version_date date, l_returnflag string, l_quantity double, version_year date, "
        "version_week string"
    ).parquet(path)
    return kept.groupBy("version_year", "version_week", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q")
    )


@query(
    "q_backup_prune",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS backup_time FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-02' - 90""",
)
def q_backup_prune(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", day("o_orderdate").alias("backup_time"))
    return rows.filter(writers.backup_kept(F.col("backup_time"), RUN, 90))


@query(
    "q_rolling_backup",
    """SELECT c_custkey, DATE '2001-08-02' AS backup_date FROM customer WHERE c_acctbal > 0
UNION ALL SELECT c_custkey, DATE '2001-06-13' FROM customer""",
)
def q_rolling_backup(t: Tables) -> DataFrame:
    """Three runs, the newest one twice; the oldest is out of the window when it is read."""
    path = new_path(t.spark, "backup")
    rows = t.customer.select("c_custkey", "c_acctbal")
    for run in (datetime(2001, 4, 1), datetime(2001, 6, 13), RUN.run_ts):
        writers.rolling_backup(rows, path, RunContext(run_ts=run))
    writers.rolling_backup(rows.filter("c_acctbal > 0"), path, RUN)
    return writers.read_backup(t.spark, path, RUN, 90).select("c_custkey", "backup_date")


@query(
    "q_replace_slice",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 'P-' || substr(o_orderpriority, 1, 1) FROM orders
WHERE o_orderstatus = 'P'""",
)
def q_replace_slice(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    old = F.col("o_orderstatus") == "P"
    new = rows.filter(old).withColumn(
        "o_orderstatus", F.concat(F.lit("P-"), F.substring("o_orderpriority", 1, 1))
    )
    return writers.replace_slice(rows, old, new).drop("o_orderpriority")


@query(
    "q_sources",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT c_custkey, c_custkey, c_acctbal FROM customer""",
)
def q_sources(t: Tables) -> DataFrame:
    """A subset snapshot is written, replaced by a larger one built from it, and read back."""
    base = new_path(t.spark, "snapshot")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    writers.copy_subset(orders, F.col("o_orderstatus") == "F", base, RUN)
    before = writers.read_snapshot(t.spark, base).drop("o_orderstatus")
    extra = t.customer.select(
        F.col("c_custkey").alias("o_orderkey"),
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_acctbal").alias("o_totalprice"),
    )
    writers.overwrite_snapshot(writers.append(before, extra), base, RUN)
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    )
    path = writers.current_version(t.spark, base)
    return readers.read_source(t.spark, {"orders": readers.Source(schema, path)}, "orders")


@query(
    "q_delimited",
    """SELECT p_partkey, nullif(CASE WHEN p_size > 25 THEN p_brand ELSE '' END, '') AS brand,
  p_name, p_retailprice FROM part""",
)
def q_delimited(t: Tables) -> DataFrame:
    """Round trip through a delimited text drop; empty codes come back as null."""
    path = new_path(t.spark, "drop")
    brand = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(F.lit(""))
    rows = t.part.select("p_partkey", brand.alias("brand"), "p_name", "p_retailprice")
    rows.write.option("sep", "|").option("emptyValue", "").csv(path)
    schema = T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("brand", T.StringType()),
            T.StructField("p_name", T.StringType()),
            T.StructField("p_retailprice", T.DoubleType()),
        ]
    )
    return readers.read_delimited(t.spark, {"drop": readers.Source(schema, path)}, "drop")


@query(
    "q_quarantine",
    """SELECT CASE WHEN p_size IN (7, 9) THEN 'rejected' ELSE 'kept' END AS state, count(*) AS n,
  CAST(sum(p_partkey) AS BIGINT) AS keys, CAST(sum(CASE WHEN p_size NOT IN (7, 9) THEN p_retailprice END) AS DOUBLE) AS price
FROM part GROUP BY 1
UNION ALL SELECT 'counted', count(*), count(*) FILTER (p_size IN (7, 9)), NULL FROM part""",
)
def q_quarantine(t: Tables) -> DataFrame:
    """A drop with values that are no numbers and lines that end early: what is kept, set aside and counted."""
    drop, landing = new_path(t.spark, "drop"), new_path(t.spark, "landing")
    price = F.when(F.col("p_size") == 7, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string"))
    line = F.concat_ws("|", F.col("p_partkey").cast("string"), "p_brand", price)
    short = F.concat_ws("|", F.col("p_partkey").cast("string"), "p_brand")
    t.part.select(F.when(F.col("p_size") == 9, short).otherwise(line).alias("value")).write.text(drop)
    schema = T.StructType().add("code", T.LongType()).add("brand", T.StringType()).add("price", T.DoubleType())
    load = readers.load_delimited(t.spark, {"drop": readers.Source(schema, drop)}, "drop", landing, most_rejected=0.5)
    kept = load.rows.select(F.lit("kept").alias("state"), "code", "price")
    code = F.split("line", "[|]").getItem(0).cast("long")
    aside = load.rejected.select(F.lit("rejected").alias("state"), code.alias("code"), F.lit(None).cast("double").alias("price"))
    sums = kept.unionByName(aside).groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum("code").alias("keys"), F.sum("price").alias("price"))
    counted = t.spark.range(1).select(F.lit("counted"), F.lit(load.lines).cast("long"), F.lit(load.n_rejected).cast("long"), F.lit(None).cast("double"))
    return sums.union(counted)


@query(
    "q_project",
    """SELECT CAST(n_nationkey AS INTEGER) AS nation, n_name AS site, 'SCC' AS source,
  DATE '2001-08-02' AS loaded, CAST(NULL AS DOUBLE) AS quantity, CAST(NULL AS VARCHAR) AS bu
FROM nation""",
)
def q_project(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").alias("nation"),
        F.col("n_name").alias("site"),
        F.lit("SCC").alias("source"),
        F.lit(RUN.run_date).alias("loaded"),
        F.lit(None).cast("double").alias("quantity"),
        F.lit(None).cast("string").alias("bu"),
    )


@query(
    "q_counter",
    """SELECT l_orderkey, CAST(n AS INTEGER) AS n FROM (
  SELECT l_orderkey, unnest(range(1, max(l_linenumber) + 1)) AS n FROM lineitem GROUP BY l_orderkey)""",
)
def q_counter(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("lines"))
    return explode_counter(lines, "lines", "n").drop("lines")

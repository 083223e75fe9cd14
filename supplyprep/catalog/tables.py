"""The test tables and the stand-in relations that the queries share.

Each stand-in exists twice, as a DataFrame (methods of ``Tables``) and as a common table
expression for the SQL counterpart (constants).
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyprep.context import RunContext

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}

RUN = RunContext(run_ts=datetime(2001, 8, 2, 6, 0))
"""Clock of the stand-in runs: a Thursday near the end of the order dates."""


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def values(self, columns: str, *rows: tuple) -> DataFrame:
        """A small configuration table."""
        text = ", ".join(
            "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in rows
        )
        return self.spark.sql(f"SELECT * FROM VALUES {text} AS v({columns})")

    @cached_property
    def edges(self) -> DataFrame:
        """Three binary trees over all parts: ``father, son, grp, qty``."""
        node = F.expr("p_partkey div 3")
        tree = F.expr("p_partkey % 3")
        return self.part.filter(node > 0).select(
            (3 * F.expr("(p_partkey div 3 - 1) div 2") + tree).alias("father"),
            F.col("p_partkey").alias("son"),
            tree.alias("grp"),
            (F.col("p_size") % 4 + 1).cast("bigint").alias("qty"),
        )

    @cached_property
    def cyclic_edges(self) -> DataFrame:
        """The trees with edges from parts of the largest size back to their grandfather."""
        back = self.part.filter(F.expr("p_partkey div 3 >= 3 AND p_size = 50")).select(
            F.col("p_partkey").alias("father"),
            (3 * F.expr("(p_partkey div 3 - 3) div 4") + F.expr("p_partkey % 3")).alias("son"),
            F.expr("p_partkey % 3").alias("grp"),
            F.lit(1).cast("bigint").alias("qty"),
        )
        return self.edges.union(back)

    @cached_property
    def multi_valued(self) -> DataFrame:
        """Parts whose code holds one or two values, with either separator."""
        size = F.col("p_size") % 3
        code = (
            F.when(size == 0, F.concat("p_brand", F.lit("&"), "p_type"))
            .when(size == 1, F.concat("p_brand", F.lit(","), "p_type"))
            .otherwise(F.col("p_brand"))
        )
        return self.part.select("p_partkey", code.alias("code"))

    @cached_property
    def conf(self) -> DataFrame:
        """Feed configuration, one row per market segment."""
        return self.values(
            "pdomain, pname, pvalue, pattribute, bom_source, inv_source, asn_source, monitor_flag",
            *[("ODM_CODE", "SITE", s, s[:2], f, f, f, m) for s, f, m in SEGMENT_CONF],
        )


# Feed configuration of the stand-ins: segment, feed, monitor flag.
SEGMENT_CONF = (
    ("AUTOMOBILE", "SCC", "N"),
    ("BUILDING", "FTP", "N"),
    ("FURNITURE", "SCC", "Y"),
    ("HOUSEHOLD", "FTP", "Y"),
    ("MACHINERY", "SCC", "Y"),
)

E_SQL = """e AS (
  SELECT 3 * (((p_partkey // 3) - 1) // 2) + p_partkey % 3 AS father, p_partkey AS son,
         p_partkey % 3 AS grp, CAST(p_size % 4 + 1 AS BIGINT) AS qty
  FROM part WHERE p_partkey // 3 > 0)"""

C_SQL = (
    E_SQL
    + """,
c AS (
  SELECT father, son, grp, qty FROM e
  UNION ALL
  SELECT p_partkey, 3 * (((p_partkey // 3) - 3) // 4) + p_partkey % 3, p_partkey % 3, 1
  FROM part WHERE p_partkey // 3 >= 3 AND p_size = 50)"""
)

MV_SQL = """mv AS (
  SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_brand || '&' || p_type
                                    WHEN 1 THEN p_brand || ',' || p_type
                                    ELSE p_brand END AS code
  FROM part)"""

CFG_SQL = "cfg(pvalue, source, monitor) AS (VALUES " + ", ".join(
    f"('{s}', '{f}', '{m}')" for s, f, m in SEGMENT_CONF
) + ")"


def day(column: str) -> Column:
    return F.to_date(F.col(column))


def money(column: str | Column) -> Column:
    """Exact sum of two-digit amounts."""
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value.cast("decimal(18,2)")).cast("double")


def money_sql(expression: str) -> str:
    return f"CAST(sum(CAST({expression} AS DECIMAL(18,2))) AS DOUBLE)"


def qty(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("decimal(18,4)")

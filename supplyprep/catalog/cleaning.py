"""Queries of the cleaning, conforming and splitting functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.catalog.registry import query
from supplyprep.catalog.tables import MV_SQL, Tables, day
from supplyprep.functions import clean
from supplyprep.functions.dates import normalize_eff_start, parse_mixed_date
from supplyprep.operators.joins import canonical_prefix, exists_in, flag_exists
from supplyprep.operators.split import split_rows, split_tokens, union_unsplit_and_split
from supplyprep.plans.common import bu_by_codes, bu_from_components, bu_from_family

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "q_na_null",
    """SELECT p_partkey, CASE WHEN code IN ('NA', 'N/A', 'NA,NA') THEN NULL ELSE code END AS code
FROM (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'NA' WHEN 'LARGE' THEN 'N/A'
  WHEN 'PROMO' THEN 'NA,NA' ELSE p_type END AS code FROM part)""",
)
def q_na_null(t: Tables) -> DataFrame:
    code = clean.code_map("p_type", {"SMALL": "NA", "LARGE": "N/A", "PROMO": "NA,NA"})
    return t.part.select("p_partkey", clean.na_to_null(code).alias("code"))


@query(
    "q_pad",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  lpad(CAST(l_orderkey AS VARCHAR), 18, '0') AS order_code,
  CASE WHEN length(code) = 7 THEN lpad(code, 12, '0') ELSE code END AS item,
  lpad(CAST(l_linenumber AS VARCHAR), 5, '0') AS line FROM (
  SELECT *, CASE WHEN l_linenumber = 1 THEN 'R' || lpad(CAST(l_partkey AS VARCHAR), 6, '0')
    ELSE 'R' || l_partkey || '-' || l_linenumber END AS code FROM lineitem)""",
)
def q_pad(t: Tables) -> DataFrame:
    short = F.concat(F.lit("R"), F.lpad(F.col("l_partkey").cast("string"), 6, "0"))
    other = clean.join_text(F.lit("R"), "l_partkey", F.lit("-"), "l_linenumber")
    return t.lineitem.select(
        *LINE_KEY,
        clean.pad_numeric(F.col("l_orderkey").cast("string")).alias("order_code"),
        clean.pad_len(F.when(F.col("l_linenumber") == 1, short).otherwise(other)).alias("item"),
        clean.pad_line("l_linenumber").alias("line"),
    )


@query(
    "q_zero_null",
    """SELECT p_partkey, CASE WHEN regexp_full_match(code, '0+') THEN NULL ELSE code END AS code
FROM (SELECT p_partkey, repeat('0', p_size % 4 + 1) ||
  CASE WHEN p_size % 2 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS code FROM part)""",
)
def q_zero_null(t: Tables) -> DataFrame:
    tail = F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_size").cast("string"))
    code = F.concat(F.repeat(F.lit("0"), F.col("p_size") % 4 + 1), tail)
    return t.part.select("p_partkey", clean.all_zero_to_null(code).alias("code"))


@query(
    "q_alias",
    """SELECT c_custkey, CASE upper(c_mktsegment) WHEN 'MACHINERY' THEN 'MACHINES'
  WHEN 'AUTOMOBILE' THEN 'CARS' ELSE lower(c_mktsegment) END AS site FROM customer""",
)
def q_alias(t: Tables) -> DataFrame:
    aliases = {"Machinery": "MACHINES", "Automobile": "CARS"}
    return t.customer.select(
        "c_custkey", clean.site_alias(F.lower("c_mktsegment"), aliases).alias("site")
    )


@query(
    "q_code_map",
    """SELECT p_partkey, CASE p_brand
  WHEN 'Brand#1' THEN CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'LARGE' THEN 'L' ELSE p_type END
  WHEN 'Brand#2' THEN CASE p_name WHEN 'red ring' THEN 'RR' ELSE p_type END
  ELSE p_type END AS bu FROM part""",
)
def q_code_map(t: Tables) -> DataFrame:
    mapped = clean.site_code_map(
        "p_brand",
        {
            "Brand#1": ("p_type", {"SMALL": "S", "LARGE": "L"}),
            "Brand#2": ("p_name", {"red ring": "RR"}),
        },
        "p_type",
    )
    return t.part.select("p_partkey", mapped.alias("bu"))


@query(
    "q_prefix_loop",
    """WITH dim AS (SELECT DISTINCT p_brand AS code FROM part UNION SELECT 'Brand#'),
rows AS (SELECT p_partkey, CASE WHEN p_size < 5 THEN p_brand
  ELSE p_brand || 'X' || p_size END AS code FROM part WHERE p_type <> 'PROMO'
  UNION ALL SELECT p_partkey, 'none' || p_brand FROM part WHERE p_type = 'PROMO'),
hits AS (SELECT r.p_partkey, min(k) AS k FROM rows r, range(7, 13) AS ks(k)
  WHERE r.code NOT IN (SELECT code FROM dim)
    AND substr(r.code, 1, CAST(k AS INTEGER)) IN (SELECT code FROM dim) GROUP BY 1)
SELECT r.p_partkey, coalesce(substr(r.code, 1, CAST(k AS INTEGER)), r.code) AS code
FROM rows r LEFT JOIN hits h ON h.p_partkey = r.p_partkey""",
)
def q_prefix_loop(t: Tables) -> DataFrame:
    """The shortest known prefix wins, each row changes at most once."""
    dim = t.part.select(F.col("p_brand").alias("code"))
    long_code = F.concat("p_brand", F.lit("X"), F.col("p_size").cast("string"))
    code = (
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("none"), "p_brand"))
        .when(F.col("p_size") < 5, F.col("p_brand"))
        .otherwise(long_code)
    )
    rows = t.part.select("p_partkey", code.alias("code"))
    return canonical_prefix(rows, "code", "code", dim, "code", (7, 8, 9, 10, 11, 12))


@query(
    "q_first_token",
    "SELECT p_partkey, split_part(p_name, ' ', 1) AS word FROM part",
)
def q_first_token(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", clean.first_token("p_name", " ").alias("word"))


@query(
    "q_fallback",
    """SELECT p_partkey, coalesce(item, site_pn) AS item, coalesce(site_pn, item) AS site_pn,
  CASE WHEN coalesce(trim(item), '') = '' THEN site_pn
    WHEN length(replace(item, '-', '')) = 7 THEN lpad(replace(item, '-', ''), 12, '0')
    ELSE replace(item, '-', '') END AS conformed
FROM (SELECT p_partkey, nullif(p_type, 'SMALL') AS item, nullif(p_brand, 'Brand#8') AS site_pn FROM part
  WHERE p_size > 10
  UNION ALL SELECT p_partkey, replace(p_brand, '#', '-'), p_type FROM part WHERE p_size <= 10)""",
)
def q_fallback(t: Tables) -> DataFrame:
    large = F.col("p_size") > 10
    rows = t.part.select(
        "p_partkey",
        F.when(large, F.nullif("p_type", F.lit("SMALL")))
        .otherwise(F.translate("p_brand", "#", "-"))
        .alias("a"),
        F.when(large, F.nullif("p_brand", F.lit("Brand#8"))).otherwise(F.col("p_type")).alias("b"),
    )
    return rows.select(
        "p_partkey",
        clean.fallback("a", "b").alias("item"),
        clean.fallback("b", "a").alias("site_pn"),
        clean.blank_or_conform("a", "b").alias("conformed"),
    )


@query(
    "q_eff_start",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE
  WHEN CAST(o_orderdate AS DATE) = CAST(l_shipdate AS DATE) - l_linenumber
  THEN date_trunc('week', l_shipdate - to_days(l_linenumber))
  ELSE l_shipdate - to_days(l_linenumber) END AS DATE) AS eff_start
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def q_eff_start(t: Tables) -> DataFrame:
    start = F.date_sub(day("l_shipdate"), F.col("l_linenumber"))
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(*LINE_KEY, normalize_eff_start(start, "o_orderdate").alias("eff_start"))


@query(
    "q_bu_rules",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linestatus WHEN 'F' THEN 'LCFC' ELSE 'X1' END AS odm,
    CASE WHEN l_returnflag = 'A' THEN CAST(l_partkey AS VARCHAR) ELSE 'S' || l_suppkey END AS site_item,
    CAST(l_partkey AS VARCHAR) AS item, CASE WHEN l_linenumber > 5 THEN 'OWN' END AS bu FROM lineitem),
parts AS (SELECT CAST(p_partkey AS VARCHAR) AS code, p_size, p_type, p_brand FROM part),
one AS (SELECT r.*, coalesce(CASE WHEN odm = 'LCFC' THEN CASE WHEN site_item <> item THEN 'DIFFERENT'
    WHEN p_size <= 30 THEN 'SAME' END END, bu) AS b FROM r LEFT JOIN parts ON code = item),
two AS (SELECT one.*, CASE WHEN odm = 'LCFC' AND b IS NULL THEN p_type ELSE b END AS c
  FROM one LEFT JOIN (SELECT * FROM parts WHERE p_size > 20) ON code = site_item),
family AS (SELECT code, CASE WHEN min(k) = max(k) THEN min(k) ELSE 'IdeaNB' END AS f FROM (
  SELECT code, p_type AS k FROM parts WHERE p_size > 10 UNION ALL SELECT code, p_brand FROM parts WHERE p_size > 40) GROUP BY code)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(CASE WHEN odm = 'X1' THEN f END, c) AS bu
FROM two LEFT JOIN family ON code = item""",
)
def q_bu_rules(t: Tables) -> DataFrame:
    """Ordered rules of the pipelines: by codes, from the using parts, from the family."""
    key = F.col("p_partkey").cast("string")
    rows = t.lineitem.select(
        *LINE_KEY,
        F.when(F.col("l_linestatus") == "F", "LCFC").otherwise("X1").alias("odm"),
        F.when(F.col("l_returnflag") == "A", F.col("l_partkey").cast("string"))
        .otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
        .alias("site_item"),
        F.col("l_partkey").cast("string").alias("item"),
        F.when(F.col("l_linenumber") > 5, "OWN").alias("bu"),
    )
    known = t.part.filter("p_size <= 30").select(key.alias("component"))
    used = t.part.filter("p_size > 20").select(
        key.alias("comp"), F.lit("LCFC").alias("werks"), F.col("p_type").alias("bu")
    )
    kinds = t.part.filter("p_size > 10").select(key.alias("comp"), F.lit("X1").alias("werks"), F.col("p_type").alias("bu"))
    brands = t.part.filter("p_size > 40").select(key.alias("comp"), F.lit("X1").alias("werks"), F.col("p_brand").alias("bu"))
    rows = bu_by_codes(rows, known, "site_item", "item", ("DIFFERENT", "SAME"), "LCFC")
    rows = bu_from_components(rows, used, "site_item", "LCFC")
    rows = bu_from_family(rows, kinds.union(brands), "item", ["X1"])
    return rows.select(*LINE_KEY, "bu")


@query(
    "q_parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN DATE '2000-01-01'
  ELSE CAST(o_orderdate AS DATE) END AS received
FROM orders""",
)
def q_parse_date(t: Tables) -> DataFrame:
    """ISO text, two-digit years with a stray mark, and missing text.

    Two-digit years of the last century lie a hundred years ahead, so only later ones are written
    in that form.
    """
    short = F.concat(F.date_format("o_orderdate", "dd-MM"), F.lit("?-"), F.date_format("o_orderdate", "yy"))
    recent = F.year("o_orderdate") >= 2000
    text = (
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .when(recent & (F.col("o_orderstatus") == "F"), short)
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    return t.orders.select("o_orderkey", parse_mixed_date(text).alias("received"))


@query(
    "q_split_ratio",
    f"""WITH {MV_SQL}
SELECT p_partkey, token AS code, CAST(1.0 AS DOUBLE) / n AS ratio FROM (
  SELECT p_partkey, unnest(parts) AS token, len(parts) AS n FROM (
    SELECT p_partkey, regexp_split_to_array(code, '[&,]') AS parts FROM mv WHERE regexp_matches(code, '[&,]')))
UNION ALL SELECT p_partkey, code, NULL FROM mv WHERE NOT regexp_matches(code, '[&,]')""",
)
def q_split_ratio(t: Tables) -> DataFrame:
    rows = t.multi_valued.withColumn("child", F.lit("x"))
    return union_unsplit_and_split(rows, "code", "child").drop("child")


@query(
    "q_split_share",
    f"""WITH {MV_SQL}
SELECT p_partkey, count(*) AS tokens, CAST(sum(1.0 / 2) AS DOUBLE) AS share FROM (
  SELECT p_partkey, unnest(string_split(code, '&')) AS token FROM mv WHERE contains(code, '&'))
GROUP BY p_partkey""",
)
def q_split_share(t: Tables) -> DataFrame:
    """The shares of one row sum to 1."""
    return (
        split_rows(t.multi_valued, "code", "&")
        .groupBy("p_partkey")
        .agg(F.count(F.lit(1)).alias("tokens"), F.sum("ratio").alias("share"))
    )


@query(
    "q_split_tokens",
    """SELECT DISTINCT p_brand, unnest(string_split(p_name, ' ')) AS p_name FROM part""",
)
def q_split_tokens(t: Tables) -> DataFrame:
    return split_tokens(t.part.select("p_brand", "p_name"), "p_name", " ")


@query(
    "q_clean_text",
    """SELECT doc_id, nullif(trim(regexp_replace(text, '[\\x00-\\x1f\\x7f]', '', 'g')), '') AS text
FROM documents""",
)
def q_clean_text(t: Tables) -> DataFrame:
    documents = t.spark.read.schema("doc_id bigint, text string").parquet(
        f"{t.folder}/documents.parquet"
    )
    return documents.select("doc_id", clean.clean_text("text").alias("text"))

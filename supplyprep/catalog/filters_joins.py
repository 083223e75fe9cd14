"""Queries of the predicate, join and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.catalog.registry import query
from supplyprep.catalog.tables import E_SQL, Tables, day, money, money_sql
from supplyprep.functions.clean import join_text
from supplyprep.functions.dates import valid_on
from supplyprep.operators import joins
from supplyprep.operators.joins import exists_in, not_exists_in
from supplyprep.operators.rows import holds
from supplyprep.operators.split import has_separator
from supplyprep.sources.writers import append


@query(
    "q_concat_key",
    """SELECT l_orderkey || '_' || l_linenumber || '_' || l_partkey AS item, count(*) AS n
FROM lineitem GROUP BY 1""",
)
def q_concat_key(t: Tables) -> DataFrame:
    key = join_text("l_orderkey", F.lit("_"), "l_linenumber", F.lit("_"), "l_partkey")
    return t.lineitem.groupBy(key.alias("item")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_filters",
    r"""SELECT p_partkey, p_brand, p_type FROM part
WHERE p_type IN ('PROMO', 'SMALL', 'LARGE') AND p_brand NOT IN ('Brand#1', 'Brand#2')
  AND p_name LIKE '%ing%' AND coalesce(nullif(p_type, 'LARGE'), 'X') NOT LIKE '%M%L%'
  AND length(p_brand) > 7 AND regexp_matches(p_brand, '#[0-9]*[13579]$')""",
)
def q_filters(t: Tables) -> DataFrame:
    known = F.coalesce(F.nullif("p_type", F.lit("LARGE")), F.lit("X"))
    return t.part.filter(
        F.col("p_type").isin("PROMO", "SMALL", "LARGE")
        & ~F.col("p_brand").isin("Brand#1", "Brand#2")
        & F.col("p_name").contains("ing")
        & ~known.like("%M%L%")
        & (F.length("p_brand") > 7)
        & F.col("p_brand").rlike("#[0-9]*[13579]$")
    ).select("p_partkey", "p_brand", "p_type")


@query(
    "q_no_separator",
    """SELECT p_partkey, p_name FROM part
WHERE coalesce(nullif(p_name, 'red ring'), 'X') NOT LIKE '% r%'""",
)
def q_no_separator(t: Tables) -> DataFrame:
    """Null-safe negated text test: a missing text counts as one without the separator."""
    text = F.nullif("p_name", F.lit("red ring"))
    return t.part.filter(~has_separator(text, [" r"])).select("p_partkey", "p_name")


@query(
    "q_tuple_in",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE (l_partkey, l_suppkey) IN (
  SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30)""",
)
def q_tuple_in(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    returned = t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 30")
    return exists_in(rows, returned, ["l_partkey", "l_suppkey"])


@query(
    "q_not_in",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (
  SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def q_not_in(t: Tables) -> DataFrame:
    returned = t.lineitem.filter("l_returnflag = 'R'")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return joins.not_in(rows, "o_orderkey", returned, "l_orderkey")


@query(
    "q_not_in_nulls",
    """SELECT 'null in list' AS kind, count(*) AS n FROM part WHERE p_size NOT IN (
  SELECT nullif(p_size, 7) FROM part WHERE p_size < 10)
UNION ALL SELECT 'null on the left', count(*) FROM part WHERE nullif(p_size, 30) NOT IN (
  SELECT p_size FROM part WHERE p_size < 10)
UNION ALL SELECT 'empty list', count(*) FROM part WHERE nullif(p_size, 30) NOT IN (
  SELECT p_size FROM part WHERE p_size < 0)""",
)
def q_not_in_nulls(t: Tables) -> DataFrame:
    small = t.part.filter("p_size < 10").select(F.nullif("p_size", F.lit(7)).alias("code"))
    plain = t.part.filter("p_size < 10").select(F.col("p_size").alias("code"))
    none = t.part.filter("p_size < 0").select(F.col("p_size").alias("code"))
    holes = t.part.select(F.nullif("p_size", F.lit(30)).alias("size"))
    cases = (
        ("null in list", t.part.select(F.col("p_size").alias("size")), small),
        ("null on the left", holes, plain),
        ("empty list", holes, none),
    )
    counted = [
        joins.not_in(rows, "size", codes, "code").agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n")
        )
        for kind, rows, codes in cases
    ]
    return append(*counted)


@query(
    "q_valid_interval",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE CAST(l_shipdate AS DATE) <= DATE '1998-06-15'
  AND CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) >= DATE '1998-06-15'""",
)
def q_valid_interval(t: Tables) -> DataFrame:
    end = F.date_add(day("l_shipdate"), F.col("l_quantity").cast("int"))
    return t.lineitem.filter(
        valid_on(F.to_date(F.lit("1998-06-15")), day("l_shipdate"), end)
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "q_flags_null",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE nullif(l_returnflag, 'N') IS NULL
  AND l_linestatus = 'O' AND (l_quantity > 40 OR nullif(l_linenumber, 7) IS NULL)""",
)
def q_flags_null(t: Tables) -> DataFrame:
    return t.lineitem.filter(
        F.nullif("l_returnflag", F.lit("N")).isNull()
        & (F.col("l_linestatus") == "O")
        & ((F.col("l_quantity") > 40) | F.nullif("l_linenumber", F.lit(7)).isNull())
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "q_inner_multi",
    f"""SELECT n_name, count(*) AS n, {money_sql('o_totalprice')} AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'F' GROUP BY n_name""",
)
def q_inner_multi(t: Tables) -> DataFrame:
    # Orders shrink to one row per customer before they meet the other tables.
    per_customer = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s")
    )
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.sum("n").alias("n"), F.sum("s").cast("double").alias("total"))
    )


@query(
    "q_left_alias",
    """SELECT n_name, coalesce(s_name, 'no supplier') AS supplier FROM nation
LEFT JOIN supplier ON n_nationkey = s_nationkey AND s_acctbal > 5000""",
)
def q_left_alias(t: Tables) -> DataFrame:
    rich = t.supplier.filter("s_acctbal > 5000")
    return t.nation.join(rich, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(
        "n_name", F.coalesce("s_name", F.lit("no supplier")).alias("supplier")
    )


@query(
    "q_self_join",
    f"WITH {E_SQL} SELECT a.father AS top, a.son AS middle, b.son AS bottom, "
    "CAST(a.qty * b.qty AS BIGINT) AS qty FROM e a JOIN e b ON a.son = b.father AND a.grp = b.grp",
)
def q_self_join(t: Tables) -> DataFrame:
    above = t.edges.select(
        F.col("father").alias("top"), F.col("son").alias("middle"), "grp", F.col("qty").alias("q")
    )
    below = t.edges.select(
        F.col("father").alias("f"), F.col("son").alias("bottom"), F.col("grp").alias("g"), "qty"
    )
    return above.join(below, (F.col("middle") == F.col("f")) & (F.col("grp") == F.col("g"))).select(
        "top", "middle", "bottom", (F.col("q") * F.col("qty")).alias("qty")
    )


@query(
    "q_semi",
    """SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (
  SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)""",
)
def q_semi(t: Tables) -> DataFrame:
    large = t.lineitem.filter("l_quantity > 45")
    return exists_in(t.orders.select("o_orderkey", "o_custkey"), large, [("o_orderkey", "l_orderkey")])


@query(
    "q_anti",
    """SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (
  SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def q_anti(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey")
    return not_exists_in(rows, t.lineitem, [("o_orderkey", "l_orderkey")])


@query(
    "q_nested_exists",
    """SELECT p_partkey, p_type FROM part WHERE NOT EXISTS (
  SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND EXISTS (
    SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'P' AND EXISTS (
      SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')))""",
)
def q_nested_exists(t: Tables) -> DataFrame:
    building = t.customer.filter("c_mktsegment = 'BUILDING'")
    orders = exists_in(
        t.orders.filter("o_orderstatus = 'P'"), building, [("o_custkey", "c_custkey")]
    )
    lines = exists_in(t.lineitem, orders, [("l_orderkey", "o_orderkey")])
    return not_exists_in(t.part.select("p_partkey", "p_type"), lines, [("p_partkey", "l_partkey")])


@query(
    "q_semi_neq",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem a WHERE EXISTS (
  SELECT 1 FROM lineitem b WHERE a.l_orderkey = b.l_orderkey AND a.l_partkey <> b.l_partkey)""",
)
def q_semi_neq(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.with_other_child(rows, ["l_orderkey"], "l_partkey")


@query(
    "q_anti_nullsafe",
    """SELECT DISTINCT nullif(l_returnflag, 'A') AS flag, nullif(l_linenumber, 7) AS line, l_suppkey
FROM lineitem a WHERE NOT EXISTS (
  SELECT 1 FROM lineitem b WHERE l_quantity < 3
    AND nullif(b.l_returnflag, 'A') IS NOT DISTINCT FROM nullif(a.l_returnflag, 'A')
    AND nullif(b.l_linenumber, 7) IS NOT DISTINCT FROM nullif(a.l_linenumber, 7)
    AND b.l_suppkey = a.l_suppkey)""",
)
def q_anti_nullsafe(t: Tables) -> DataFrame:
    def holes(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.nullif("l_returnflag", F.lit("A")).alias("flag"),
            F.nullif("l_linenumber", F.lit(7)).alias("line"),
            "l_suppkey",
        )

    keys = ["flag", "line", "l_suppkey"]
    small = holes(t.lineitem.filter("l_quantity < 3"))
    return not_exists_in(holes(t.lineitem).distinct(), small, keys, null_safe=True)


@query(
    "q_prefix_join",
    """WITH dim AS (SELECT DISTINCT p_brand AS code FROM part),
rows AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN p_brand ELSE p_brand || 'X' END AS item,
         p_brand || 'X' || p_size AS site_pn FROM part)
SELECT p_partkey, site_pn, CASE
    WHEN item IN (SELECT code FROM dim) THEN item
    WHEN substr(site_pn, 1, 7) IN (SELECT code FROM dim) THEN substr(site_pn, 1, 7)
    WHEN substr(site_pn, 1, 10) IN (SELECT code FROM dim) THEN substr(site_pn, 1, 10)
    ELSE item END AS item FROM rows""",
)
def q_prefix_join(t: Tables) -> DataFrame:
    dim = t.part.select(F.col("p_brand").alias("code"))
    item = F.when(F.col("p_size") < 10, F.col("p_brand")).otherwise(
        F.concat("p_brand", F.lit("X"))
    )
    rows = t.part.select(
        "p_partkey",
        item.alias("item"),
        F.concat("p_brand", F.lit("X"), F.col("p_size").cast("string")).alias("site_pn"),
    )
    return joins.canonical_prefix(rows, "item", "site_pn", dim, "code", (7, 10))


@query(
    "q_contains_best",
    """WITH words AS (SELECT DISTINCT p_type AS word FROM part
  UNION SELECT DISTINCT upper(split_part(p_name, ' ', 2)) FROM part)
SELECT p_partkey, max(word) AS best FROM part
LEFT JOIN words ON instr(upper(p_name || ' ' || CASE WHEN p_size > 25 THEN p_type ELSE '' END), word) > 0
WHERE p_name NOT LIKE '%none%' GROUP BY p_partkey""",
)
def q_contains_best(t: Tables) -> DataFrame:
    second = F.upper(F.split_part("p_name", F.lit(" "), F.lit(2)))
    words = t.part.select(F.col("p_type").alias("word")).union(t.part.select(second)).distinct()
    kind = F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.lit(""))
    text = F.upper(F.concat("p_name", F.lit(" "), kind))
    found = joins.contained_best(t.part, text, words, "word", "word", "best")
    return found.select("p_partkey", "best")


@query(
    "q_any_match",
    """SELECT s_suppkey, min(p_brand) AS brand FROM supplier
LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_returnflag = 'R'
LEFT JOIN part ON p_partkey = l_partkey GROUP BY s_suppkey""",
)
def q_any_match(t: Tables) -> DataFrame:
    parts = t.lineitem.filter("l_returnflag = 'R'").select("l_suppkey", "l_partkey").distinct()
    brands = parts.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = t.supplier.select("s_suppkey")
    return joins.any_match(rows, brands, [("s_suppkey", "l_suppkey")], "p_brand", "brand")


@query(
    "q_scalar_sub",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) - coalesce((
  SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lineitem
  WHERE l_orderkey = o_orderkey), 0) AS DOUBLE) AS rest FROM orders""",
)
def q_scalar_sub(t: Tables) -> DataFrame:
    summed = joins.sum_lookup(
        t.orders,
        t.lineitem,
        [("o_orderkey", "l_orderkey")],
        F.col("l_extendedprice").cast("decimal(18,2)"),
        "lines",
    )
    rest = F.col("o_totalprice").cast("decimal(18,2)") - F.col("lines")
    return summed.select("o_orderkey", rest.cast("double").alias("rest"))


@query(
    "q_casefold",
    """SELECT c_custkey, n_name FROM customer JOIN nation
ON upper(lower(n_name)) = upper('nation_' || c_nationkey)""",
)
def q_casefold(t: Tables) -> DataFrame:
    left = t.customer.select(
        "c_custkey", F.upper(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))).alias("k")
    )
    right = t.nation.select("n_name", F.upper(F.lower("n_name")).alias("folded"))
    return left.join(right, F.col("k") == F.col("folded")).select("c_custkey", "n_name")


@query(
    "q_full_outer",
    """SELECT coalesce(r.l_partkey, n.l_partkey) AS l_partkey, coalesce(r.l_suppkey, n.l_suppkey) AS l_suppkey,
  coalesce(returned, 0) AS returned, coalesce(kept, 0) AS kept FROM (
  SELECT l_partkey, l_suppkey, sum(l_quantity) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) r
FULL JOIN (SELECT l_partkey, l_suppkey, sum(l_quantity) AS kept FROM lineitem
  WHERE l_returnflag = 'N' GROUP BY 1, 2) n ON r.l_partkey = n.l_partkey AND r.l_suppkey = n.l_suppkey""",
)
def q_full_outer(t: Tables) -> DataFrame:
    keys = ["l_partkey", "l_suppkey"]
    returned = t.lineitem.filter("l_returnflag = 'R'").groupBy(*keys).agg(
        F.sum("l_quantity").alias("returned")
    )
    kept = t.lineitem.filter("l_returnflag = 'N'").groupBy(*keys).agg(
        F.sum("l_quantity").alias("kept")
    )
    return returned.join(kept, keys, "full_outer").select(
        *keys,
        F.coalesce("returned", F.lit(0.0)).alias("returned"),
        F.coalesce("kept", F.lit(0.0)).alias("kept"),
    )


@query(
    "q_union_all",
    """SELECT c_nationkey AS nation, 'customer' AS kind, c_name AS name FROM customer
UNION ALL SELECT s_nationkey, 'supplier', s_name FROM supplier""",
)
def q_union_all(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind"), F.col("c_name").alias("name")
    )
    suppliers = t.supplier.select(
        F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"), F.col("s_name").alias("name")
    )
    return append(customers, suppliers)


@query(
    "q_union",
    """SELECT c_custkey AS code, 'known' AS kind FROM customer UNION SELECT s_suppkey, 'known' FROM supplier
UNION ALL (SELECT p_partkey, 'other' FROM part EXCEPT (
  SELECT c_custkey, 'other' FROM customer UNION SELECT s_suppkey, 'other' FROM supplier))""",
)
def q_union(t: Tables) -> DataFrame:
    """Distinct union, and the difference as an anti join."""
    known = t.customer.select(F.col("c_custkey").alias("code")).union(t.supplier.select("s_suppkey")).distinct()
    other = not_exists_in(t.part, known, [("p_partkey", "code")]).select(F.col("p_partkey").alias("code"))
    return append(known.withColumn("kind", F.lit("known")), other.withColumn("kind", F.lit("other")))


@query(
    "q_many_inserts",
    f"""SELECT 'large' AS step, l_partkey AS item, {money_sql('l_extendedprice')} AS amount
FROM lineitem WHERE l_quantity > 45 GROUP BY l_partkey
UNION ALL SELECT 'returned', l_partkey, {money_sql('l_extendedprice')}
FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey
UNION ALL SELECT 'taxed', l_partkey, {money_sql('l_extendedprice')}
FROM lineitem WHERE l_tax > 0.06 GROUP BY l_partkey""",
)
def q_many_inserts(t: Tables) -> DataFrame:
    """Independent filtered inserts in one scan: each row carries the steps it belongs to."""
    steps = {
        "large": F.col("l_quantity") > 45,
        "returned": F.col("l_returnflag") == "R",
        "taxed": F.col("l_tax") > 0.06,
    }
    hits = F.filter(
        F.array(*[F.when(holds(c), F.lit(name)) for name, c in steps.items()]),
        lambda step: step.isNotNull(),
    )
    return (
        t.lineitem.select(F.explode(hits).alias("step"), F.col("l_partkey").alias("item"), "l_extendedprice")
        .groupBy("step", "item")
        .agg(money("l_extendedprice").alias("amount"))
    )

"""Queries of the bill-of-material operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.catalog.registry import query
from supplyprep.catalog.tables import C_SQL, E_SQL, RUN, Tables
from supplyprep.operators import graph
from supplyprep.operators.groups import multi_mapped
from supplyprep.operators.joins import exists_in
from supplyprep.schemas import OUTPUTS

EDGE = ["father", "son", "grp"]

# Edges between items: the names of two parts, their brands as site codes.
ITEM_EDGES_SQL = (
    E_SQL
    + """,
b AS (
  SELECT 'S' || grp AS odm, f.p_name AS father_pn, f.p_brand AS father_site_pn, s.p_name AS son_pn,
    s.p_brand AS son_site_pn, CAST(qty AS DOUBLE) AS qtyper,
    CASE WHEN s.p_size > 5 THEN DATE '2002-01-01' ELSE DATE '2001-01-01' END AS eff_end,
    CASE WHEN s.p_type = 'SMALL' THEN 'OTHER' ELSE 'supplyprep' END AS created_by,
    CAST(son AS VARCHAR) AS flag
  FROM e JOIN part f ON f.p_partkey = father JOIN part s ON s.p_partkey = son)"""
)
MULTI_SQL = """m AS (
  SELECT DISTINCT odm, father_pn, father_site_pn FROM (
    SELECT *, count(*) OVER (PARTITION BY odm, father_pn) AS of_item,
      count(*) OVER (PARTITION BY odm, father_pn, father_site_pn) AS of_code
    FROM b WHERE created_by = 'supplyprep' AND eff_end >= DATE '2001-07-30')
  WHERE of_item / of_code > 1)"""
SHOWN = ["odm", "father_pn", "father_site_pn", "son_pn", "son_site_pn"]

# Edges between part keys as codes; codes of large parts are unknown on the company side.
NODE_EDGES_SQL = (
    E_SQL
    + """,
n AS (
  SELECT 'S' || grp AS odm, CASE WHEN f.p_type <> 'LARGE' THEN 'I' || father END AS father_pn,
    'C' || father AS father_site_pn, CASE WHEN s.p_type <> 'LARGE' THEN 'I' || son END AS son_pn,
    'C' || son AS son_site_pn, CAST(qty AS DOUBLE) AS qtyper, f.p_type AS father_type,
    s.p_type AS son_type
  FROM e JOIN part f ON f.p_partkey = father JOIN part s ON s.p_partkey = son)"""
)


def _code(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def with_parts(t: Tables) -> DataFrame:
    """Edges with the columns of both parts, prefixed ``f_`` and ``s_``."""
    result = t.edges
    for side, column in (("f", "father"), ("s", "son")):
        names = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")
        part = t.part.select(*[F.col(c).alias(f"{side}_{c[2:]}") for c in names])
        result = result.join(part, F.col(column) == F.col(f"{side}_partkey"))
    return result


def item_edges(t: Tables) -> DataFrame:
    values = {
        "odm": _code("S", "grp"),
        "father_pn": F.col("f_name"),
        "father_site_pn": F.col("f_brand"),
        "son_pn": F.col("s_name"),
        "son_site_pn": F.col("s_brand"),
        "qtyper": F.col("qty"),
        "eff_end": F.to_date(F.when(F.col("s_size") > 5, "2002-01-01").otherwise("2001-01-01")),
        "created_by": F.when(F.col("s_type") == "SMALL", "OTHER").otherwise("supplyprep"),
        "flag": F.col("son").cast("string"),
    }
    return with_parts(t).select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in OUTPUTS["bom"].fields
        ]
    )


def node_edges(t: Tables) -> DataFrame:
    def known(side: str, column: str) -> Column:
        return F.when(F.col(f"{side}_type") != "LARGE", _code("I", column))

    return with_parts(t).select(
        _code("S", "grp").alias("odm"),
        known("f", "father").alias("father_pn"),
        _code("C", "father").alias("father_site_pn"),
        known("s", "son").alias("son_pn"),
        _code("C", "son").alias("son_site_pn"),
        F.col("qty").cast("double").alias("qtyper"),
        F.col("f_type").alias("father_type"),
        F.col("s_type").alias("son_type"),
    )


def parts_of(t: Tables, *types: str) -> DataFrame:
    return t.part.filter(F.col("p_type").isin(*types)).select(F.col("p_partkey").alias("code"))


WALK_SQL = (
    "WITH RECURSIVE "
    + C_SQL
    + """,
w(father, son, grp, path) AS (
  SELECT father, son, grp, [father] FROM c WHERE father < 3
  UNION ALL
  SELECT c.father, c.son, c.grp, list_append(w.path, c.father) FROM w
  JOIN c ON c.father = w.son AND c.grp = w.grp WHERE NOT list_contains(w.path, w.son)),
found AS (
  SELECT grp, father, son, CAST(min(len(path)) AS INTEGER) AS level FROM w
  WHERE list_contains(path, son) GROUP BY ALL)"""
)


def cycle_edges(t: Tables) -> DataFrame:
    return graph.find_cycle_edges(
        t.cyclic_edges, F.col("father") < 3, "father", "son", group=["grp"]
    )


@query(
    "q_cycle_edges",
    WALK_SQL
    + """ SELECT grp, father, son, level,
  (SELECT count(*) FROM c WHERE c.father = found.son AND c.grp = found.grp) <= 1 AS is_leaf
FROM found""",
)
def q_cycle_edges(t: Tables) -> DataFrame:
    return cycle_edges(t)


@query(
    "q_cycle_removed",
    WALK_SQL
    + """ SELECT father, son, grp FROM c
WHERE (father, son, grp) NOT IN (SELECT (father, son, grp) FROM found)""",
)
def q_cycle_removed(t: Tables) -> DataFrame:
    return graph.delete_cycle_edges(t.cyclic_edges.select(*EDGE), cycle_edges(t), EDGE)


@query(
    "q_flagged_ancestor",
    "WITH RECURSIVE "
    + E_SQL
    + """,
up(node, ancestor, distance) AS (
  SELECT son, father, 1 FROM e UNION ALL
  SELECT node, e.father, distance + 1 FROM up JOIN e ON e.son = up.ancestor
  JOIN part ON p_partkey = up.ancestor AND p_type <> 'PROMO')
SELECT node AS son, ancestor, distance FROM up JOIN part ON p_partkey = ancestor
WHERE p_type = 'PROMO'""",
)
def q_flagged_ancestor(t: Tables) -> DataFrame:
    promo = t.part.select("p_partkey", "p_type")
    edges = t.edges.join(promo, F.col("father") == F.col("p_partkey"))
    label = F.when(F.col("p_type") == "PROMO", F.col("father"))
    return graph.flagged_ancestor(edges, "father", "son", ["grp"], label).drop("grp")


LOOP_SQL = """
SELECT odm, father_pn, father_site_pn, CASE WHEN father_pn = son_pn THEN NULL ELSE son_pn END AS son_pn,
  son_site_pn, flag FROM b x WHERE father_pn <> son_pn OR NOT EXISTS (
  SELECT 1 FROM b y WHERE x.odm = y.odm AND x.{same} = y.{same} AND y.father_pn <> y.son_pn)"""


@query("q_self_loop", f"WITH {ITEM_EDGES_SQL} {LOOP_SQL.format(same='father_site_pn')}")
def q_self_loop(t: Tables) -> DataFrame:
    """Loops by item name; another edge of the same father code decides."""
    edges = item_edges(t).select(*SHOWN, "flag")
    return graph.drop_self_loops(edges, ["odm"], "father_pn", "son_pn", same="father_site_pn")


@query("q_self_loop_father", f"WITH {ITEM_EDGES_SQL} {LOOP_SQL.format(same='father_pn')}")
def q_self_loop_father(t: Tables) -> DataFrame:
    edges = item_edges(t).select(*SHOWN, "flag")
    return graph.drop_self_loops(edges, ["odm"], "father_pn", "son_pn")


@query(
    "q_self_loop_son",
    f"""WITH {ITEM_EDGES_SQL}
SELECT odm, father_pn, father_site_pn,
  CASE WHEN father_pn = son_pn AND son_site_pn <> 'Brand#3' THEN NULL ELSE son_pn END AS son_pn,
  son_site_pn, flag FROM b x
WHERE father_pn <> son_pn OR son_site_pn = 'Brand#3' OR NOT EXISTS (
  SELECT 1 FROM b y WHERE x.odm = y.odm AND x.son_pn = y.son_pn AND x.father_pn <> y.father_pn)""",
)
def q_self_loop_son(t: Tables) -> DataFrame:
    edges = item_edges(t).select(*SHOWN, "flag")
    return graph.drop_self_loops(
        edges, ["odm"], "father_pn", "son_pn", same="son", only=F.col("son_site_pn") != "Brand#3"
    )


@query(
    "q_bypass",
    f"""WITH {NODE_EDGES_SQL}
SELECT odm, father_pn, father_site_pn, son_pn, son_site_pn, qtyper FROM n
WHERE son_type <> 'SMALL'
UNION ALL
SELECT a.odm, a.father_pn, a.father_site_pn, b.son_pn, b.son_site_pn, b.qtyper
FROM n a JOIN n b ON a.odm = b.odm AND a.son_site_pn = b.father_site_pn
WHERE a.son_type = 'SMALL' AND a.father_type <> 'SMALL' AND NOT EXISTS (
  SELECT 1 FROM n c WHERE c.odm = a.odm AND c.father_pn IS NOT DISTINCT FROM a.father_pn
    AND c.father_site_pn = a.father_site_pn AND c.son_pn IS NOT DISTINCT FROM b.son_pn
    AND c.son_site_pn = b.son_site_pn)""",
)
def q_bypass(t: Tables) -> DataFrame:
    edges = node_edges(t)
    upper = (F.col("son_type") == "SMALL") & (F.col("father_type") != "SMALL")
    bypassed = graph.bypass_level(edges, edges, upper, remove=F.col("son_type") == "SMALL")
    return bypassed.select(*SHOWN, "qtyper")


@query(
    "q_forbidden",
    f"""WITH {NODE_EDGES_SQL}
SELECT odm, father_site_pn, son_site_pn FROM n
WHERE NOT (father_type = 'PROMO' AND son_type = 'PROMO') OR EXISTS (
  SELECT 1 FROM part WHERE 'C' || p_partkey = father_site_pn
    AND (p_brand = 'Brand#1' OR p_size > 40))""",
)
def q_forbidden(t: Tables) -> DataFrame:
    codes = t.part.withColumn("code", _code("C", "p_partkey"))
    allowed = [(codes.filter("p_brand = 'Brand#1'"), "code"), (codes.filter("p_size > 40"), "code")]
    forbidden = (F.col("father_type") == "PROMO") & (F.col("son_type") == "PROMO")
    kept = graph.drop_forbidden_edges(node_edges(t), forbidden, allowed, F.col("father_site_pn"))
    return kept.select("odm", "father_site_pn", "son_site_pn")


@query(
    "q_edges_to_both",
    f"""WITH {E_SQL} SELECT father, son, grp FROM e
WHERE NOT (grp = 0 AND son IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')
  AND son IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49))""",
)
def q_edges_to_both(t: Tables) -> DataFrame:
    large = t.lineitem.filter("l_quantity > 49")
    return graph.drop_edges_to_both(
        t.edges.select(*EDGE),
        F.col("grp") == 0,
        "son",
        [(parts_of(t, "PROMO"), "code"), (large, "l_partkey")],
    )


@query(
    "q_null_child",
    f"""WITH {E_SQL} SELECT father, grp, CASE
  WHEN son IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')
   AND father IN (SELECT p_partkey FROM part WHERE p_type = 'SMALL') THEN NULL ELSE son END AS son
FROM e""",
)
def q_null_child(t: Tables) -> DataFrame:
    return graph.null_child_by_dims(
        t.edges.select(*EDGE),
        None,
        "son",
        parts_of(t, "PROMO"),
        "code",
        F.col("father"),
        parts_of(t, "SMALL"),
        "code",
    )


@query(
    "q_readmit",
    f"""WITH {E_SQL} SELECT father, son, grp FROM e JOIN part ON p_partkey = son
WHERE p_type <> 'PROMO' OR father IN (
  SELECT l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')""",
)
def q_readmit(t: Tables) -> DataFrame:
    raw = t.edges.select(*EDGE)
    left = graph.drop_fathers_in(raw, F.lit(True), "son", parts_of(t, "PROMO"), "code")
    urgent = t.orders.filter("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
    lines = exists_in(t.lineitem, urgent, [("l_orderkey", "o_orderkey")])
    return graph.readmit_edges(
        left, raw, lines, "l_partkey", parts_of(t, "PROMO"), "code", "father", "son"
    )


@query(
    "q_allow_list",
    f"""WITH {E_SQL}, p AS (SELECT p_partkey AS k, p_type AS kind FROM part)
SELECT father, son, grp FROM e
WHERE grp <> 0 OR NOT (
    (father IN (SELECT k FROM p WHERE kind IN ('MEDIUM', 'SMALL', 'LARGE'))
     AND son IN (SELECT k FROM p WHERE kind = 'PROMO')
     AND father NOT IN (SELECT k FROM p WHERE kind = 'SMALL'))
    OR (father IN (SELECT k FROM p WHERE kind = 'SMALL')
     AND son NOT IN (SELECT k FROM p WHERE kind = 'PROMO')))""",
)
def q_allow_list(t: Tables) -> DataFrame:
    return graph.drop_by_allow_list(
        t.edges.select(*EDGE),
        F.col("grp") == 0,
        parts_of(t, "MEDIUM", "SMALL", "LARGE"),
        "code",
        parts_of(t, "PROMO"),
        "code",
        "father",
        "son",
        allow=parts_of(t, "SMALL"),
    )


@query(
    "q_drop_fathers",
    f"""WITH {E_SQL} SELECT father, son, grp FROM e WHERE grp <> 1 OR father NOT IN (
  SELECT p_partkey FROM part WHERE p_type = 'LARGE' AND p_brand NOT IN ('Brand#1', 'Brand#2'))""",
)
def q_drop_fathers(t: Tables) -> DataFrame:
    items = t.part.filter("p_type = 'LARGE' AND p_brand NOT IN ('Brand#1', 'Brand#2')")
    return graph.drop_fathers_in(
        t.edges.select(*EDGE), F.col("grp") == 1, "father", items, "p_partkey"
    )


@query(
    "q_exceptions",
    f"""WITH {E_SQL} SELECT p_partkey AS code FROM part WHERE p_type = 'PROMO'
UNION SELECT son FROM e JOIN part ON p_partkey = father WHERE p_type = 'MEDIUM'""",
)
def q_exceptions(t: Tables) -> DataFrame:
    derived = exists_in(t.edges, parts_of(t, "MEDIUM"), [("father", "code")])
    return graph.exception_list(parts_of(t, "PROMO"), derived.select("son"))


@query(
    "q_split_father",
    f"""WITH {ITEM_EDGES_SQL}, {MULTI_SQL}
SELECT odm, father_pn, NULL AS father_site_pn, father_site_pn AS son_pn, father_site_pn AS son_site_pn,
  CAST(1 AS DOUBLE) AS qtyper, 'BOM_ADJUST_INSERT' AS created_by, NULL AS flag FROM m
UNION ALL
SELECT odm, CASE WHEN moved THEN father_site_pn ELSE father_pn END, father_site_pn,
  CASE WHEN NOT lost THEN son_pn END, son_site_pn, qtyper,
  CASE WHEN moved THEN 'BOM_ADJUST_UPDATE' ELSE created_by END || CASE WHEN lost THEN '_FIX' ELSE '' END,
  flag
FROM (SELECT *, created_by = 'supplyprep' AND (odm, father_pn, father_site_pn) IN (SELECT (odm, father_pn, father_site_pn) FROM m) AS moved,
    son_pn <> son_site_pn AND (odm, son_pn, son_site_pn) IN (SELECT (odm, father_pn, father_site_pn) FROM m)
      AND EXISTS (SELECT 1 FROM b c WHERE c.odm = b.odm AND c.father_site_pn = b.son_site_pn) AS lost
  FROM b)""",
)
def q_split_father(t: Tables) -> DataFrame:
    own = F.col("created_by") == "supplyprep"
    split = graph.split_multi_mapped_father(item_edges(t), RUN, own)
    return split.select(*SHOWN, F.col("qtyper").cast("double").alias("qtyper"), "created_by", "flag")


@query(
    "q_prefer_prefix",
    f"""WITH {ITEM_EDGES_SQL}, {MULTI_SQL},
stock AS (SELECT DISTINCT odm, father_pn FROM b WHERE qtyper > 2),
other AS (SELECT DISTINCT father_pn AS item, father_site_pn AS code FROM m
  WHERE father_pn LIKE 'red%' AND father_site_pn NOT LIKE 'Brand#1%'
    AND EXISTS (SELECT 1 FROM m p WHERE p.odm = m.odm AND p.father_pn = m.father_pn
      AND p.father_site_pn LIKE 'Brand#1%')
    AND EXISTS (SELECT 1 FROM stock s WHERE s.odm = m.odm AND s.father_pn = m.father_pn))
SELECT odm, CASE WHEN odm = 'S0' AND ((father_pn, father_site_pn) IN (SELECT (item, code) FROM other)
    OR (son_pn, son_site_pn) IN (SELECT (item, code) FROM other)) THEN NULL ELSE father_pn END AS father_pn,
  father_site_pn, son_pn, son_site_pn, flag FROM b""",
)
def q_prefer_prefix(t: Tables) -> DataFrame:
    edges = item_edges(t)
    current = edges.filter((F.col("created_by") == "supplyprep") & (F.col("eff_end") >= F.lit(RUN.plan_version)))
    mapping = multi_mapped(current, "odm", "father_pn", "father_site_pn")
    stock = edges.filter("qtyper > 2").select("odm", "father_pn")
    preferred = graph.prefer_prefix_mapping(
        edges, mapping, stock, F.col("odm") == "S0", "red", "Brand#1"
    )
    return preferred.select(*SHOWN, "flag")


@query(
    "q_dummy_level",
    f"""WITH {ITEM_EDGES_SQL}, dummy AS (
  SELECT DISTINCT 'S0' AS odm, p_name AS father_pn, p_name AS father_site_pn, p_brand AS son_pn,
    p_brand AS son_site_pn, CAST(1 AS DOUBLE) AS qtyper, 'VN' AS flag FROM part
  WHERE p_size > 25 AND p_type = 'PROMO' AND p_name LIKE 'red%'),
all_edges AS (SELECT odm, father_pn, father_site_pn, son_pn, son_site_pn, qtyper, flag FROM b
  UNION ALL SELECT * FROM dummy)
SELECT * FROM all_edges UNION ALL
SELECT 'S9', father_pn, father_site_pn, son_pn, son_site_pn, qtyper, flag FROM all_edges WHERE odm = 'S0'""",
)
def q_dummy_level(t: Tables) -> DataFrame:
    version = F.when(F.col("p_type") == "PROMO", "2001080201").otherwise("2001080109")
    feed = t.part.select(
        F.when(F.col("p_size") > 25, "S0").otherwise("S1").alias("from_odm"),
        F.col("p_name").alias("item"),
        F.col("p_brand").alias("odm_pn"),
        F.to_date(F.lit("2001-01-01")).alias("odm_created_date"),
        F.lit(RUN.run_ts).alias("create_time"),
        version.alias("version"),
    )
    edges = graph.insert_dummy_level(item_edges(t), feed, RUN, [("S0", "red")], flag="VN")
    cloned = graph.clone_site(edges, "odm", "S0", "S9")
    return cloned.select(*SHOWN, F.col("qtyper").cast("double").alias("qtyper"), "flag")


SUFFIX_SQL = (
    E_SQL
    + """,
k AS (
  SELECT grp, lpad(CAST(father AS VARCHAR), 10, '0') AS father, lpad(CAST(son AS VARCHAR), 10, '0') AS son
  FROM e
  UNION ALL
  SELECT grp, lpad(CAST(father AS VARCHAR), 10, '0'), lpad(CAST(son AS VARCHAR), 10, '0') || 'AA' FROM e
  UNION ALL
  SELECT grp, lpad(CAST(p_partkey AS VARCHAR), 10, '0'), lpad(CAST(p_partkey AS VARCHAR), 10, '0') || 'AB'
  FROM part, (SELECT DISTINCT grp FROM e) WHERE p_partkey % 3 = grp AND p_type = 'MEDIUM')"""
)


@query(
    "q_suffix_edges",
    f"""WITH {SUFFIX_SQL}
SELECT grp, father, son FROM k a WHERE NOT (length(son) > 10
  AND NOT EXISTS (SELECT 1 FROM k x WHERE x.father = a.son AND x.grp = a.grp)
  AND EXISTS (SELECT 1 FROM part WHERE lpad(CAST(p_partkey AS VARCHAR), 10, '0') = substr(a.son, 1, 10)
    AND p_type <> 'PROMO')
  AND EXISTS (SELECT 1 FROM k x WHERE x.father = substr(a.son, 1, 10) AND x.grp = a.grp)
  AND NOT EXISTS (SELECT 1 FROM k x WHERE x.father = substr(a.son, 1, 10) AND x.grp = a.grp
    AND substr(x.father, 1, 10) = substr(x.son, 1, 10)))""",
)
def q_suffix_edges(t: Tables) -> DataFrame:
    def code(column: str) -> Column:
        return F.lpad(F.col(column).cast("string"), 10, "0")

    plain = t.edges.select("grp", code("father").alias("father"), code("son").alias("son"))
    long_codes = plain.withColumn("son", F.concat("son", F.lit("AA")))
    nested = t.part.filter("p_type = 'MEDIUM'").select(
        F.expr("p_partkey % 3").alias("grp"),
        code("p_partkey").alias("father"),
        F.concat(code("p_partkey"), F.lit("AB")).alias("son"),
    )
    dim = t.part.filter("p_type <> 'PROMO'").select(code("p_partkey").alias("component"))
    return graph.drop_redundant_suffix_edges(
        plain.union(long_codes).union(nested), dim, "component", None, "grp", "father", "son"
    )


@query(
    "q_variant",
    f"""WITH {NODE_EDGES_SQL}, v AS (
  SELECT odm, father_pn, father_site_pn, son_site_pn FROM n WHERE father_type <> 'PROMO'
  UNION ALL SELECT odm, father_pn, father_site_pn || '$01', son_site_pn FROM n WHERE odm = 'S1')
SELECT * FROM v a WHERE NOT (father_site_pn LIKE '%$%' AND EXISTS (
  SELECT 1 FROM v x WHERE x.father_pn = a.father_pn AND x.odm = a.odm
    AND x.father_site_pn <> a.father_site_pn AND x.father_site_pn NOT LIKE '%$%'))""",
)
def q_variant(t: Tables) -> DataFrame:
    edges = node_edges(t)
    columns = ["odm", "father_pn", "father_site_pn", "son_site_pn"]
    plain = edges.filter("father_type <> 'PROMO'").select(*columns)
    variants = edges.filter("odm = 'S1'").select(
        "odm", "father_pn", F.concat("father_site_pn", F.lit("$01")).alias("father_site_pn"), "son_site_pn"
    )
    return graph.drop_variant_fathers(plain.union(variants), "odm", "father_pn", "father_site_pn")


@query(
    "q_compound",
    """WITH r AS (SELECT p_type AS odm, p_brand || '_' || p_type AS father, p_name AS son,
    DATE '2001-01-01' + p_size AS eff_start, DATE '2002-01-01' + p_size AS eff_end,
    p_brand AS first, substr(p_type, 1, 10) AS second FROM part
  WHERE contains(p_brand || '_' || p_type, 'Brand#1') AND contains(p_brand || '_' || p_type, 'M'))
SELECT odm, second AS father_pn, second AS father_site_pn, first AS son_pn, first AS son_site_pn,
  CAST(1 AS DOUBLE) AS qtyper, min(eff_start) AS eff_start, max(eff_end) AS eff_end FROM r
GROUP BY ALL
UNION ALL
SELECT odm, first, 'site', son, son, CAST(2 AS DOUBLE), min(eff_start), max(eff_end) FROM r GROUP BY ALL""",
)
def q_compound(t: Tables) -> DataFrame:
    values = {
        "odm": F.col("p_type"),
        "father_pn": F.concat("p_brand", F.lit("_"), "p_type"),
        "father_site_pn": F.lit("site"),
        "son_pn": F.col("p_name"),
        "son_site_pn": F.col("p_name"),
        "qtyper": F.lit(2),
        "eff_start": F.date_add(F.lit("2001-01-01"), F.col("p_size")),
        "eff_end": F.date_add(F.lit("2002-01-01"), F.col("p_size")),
    }
    source = t.part.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in OUTPUTS["bom"].fields
        ]
    )
    expanded = graph.expand_compound_father(source, RUN, marks=("Brand#1", "M"))
    return expanded.select(
        *SHOWN, F.col("qtyper").cast("double").alias("qtyper"), "eff_start", "eff_end"
    )

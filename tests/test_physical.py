"""Physical plans: no all-pairs joins, no Python, no single-task windows."""

from __future__ import annotations

import re

from datetime import datetime

import pytest

from supplyprep.catalog import queries
from supplyprep.catalog.supply import StandIn
from supplyprep.catalog.tables import Tables
from supplyprep.context import RunContext
from supplyprep.operators import joins
from supplyprep.plans import supply

# Queries that write tables or walk graphs while their plan is built are covered by their results.
SLOW = {
    "q_bom",
    "q_bom_init",
    "q_run_supply",
    "q_cycle_edges",
    "q_cycle_removed",
    "q_flagged_ancestor",
    "q_source_map",
    "q_stream_latest",
    "q_stream_match",
    "q_stream_upsert",
    "q_supply_all",
    "q_weekly_history",
}
FORBIDDEN = re.compile(
    r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|SinglePartition.*Window"
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries()) - SLOW))
def test_plan(spark, data, name):
    found = FORBIDDEN.search(plan_of(queries()[name](spark, data)))
    assert found is None, found


def test_filter_and_columns_reach_the_scan(spark, data):
    plan = plan_of(queries()["q_open_po"](spark, data))
    receipts = [l for l in plan.splitlines() if "FileScan" in l and "l_returnflag" in l]
    assert any("EqualTo(l_returnflag,R)" in l for l in receipts)
    assert all("l_extendedprice" not in l for l in plan.splitlines() if "ReadSchema" in l)


def way_up(plan: str, leaf: str) -> list[str]:
    """The operators above the leaf that holds ``leaf``, nearest first, by the plan's indentation."""
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if leaf in line)
    out, now = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < now:
            now = depth(line)
            out.append(re.sub(r"^[ :+-]*(\*\(\d+\) )?", "", line).split(" ")[0].split("(")[0])
    return out


@pytest.mark.parametrize("bu", ["NB", "DT"])
@pytest.mark.parametrize("kind", ["inventory", "fg", "wip"])
def test_snapshots_are_summed_before_lookups(spark, data, tmp_path, bu, kind):
    """A snapshot is shuffled once, as partial sums, and meets no join before that."""
    inputs = StandIn(Tables(spark, data)).inputs
    name = f"{kind}_{bu.lower()}"
    getattr(inputs, name).write.parquet(str(tmp_path / "snapshot"))
    setattr(inputs, name, spark.read.parquet(str(tmp_path / "snapshot")))
    ctx = RunContext(run_ts=datetime(2024, 5, 16, 8))
    built = {
        "inventory": lambda: supply.inventory_supply(inputs, bu),
        "fg": lambda: supply.finished_goods_supply(inputs, bu, ctx),
        "wip": lambda: supply.wip_supply(inputs, bu, ctx),
    }[kind]()
    plan = plan_of(built)
    assert plan.count(str(tmp_path)) == 1
    above = way_up(plan, str(tmp_path))
    first = [step for step in above if step in ("HashAggregate", "Exchange") or "Join" in step]
    assert first[:3] == ["HashAggregate", "Exchange", "HashAggregate"]


JOINS = {"fg_nb": 2, "fg_dt": 4, "wip_nb": 3, "wip_dt": 3}


@pytest.mark.parametrize("name", sorted(JOINS))
def test_lookups_of_which_a_row_needs_one_share_a_join(spark, data, tmp_path, name):
    inputs = StandIn(Tables(spark, data)).inputs
    getattr(inputs, name).write.parquet(str(tmp_path / "snapshot"))
    setattr(inputs, name, spark.read.parquet(str(tmp_path / "snapshot")))
    build = supply.finished_goods_supply if name.startswith("fg") else supply.wip_supply
    plan = plan_of(build(inputs, name[-2:].upper(), RunContext(run_ts=datetime(2024, 5, 16, 8))))
    assert sum("Join" in step for step in way_up(plan, str(tmp_path))) == JOINS[name]


@pytest.mark.parametrize("name", ["fg_nb", "fg_dt", "wip_nb"])
def test_sums_are_not_shuffled_again_for_their_rules(spark, data, tmp_path, name):
    """Every rule keeps all keys of the sums apart, so there is nothing left to add up."""
    inputs = StandIn(Tables(spark, data)).inputs
    getattr(inputs, name).write.parquet(str(tmp_path / "snapshot"))
    setattr(inputs, name, spark.read.parquet(str(tmp_path / "snapshot")))
    build = supply.finished_goods_supply if name.startswith("fg") else supply.wip_supply
    plan = plan_of(build(inputs, name[-2:].upper(), RunContext(run_ts=datetime(2024, 5, 16, 8))))
    assert way_up(plan, str(tmp_path)).count("HashAggregate") == 2


def test_rows_of_a_few_texts_are_not_gathered_by_text(spark):
    """The table of found aliases is small, so the rows stay where they are."""
    rows = spark.range(40_000).selectExpr("id", "IF(id % 2 = 0, 'L215', 'CQlaibao') AS site", "repeat('x', 50) AS more")
    aliases = spark.createDataFrame([("UBX", "a"), ("CQ", "b")], "alias string, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
    try:
        found = joins.contained_best(rows, "site", aliases, "alias", "name", "found")
        plan = plan_of(found)
        assert found.groupBy("site", "found").count().count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan.split("Initial Plan")[-1]
    assert {r["found"] for r in found.filter("site = 'CQlaibao'").select("found").distinct().collect()} == {"b"}

"""Run queries on Spark and their SQL on DuckDB over the same files and compare the rows.

    python tools/check_oracle.py [--sf DIR] [--time] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from supplyprep.catalog import oracle_sql, queries  # noqa: E402
from supplyprep.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


#: Queries without SQL that are compared elsewhere (see tests/test_plans.py); any other one fails.
ROWS_ONLY = ("q_bom",)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def normal(frame):
    names = sorted(frame.columns)
    return sorted(
        (tuple("NULL" if v is None or v != v else str(v) for v in row) for row in frame[names].itertuples(index=False, name=None))
    )


def compare(spark, connection, name: str, folder: str) -> tuple[bool, str]:
    run, sql = queries()[name], oracle_sql().get(name)
    started = time.time()
    table = run(spark, folder).toArrow()
    seconds = time.time() - started
    mine = table.to_pandas(types_mapper=None, integer_object_nulls=True)
    if sql is None:
        return name in ROWS_ONLY and len(mine) > 0, f"no SQL: {len(mine)} rows {seconds:.1f}s"
    started = time.time()
    arrow = connection.execute(sql).to_arrow_table()
    duck = time.time() - started
    theirs = arrow.to_pandas(integer_object_nulls=True)
    kinds = {f.name: str(f.type) for f in table.schema}
    other = {f.name: str(f.type) for f in arrow.schema}
    note = f"{len(mine)} rows, spark {seconds:.1f}s duck {duck:.2f}s"
    if sorted(mine.columns) != sorted(theirs.columns):
        return False, f"columns {sorted(mine.columns)} / {sorted(theirs.columns)}"
    left, right = normal(mine), normal(theirs)
    types = {k: (kinds[k], other[k]) for k in kinds if kinds[k] != other[k] and not (
        kinds[k].startswith(("string", "large_string")) and other[k].startswith(("string", "large_string")))}
    if left != right:
        only_left = [r for r in left[:100000] if r not in set(right)][:3]
        only_right = [r for r in right[:100000] if r not in set(left)][:3]
        return False, f"{note}; {len(left)}/{len(right)} rows; spark only {only_left}; sql only {only_right}; types {types}"
    if not left:
        note += " EMPTY"
    if types:
        note += f" TYPES {types}"
    return not types, note


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    options = parser.parse_args()
    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(options.sf)
    bad = []
    for name in options.names or queries():
        try:
            fine, note = compare(spark, connection, name, options.sf)
        except Exception as error:  # noqa: BLE001 - report and go on
            fine, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if fine else "FAIL", name, note, flush=True)
        if not fine:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())

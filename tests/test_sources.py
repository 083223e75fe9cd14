from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from supplyprep.context import RunContext
from supplyprep.plans import runs
from supplyprep.schemas import INPUTS, OUTPUTS, table
from supplyprep.sources import manifest, readers, storage, writers
from supplyprep.streaming import incremental

CTX = RunContext(run_ts=datetime(2024, 5, 16, 8))


def test_delimited_with_bad_and_empty_values(spark, tmp_path):
    (tmp_path / "drop.txt").write_text("a|1.5|2024-01-02\n|2|2024-01-03\nb|oops|2024-01-04\n")
    source = {"feed": readers.Source(table("code qty:q day:d"), str(tmp_path / "drop.txt"))}
    good = readers.read_delimited(spark, source, "feed")
    assert rows(good, "code", "day") == [("a", date(2024, 1, 2)), (None, date(2024, 1, 3))]
    assert rows(good, "code") == [("a",), (None,)]
    kept = readers.read_delimited(spark, source, "feed", keep_corrupt=True)
    assert kept.filter(F.col(readers.CORRUPT).isNotNull()).count() == 1


def test_empty_text_becomes_null_for_json(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"code": "", "qty": 1}\n')
    source = {"j": readers.Source(table("code qty:q"), str(tmp_path / "x.json"), "json")}
    assert readers.read_source(spark, source, "j").first()["code"] is None


def test_jdbc_needs_a_complete_split(spark):
    source = {"db": readers.Source(table("code"), "jdbc:x", "jdbc", {"dbtable": "t", "partitionColumn": "id"})}
    with pytest.raises(ValueError, match="needs all of"):
        readers.read_source(spark, source, "db")


def test_snapshot_may_be_replaced_by_its_own_content(spark, tmp_path):
    base = str(tmp_path / "snap")
    writers.overwrite_snapshot(spark.range(3), base, CTX)
    old = writers.current_version(spark, base)
    writers.overwrite_snapshot(writers.read_snapshot(spark, base).filter("id > 0"), base, CTX)
    assert rows(writers.read_snapshot(spark, base)) == [(1,), (2,)]
    assert writers.current_version(spark, base) != old
    with pytest.raises(FileNotFoundError):
        writers.read_snapshot(spark, str(tmp_path / "none"))


def test_weekly_history_replaces_only_its_week(spark, tmp_path):
    path = str(tmp_path / "his")
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    assert not writers.weekly_history(df, path, RunContext(run_ts=datetime(2024, 5, 15)))
    assert writers.weekly_history(df, path, CTX)
    later = RunContext(run_ts=CTX.run_ts + timedelta(days=7))
    writers.weekly_history(df, path, later)
    writers.weekly_history(df.limit(1), path, later)
    got = spark.read.parquet(path).groupBy("version_week").count()
    assert rows(got.select(F.col("version_week").cast("int"), "count")) == [(20, 2), (21, 1)]


def test_rolling_backup_hides_old_rows(spark, tmp_path):
    path = str(tmp_path / "bak")
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    for days in (0, 50, 120, 120):
        ctx = RunContext(run_ts=CTX.run_ts + timedelta(days=days))
        writers.rolling_backup(df, path, ctx)
    assert writers.read_backup(spark, path, ctx, days=90).count() == 4
    assert writers.read_backup(spark, path, ctx, days=180).count() == 6


def test_routing_with_monitor_and_overrides(spark):
    conf = spark.createDataFrame(
        [("ODM_CODE", "A", "SCC", "N"), ("ODM_CODE", "B", "SCC", "Y"), ("ODM_CODE", "C", "FTP", "N"), ("ODM_CODE", "A", "SCC", "N")],
        "pdomain string, pvalue string, inv_source string, monitor_flag string",
    )
    df = spark.createDataFrame([("a",), ("B",), ("c",), (None,)], "odm string")
    plain = readers.route_by_source(df, conf, "inv_source", "SCC", monitor="N")
    assert rows(plain) == [("a",)]
    assert rows(readers.route_by_source(df, conf, "inv_source", "SCC", monitor="N", always=("B",))) == [("B",), ("a",)]
    assert rows(readers.route_by_source(df, conf, "inv_source", "SCC", monitor="Y", never=("B",))) == []


def test_latest_version_per_key_keeps_ties(spark):
    df = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("a", "2", 3), ("b", "1", 4)], "k string, v string, n int")
    assert rows(readers.latest_version_per_key(df, ["k"], "v"), "n") == [(2,), (3,), (4,)]


def test_work_folder_comes_from_the_session(spark):
    assert storage.work_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    table_, n = storage.materialize(spark.range(5).filter("id > 1"), "t")
    assert n == 3 and table_.count() == 3


def test_schemas_have_no_repeated_columns():
    for name, schema in {**INPUTS, **OUTPUTS}.items():
        assert len(set(schema.names)) == len(schema.names), name


def test_old_snapshots_expire(spark, tmp_path):
    base = str(tmp_path / "table")
    paths = [writers.overwrite_snapshot(spark.range(k), base, CTX) for k in range(1, 5)]
    assert writers.expire_snapshots(spark, base, keep=2) == 2
    assert [Path(p).exists() for p in paths] == [False, False, True, True]
    assert writers.read_snapshot(spark, base).count() == 4
    assert writers.expire_snapshots(spark, base, keep=2) == 0
    writers.overwrite_snapshot(spark.range(9), base, CTX)
    assert writers.read_snapshot(spark, base).count() == 9


def test_bucketed_table_keeps_untouched_buckets(spark, tmp_path):
    base = str(tmp_path / "buckets")
    rows = spark.range(50).withColumn("v", F.lit(1))
    writers.write_buckets(writers.with_bucket(rows, ["id"], 8), base, CTX)
    some = writers.with_bucket(rows, ["id"], 8).filter("bucket = 3").withColumn("v", F.lit(2))
    writers.write_buckets(some, base, CTX)
    found = writers.with_bucket(writers.read_buckets(spark, base), ["id"], 8)
    assert found.count() == 50
    assert {(r["bucket"] == 3, r["v"]) for r in found.collect()} == {(True, 2), (False, 1)}


def test_older_rows_lose_in_a_stream(spark, tmp_path):
    drop, target, checkpoint = (str(tmp_path / n) for n in ("drop", "target", "checkpoint"))
    schema = "k string, ts int, v string"
    for batch in ([("a", 2, "new"), ("b", 1, "b")], [("a", 1, "old"), ("c", 1, "c")], [("b", 3, "b3")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(drop)
        stream = incremental.file_stream(spark, drop, spark.createDataFrame([], schema).schema)
        incremental.stream_upsert(stream, target, checkpoint, ["k"], ["ts"], ["ts", "v"], CTX, buckets=4).awaitTermination()
    assert rows(writers.read_buckets(spark, target), "k", "ts", "v") == [("a", 2, "new"), ("b", 3, "b3"), ("c", 1, "c")]


def test_marks_move_on(spark, tmp_path):
    out = str(tmp_path / "out")
    assert runs.stored_mark(spark, out, "delivery") is None
    for mark in ("5", "9"):
        runs.store_mark(spark, out, "delivery", mark, CTX)
    runs.store_mark(spark, out, "other", "1", CTX)
    assert runs.stored_mark(spark, out, "delivery") == "9"


def test_expiry_of_a_bucketed_table_loses_nothing(spark, tmp_path):
    base = tmp_path / "buckets"
    rows = spark.range(100).withColumn("v", F.lit(0))
    writers.write_buckets(writers.with_bucket(rows, ["id"], 8), str(base), CTX)
    for k in (1, 2, 3, 4):
        some = writers.with_bucket(rows, ["id"], 8).filter(f"bucket = {k % 2}").withColumn("v", F.lit(k))
        writers.write_buckets(some, str(base), CTX)
    before = sorted(map(tuple, writers.read_buckets(spark, str(base)).collect()))
    assert writers.expire_snapshots(spark, str(base), keep=1) == 4
    assert sorted(map(tuple, writers.read_buckets(spark, str(base)).collect())) == before and len(before) == 100
    # Two folders of the first write were replaced, and the second and third write wholly.
    assert len(list(base.glob("v=*/bucket=*"))) == 8 and len(list(base.glob("v=*"))) == 3
    assert writers.expire_snapshots(spark, str(base), keep=1) == 0


def test_one_of_two_writers_fails(spark, tmp_path):
    base = str(tmp_path / "table")
    writers.overwrite_snapshot(spark.range(3), base, CTX)
    since, _ = manifest.live_parts(spark, base)
    writers.overwrite_snapshot(spark.range(4), base, CTX, since)
    with pytest.raises(manifest.ConcurrentWrite):
        writers.overwrite_snapshot(spark.range(5), base, CTX, since)
    assert writers.read_snapshot(spark, base).count() == 4
    with pytest.raises(manifest.ConcurrentWrite):
        writers.write_buckets(writers.with_bucket(spark.range(5), ["id"], 2), base, CTX, since)
    assert not [p for p in (tmp_path / "table" / "_manifest").iterdir() if not p.name.strip(".").startswith("0")]


def test_writers_in_threads_lose_no_row(spark, tmp_path):
    """Writers that start from the same version: those that succeed are all there, the others know."""
    base = str(tmp_path / "table")
    writers.write_buckets(writers.with_bucket(spark.range(8), ["id"], 4).withColumn("who", F.lit(-1)), base, CTX)

    def write(who):
        version, _ = manifest.live_parts(spark, base)
        rows = writers.with_bucket(spark.range(8), ["id"], 4).filter(f"bucket = {who % 4}").withColumn("who", F.lit(who))
        try:
            writers.write_buckets(rows, base, CTX, version)
            return who
        except manifest.ConcurrentWrite:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = {who for who in pool.map(write, range(4)) if who is not None}
    assert done
    assert {r["who"] for r in writers.read_buckets(spark, base).select("who").distinct().collect()} - {-1} <= done
    assert writers.read_buckets(spark, base).count() == 8
    assert len(manifest.versions(spark, base)) == 1 + len(done)


def test_folders_of_failed_writes_go_when_they_are_old(spark, tmp_path):
    base = tmp_path / "table"
    writers.overwrite_snapshot(spark.range(3), str(base), CTX)
    spark.range(9).write.parquet(str(base / "v=failed"))
    assert manifest.expire(spark, str(base), keep=1) == 0 and (base / "v=failed").exists()
    os.utime(base / "v=failed", (0, 0))
    manifest.expire(spark, str(base), keep=1)
    assert not (base / "v=failed").exists() and writers.read_snapshot(spark, str(base)).count() == 3


def test_stream_leaves_no_replaced_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "KEPT_VERSIONS", 1)
    drop, target, checkpoint = (str(tmp_path / n) for n in ("drop", "target", "checkpoint"))
    schema = "k string, ts int"
    for ts in range(4):
        spark.createDataFrame([("a", ts), ("b", ts)], schema).coalesce(1).write.mode("append").parquet(drop)
        stream = incremental.file_stream(spark, drop, spark.createDataFrame([], schema).schema)
        incremental.stream_latest(stream, target, checkpoint, ["k"], ["ts"], CTX, buckets=2).awaitTermination()
    assert rows(writers.read_buckets(spark, target), "k", "ts") == [("a", 3), ("b", 3)]
    assert len(list(Path(target).glob("v=*/bucket=*"))) <= 2


def test_work_tables_of_a_scope_are_removed(spark):
    with storage.work_scope(spark, "run"):
        inner = storage.new_path(spark, "t")
        spark.range(3).write.parquet(inner)
    assert not Path(inner).exists()
    outer, _ = storage.materialize(spark.range(3), "t")
    assert outer.count() == 3


def test_drop_with_too_many_bad_lines_fails_but_keeps_them(spark, tmp_path):
    (tmp_path / "drop.txt").write_text("a|1.5|2024-01-02\nb|oops|2024-01-04\nc|3\n\nd|4|2024-01-05\n")
    source = {"feed": readers.Source(table("code qty:q day:d"), str(tmp_path / "drop.txt"))}
    landing = str(tmp_path / "landing")
    with pytest.raises(readers.TooManyRejected, match="2 of 4 lines of feed"):
        readers.load_delimited(spark, source, "feed", landing, most_rejected=0.3)
    assert len(list((tmp_path / "landing").glob("*/rejected=true/*.parquet"))) == 1
    load = readers.load_delimited(spark, source, "feed", landing, most_rejected=0.5)
    assert (load.lines, load.n_rejected) == (4, 2)
    assert rows(load.rows, "code") == [("a",), ("d",)]
    assert rows(load.rejected) == [("b|oops|2024-01-04",), ("c|3",)]
    (tmp_path / "drop.txt").write_text("")
    empty = readers.load_delimited(spark, source, "feed", landing)
    assert (empty.lines, empty.n_rejected, empty.rows.count()) == (0, 0, 0)


def test_rows_and_partners_meet_whichever_comes_first(spark, tmp_path):
    """Waiting rows are tables: no stage of a match keeps rows in a state store."""
    at = lambda day: datetime(2024, 1, 1) + timedelta(days=day)
    ours, theirs = "k string, n int, at timestamp", "key string, p int, met timestamp"
    out, state = [], str(tmp_path / "state")
    drops = [
        ([("a", 1, at(10)), ("a", 2, at(30)), ("b", 3, at(10)), (None, 4, at(11)), ("z", 5, None)], []),
        ([("c", 6, at(12))], [("a", 1, at(8)), ("a", 2, at(9)), ("b", 3, at(1)), ("c", 4, at(14)), (None, 5, at(11)), ("z", 6, None)]),
        ([("a", 7, at(14)), ("a", 8, at(13)), ("late", 8, at(10))], [("b", 7, at(10)), ("d", 8, at(40))]),
        ([("e", 9, at(60))], [("a", 9, at(30)), ("e", 10, at(60))]),
        ([("e", 10, at(62))], [("f", 11, at(90))]),
    ]
    for number, (left, right) in enumerate(drops):
        spark.createDataFrame(left, ours).write.mode("append").parquet(str(tmp_path / "rows"))
        spark.createDataFrame(right, theirs).write.mode("append").parquet(str(tmp_path / "partners"))
        streams = [incremental.file_stream(spark, str(tmp_path / n), spark.createDataFrame([], s).schema) for n, s in (("rows", ours), ("partners", theirs))]
        matched = incremental.stream_matched(*streams, [("k", "key")], "at", "met", before="5 DAYS", after="2 DAYS", state=state)
        assert matched.isStreaming and matched.columns == ["k", "n", "at", "key", "p", "met"]
        found = spark.read.schema(matched.schema).parquet(f"{state}/matched/{number}")
        out.append(sorted((r["n"], r["p"]) for r in found.select("n", F.coalesce("p", F.lit(0)).alias("p")).collect()))
    # Both clocks end at day 13, 29, 59 and 61: 3 and 4 are due at once, two rows and a partner come too late.
    assert out == [[], [(1, 1), (1, 2), (3, 0), (4, 0), (6, 4)], [(7, 2)], [(2, 9), (9, 10)], [(10, 10)]]
    assert not (tmp_path / "state" / "checkpoint" / "state").exists()


def test_a_table_is_written_apart_from_the_work_tables_it_needs(spark):
    kept = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, made = spark.conf.get(kept), []

    def build():
        work = storage.staged(spark.range(6).selectExpr("id % 3 AS k"), "work")
        made.extend(work.inputFiles())
        assert spark.conf.get(kept) == "true"
        return work.groupBy("k").count()

    table = storage.staged_apart(spark, "kept", build)
    assert rows(table) == [(0, 2), (1, 2), (2, 2)]
    assert made and not any(Path(name.removeprefix("file:")).exists() for name in made)
    assert spark.conf.get(kept) == before
    with pytest.raises(ZeroDivisionError):
        storage.staged_apart(spark, "kept", lambda: 1 / 0)
    assert spark.conf.get(kept) == before


def test_slices_hold_every_row_once(spark):
    table = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("",), ("c",)], "item string")
    parts = storage.staged_slices(spark, "slices", 4, lambda n: storage.sliced(table, "item", n, 4).withColumn("n", F.lit(n)))
    assert rows(parts, "item") == rows(table)
    assert parts.select("item", "n").distinct().count() == 5
    assert storage.file_bytes(table) == 0 < storage.file_bytes(parts)

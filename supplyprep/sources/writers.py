"""Write modes: full snapshots, bucketed tables, weekly history, rolling backups and replaced slices.

A snapshot or bucket is a new folder, and a manifest that names all live folders makes it the
current one. A failed run leaves the previous version in place, a job may read the data set that
it replaces, and of two writers at the same time one fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from supplyprep.context import RunContext
from supplyprep.functions.dates import calendar_week, year_start
from supplyprep.sources.manifest import commit, expire, live_parts

#: Part name of a table that is one folder.
WHOLE = ""


def current_version(spark: SparkSession, base: str) -> str | None:
    """Folder of the snapshot that readers see now, or nothing before the first write."""
    _, parts = live_parts(spark, base)
    return f"{base}/{parts[WHOLE]}" if WHOLE in parts else None


def read_snapshot(spark: SparkSession, base: str) -> DataFrame:
    path = current_version(spark, base)
    if path is None:
        raise FileNotFoundError(f"no snapshot under {base}")
    return spark.read.parquet(path)


def overwrite_snapshot(df: DataFrame, base: str, ctx: RunContext, since: int | None = None) -> str:
    """Full refresh: write a new version folder, then make it the live one.

    ``since`` is the version that ``df`` was made from, by default the one there is now; if another
    writer is faster, the write fails and the other's version stays.
    """
    spark = df.sparkSession
    if since is None:
        since, _ = live_parts(spark, base)
    folder = f"v={ctx.version}-{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{folder}")
    commit(spark, base, since, {WHOLE: folder})
    return f"{base}/{folder}"


def expire_snapshots(spark: SparkSession, base: str, keep: int = 3) -> int:
    """Delete all but the newest ``keep`` versions of a snapshot or bucketed table; says how many went."""
    return expire(spark, base, keep)


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows with the bucket of their key, in a table kept by :func:`write_buckets`."""
    return df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def read_buckets(
    spark: SparkSession, base: str, schema: StructType | None = None, only: Sequence[int] | None = None, version: int | None = None
) -> DataFrame:
    """The rows of a bucketed table, or of some buckets of it; ``schema`` is needed where none is written yet."""
    _, parts = live_parts(spark, base, version)
    wanted = parts if only is None else {str(b) for b in only} & parts.keys()
    paths = [f"{base}/{parts[bucket]}" for bucket in sorted(wanted)]
    if paths:
        return spark.read.parquet(*paths)
    if schema is None:
        raise FileNotFoundError(f"no rows under {base}")
    return spark.createDataFrame([], schema)


def write_buckets(df: DataFrame, base: str, ctx: RunContext, since: int | None = None) -> None:
    """Replace the buckets that ``df`` (with the column ``bucket``) has rows of; the others stay.

    ``since``: as with :func:`overwrite_snapshot`.
    """
    spark = df.sparkSession
    since, parts = live_parts(spark, base, since)
    folder = f"v={ctx.version}-{uuid.uuid4().hex}"
    df.write.partitionBy("bucket").parquet(f"{base}/{folder}")
    touched = spark.read.parquet(f"{base}/{folder}").select("bucket").distinct().collect()  # at most the number of buckets
    commit(spark, base, since, parts | {str(r["bucket"]): f"{folder}/bucket={r['bucket']}" for r in touched})


def append(*parts: DataFrame) -> DataFrame:
    """Rows of several independent steps as one table, matched by column name."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def with_history_prefix(df: DataFrame, ctx: RunContext) -> DataFrame:
    day = F.lit(ctx.week_start)
    return df.select(
        year_start(day).alias("version_year"),
        calendar_week(day).alias("version_week"),
        day.alias("version_date"),
        "*",
    )


def weekly_history(df: DataFrame, path: str, ctx: RunContext, force: bool = False) -> bool:
    """On the snapshot day, replace this week's partition. Says whether it wrote."""
    if not (force or ctx.is_snapshot_day):
        return False
    (
        with_history_prefix(df, ctx)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("version_year", "version_week")
        .parquet(path)
    )
    return True


def with_backup_time(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.select("*", F.lit(ctx.run_ts).alias("backup_time"))


def backup_kept(backup_time: Column, ctx: RunContext, days: int) -> Column:
    return backup_time >= F.date_sub(F.lit(ctx.run_date), days)


def rolling_backup(df: DataFrame, path: str, ctx: RunContext) -> None:
    """Add the rows to the backup, in the partition of the run day (a repeated run replaces it)."""
    (
        with_backup_time(df, ctx)
        .withColumn("backup_date", F.lit(ctx.run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("backup_date")
        .parquet(path)
    )


def read_backup(spark: SparkSession, path: str, ctx: RunContext, days: int = 90) -> DataFrame:
    """Backup rows that are not older than ``days``.

    Older partitions are pruned before the scan, so nothing is rewritten to let them go; the
    storage's own lifecycle rule may remove their folders at any time.
    """
    return spark.read.parquet(path).filter(backup_kept(F.col("backup_date"), ctx, days))


def without_slice(df: DataFrame, slice_: Column) -> DataFrame:
    return df.filter(~F.coalesce(slice_, F.lit(False)))


def replace_slice(df: DataFrame, slice_: Column, new: DataFrame) -> DataFrame:
    """The rows outside the slice together with the new rows."""
    return append(without_slice(df, slice_), new)


def copy_subset(df: DataFrame, condition: Column, base: str, ctx: RunContext) -> str:
    return overwrite_snapshot(df.filter(condition), base, ctx)

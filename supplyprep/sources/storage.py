"""The shared work folder and written intermediate tables.

Loops (graph walks) and steps that need one fixed copy of an intermediate result cut the lineage
with a table written to the folder named by ``spark.checkpoint.dir``. The table survives the loss
of an executor and gives the planner real sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL_FOLDERS: dict[str, str] = {}
_SCOPES: list[str] = []


def work_folder(spark: SparkSession) -> str:
    """Folder of the cluster's checkpoint setting; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    existing = context.getCheckpointDir()
    if existing:
        return existing
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="supplyprep-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the work folder that no other run uses."""
    return "/".join([work_folder(spark), spark.sparkContext.applicationId, *_SCOPES, f"{label}-{uuid.uuid4().hex}"])


def materialize(
    df: DataFrame, label: str, counted: Column | None = None
) -> tuple[DataFrame, int]:
    """Write the rows once; return the table read back and its row count.

    ``counted`` counts only the rows that meet the condition.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    seen = Observation()
    rows = F.count(F.lit(1)) if counted is None else F.count_if(counted)
    df.observe(seen, rows.alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"]


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once and go on from the table.

    Used between steps that each read their input several times; without it the plan would repeat
    everything before them once per reading.
    """
    return materialize(df, label)[0]


#: Spark keeps a query's shuffle files until the driver happens to collect what refers to them.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside drops its shuffle files as soon as it is written.

    For chains of written tables: the disk holds the shuffles of one step, not those of all.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whichever file system the path names. Says whether there was one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def work_scope(spark: SparkSession, label: str) -> Iterator[None]:
    """Work tables written inside are deleted at the end, also after a failure.

    For whole runs, whose results are tables of their own by then.
    """
    _SCOPES.append(f"{label}-{uuid.uuid4().hex}")
    folder = "/".join([work_folder(spark), spark.sparkContext.applicationId, *_SCOPES])
    try:
        yield
    finally:
        _SCOPES.pop()
        remove_folder(spark, folder)


def staged_apart(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write the rows that ``build`` returns; work tables and shuffle files made for them are dropped."""
    path = new_path(spark, label)
    with shuffles_freed(spark), work_scope(spark, label):
        rows = build()
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def staged_slices(spark: SparkSession, label: str, slices: int, build: Callable[[int], DataFrame]) -> DataFrame:
    """Write the rows that ``build`` returns for each slice, one slice after the other, as one table."""
    path = new_path(spark, label)
    for n in range(slices):
        rows = build(n)
        rows.write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def sliced(rows: DataFrame, column: str, n: int, slices: int) -> DataFrame:
    """The rows of one slice of the values of a column; those without a value are in one slice, too."""
    return rows.filter(F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(slices)) == n)


def file_bytes(rows: DataFrame) -> int:
    """Size of the tables that the rows are read from; in-memory rows count as nothing."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size())]
    return sum(size for size in sizes if size < 2**60)  # what Spark says of rows of unknown size is above


def remove_work_tables(spark: SparkSession) -> bool:
    """Delete what this application wrote by :func:`materialize`; for the end of a run.

    DataFrames that read such tables, results of pipelines not yet written among them, are of no
    use afterwards.
    """
    return remove_folder(spark, f"{work_folder(spark)}/{spark.sparkContext.applicationId}")

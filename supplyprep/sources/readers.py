"""Reading named inputs and choosing which of their rows count."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyprep.context import RunContext
from supplyprep.functions.clean import as_column, null_if_empty

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Source:
    """Where a named input lives.

    ``format`` is ``parquet``, ``orc``, ``json``, ``delimited`` or ``jdbc``. For ``jdbc``, ``path``
    is the connection URL and ``options`` holds ``dbtable`` and the split: ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` (without them the read is one task).
    """

    schema: T.StructType
    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


def empty_text_to_null(df: DataFrame) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[null_if_empty(c).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def read_source(spark: SparkSession, sources: Mapping[str, Source], name: str) -> DataFrame:
    """One named input with its declared schema; empty text read from outside becomes null."""
    source = sources[name]
    if source.format == "delimited":
        return read_delimited(spark, sources, name)
    reader = spark.read.options(**source.options)
    if source.format == "jdbc":
        split = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
        given = split & set(source.options)
        if given and given != split:
            raise ValueError(f"jdbc source {name} needs all of {sorted(split)}")
        table = reader.format("jdbc").option("url", source.path).load()
        return empty_text_to_null(
            table.select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in source.schema.fields]
            )
        )
    df = reader.schema(source.schema).format(source.format).load(source.path)
    # Columnar snapshots are written by this package and hold no empty text; leaving them as they
    # are keeps filters pushable to the scan.
    return df if source.format in ("parquet", "orc") else empty_text_to_null(df)


def read_delimited(
    spark: SparkSession, sources: Mapping[str, Source], name: str, keep_corrupt: bool = False
) -> DataFrame:
    """Site text drops. Lines that do not fit the schema are kept in ``_corrupt_record`` on request.

    Values are read as text and cast here: the text reader itself only notices a bad value in a
    column that the query happens to use, so which lines count would depend on the query.
    """
    source = sources[name]
    fields = source.schema.fields
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    lines = (
        spark.read.schema(T.StructType([*raw.fields, T.StructField(CORRUPT, T.StringType())]))
        .options(**{"sep": "|", "header": "false", "mode": "PERMISSIVE", **source.options})
        .option("columnPruning", "false")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(source.path)
    )
    texts = empty_text_to_null(lines)
    bad = F.col(CORRUPT).isNotNull()
    for f in fields:
        bad |= F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    if not keep_corrupt:
        return texts.filter(~bad).select(*typed)
    sep = {"sep": source.options.get("sep", "|")}
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[f.name for f in fields]), sep))
    return texts.select(*typed, F.when(bad, line).alias(CORRUPT))


class TooManyRejected(RuntimeError):
    """More lines of a drop do not fit than the load allows; they lie in its quarantine."""


@dataclass(frozen=True)
class Load:
    """What one pass over a text drop gave: the rows that fit, the lines that do not, and their numbers."""

    rows: DataFrame
    rejected: DataFrame
    lines: int
    n_rejected: int


def load_delimited(
    spark: SparkSession, sources: Mapping[str, Source], name: str, landing: str, most_rejected: float = 0.0
) -> Load:
    """Read a site text drop once: rows that fit and lines that do not are written apart and counted.

    ``landing`` is a folder that outlives the run: rejected lines stay there (put together again from
    their fields where just a value does not fit) until somebody has looked at them. If their share is above ``most_rejected`` the load fails, after
    both were written. An empty drop has no rows and no rejected lines.
    """
    typed = read_delimited(spark, sources, name, keep_corrupt=True)
    marked = typed.withColumn("rejected", F.col(CORRUPT).isNotNull())
    path, seen = f"{landing}/{name}-{uuid.uuid4().hex}", Observation()
    counted = marked.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("rejected")).alias("rejected"))
    counted.write.partitionBy("rejected").parquet(path)
    lines, rejected = seen.get["lines"], seen.get["rejected"]
    if rejected > most_rejected * lines:
        raise TooManyRejected(f"{rejected} of {lines} lines of {name} do not fit, see {path}/rejected=true")
    written = spark.read.schema(marked.schema).parquet(path)
    rows = written.filter(~F.col("rejected")).drop(CORRUPT, "rejected")
    return Load(rows, written.filter("rejected").select(F.col(CORRUPT).alias("line")), lines, rejected)


def configured_sites(
    conf: DataFrame,
    kind: str,
    value: str,
    monitor: str | None = None,
    always: Sequence[str] = (),
    never: Sequence[str] = (),
    domain: str = "ODM_CODE",
    key: str = "pvalue",
) -> DataFrame:
    """Distinct site codes whose configured feed of this kind equals ``value``.

    ``monitor`` demands that monitor flag; ``always`` sites pass without it, ``never`` sites do not
    pass at all.
    """
    wanted = (F.col("pdomain") == domain) & (F.col(kind) == value)
    if monitor is not None:
        wanted &= (F.col("monitor_flag") == monitor) | F.col("pvalue").isin(*always)
    if never:
        wanted &= ~F.col("pvalue").isin(*never)
    return conf.filter(wanted).select(F.col(key).alias("site_code")).distinct()


def route_by_source(
    df: DataFrame,
    conf: DataFrame,
    kind: str,
    value: str,
    site: Column | str = "odm",
    fold: bool = True,
    **rule: object,
) -> DataFrame:
    """Rows of the sites that are configured to use this feed."""
    sites = configured_sites(conf, kind, value, **rule)
    column = as_column(site)
    return df.join(sites, (F.upper(column) if fold else column) == sites["site_code"], "left_semi")


def latest_version_global(
    df: DataFrame, version: Column | str, of: DataFrame | None = None
) -> DataFrame:
    """Rows of the newest version of the whole feed (``of``: the feed that defines the newest)."""
    column = as_column(version)
    newest = (df if of is None else of).agg(F.max(column).alias("newest")).scalar()
    return df.filter(column == newest)


def latest_version_per_key(
    df: DataFrame, keys: Sequence[str], version: Column | str
) -> DataFrame:
    """Rows whose version is the newest of their own key.

    The newest version per key is aggregated before the shuffle and joined back, so that one hot
    key is never gathered in one task.
    """
    column = as_column(version)
    newest = df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(
        F.max(column).alias("__newest")
    )
    match = column == F.col("__newest")
    for key in keys:
        match &= F.col(key) == F.col(f"__k_{key}")
    return df.join(newest, match, "left_semi")


def latest_version_for_subset(
    df: DataFrame, condition: Column, version: Column | str
) -> DataFrame:
    """Newest version only for rows that meet the condition; all other rows stay."""
    column = as_column(version)
    newest = df.filter(condition).agg(F.max(column).alias("newest")).scalar()
    chosen = F.coalesce(condition, F.lit(False))
    return df.filter(~chosen | (column == newest))


def version_is_today(df: DataFrame, version: Column | str, ctx: RunContext) -> DataFrame:
    return df.filter(as_column(version) == F.lit(ctx.version))


def same_iso_week(df: DataFrame, loaded: Column | str, ctx: RunContext) -> DataFrame:
    """Rows loaded in the Monday-based week of the run (a plain range, so it reaches the scan)."""
    day = F.to_date(F.lit(ctx.week_start.isoformat()))
    column = as_column(loaded)
    return df.filter((column >= day) & (column < F.date_add(day, 7)))


def net_change_window(df: DataFrame, modified: Column | str, low: Column, high: Column) -> DataFrame:
    """Rows changed since the last good run, both ends inclusive."""
    return df.filter(as_column(modified).between(low, high))


def rolling_lookback(
    df: DataFrame, day: Column | str, ctx: RunContext, days: int = 365
) -> DataFrame:
    limit = F.date_sub(F.lit(ctx.run_date), days)
    return df.filter(as_column(day) > limit)

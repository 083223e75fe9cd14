"""Per-group choices and aggregates.

Window functions gather a whole group in one task. Here each is an aggregate that combines on
the map side (a hot group shrinks to one row per task before the shuffle) or, where every row must
stay, an aggregate that is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from supplyprep.functions.clean import as_column
from supplyprep.operators.joins import all_of
from supplyprep.operators.rows import holds
from supplyprep.sources.storage import materialize


def _one_per_group(df, keys, order, largest: bool) -> DataFrame:
    """The row that is last (or first) by the order columns, then by the remaining columns.

    Nulls in the order columns count as largest.
    """
    sort = [f for c in order for f in (as_column(c).isNull(), as_column(c))]
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(
        *[c.alias(f"__o{i}") for i, c in enumerate(sort)],
        *[F.col(c).alias(f"__p{i}") for i, c in enumerate(rest)],
    )
    best = (F.max if largest else F.min)(row)
    chosen = df.groupBy(*keys).agg(best.alias("__row"))
    picked = {c: F.col(f"__row.__p{i}") for i, c in enumerate(rest)}
    return chosen.select(*[picked[c].alias(c) if c in picked else F.col(c) for c in df.columns])


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the largest by the order columns (a missing value counts as newest)."""
    return _one_per_group(df, keys, order, largest=True)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the smallest by the order columns (a missing value comes last)."""
    return _one_per_group(df, keys, order, largest=False)


def dedup_subset(
    df: DataFrame, condition: Column, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Keep one row per key among the rows that meet the condition; all others stay."""
    chosen = holds(condition)
    first = keep_first(df.filter(chosen), keys, order)
    return df.filter(~chosen).unionByName(first)


def singletons(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")


def blank_where_count_is_one(
    df: DataFrame, keys: Sequence[str], counted: str, column: str
) -> DataFrame:
    """Null the column where its group holds one non-null ``counted`` value.

    Only rows with a value in the column form the groups.
    """
    single = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*[F.col(k).alias(f"__w_{k}") for k in keys])
        .agg(F.count(counted).alias("__n"))
        .filter(F.col("__n") == 1)
    )
    match = all_of([F.col(k).eqNullSafe(F.col(f"__w_{k}")) for k in keys])
    joined = df.join(single, match, "left")
    value = F.when(F.col("__n").isNull(), F.col(column))
    return joined.select(*[value.alias(c) if c == column else F.col(c) for c in df.columns])


def one_or_default(
    df: DataFrame, keys: Sequence[str], value: str, default: str, out: str
) -> DataFrame:
    """Per key: the value if there is just one distinct row of (key, value), else the default.

    A missing value counts as one more. Smallest and largest decide, so no set of values is kept.
    """
    rows = F.count(F.lit(1))
    known = F.count(value)
    single = (F.min(value) == F.max(value)) & (rows == known)
    return df.groupBy(*keys).agg(
        F.when(single, F.max(value)).when(known == 0, F.lit(None)).otherwise(F.lit(default)).alias(out)
    )


def signed_sum(
    quantity: Column | str, code: Column | str, plus: Sequence[str], minus: Sequence[str]
) -> Column:
    """Sum with sign by code; other codes are ignored (null if no row counts)."""
    quantity, code = as_column(quantity), as_column(code)
    return F.sum(F.when(code.isin(*plus), quantity).when(code.isin(*minus), -quantity))


def multi_mapped(df: DataFrame, site: str, item: str, code: str) -> DataFrame:
    """(site, item, code) of items that map to several codes; a missing code counts as one more."""
    pairs = df.groupBy(site, item, code).agg(F.lit(1).alias("__one"))
    several = (
        pairs.groupBy(F.col(site).alias("__ms"), F.col(item).alias("__mi"))
        .agg(F.count(F.lit(1)).alias("__codes"))
        .filter(F.col("__codes") > 1)
    )
    return (
        pairs.filter(F.col(item).isNotNull() & F.col(code).isNotNull())
        .join(
            several,
            F.col(site).eqNullSafe(F.col("__ms")) & (F.col(item) == F.col("__mi")),
            "left_semi",
        )
        .select(site, item, code)
    )


def dense_rank_within(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "rank"
) -> DataFrame:
    """Distinct (group, order) keys with their dense rank inside the group.

    The keys are sorted by range over the whole cluster; each range ranks its own keys and adds
    the number of keys of the same group in the ranges before it. One group may thus spread over
    any number of tasks. Missing order values come last.
    """
    keys = df.select(*group, *order).distinct()
    sort = [F.col(c).asc_nulls_last() for c in [*group, *order]]
    ranged = keys.repartitionByRange(*sort).withColumn("__range", F.spark_partition_id())
    ranged, _ = materialize(ranged, "rank")
    inside = W.partitionBy(*group, "__range").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    before = W.partitionBy(*group).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*group, "__range")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .select(
            *[F.col(g).alias(f"__g_{g}") for g in group],
            F.col("__range").alias("__g_range"),
            "__before",
        )
    )
    match = all_of(
        [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in group]
        + [F.col("__range") == F.col("__g_range")]
    )
    return (
        ranged.withColumn("__local", F.row_number().over(inside))
        .join(offsets, match)
        .select(*group, *order, (F.col("__local") + F.col("__before")).alias(out))
    )

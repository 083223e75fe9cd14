"""Row changes as functions from table to table; nothing is changed in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.functions.clean import as_column
from supplyprep.operators.joins import Key, all_of, exists_in, key_pairs, not_exists_in, unique_ref


def holds(condition: Column) -> Column:
    """A condition in which "unknown" counts as false."""
    return F.coalesce(condition, F.lit(False))


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that meet the condition; all values see the old row."""
    return df.withColumns(
        {c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()}
    )


def self_update(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Rewrite columns from the row itself."""
    return df.withColumns(dict(values))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(~holds(condition))


def delete_exists(
    df: DataFrame, ref: DataFrame, keys: Sequence[Key], null_safe: bool = False
) -> DataFrame:
    return exists_in(df, ref, keys, negate=True, null_safe=null_safe)


def update_from(
    df: DataFrame,
    ref: DataFrame,
    keys: Sequence[Key],
    values: Mapping[str, str],
    condition: Column | None = None,
    pick: str = "error",
) -> DataFrame:
    """Set columns from a matching reference row, on rows that also meet the condition.

    ``values`` maps a column of ``df`` to a column of ``ref``. A reference key that repeats fails
    the job unless ``pick`` says which row to take.
    """
    pairs = key_pairs(keys)
    names = [f"__u{i}" for i in range(len(pairs))]
    outs = {column: f"__v_{column}" for column in values}
    right = ref.select(
        *[r.alias(n) for n, (_, r) in zip(names, pairs)],
        *[F.col(source).alias(outs[column]) for column, source in values.items()],
    ).filter(all_of([F.col(n).isNotNull() for n in names]))
    right = unique_ref(right, names, list(outs.values()), pick).withColumn("__hit", F.lit(True))
    joined = df.join(right, all_of([l == F.col(n) for n, (l, _) in zip(names, pairs)]), "left")
    hit = F.col("__hit").isNotNull()
    chosen = hit if condition is None else hit & holds(condition)
    return joined.select(
        *[
            F.when(chosen, F.col(outs[c])).otherwise(F.col(c)).alias(c) if c in outs else F.col(c)
            for c in df.columns
        ]
    )


def update_lookup(
    df: DataFrame, ref: DataFrame, keys: Sequence[Key], column: str, value: str, **options: object
) -> DataFrame:
    """Set one column to the matching reference value; several matches give the smallest."""
    return update_from(df, ref, keys, {column: value}, **{"pick": "min", **options})


def upsert(
    df: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    insert: Sequence[str] | None = None,
) -> DataFrame:
    """Update matched rows, insert the others. A repeated source key fails the job."""
    insert = list(insert if insert is not None else src.columns)
    carried = [c for c in dict.fromkeys([*update, *insert]) if c not in keys]
    right = unique_ref(src, list(keys), carried).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.col(c).alias(f"__n_{c}") for c in carried],
        F.lit(True).alias("__new"),
    )
    match = all_of([F.col(k) == F.col(f"__k_{k}") for k in keys])
    keyed = all_of([F.col(k).isNotNull() for k in keys])
    new = F.col("__new").isNotNull()

    def updated(name: str) -> Column:
        if name not in update or name in keys:
            return F.col(name)
        return F.when(new, F.col(f"__n_{name}")).otherwise(F.col(name))

    # Two joins with the table on one side each, so a hot key can be split; rows without a key pass by.
    changed = df.filter(keyed).join(right, match, "left").select(
        *[updated(c).alias(c) for c in df.columns]
    )
    fresh = not_exists_in(src, df, list(keys)).select(
        *[
            (F.col(f.name) if f.name in keys or (f.name in insert and f.name in carried) else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in df.schema.fields
        ]
    )
    return changed.union(df.filter(~keyed)).union(fresh)


def blank_singletons(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Null the column where its group has exactly one row."""
    single = (
        df.groupBy(*[F.col(k).alias(f"__b_{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") == 1)
    )
    match = all_of([F.col(k) == F.col(f"__b_{k}") for k in keys])
    joined = df.join(single, match, "left")
    value = F.when(F.col("__n").isNull(), F.col(column))
    return joined.select(*[value.alias(c) if c == column else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class Lookup:
    """One level of a cascade: where to look and by which keys."""

    ref: DataFrame
    keys: Sequence[Key]


def fill_cascade(
    df: DataFrame,
    levels: Sequence[Lookup],
    values: Mapping[str, str],
    sentinel: str = "X",
) -> DataFrame:
    """Fill columns from the first level that has a match; null and the sentinel mean missing.

    The first column of ``values`` decides whether a row is still missing. Within a level the
    largest value of each column is taken per key.
    """
    first = next(iter(values))
    result = df
    found: list[str] = []
    for n, level in enumerate(levels):
        pairs = key_pairs(level.keys)
        names = [f"__c{n}_{i}" for i in range(len(pairs))]
        right = (
            level.ref.groupBy(*[r.alias(k) for k, (_, r) in zip(names, pairs)])
            .agg(*[F.max(source).alias(f"__f{n}_{c}") for c, source in values.items()])
            .withColumn(f"__h{n}", F.lit(True))
        )
        tests = [left == F.col(k) for k, (left, _) in zip(names, pairs)]
        result = result.join(right, all_of(tests), "left").drop(*names)
        found.append(f"__f{n}_{first}")

    missing = F.col(first).isNull() | (F.col(first) == sentinel)

    def filled(column: str) -> Column:
        chain = F.when(~missing, F.col(column))
        for n, name in enumerate(found):
            usable = F.col(name).isNotNull() & (F.col(name) != sentinel)
            chain = chain.when(usable, F.col(f"__f{n}_{column}"))
        return chain.otherwise(F.col(column))

    return result.select(*[filled(c).alias(c) if c in values else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class Correction:
    """One hand-kept fix: rows that equal ``match`` are deleted or get ``values``.

    ``match`` maps a column to the listed codes.
    """

    match: Mapping[str, Sequence[str]]
    values: Mapping[str, str | None] | None = None
    """New values; ``None`` deletes the rows."""


def correction_condition(rule: Correction) -> Column:
    return all_of([as_column(c).isin(*codes) for c, codes in rule.match.items()])


def apply_corrections(df: DataFrame, rules: Sequence[Correction]) -> DataFrame:
    """Apply the fixes in their order; each sees the result of the ones before."""
    for rule in rules:
        condition = correction_condition(rule)
        if rule.values is None:
            df = delete_where(df, condition)
        else:
            df = update_where(df, condition, {c: F.lit(v) for c, v in rule.values.items()})
    return df

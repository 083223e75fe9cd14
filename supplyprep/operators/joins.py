"""Lookups, existence tests and code-prefix joins.

No operator hints a broadcast: the optimizer broadcasts a side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, with adaptive
splitting of hot keys on the left.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.functions.clean import as_column
from supplyprep.sources.storage import staged

Key = str | tuple[str | Column, str | Column]
"""A column of both sides, or a (left, right) pair of columns or expressions."""


def key_pairs(keys: Sequence[Key]) -> list[tuple[Column, Column]]:
    pairs = [(k, k) if isinstance(k, str) else k for k in keys]
    return [(as_column(left), as_column(right)) for left, right in pairs]


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def exists_in(
    df: DataFrame,
    ref: DataFrame,
    keys: Sequence[Key],
    negate: bool = False,
    null_safe: bool = False,
    distinct: bool = True,
) -> DataFrame:
    """Rows with (``negate``: without) a partner in ``ref``; null keys match only if null-safe."""
    pairs = key_pairs(keys)
    right = ref.select(*[r.alias(f"__r{i}") for i, (_, r) in enumerate(pairs)])
    right = right.distinct() if distinct else right
    tests = [
        left.eqNullSafe(F.col(f"__r{i}")) if null_safe else left == F.col(f"__r{i}")
        for i, (left, _) in enumerate(pairs)
    ]
    return df.join(right, all_of(tests), "left_anti" if negate else "left_semi")


def not_exists_in(
    df: DataFrame, ref: DataFrame, keys: Sequence[Key], null_safe: bool = False
) -> DataFrame:
    return exists_in(df, ref, keys, negate=True, null_safe=null_safe)


def flag_exists(df: DataFrame, ref: DataFrame, keys: Sequence[Key], flag: str) -> DataFrame:
    """Add a boolean column that says whether a partner exists; keeps every row once."""
    pairs = key_pairs(keys)
    names = [f"__{flag}{i}" for i in range(len(pairs))]
    right = (
        ref.select(*[r.alias(n) for n, (_, r) in zip(names, pairs)])
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    tests = [left == F.col(n) for n, (left, _) in zip(names, pairs)]
    joined = df.join(right, all_of(tests), "left")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop(*names)


def flag_one_of(
    df: DataFrame, lookups: Sequence[tuple[str, DataFrame, Sequence[Key], str]]
) -> DataFrame:
    """Several flags like those of :func:`flag_exists` by one join, where no row needs two of them.

    A lookup is a flag, its reference, the keys (text) and the SQL condition of the rows that need
    it. A row is looked up for the first condition that it meets; its other flags are false. Rows that
    meet none stay spread by the keys of the widest lookup.
    """
    pairs = [key_pairs(keys) for _, _, keys, _ in lookups]
    widest = max(pairs, key=len)
    kind = F.lit(0)
    for n in range(len(lookups), 0, -1):
        kind = F.when(F.coalesce(F.expr(lookups[n - 1][3]), F.lit(False)), F.lit(n)).otherwise(kind)
    tests = [kind == F.col("__kind")]
    for i, (own, _) in enumerate(widest):
        key = own
        for n, its in enumerate(pairs, 1):
            key = F.when(kind == n, its[i][0] if i < len(its) else F.lit("")).otherwise(key)
        tests.append(key == F.col(f"__key{i}"))
    refs = []
    for n, ((_, ref, _, _), its) in enumerate(zip(lookups, pairs), 1):
        keys = [r for _, r in its] + [F.lit("")] * (len(widest) - len(its))
        refs.append(ref.select(F.lit(n).alias("__kind"), *[k.alias(f"__key{i}") for i, k in enumerate(keys)]))
    right = reduce(DataFrame.union, refs).distinct()
    joined = df.join(right, all_of(tests), "left")
    flags = [F.coalesce(F.col("__kind") == n, F.lit(False)).alias(l[0]) for n, l in enumerate(lookups, 1)]
    return joined.select(*df.columns, *flags)


def not_in(df: DataFrame, column: Column | str, ref: DataFrame, ref_column: str) -> DataFrame:
    """SQL ``NOT IN`` with its null rules, as an equi anti join.

    A null in the list rejects every row, a null on the left is rejected unless the list is empty.
    """
    flagged = _not_in_rules(df, column, ref, ref_column)
    return not_exists_in(flagged, ref, [(column, ref_column)])


def _list_facts(ref: DataFrame, ref_column: str) -> tuple[Column, Column]:
    empty = ref.agg((F.count(F.lit(1)) == 0).alias("e")).scalar()
    has_null = ref.agg((F.count(F.lit(1)) > F.count(ref_column)).alias("n")).scalar()
    return empty, has_null


def _not_in_rules(df: DataFrame, column: Column | str, ref: DataFrame, ref_column: str):
    empty, has_null = _list_facts(ref, ref_column)
    return df.filter(empty | (as_column(column).isNotNull() & ~has_null))


def flag_not_in(
    df: DataFrame, column: str, ref: DataFrame, ref_column: str, flag: str
) -> DataFrame:
    """The same test as a boolean column (false where SQL would give null)."""
    empty, has_null = _list_facts(ref, ref_column)
    found = flag_exists(df, ref, [(column, ref_column)], flag)
    passed = F.col(column).isNotNull() & ~F.col(flag) & ~has_null
    return found.withColumn(flag, empty | passed)


def with_other_child(
    df: DataFrame, group: Sequence[str], child: str, negate: bool = False
) -> DataFrame:
    """Rows whose group holds another row with a different child.

    A group has one if its smallest and largest child differ from the row's own in at least one
    case, so two numbers per group replace the pairwise comparison.
    """
    ends = df.groupBy(*[F.col(g).alias(f"__g_{g}") for g in group]).agg(
        F.min(child).alias("__low"), F.max(child).alias("__high")
    )
    match = all_of([F.col(g) == F.col(f"__g_{g}") for g in group])
    differs = (F.col(child) != F.col("__low")) | (F.col(child) != F.col("__high"))
    return df.join(ends, match & differs, "left_anti" if negate else "left_semi")


def unique_ref(
    ref: DataFrame, keys: Sequence[str], values: Sequence[str], pick: str = "error"
) -> DataFrame:
    """One row per key. ``pick`` is ``min``, ``max`` or ``error`` (fail if a key repeats).

    All picked values come from one row.
    """
    if pick == "error":
        row = F.when(
            F.count(F.lit(1)) > 1,
            F.raise_error(F.lit(f"lookup key {list(keys)} is not unique")),
        ).otherwise(F.max(F.struct(*values)))
    else:
        row = {"min": F.min, "max": F.max}[pick](F.struct(*values))
    return ref.groupBy(*keys).agg(row.alias("__row")).select(*keys, "__row.*")


def any_match(
    df: DataFrame,
    ref: DataFrame,
    keys: Sequence[Key],
    value: str,
    out: str,
    pick: str = "min",
) -> DataFrame:
    """Look up one value; if several rows match, the smallest (or largest) one."""
    pairs = key_pairs(keys)
    names = [f"__m{i}" for i in range(len(pairs))]
    right = ref.groupBy(*[r.alias(n) for n, (_, r) in zip(names, pairs)]).agg(
        {"min": F.min, "max": F.max}[pick](value).alias("__value")
    )
    tests = [left == F.col(n) for n, (left, _) in zip(names, pairs)]
    joined = df.join(right, all_of(tests), "left")
    return joined.withColumn(out, F.col("__value")).drop("__value", *names)


def sum_lookup(
    df: DataFrame, ref: DataFrame, keys: Sequence[Key], value: Column | str, out: str
) -> DataFrame:
    """Add the sum of the matching rows, 0 where none match."""
    pairs = key_pairs(keys)
    names = [f"__s{i}" for i in range(len(pairs))]
    right = ref.groupBy(*[r.alias(n) for n, (_, r) in zip(names, pairs)]).agg(
        F.sum(as_column(value)).alias("__sum")
    )
    tests = [left == F.col(n) for n, (left, _) in zip(names, pairs)]
    joined = df.join(right, all_of(tests), "left")
    return joined.withColumn(out, F.coalesce(F.col("__sum"), F.lit(0))).drop("__sum", *names)


def canonical_prefix(
    df: DataFrame,
    target: str,
    source: str,
    dim: DataFrame,
    dim_code: str,
    lengths: Sequence[int],
    where: Column | None = None,
) -> DataFrame:
    """Replace an unknown code by the shortest known prefix of the source code.

    A row changes only if its target code is not in the dimension and some prefix of its source
    code is. The work is done on the distinct codes; one join brings the result back.
    """
    known = dim.select(F.col(dim_code).alias("__known")).distinct()
    rows = df if where is None else df.filter(where)
    codes = rows.select(F.col(source).alias("__src"), F.col(target).alias("__tgt")).distinct()
    unknown = codes.join(known, F.col("__tgt") == F.col("__known"), "left_anti")
    tries = (
        unknown.select("__src")
        .distinct()
        .withColumn("__k", F.explode(F.array(*[F.lit(k) for k in lengths])))
        .withColumn("__prefix", F.substring("__src", 1, F.col("__k")))
    )
    hits = (
        tries.join(known, F.col("__prefix") == F.col("__known"), "left_semi")
        .groupBy("__src")
        .agg(F.min("__k").alias("__len"))
    )
    fixes = unknown.join(hits, "__src").select(
        F.col("__src").alias("__fsrc"),
        F.col("__tgt").alias("__ftgt"),
        F.substring("__src", 1, F.col("__len")).alias("__new"),
    )
    match = (F.col(source) == F.col("__fsrc")) & F.col(target).eqNullSafe(F.col("__ftgt"))
    chosen = F.col("__new").isNotNull()
    if where is not None:
        chosen &= F.coalesce(where, F.lit(False))
    return df.join(fixes, match, "left").select(
        *[
            F.when(chosen, F.col("__new")).otherwise(F.col(c)).alias(c) if c == target else F.col(c)
            for c in df.columns
        ]
    )


def grams_of(text: Column, width: Column) -> Column:
    """The distinct substrings of one width; none of a shorter text."""
    starts = F.sequence(F.lit(1), F.length(text) - width + 1)
    cut = F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, width)))
    return F.when(F.length(text) >= width, cut).otherwise(F.array().cast("array<string>"))


def alias_signatures(words: DataFrame) -> DataFrame:
    """All columns of the rows of distinct ``__alias`` with width and gram: the substring by which texts find each.

    The width is the largest power of two that is not above the alias length. Of the alias's
    substrings of that width the one that fewest aliases have is taken, so that what many codes have
    in common does not lead to all of them.
    """
    alias = F.col("__alias")
    wide = words.withColumn("__width", F.pow(F.lit(2), F.floor(F.log2(F.length(alias)))).cast("int"))
    grams = wide.select("*", F.explode(grams_of(alias, F.col("__width"))).alias("__gram"))
    shared = grams.groupBy(F.col("__gram").alias("__shared")).agg(F.count(F.lit(1)).alias("__n"))
    rarest = F.min(F.struct("__n", "__gram"))["__gram"].alias("__gram")
    return (
        grams.join(shared, F.col("__gram") == F.col("__shared"))
        .groupBy(*wide.columns)
        .agg(rarest)
    )


def contained_best(
    df: DataFrame, text: Column | str, aliases: DataFrame, alias: str, value: str, out: str
) -> DataFrame:
    """Largest ``value`` among the aliases that occur inside the text (null where none does).

    A text meets an alias by equality of one substring, the alias's signature, and is then searched
    for the whole alias; all texts are never compared with all aliases. A text is cut once for each
    power of two among the signature widths, so the rows grow with the logarithm of the alias
    length, not with the number of different lengths. Whole texts are searched.
    """
    words = aliases.filter(F.length(alias) > 0).select(
        F.col(alias).alias("__alias"), F.col(value).alias("__value")
    )
    signed = alias_signatures(words.groupBy("__alias").agg(F.max("__value").alias("__value")))
    length = F.length("__alias")
    widths = words.agg(
        F.collect_set(F.pow(F.lit(2), F.floor(F.log2(length))).cast("int")).alias("w")
    ).scalar()
    keyed = df.withColumn("__text", as_column(text))
    grams = (
        keyed.select("__text")
        .distinct()
        .withColumn("__k", F.explode(widths))
        .select("__text", F.explode(grams_of(F.col("__text"), F.col("__k"))).alias("__piece"))
    )
    best = (
        grams.join(signed, F.col("__piece") == F.col("__gram"))
        .filter(F.contains("__text", "__alias"))
        .groupBy(F.col("__text").alias("__btext"))
        .agg(F.max("__value").alias("__best"))
    )
    # A few texts may be those of all rows. Written, their real size is known: few are broadcast, and
    # for many a hot text is split, where an aggregate straight below the join allows neither.
    best = staged(best, "contained_best")
    # Rows without a text match nothing; a hash of the row spreads them over the tasks.
    keyed = keyed.withColumn(
        "__key", F.coalesce("__text", F.xxhash64(*df.columns).cast("string"))
    )
    match = (F.col("__key") == F.col("__btext")) & F.col("__text").isNotNull()
    joined = keyed.join(best, match, "left")
    return joined.withColumn(out, F.col("__best")).drop("__text", "__key", "__btext", "__best")

"""Splitting of multi-valued codes into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.functions.clean import as_column, null_if_empty
from supplyprep.operators.rows import holds


def tokens(value: Column | str, separator: str) -> Column:
    """Non-empty parts between separators, in order."""
    return F.regexp_extract_all(as_column(value), F.lit(f"[^{separator}]+"), F.lit(0))


def has_separator(value: Column | str, separators: Sequence[str]) -> Column:
    column = F.coalesce(as_column(value), F.lit(""))
    test = F.lit(False)
    for separator in separators:
        test |= F.contains(column, F.lit(separator))
    return test


def without_blanks(value: Column) -> Column:
    return null_if_empty(F.replace(value, F.lit(" "), F.lit("")))


def shares(
    column: str,
    separator: str,
    counted: str,
    legacy_share: bool = False,
    first_only: Column | None = None,
) -> tuple[Column, Column]:
    """Tokens of a code and the share of each."""
    parts = tokens(column, separator)
    share = F.lit(1.0) / F.size(parts)
    if legacy_share:
        without = F.replace(F.col(column), F.lit(counted), F.lit(""))
        share = F.lit(1.0) / (F.length(column) - F.length(without) + 1)
    if first_only is not None:
        parts = F.when(holds(first_only), F.slice(parts, 1, 1)).otherwise(parts)
    return parts, share


def split_rows(
    df: DataFrame,
    column: str,
    separator: str,
    ratio: str = "ratio",
    counted: str | None = None,
    legacy_share: bool = False,
    first_only: Column | None = None,
) -> DataFrame:
    """One row per token of rows that hold the separator, with the token's share.

    The share is 1 / number of tokens. ``legacy_share`` gives 1 / (separators + 1) instead, where
    the counted separator may differ from the one that splits. Blanks inside tokens are removed.
    Rows that meet ``first_only`` give their first token only.
    """
    parts, share = shares(column, separator, counted or separator, legacy_share, first_only)
    marked = df.filter(F.contains(F.col(column), F.lit(separator))).withColumn(ratio, share)
    exploded = marked.withColumn("__token", F.explode(parts))
    token = without_blanks(F.col("__token"))
    names = [c for c in df.columns if c != ratio]
    return exploded.select(
        *[token.alias(c) if c == column else F.col(c) for c in names], F.col(ratio)
    )


def union_unsplit_and_split(
    df: DataFrame,
    father: str,
    child: str,
    father_separators: Sequence[str] = ("&", ",", "/"),
    child_separators: Sequence[str] = (",", "&"),
    ratio: str = "ratio",
    legacy_share: bool = False,
    cascade: bool = False,
    first_only: Column | None = None,
) -> DataFrame:
    """Plain rows together with the split rows; rows that still hold a separator are dropped.

    Each split starts from the original row, so of a row that needs two splits only the tokens
    without the other separator are left; ``cascade`` splits such rows on both sides instead.
    """
    base = df if ratio in df.columns else df.withColumn(ratio, F.lit(None).cast("double"))
    if cascade:
        done = _split_any(base, father, father_separators, ratio)
        return _split_any(done, child, child_separators, ratio)

    def entry(father_code: Column, child_code: Column, share: Column) -> Column:
        return F.struct(
            father_code.alias("f"), child_code.alias("c"), share.cast("double").alias("r")
        )

    def split(column: str, separator: str, counted: str, make) -> Column:
        parts, share = shares(column, separator, counted, legacy_share, first_only)
        entries = F.transform(parts, lambda p: make(without_blanks(p), share))
        return F.when(F.contains(F.col(column), F.lit(separator)), entries)

    # Every split of a row becomes one entry of an array, so the rows are read once.
    plain = F.array(entry(F.col(father), F.col(child), F.col(ratio)))
    ways = [plain]
    for separator in father_separators:
        ways.append(split(father, separator, separator, lambda p, r: entry(p, F.col(child), r)))
    for separator in child_separators:
        ways.append(split(child, separator, ",", lambda p, r: entry(F.col(father), p, r)))
    known = F.filter(F.array(*ways), lambda way: way.isNotNull())
    clean = F.filter(
        F.flatten(known),
        lambda e: ~has_separator(e["f"], father_separators)
        & ~has_separator(e["c"], child_separators),
    )
    values = {father: F.col("__e.f"), child: F.col("__e.c"), ratio: F.col("__e.r")}
    exploded = base.withColumn("__e", F.explode(clean))
    return exploded.select(
        *[values[c].alias(c) if c in values else F.col(c) for c in base.columns]
    )


def _split_any(df: DataFrame, column: str, separators: Sequence[str], ratio: str) -> DataFrame:
    pattern = "".join(separators)
    several = holds(has_separator(column, separators))
    parts = F.when(several, tokens(column, pattern)).otherwise(F.array(F.col(column)))
    share = F.when(several, F.coalesce(F.col(ratio), F.lit(1.0)) / F.size(parts)).otherwise(
        F.col(ratio)
    )
    marked = df.withColumn("__share", share).withColumn("__token", F.explode(parts))
    token = without_blanks(F.col("__token"))
    replaced = {column: token, ratio: F.col("__share")}
    return marked.select(
        *[replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns]
    )


def split_tokens(df: DataFrame, column: str, separator: str = "_") -> DataFrame:
    """Distinct rows with the column replaced by each of its tokens."""
    exploded = df.withColumn("__token", F.explode(tokens(column, separator)))
    return exploded.select(
        *[F.col("__token").alias(c) if c == column else F.col(c) for c in df.columns]
    ).distinct()


def explode_counter(df: DataFrame, count: Column | str, out: str) -> DataFrame:
    """Repeat a row ``count`` times with a number from 1."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), as_column(count))))

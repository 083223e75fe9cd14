"""Cleaning and conforming of codes, as column expressions only.

An empty string means "no value" in the feeds, so every function here that can produce an empty
string turns it into null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean "no code".
NA_TOKENS = ("NA", "N/A", "NA,NA")
NA_TOKENS_BOM = ("NA", "N/A", "SNA", "S-NA")
# Site code spellings, matched on the upper-cased code.
SITE_ALIASES = {"FOXCONNL6": "FOXCONN"}
MATERIAL_LENGTH = 18
SHORT_CODE_LENGTH = 7
PADDED_CODE_LENGTH = 12


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_if_empty(value: Column | str) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def is_blank(value: Column | str) -> Column:
    """True where the text is missing or only blanks."""
    return F.coalesce(F.trim(as_column(value)), F.lit("")) == ""


def na_to_null(value: Column | str, tokens: Sequence[str] = NA_TOKENS) -> Column:
    column = as_column(value)
    return F.when(column.isin(*tokens), F.lit(None)).otherwise(column)


def strip_chars(value: Column | str, chars: str = " _-") -> Column:
    """Remove every occurrence of the given characters."""
    return null_if_empty(F.translate(as_column(value), chars, ""))


def strip_line_breaks(value: Column | str) -> Column:
    return strip_chars(value, "\r\n")


def clean_text(value: Column | str) -> Column:
    """Trim, without control characters."""
    return null_if_empty(F.trim(F.regexp_replace(as_column(value), r"[\x00-\x1f\x7f]", "")))


def pad_numeric(value: Column | str, length: int = MATERIAL_LENGTH) -> Column:
    """Left-pad codes made of digits only; the rule also cuts longer ones to ``length``."""
    column = as_column(value)
    return F.when(column.rlike("^[0-9]+$"), F.lpad(column, length, "0")).otherwise(column)


def pad_len(
    value: Column | str, have: int = SHORT_CODE_LENGTH, want: int = PADDED_CODE_LENGTH
) -> Column:
    """Left-pad codes of exactly ``have`` characters to ``want``."""
    column = as_column(value)
    return F.when(F.length(column) == have, F.lpad(column, want, "0")).otherwise(column)


def conform_material(value: Column | str) -> Column:
    """Material-number form: digits padded to 18, seven-character codes to 12."""
    return pad_len(pad_numeric(F.trim(as_column(value))))


def pad_line(value: Column | str, length: int = 5) -> Column:
    """Left-pad line numbers; longer ones stay whole, so two lines never become one."""
    text = as_column(value).cast("string")
    return F.when(F.length(text) < length, F.lpad(text, length, "0")).otherwise(text)


def all_zero_to_null(value: Column | str) -> Column:
    column = as_column(value)
    return F.when(column.rlike("^0+$"), F.lit(None)).otherwise(column)


def code_map(
    value: Column | str, mapping: Mapping[str, str | None], default: Column | None = None
) -> Column:
    """Replace listed codes; anything else becomes ``default`` (the code itself if not given)."""
    column = as_column(value)
    chain = None
    for source, target in mapping.items():
        test = column == F.lit(source)
        chain = F.when(test, F.lit(target)) if chain is None else chain.when(test, F.lit(target))
    rest = column if default is None else default
    return rest if chain is None else chain.otherwise(rest)


def site_code_map(
    site: Column | str,
    rules: Mapping[str, tuple[str, Mapping[str, str | None]]],
    default: Column | str,
) -> Column:
    """Per-site code maps: ``rules[site] = (column to translate, mapping)``.

    Codes that a site's mapping does not list keep ``default``.
    """
    site, default = as_column(site), as_column(default)
    chain = None
    for name, (source, mapping) in rules.items():
        translated = code_map(source, mapping, default=default)
        test = site == F.lit(name)
        chain = F.when(test, translated) if chain is None else chain.when(test, translated)
    return default if chain is None else chain.otherwise(default)


def site_alias(value: Column | str, aliases: Mapping[str, str] = SITE_ALIASES) -> Column:
    """Conform known site spellings, compared without regard to case."""
    column = as_column(value)
    folded = {name.upper(): target for name, target in aliases.items()}
    return code_map(F.upper(column), folded, default=column)


def first_token(value: Column | str, separator: str = "/") -> Column:
    return null_if_empty(F.regexp_extract(as_column(value), f"[^{separator}]+", 0))


def fallback(first: Column | str, second: Column | str) -> Column:
    return F.coalesce(as_column(first), as_column(second))


def blank_or_conform(value: Column | str, other: Column | str) -> Column:
    """``other`` where the code is blank, else the code without dashes in material form."""
    column = as_column(value)
    return F.when(is_blank(column), as_column(other)).otherwise(
        conform_material(F.translate(column, "-", ""))
    )


def join_text(*parts: Column | str) -> Column:
    """Concatenation in which a missing part counts as empty."""
    return F.concat(*[F.coalesce(as_column(p).cast("string"), F.lit("")) for p in parts])


def short_group_code(
    code: Column | str, father: Column | str, rank: Column | str, max_bytes: int = 10
) -> Column:
    """Keep short group codes; replace long ones by father code and rank."""
    column = as_column(code)
    kept = na_to_null(column, ("NA", "N/A"))
    return (
        F.when(F.coalesce(column, F.lit("NA")).isin("NA", "N/A"), kept)
        .when(F.octet_length(column) < max_bytes, column)
        .otherwise(join_text(father, F.lit("-"), rank))
    )

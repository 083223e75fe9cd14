"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from supplyprep.functions.clean import as_column

NO_DATE = "2000-01-01"
OPEN_END = "9999-12-31"


def year_start(value: Column | str) -> Column:
    return F.trunc(as_column(value), "year")


def week_start(value: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(as_column(value), "week")


def calendar_week(value: Column | str) -> Column:
    """Two digits, counted in seven-day blocks from 1 January (differs from the ISO week)."""
    week = F.floor((F.dayofyear(as_column(value)) - 1) / 7) + 1
    return F.lpad(week.cast("string"), 2, "0")


def normalize_eff_start(start: Column | str, loaded: Column | str) -> Column:
    """A start equal to the load day moves back to Monday of its week."""
    start, loaded = F.to_date(as_column(start)), F.to_date(as_column(loaded))
    return F.when(loaded == start, week_start(start)).otherwise(start)


def parse_mixed_date(value: Column | str) -> Column:
    """ISO text if the first dash is at position 5, else ``dd-MM-yy``, else a fixed early day."""
    text = as_column(value)
    iso = F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
    short = F.try_to_date(F.translate(text, "?", ""), "dd-MM-yy")
    return F.coalesce(
        F.when(F.instr(text, "-") == 5, iso).otherwise(short), F.to_date(F.lit(NO_DATE))
    )


def valid_on(day: Column, start: Column | str, end: Column | str) -> Column:
    """Validity interval contains the day, both ends inclusive."""
    return (as_column(start) <= day) & (as_column(end) >= day)

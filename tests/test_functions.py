from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from supplyprep.context import RunContext
from supplyprep.functions import clean, dates
from supplyprep.operators.split import split_rows, union_unsplit_and_split


def one(spark, value, expression):
    df = spark.createDataFrame([(value,)], "c string")
    return df.select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, expected",
    [("NA", None), ("N/A", None), ("NA,NA", None), ("NAB", "NAB"), (None, None)],
)
def test_na_to_null(spark, value, expected):
    assert one(spark, value, clean.na_to_null("c")) == expected


def test_strip_chars_gives_null_when_nothing_is_left(spark):
    assert one(spark, " _-", clean.strip_chars("c")) is None
    assert one(spark, "A_B-C D", clean.strip_chars("c")) == "ABCD"
    assert one(spark, "x\r\n", clean.strip_line_breaks("c")) == "x"


@pytest.mark.parametrize(
    "value, expected",
    [
        ("12345", "000000000000012345"),
        ("1234567", "000000000001234567"),
        ("AB12345", "00000AB12345"),
        ("AB123456", "AB123456"),
        ("1234567890123456789", "123456789012345678"),
        (None, None),
    ],
)
def test_conform_material(spark, value, expected):
    assert one(spark, value, clean.conform_material("c")) == expected


def test_all_zero_codes(spark):
    assert one(spark, "0000", clean.all_zero_to_null("c")) is None
    assert one(spark, "0010", clean.all_zero_to_null("c")) == "0010"


def test_blank_item_falls_back_to_site_code(spark):
    df = spark.createDataFrame([(" ", "S1"), ("AB-12345", "S2"), (None, "S3")], "i string, s string")
    got = rows(df.select("s", clean.blank_or_conform("i", "s").alias("r")))
    assert got == [("S1", "S1"), ("S2", "00000AB12345"), ("S3", "S3")]


def test_site_alias_ignores_case_and_keeps_unknown_sites(spark):
    assert one(spark, "FoxconnL6", clean.site_alias("c")) == "FOXCONN"
    assert one(spark, "Other", clean.site_alias("c")) == "Other"


def test_short_group_code(spark):
    df = spark.createDataFrame(
        [("G1", 1), ("N/A", 2), (None, 3), ("much-too-long", 4), ("exactly10!", 5)], "c string, r int"
    )
    got = [r[0] for r in df.orderBy("r").select(clean.short_group_code("c", F.lit("F"), "r")).collect()]
    assert got == ["G1", None, None, "F-4", "F-5"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-03-05 10:00", date(2024, 3, 5)),
        ("05-03-24", date(2024, 3, 5)),
        ("05-03?-24", date(2024, 3, 5)),
        (None, date(2000, 1, 1)),
    ],
)
def test_parse_mixed_date(spark, value, expected):
    assert one(spark, value, dates.parse_mixed_date("c")) == expected


def test_calendar_week_is_not_the_iso_week(spark):
    assert one(spark, "2027-01-01", dates.calendar_week(F.to_date("c"))) == "01"
    assert one(spark, "2024-12-31", dates.calendar_week(F.to_date("c"))) == "53"


def test_context_calendar():
    ctx = RunContext(run_ts=datetime(2024, 5, 16, 8))  # a Thursday
    assert ctx.is_snapshot_day and ctx.version == "20240516"
    assert ctx.week_start == date(2024, 5, 13) and ctx.calendar_week == "20"
    assert ctx.receipt_cutoff == date(2024, 5, 16)
    assert RunContext(run_ts=datetime(2024, 5, 15)).receipt_cutoff == date(2024, 5, 9)


SPLIT = [("A&B", "x"), ("A,B", "x"), ("A/B", "x"), ("A&&B", "x"), ("A&B,C", "x"), ("A&B", "x,y"), ("C", "x&y"), ("C", "z")]


def test_split_shares_sum_to_one(spark):
    df = spark.createDataFrame([(v,) for v in ("A&B", "A&&B", "A& B&C")], "f string").withColumn("id", F.col("f"))
    out = split_rows(df, "f", "&").groupBy("id").agg(F.sum("ratio").alias("s"))
    assert all(abs(r["s"] - 1) < 1e-9 for r in out.collect())


def test_legacy_share_counts_separators(spark):
    df = spark.createDataFrame([("A&&B",), ("A&B",)], "f string").withColumn("id", F.col("f"))
    got = rows(split_rows(df, "f", "&", legacy_share=True), "id", "f", "ratio")
    assert got == [("A&&B", "A", pytest.approx(1 / 3)), ("A&&B", "B", pytest.approx(1 / 3)), ("A&B", "A", 0.5), ("A&B", "B", 0.5)]
    child = split_rows(df, "f", "&", counted=",", legacy_share=True)
    assert {r["ratio"] for r in child.collect()} == {1.0}


def test_rows_that_need_two_splits_are_dropped_or_cascaded(spark):
    df = spark.createDataFrame(SPLIT, "f string, c string")
    got = rows(union_unsplit_and_split(df, "f", "c"), "f", "c")
    # Of "A&B,C" each split leaves one token without the other separator.
    mixed = [("A", "x"), ("C", "x")]
    assert got == sorted(
        [("A", "x"), ("B", "x")] * 4 + mixed + [("C", "x"), ("C", "y"), ("C", "z")]
    )
    both = union_unsplit_and_split(df, "f", "c", cascade=True)
    assert both.filter("f = 'B' AND c = 'y'").select("ratio").first()["ratio"] == 0.25
    assert both.count() == 8 + 3 + 4 + 2 + 1


def test_first_only_keeps_one_token(spark):
    df = spark.createDataFrame([("A&B", None), ("C&D", "u")], "f string, bu string")
    got = rows(split_rows(df, "f", "&", first_only=F.col("bu").isNull()), "f", "bu")
    assert got == [("A", None), ("C", "u"), ("D", "u")]

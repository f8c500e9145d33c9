import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tellwatt.functions import daybits, scalars
from tellwatt.functions.dates import (
    calendar_of, export_window, header_date, month_calendar, month_days, parse_date,
)


def one(spark, column, *values, schema="x string"):
    column = F.expr(column) if isinstance(column, str) else column
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(column).collect()]


def test_key_strip(spark):
    got = one(spark, scalars.normalize_key("x"), "0043138963", "000", "0", "00A", None, "")
    assert got == ["43138963", "0", "0", "A", None, ""]
    assert one(spark, scalars.normalize_key("x"), 43, schema="x bigint") == ["43"]


def test_key_strip_follows_its_pattern(spark):
    rng = random.Random(3)
    keys = ["".join(rng.choice("0001A é9") for _ in range(rng.randrange(9))) for _ in range(2000)]
    assert one(spark, scalars.normalize_key("x"), *keys) == [re.sub("^0+(.)", r"\1", k) for k in keys]


def test_parse_date(spark):
    got = one(spark, parse_date(F.col("x")), "2026-02-24", "24-02-2026", "24/02/2026", "4/2/2026", "31/02/2026", "NIO", None)
    day = date(2026, 2, 24)
    assert got == [day, day, day, date(2026, 2, 4), None, None, None]


@pytest.mark.parametrize("text", ["2026-02-24", "24-02-2026", "24/02/2026"])
def test_header_date(text):
    assert header_date(text) == date(2026, 2, 24)


def test_header_date_of_other_names():
    assert [header_date(n) for n in ("NIO", "90", "31/02/2026", "")] == [None] * 4


def test_numbers(spark):
    got = one(spark, scalars.to_number("x"), "0,25", "0.5", "1", "abc", "", None)
    assert got == [0.25, 0.5, 1.0, None, None, None]


def test_binarize_and_cut(spark):
    values = [0.75, 0.0, -1.0, None, 300.0, 1.9]
    assert one(spark, scalars.binarize("x"), *values, schema="x double") == [1, 0, 0, 0, 1, 1]
    assert one(spark, scalars.to_flag("x"), *values, schema="x double") == [0, 0, -1, None, None, 1]


def test_rejected(spark):
    assert one(spark, scalars.rejected("x"), "abc", "0,5", None) == [True, False, False]


def test_ratio_ties_go_to_even(spark):
    df = spark.createDataFrame([(1, 32), (3, 32), (1, 3), (0, 5)], "a bigint, b bigint")
    assert [r[0] for r in df.selectExpr(scalars.ratio("a", "b")).collect()] == [0.0312, 0.0938, 0.3333, 0.0]


@pytest.mark.parametrize(
    "month, lookback, first, days",
    [
        ("2026-01", 5, date(2025, 12, 27), 36),
        ("2026-02", 5, date(2026, 1, 27), 33),
        ("2026-01", 0, date(2026, 1, 1), 31),
        ("2026-02", 0, date(2026, 2, 1), 28),
        ("2024-02", 0, date(2024, 2, 1), 29),
    ],
)
def test_calendars(spark, month, lookback, first, days):
    rows = sorted(r[0] for r in month_calendar(spark, month, lookback).collect())
    assert rows[0] == first and len(rows) == days
    assert rows[-1] == month_days(month)[-1]


def test_calendar_and_export_window_of_a_column(spark):
    df = spark.createDataFrame([(date(2026, 3, 1),)], "m date")
    assert len(df.select(calendar_of(F.col("m"), 5)).first()[0]) == 36
    assert tuple(df.select(*export_window(F.col("m"))).first()) == (date(2026, 2, 24), date(2026, 3, 31), "mar2026")


def test_day_bits(spark):
    df = spark.createDataFrame([(0b1,), (0b100000,), (0,)], "d bigint")
    got = [r[0] for r in df.selectExpr(daybits.any_of_preceding("d", 5, 31)).collect()]
    # Bit 0 is five days before the month: it counts for the first day only.
    assert got == [0b1, 0b111110, 0]
    assert spark.range(1).selectExpr(daybits.has_bit(daybits.bit("62"), "62")).first()[0] is True
    assert spark.range(1).selectExpr(daybits.without("7L", "2L")).first()[0] == 5

"""Dates: parsing, calendars and labels."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.vocabulary import DAY, PYTHON_DATE_PATTERNS, SPARK_DATE_PATTERNS


def parse_date(text: Column) -> Column:
    """Date in any accepted spelling, null when none fits."""
    return F.coalesce(*(F.try_to_date(text, pattern) for pattern in SPARK_DATE_PATTERNS))


def header_date(name: str) -> date | None:
    """The same rule for a column name, which only the driver sees."""
    for pattern in PYTHON_DATE_PATTERNS:
        try:
            return datetime.strptime(name, pattern).date()
        except ValueError:
            pass
    return None


def month_first(month: str) -> date:
    return datetime.strptime(month, "%Y-%m").date()


def month_last(month: str) -> date:
    after = month_first(month) + timedelta(days=31)
    return after.replace(day=1) - timedelta(days=1)


def month_days(month: str) -> list[date]:
    first, last = month_first(month), month_last(month)
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def calendar_of(first_of_month: Column, lookback: int = 0) -> Column:
    """Array of a month's days, led by ``lookback`` days of the month before."""
    return F.sequence(F.date_sub(first_of_month, lookback), F.last_day(first_of_month))


def month_calendar(spark: SparkSession, month: str, lookback: int = 0) -> DataFrame:
    """One row per day of ``month``, with look-back days in front."""
    first = F.lit(month_first(month))
    return spark.range(1).select(F.explode(calendar_of(first, lookback)).alias(DAY))


def export_window(first_of_month: Column, lookback: int = 5) -> list[Column]:
    """First day, last day and label of the export that belongs to a month."""
    return [
        F.date_sub(first_of_month, lookback).alias("from_date"),
        F.last_day(first_of_month).alias("to_date"),
        F.lower(F.date_format(first_of_month, "MMMyyyy")).alias("label"),
    ]


def iso(day: Column) -> Column:
    """``yyyy-MM-dd`` text, the spelling of days in stored results."""
    return F.date_format(day, "yyyy-MM-dd")

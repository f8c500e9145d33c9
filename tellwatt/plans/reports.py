"""Exports and the report over several months."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.functions.dates import month_first, month_last
from tellwatt.operators.columns import canonical_order, select_columns
from tellwatt.operators.reshape import columns_between, rename_raw_key, to_absolute_days
from tellwatt.sinks.writers import write_csv
from tellwatt.sources.dated import read_month_results
from tellwatt.sources.tables import read_table
from tellwatt.vocabulary import BRAND, CITY, DAY, DEFAULT_WINDOW_DAYS


def enrich(df: DataFrame, reference: date) -> DataFrame:
    """A raw wide table with dates as column names and the usual key name."""
    return rename_raw_key(to_absolute_days(df, reference))


def month_columns(df: DataFrame, month: str, lookback: int = DEFAULT_WINDOW_DAYS) -> DataFrame:
    """Day columns of a month and its look-back."""
    return columns_between(df, month_first(month) - timedelta(days=lookback), month_last(month))


def export_days(spark: SparkSession, source: str, target: str, first: date, last: date, overwrite: bool = False) -> None:
    """Day columns of a stored table as CSV; an existing target is kept unless told otherwise."""
    mode = "overwrite" if overwrite else "errorifexists"
    write_csv(columns_between(read_table(spark, source), first, last), target, mode)


def export_columns(df: DataFrame, spec: str, target: str) -> None:
    write_csv(select_columns(df, spec), target)


def combine_months(results: DataFrame, distinct: bool = False) -> DataFrame:
    """Month results in one table, sorted by day, city and brand."""
    rows = canonical_order(results.distinct() if distinct else results)
    keys = [DAY, CITY, BRAND] if {CITY, BRAND} <= set(rows.columns) else [DAY]
    return rows.orderBy(*keys) if DAY in rows.columns else rows


def month_report(
    spark: SparkSession, folder: str, distinct: bool = False, prefer: str | None = None
) -> DataFrame | None:
    """All stored month results of a folder; None if it has none that can be read.

    Columns beyond the result's own stand last; files that can't be read are logged, and
    listed by ``read_month_results``. A month stored as CSV and as Parquet counts twice unless ``distinct`` is set or
    ``prefer`` names the format to take for such months.
    """
    results, _ = read_month_results(spark, folder)
    if results is None:
        return None
    if prefer:
        # One row per stored month.
        preferred = F.broadcast(results.where(F.col("suffix") == prefer).select("month").distinct())
        other = results.where(F.col("suffix") != prefer).join(preferred, "month", "left_anti")
        results = results.where(F.col("suffix") == prefer).unionByName(other)
    return combine_months(results.drop("file_path", "month", "suffix"), distinct)

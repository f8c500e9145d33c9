"""From the stored files of a month to its stored result."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.functions.dates import month_days
from tellwatt.operators.flags import flags_from_wide
from tellwatt.operators.quality import rejected_cells
from tellwatt.operators.reshape import day_columns, header_row_to_absolute
from tellwatt.plans.month import Month, Origin, flags_table, month_indicator, near_columns
from tellwatt.plans.reports import enrich
from tellwatt.sinks.writers import csv_to_parquet, write_csv
from tellwatt.sources.dated import read_brands, read_reference_date, read_universe
from tellwatt.sources.tables import read_if_present, read_table, with_file_order
from tellwatt.vocabulary import BRAND, CITY, DEFAULT_WINDOW_DAYS, KEY, ORIGIN, RESULT_SCHEMA, SMART_BRANDS

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class OriginFiles:
    """Where an origin's wide table is stored.

    Its columns are relative days when ``reference`` names the file with the
    reference date; otherwise they are dates, or digits above a row of dates. ``key`` is
    the name of its key column.
    """

    name: str
    table: str
    reference: str | None = None
    binary: bool = False
    key: str = KEY


def read_origin(spark: SparkSession, files: OriginFiles) -> Origin | None:
    """The origin, or None with a warning when one of its files does not exist."""
    table = read_if_present(lambda: read_table(spark, files.table))
    if table is None:
        logger.warning("%s left out: no %s", files.name, files.table)
        return None
    ordered = with_file_order(table, "_order")
    if files.reference:
        reference = read_if_present(lambda: read_reference_date(spark, files.reference))
        if reference is None:
            logger.warning("%s left out: no %s", files.name, files.reference)
            return None
        ordered = enrich(ordered, reference)
    elif not day_columns(table.columns):
        ordered = header_row_to_absolute(ordered)
    return Origin(files.name, ordered, files.binary, order="_order", key=files.key)


def read_origins(spark: SparkSession, files: Sequence[OriginFiles]) -> list[Origin]:
    """Origins in order of precedence, those that exist."""
    origins = [o for o in (read_origin(spark, f) for f in files) if o]
    if not origins:
        raise FileNotFoundError("no origin has its files")
    return origins


def store_enriched(spark: SparkSession, files: OriginFiles, target: str) -> None:
    """An origin's raw table as CSV, with dates as column names."""
    write_csv(enrich(read_table(spark, files.table), read_reference_date(spark, files.reference)), target)


def origin_flags_from_files(
    spark: SparkSession, month: str, origins: Sequence[OriginFiles], window_days: int = DEFAULT_WINDOW_DAYS
) -> DataFrame:
    """A month's flags of each origin (NIO, DISP, DATA, ORIGEM), read from files; no shuffle."""
    return reduce(
        DataFrame.unionByName,
        [
            flags_from_wide(o.frame, month_days(month), window_days, o.binary).withColumn(ORIGIN, F.lit(o.name))
            for o in read_origins(spark, origins)
        ],
    )


def month_from_files(
    spark: SparkSession,
    month: str,
    origins: Sequence[OriginFiles],
    universe: str,
    brands: str,
    window_days: int = DEFAULT_WINDOW_DAYS,
    kept: Sequence[str] = SMART_BRANDS,
    levels: bool = False,
    key: str = KEY,
    city: str = CITY,
    brand: str = BRAND,
) -> DataFrame:
    """A month's indicator, read from files in one plan.

    ``levels`` takes any plain reading and any window, see ``month_indicator``. ``key``
    and ``city`` are the universe files' column names, ``key`` and ``brand`` those of
    the brand table; an origin names its own key.
    """
    return month_indicator(
        read_universe(spark, universe, month, key, city),
        read_brands(spark, brands, key, brand),
        read_origins(spark, origins),
        month,
        window_days,
        kept,
        levels=levels,
    )


def rejected_from_files(
    spark: SparkSession, month: str, origins: Sequence[OriginFiles], window_days: int = DEFAULT_WINDOW_DAYS
) -> DataFrame:
    """Per origin (ORIGEM), how many cells that matter to the month hold no number or none that fits."""
    span = Month(month, window_days)
    return reduce(
        DataFrame.unionByName,
        [
            rejected_cells(o.frame, near_columns(o, span), plain=not o.binary).select(F.lit(o.name).alias(ORIGIN), "rejected")
            for o in read_origins(spark, origins)
        ],
    )


def flags_from_files(
    spark: SparkSession,
    month: str,
    origins: Sequence[OriginFiles],
    window_days: int = DEFAULT_WINDOW_DAYS,
    levels: bool = False,
) -> DataFrame:
    """A month's merged flags, read from files."""
    return flags_table(read_origins(spark, origins), month, window_days, levels)


def store_month(result: DataFrame, folder: str, month: str, parquet: bool = True) -> None:
    """A month's result as CSV and, by default, as Parquet made from it."""
    path = f"{folder.rstrip('/')}/municipio_{month}"
    write_csv(result, f"{path}.csv")
    if parquet:
        csv_to_parquet(result.sparkSession, f"{path}.csv", f"{path}.parquet", RESULT_SCHEMA)

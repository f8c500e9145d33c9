"""Joins on normalised device keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellwatt.functions.scalars import normalize_key, quoted
from tellwatt.vocabulary import BRAND, CITY, DAY, FLAG, KEY, MERGED_ORIGIN, ORIGIN, SMART_BRANDS


def with_key(df: DataFrame, key: str = KEY) -> DataFrame:
    return df.withColumn(key, F.expr(normalize_key(quoted(key))))


def renamed(df: DataFrame, key: str = KEY, city: str = CITY) -> DataFrame:
    """The table with its own key and city columns under the usual names."""
    return df.withColumnsRenamed({key: KEY, city: CITY})


def join_universe(
    universe: DataFrame,
    flags: DataFrame,
    origin: str = MERGED_ORIGIN,
    days: DataFrame | None = None,
    key: str = KEY,
    city: str = CITY,
) -> DataFrame:
    """Every universe row of the days that have flags; 0 where a device has none.

    Universe rows are never merged, so a device listed twice counts twice. ``days``
    (DATA) spares a pass over flags that are not stored. ``key`` and ``city`` are the
    columns' names in both tables and in the result.
    """
    universe, flags = renamed(universe, key, city), with_key(renamed(flags, key, city))
    # One row per calendar day.
    valid = F.broadcast((flags if days is None else days).select(DAY).distinct())
    listed = with_key(universe).join(valid, DAY, "left_semi")
    joined = listed.join(flags.select(DAY, KEY, FLAG), [DAY, KEY], "left")
    return joined.select(
        F.col(KEY).alias(key),
        F.col(CITY).alias(city),
        F.lit(origin).alias(ORIGIN),
        F.coalesce(F.col(FLAG), F.lit(0)).cast("tinyint").alias(FLAG),
        DAY,
    )


def smart_brands(brands: DataFrame, kept: Sequence[str] = SMART_BRANDS, key: str = KEY) -> DataFrame:
    """Brand table rows of the kept brands, compared case-sensitively, keys under the usual name."""
    brands = renamed(brands, key)
    brand = F.col(BRAND).cast("string")
    return brands.where(brand.isin(*kept)).select(
        F.expr(normalize_key(KEY)).alias(KEY), brand.alias(BRAND)
    )


def join_brands(df: DataFrame, brands: DataFrame, kept: Sequence[str] = SMART_BRANDS, key: str = KEY) -> DataFrame:
    """Rows whose device has a kept brand; repeated brand rows repeat the device."""
    kept_brands = smart_brands(brands, kept, key).withColumnRenamed(KEY, key)
    return with_key(df, key).join(kept_brands, key, "inner")

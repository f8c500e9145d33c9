"""Counts and ratios over joined rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellwatt.functions.dates import iso
from tellwatt.functions.scalars import ratio
from tellwatt.vocabulary import BRAND, CITY, COMM, DAY, FLAG, KEY, RATIO, RESULT_SCHEMA, TOTAL


def availability(joined: DataFrame, key: str = KEY, city: str = CITY) -> DataFrame:
    """Communicating and total devices, and their ratio, by city, brand and day.

    ``key`` and ``city`` are the columns' names; the result has the usual ones.
    """
    counted = joined.withColumnsRenamed({key: KEY, city: CITY}).groupBy(CITY, BRAND, DAY).agg(
        F.coalesce(F.sum(FLAG), F.lit(0)).alias(COMM),
        F.count(KEY).alias(TOTAL),
    )
    return with_ratio(counted)


def with_ratio(counted: DataFrame) -> DataFrame:
    shares = counted.withColumn(RATIO, F.expr(ratio(COMM, TOTAL)))
    return shares.withColumn(DAY, iso(F.col(DAY))).select(*RESULT_SCHEMA.names)


def flag_counts(flags: DataFrame, *by: str) -> DataFrame:
    """Devices and communicating devices."""
    return flags.groupBy(*by).agg(
        F.count("*").alias("meters"),
        F.count_if(F.col(FLAG) == 1).alias("communicating"),
    )


def brand_counts(brands: DataFrame) -> DataFrame:
    return brands.groupBy(BRAND).agg(F.count("*").alias("meters"))


def day_totals(result: DataFrame) -> DataFrame:
    """Sums over all groups of a day."""
    return result.groupBy(DAY).agg(
        F.sum(COMM).alias("comm"),
        F.sum(TOTAL).alias("total"),
        F.count("*").alias("groups"),
    )

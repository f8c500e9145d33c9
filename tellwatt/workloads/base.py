"""The driver's tables in the roles of readings, universe and brands.

``events`` are readings, ``customer`` and ``nation`` list the devices with their
cities, market segments are brands. Reading keys are padded with zeros, the
others are not.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.functions.dates import month_first, month_last
from tellwatt.plans.month import Origin
from tellwatt.vocabulary import BRAND, CITY, DAY, KEY, ORIGIN, ORIGINS

MONTH = "2024-01"
SEGMENTS = ("BUILDING", "MACHINERY", "FURNITURE")

FIRST, SECOND = ORIGINS


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def padded(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 10, "0")


def first_cell() -> Column:
    """Every event is a reading of the first origin: a quarter if it is a purchase."""
    return F.when(F.col("event_type") == "purchase", F.lit("0,25")).otherwise(F.lit("0"))


def second_cell() -> Column:
    """And one of the second: 1 if it is a signup."""
    return F.when(F.col("event_type") == "signup", F.lit("1")).otherwise(F.lit("0"))


def readings(events: DataFrame, cell: Column) -> DataFrame:
    return events.select(padded("user_id").alias(KEY), F.to_date("ts").alias(DAY), cell.alias("VALUE"))


def origins(spark: SparkSession, sf: str) -> list[Origin]:
    """Both origins, read in one pass."""
    tagged = tagged_readings(spark, sf)
    return [Origin(FIRST, tagged, binary=True, tagged=True), Origin(SECOND, tagged, tagged=True)]


def tagged_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Both origins' readings in one pass over the events."""
    cells = F.map_from_arrays(
        F.array(F.lit(FIRST), F.lit(SECOND)), F.array(first_cell(), second_cell())
    )
    return table(spark, sf, "events").select(
        padded("user_id").alias(KEY), F.to_date("ts").alias(DAY), F.explode(cells).alias(ORIGIN, "VALUE")
    )


def devices(spark: SparkSession, sf: str) -> DataFrame:
    """Devices and their cities. ``nation`` has 25 rows at any scale."""
    nation = F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    customer = table(spark, sf, "customer")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        F.col("c_custkey").cast("string").alias(KEY), F.col("n_name").alias(CITY)
    )


def universe(spark: SparkSession, sf: str) -> DataFrame:
    """Every device on every day of the month."""
    days = F.sequence(F.lit(month_first(MONTH)), F.lit(month_last(MONTH)))
    return devices(spark, sf).select(KEY, CITY, F.explode(days).alias(DAY))


def brands(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias(KEY), F.col("c_mktsegment").alias(BRAND)
    )


def reading_days(spark: SparkSession, sf: str) -> tuple[date, date]:
    """First and last day that has an event."""
    bounds = table(spark, sf, "events").agg(F.min("ts"), F.max("ts")).first()
    return bounds[0].date(), bounds[1].date()


def reference(spark: SparkSession, sf: str) -> date:
    """The day after the last reading, which relative days count back from."""
    return reading_days(spark, sf)[1] + timedelta(days=1)


def wide(spark: SparkSession, sf: str, value: Column, merge=F.sum) -> DataFrame:
    """Readings as a wide table under relative days; the highest is the day before the reference."""
    first, last = reading_days(spark, sf)
    relative = F.datediff(F.to_date("ts"), F.lit(first)) + 1
    days = list(range((last - first).days + 1, 0, -1))
    return (
        table(spark, sf, "events")
        .select(padded("user_id").alias(KEY), relative.alias("day"), value.alias("value"))
        .groupBy(KEY)
        .pivot("day", days)
        .agg(merge("value"))
    )


def quarter_purchases() -> Column:
    return F.when(F.col("event_type") == "purchase", 0.25).otherwise(0.0)


def half_signups() -> Column:
    return F.when(F.col("event_type") == "signup", 0.5).otherwise(0.0)


def any_signup() -> Column:
    return F.when(F.col("event_type") == "signup", 1).otherwise(0)


def decimal_comma(df: DataFrame) -> DataFrame:
    """All cells as text with a decimal comma."""
    cells = [f"replace(cast(`{c}` AS string), '.', ',') AS `{c}`" for c in df.columns if c != KEY]
    return df.selectExpr(KEY, *cells)


# The same tables for the check in SQL.
SQL_READINGS = """
days AS (SELECT CAST(range AS DATE) AS d FROM range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY)),
readings AS (
  SELECT 'ORCA' AS o, user_id AS k, CAST(ts AS DATE) AS d, event_type = 'purchase' AS hit FROM events
  UNION ALL
  SELECT 'SANPLAT', user_id, CAST(ts AS DATE), event_type = 'signup' FROM events),
covered AS (
  SELECT DISTINCT r.o, days.d FROM (SELECT DISTINCT o, d FROM readings) r
  JOIN days ON r.d BETWEEN days.d - 5 AND days.d - 1),
origin_flags AS (
  SELECT m.o, m.k, c.d, CAST(max(CASE WHEN r.hit THEN 1 WHEN r.hit IS NOT NULL OR m.o = 'ORCA' THEN 0 END) AS TINYINT) AS disp
  FROM (SELECT DISTINCT o, k FROM readings) m
  JOIN covered c ON c.o = m.o
  LEFT JOIN readings r ON r.o = m.o AND r.k = m.k AND r.d BETWEEN c.d - 5 AND c.d - 1
  GROUP BY m.o, m.k, c.d),
merged AS (
  SELECT k, d, disp FROM (
    SELECT *, row_number() OVER (PARTITION BY k, d ORDER BY o) AS place FROM origin_flags)
  WHERE place = 1)
"""

SQL_UNIVERSE = """
universe AS (
  SELECT c_custkey AS k, n_name AS city, d
  FROM customer JOIN nation ON n_nationkey = c_nationkey CROSS JOIN days),
listed AS (SELECT * FROM universe WHERE d IN (SELECT d FROM merged)),
joined AS (
  SELECT u.k, u.city, u.d, COALESCE(m.disp, 0) AS disp
  FROM listed u LEFT JOIN merged m ON m.k = u.k AND m.d = u.d)
"""

SQL_AVAILABILITY = """
SELECT city AS "MUNICIPIO", c_mktsegment AS "INTELIGENTE",
  CAST(sum(disp) AS BIGINT) AS "CONTAGEM_COMM", count(*) AS "CONTAGEM_TOT",
  round_even(sum(disp) / count(*), 4) AS "DISP", strftime(d, '%Y-%m-%d') AS "DATA"
FROM joined JOIN customer ON c_custkey = k
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')
GROUP BY city, c_mktsegment, d
"""

"""Queries for the moving window and the month's indicator."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellwatt.functions.dates import iso, month_days
from tellwatt.operators.flags import (
    flags_by_frame, flags_from_long, flags_from_wide, merge_origins, observed_targets, sliding_flags,
)
from tellwatt.operators.indicators import availability
from tellwatt.operators.joins import join_brands, join_universe, with_key
from tellwatt.operators.reshape import to_absolute_days
from tellwatt.plans.month import Origin, covered_table, flags_table, month_indicator
from tellwatt.vocabulary import DAY, DEFAULT_WINDOW_DAYS, FLAG, KEY, ORIGIN
from tellwatt.workloads import base
from tellwatt.workloads.base import MONTH, SEGMENTS, SQL_AVAILABILITY, SQL_READINGS, SQL_UNIVERSE

PADDED = "lpad(CAST(k AS VARCHAR), 10, '0')"


def edge(df, *columns):
    """Days as text, the form results are stored in."""
    return df.withColumn(DAY, iso(F.col(DAY))).select(*columns)


def availability_daily(spark, sf):
    return month_indicator(
        base.universe(spark, sf), base.brands(spark, sf), base.origins(spark, sf), MONTH, kept=SEGMENTS
    )


def availability_step_by_step(spark, sf):
    readings = base.tagged_readings(spark, sf)
    flags = merge_origins(flags_from_long(readings, MONTH))
    days = observed_targets(readings, MONTH, DEFAULT_WINDOW_DAYS)
    joined = join_universe(base.universe(spark, sf), flags, days=days)
    return availability(join_brands(joined, base.brands(spark, sf), SEGMENTS))


def overlapping(spark, sf):
    """Few devices send to the first origin: the events whose property k is 7 or 77."""
    events = base.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    first = F.coalesce(k.isin("7", "77"), F.lit(False))
    cell = F.when(F.col("value") > 50, F.lit("1")).otherwise(F.lit("0"))
    rows = events.select(base.padded("user_id").alias(KEY), F.to_date("ts").alias(DAY), cell.alias("VALUE"), first.alias("first"))
    return [
        Origin(base.FIRST, rows.where("first").select(KEY, DAY, "VALUE"), binary=True),
        Origin(base.SECOND, rows.where("NOT first").select(KEY, DAY, "VALUE")),
    ]


def availability_overlapping_origins(spark, sf):
    return month_indicator(
        base.universe(spark, sf), base.brands(spark, sf), overlapping(spark, sf), MONTH, kept=SEGMENTS
    )


SQL_OVERLAPPING = SQL_READINGS.replace(
    SQL_READINGS[SQL_READINGS.index("readings AS ("):SQL_READINGS.index("covered AS (")],
    """readings AS (
  SELECT CASE WHEN regexp_extract(props, '"k": *([0-9]+)', 1) IN ('7', '77') THEN 'ORCA' ELSE 'SANPLAT' END AS o,
    user_id AS k, CAST(ts AS DATE) AS d, value > 50 AS hit FROM events),
""",
)


def moving_or_flag_wide(spark, sf):
    table = to_absolute_days(base.decimal_comma(base.wide(spark, sf, base.quarter_purchases())), base.reference(spark, sf))
    return edge(flags_from_wide(table, month_days(MONTH), binary=True), KEY, FLAG, DAY)


def moving_or_flag_plain(spark, sf):
    table = to_absolute_days(base.wide(spark, sf, base.half_signups()), base.reference(spark, sf))
    return edge(flags_from_wide(table, month_days(MONTH)), KEY, FLAG, DAY)


def moving_or_flag_two_days(spark, sf):
    table = to_absolute_days(base.wide(spark, sf, base.quarter_purchases()), base.reference(spark, sf))
    return edge(flags_from_wide(table, month_days(MONTH), window_days=2, binary=True), KEY, FLAG, DAY)


def moving_or_flag_long(spark, sf):
    return edge(flags_from_long(base.tagged_readings(spark, sf), MONTH), KEY, ORIGIN, FLAG, DAY)


def moving_or_flag_frame(spark, sf):
    return edge(flags_by_frame(base.tagged_readings(spark, sf), MONTH), KEY, ORIGIN, FLAG, DAY)


def moving_or_flag_bits(spark, sf):
    return edge(flags_table(base.origins(spark, sf), MONTH), KEY, FLAG, DAY)


def odd_readings(spark, sf):
    """A plain origin with readings beyond 1, beyond a flag, and with a letter behind."""
    kind = F.col("event_type")
    cell = (
        F.when(kind == "purchase", F.lit("2")).when(kind == "signup", F.lit("200")).when(kind == "view", F.lit("1d"))
        .otherwise(F.lit("1,0"))
    )
    return [Origin(base.SECOND, base.readings(base.table(spark, sf, "events"), cell))]


def moving_or_flag_levels(spark, sf):
    return edge(flags_table(odd_readings(spark, sf), MONTH, 45, levels=True), KEY, FLAG, DAY)


def availability_levels(spark, sf):
    return month_indicator(
        base.universe(spark, sf), base.brands(spark, sf), odd_readings(spark, sf), MONTH, 45, SEGMENTS, levels=True
    )


def availability_year(spark, sf):
    """A window of a year; the readings are of its last month."""
    return month_indicator(
        base.universe(spark, sf), base.brands(spark, sf), odd_readings(spark, sf), MONTH, 365, SEGMENTS, levels=True
    )


def moving_or_flag_sliding(spark, sf):
    events = base.table(spark, sf, "events").select(
        base.padded("user_id").alias(KEY), "ts", base.first_cell().alias("VALUE")
    )
    return edge(sliding_flags(events).where(F.col(FLAG) == 1), KEY, FLAG, DAY)


def dedup_first_by_origin(spark, sf):
    flags = flags_from_long(base.tagged_readings(spark, sf), MONTH)
    return edge(merge_origins(flags), KEY, FLAG, DAY)


def universe_left_join(spark, sf):
    origins = base.origins(spark, sf)
    days = covered_table(origins, MONTH)
    joined = join_universe(base.universe(spark, sf), flags_table(origins, MONTH), days=days)
    return edge(joined, KEY, "MUNICIPIO", ORIGIN, FLAG, DAY)


def dedup_with_ties(spark, sf):
    """Orders as flags of a customer and month, an origin a status; of an origin, the lowest order stands."""
    flags = base.table(spark, sf, "orders").select(
        base.padded("o_custkey").alias(KEY),
        F.when(F.col("o_totalprice") > 150000, 1).otherwise(0).cast("tinyint").alias(FLAG),
        F.trunc("o_orderdate", "year").alias(DAY),
        F.when(F.col("o_orderstatus") == "P", base.FIRST).otherwise(base.SECOND).alias(ORIGIN),
        F.col("o_orderkey").alias("seq"),
    )
    return edge(merge_origins(flags, order="seq"), KEY, FLAG, DAY)


def availability_other_names(spark, sf):
    """The month with its key and city columns under names of their own."""
    tagged = base.tagged_readings(spark, sf).withColumnRenamed(KEY, "Device No.")
    origins = [
        Origin(base.FIRST, tagged, binary=True, tagged=True, key="Device No."),
        Origin(base.SECOND, tagged, tagged=True, key="Device No."),
    ]
    names = {KEY: "Device No.", "MUNICIPIO": "Town"}
    return month_indicator(
        base.universe(spark, sf).withColumnsRenamed(names), base.brands(spark, sf).withColumnsRenamed(names),
        origins, MONTH, kept=SEGMENTS, key="Device No.", city="Town",
    )


def brand_inner_join(spark, sf):
    return join_brands(base.devices(spark, sf), base.brands(spark, sf), SEGMENTS)


def normalized_key_join(spark, sf):
    padded = base.table(spark, sf, "orders").select(base.padded("o_custkey").alias(KEY), "o_orderkey")
    return with_key(padded).join(with_key(base.devices(spark, sf)), KEY).select(KEY, "o_orderkey", "MUNICIPIO")


# Flags of a wide table: sum of a type's events per day, then the window's maximum.
def sql_wide_flags(event_type: str, unit: float, window: int, flag: str) -> str:
    return f"""
WITH {SQL_READINGS},
cells AS (
  SELECT user_id AS k, CAST(ts AS DATE) AS d, sum(CASE WHEN event_type = '{event_type}' THEN {unit} ELSE 0 END) AS v
  FROM events GROUP BY 1, 2),
grid AS (
  SELECT k, days.d FROM (SELECT DISTINCT k FROM cells) CROSS JOIN days WHERE days.d > (SELECT min(d) FROM cells) AND days.d <= (SELECT max(d) FROM cells) + {window})
SELECT lpad(CAST(g.k AS VARCHAR), 10, '0') AS "NIO", CAST({flag} AS TINYINT) AS "DISP", strftime(g.d, '%Y-%m-%d') AS "DATA"
FROM grid g LEFT JOIN cells c ON c.k = g.k AND c.d BETWEEN g.d - {window} AND g.d - 1
GROUP BY g.k, g.d
"""


# 200 fits no flag and 1d is no number; a device without any other reading has none.
SQL_LEVELS = """
days AS (SELECT CAST(range AS DATE) AS d FROM range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY)),
readings AS (
  SELECT user_id AS k, CAST(ts AS DATE) AS d,
    CASE event_type WHEN 'purchase' THEN 2 WHEN 'signup' THEN NULL WHEN 'view' THEN NULL ELSE 1 END AS v
  FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' - 45 AND DATE '2024-01-30'),
merged AS (
  SELECT k, days.d, CAST(coalesce(max(v) FILTER (r.d BETWEEN days.d - 45 AND days.d - 1), 0) AS TINYINT) AS disp
  FROM readings r CROSS JOIN (
    SELECT * FROM days WHERE EXISTS (SELECT 1 FROM readings o WHERE o.d BETWEEN days.d - 45 AND days.d - 1)) days
  GROUP BY k, days.d)
"""

BINARY = "CASE WHEN max(v) > 0 THEN 1 ELSE 0 END"

QUERIES = {
    "availability_daily": (
        availability_daily, f"WITH {SQL_READINGS}, {SQL_UNIVERSE} {SQL_AVAILABILITY}"
    ),
    "availability_step_by_step": (
        availability_step_by_step, f"WITH {SQL_READINGS}, {SQL_UNIVERSE} {SQL_AVAILABILITY}"
    ),
    "availability_overlapping_origins": (
        availability_overlapping_origins, f"WITH {SQL_OVERLAPPING}, {SQL_UNIVERSE} {SQL_AVAILABILITY}"
    ),
    "moving_or_flag_wide": (moving_or_flag_wide, sql_wide_flags("purchase", 0.25, 5, BINARY)),
    "moving_or_flag_plain": (moving_or_flag_plain, sql_wide_flags("signup", 0.5, 5, "floor(max(v))")),
    "moving_or_flag_two_days": (moving_or_flag_two_days, sql_wide_flags("purchase", 0.25, 2, BINARY)),
    "moving_or_flag_long": (
        moving_or_flag_long,
        f"""WITH {SQL_READINGS} SELECT {PADDED} AS "NIO", o AS "ORIGEM", disp AS "DISP",
        strftime(d, '%Y-%m-%d') AS "DATA" FROM origin_flags""",
    ),
    "moving_or_flag_frame": (
        moving_or_flag_frame,
        f"""WITH {SQL_READINGS} SELECT {PADDED} AS "NIO", o AS "ORIGEM", disp AS "DISP",
        strftime(d, '%Y-%m-%d') AS "DATA" FROM origin_flags""",
    ),
    "moving_or_flag_bits": (
        moving_or_flag_bits,
        f"""WITH {SQL_READINGS} SELECT CAST(k AS VARCHAR) AS "NIO", disp AS "DISP",
        strftime(d, '%Y-%m-%d') AS "DATA" FROM merged""",
    ),
    "moving_or_flag_levels": (
        moving_or_flag_levels,
        f"""WITH {SQL_LEVELS} SELECT CAST(k AS VARCHAR) AS "NIO", disp AS "DISP", strftime(d, '%Y-%m-%d') AS "DATA" FROM merged""",
    ),
    "availability_levels": (availability_levels, f"WITH {SQL_LEVELS}, {SQL_UNIVERSE} {SQL_AVAILABILITY}"),
    "availability_year": (
        availability_year, f"WITH {SQL_LEVELS.replace('- 45', '- 365')}, {SQL_UNIVERSE} {SQL_AVAILABILITY}"
    ),
    "moving_or_flag_sliding": (
        moving_or_flag_sliding,
        f"""WITH {SQL_READINGS} SELECT DISTINCT {PADDED} AS "NIO", CAST(1 AS TINYINT) AS "DISP",
        strftime(days.d, '%Y-%m-%d') AS "DATA"
        FROM readings r JOIN (SELECT CAST(range AS DATE) AS d FROM range(DATE '2023-12-01', DATE '2024-03-01', INTERVAL 1 DAY)) days
        ON r.d BETWEEN days.d - 5 AND days.d - 1 WHERE r.o = 'ORCA' AND r.hit""",
    ),
    "dedup_first_by_origin": (
        dedup_first_by_origin,
        f"""WITH {SQL_READINGS} SELECT CAST(k AS VARCHAR) AS "NIO", disp AS "DISP",
        strftime(d, '%Y-%m-%d') AS "DATA" FROM merged""",
    ),
    "dedup_with_ties": (
        dedup_with_ties,
        """SELECT CAST(o_custkey AS VARCHAR) AS "NIO", CAST(CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS TINYINT) AS "DISP",
        strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS "DATA" FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('year', o_orderdate)
          ORDER BY CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END, o_orderkey) = 1""",
    ),
    "availability_other_names": (
        availability_other_names, f"WITH {SQL_READINGS}, {SQL_UNIVERSE} {SQL_AVAILABILITY}"
    ),
    "universe_left_join": (
        universe_left_join,
        f"""WITH {SQL_READINGS}, {SQL_UNIVERSE} SELECT CAST(k AS VARCHAR) AS "NIO", city AS "MUNICIPIO",
        'MIXED' AS "ORIGEM", CAST(disp AS TINYINT) AS "DISP", strftime(d, '%Y-%m-%d') AS "DATA" FROM joined""",
    ),
    "brand_inner_join": (
        brand_inner_join,
        """SELECT CAST(c_custkey AS VARCHAR) AS "NIO", n_name AS "MUNICIPIO", c_mktsegment AS "INTELIGENTE"
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')""",
    ),
    "normalized_key_join": (
        normalized_key_join,
        """SELECT CAST(c_custkey AS VARCHAR) AS "NIO", o_orderkey, n_name AS "MUNICIPIO"
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    ),
}

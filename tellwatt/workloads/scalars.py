"""Queries for dates, keys, readings, column choice and checks."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from tellwatt.functions import scalars
from tellwatt.functions.dates import calendar_of, export_window, iso, month_days, parse_date
from tellwatt.operators.columns import sample_rows, search, select_columns
from tellwatt.operators.indicators import availability, brand_counts, day_totals, flag_counts, with_ratio
from tellwatt.operators.joins import join_brands, join_universe
from tellwatt.operators.quality import (
    checkpoint_stats, missing_days, reconcile, rejected_cells, stored_with_counts, stored_with_stats,
)
from tellwatt.operators.reshape import columns_between, to_absolute_days, to_long
from tellwatt.plans.month import covered_table, flags_table
from tellwatt.plans.reports import combine_months
from tellwatt.session import shared_folder
from tellwatt.sinks.writers import write_table
from tellwatt.sources.tables import read_parquet
from tellwatt.vocabulary import BRAND, CITY, COMM, DAY, FLAG, KEY, TOTAL
from tellwatt.workloads import base
from tellwatt.workloads.base import MONTH, SEGMENTS, SQL_READINGS, SQL_UNIVERSE, table


def relative_to_absolute(spark, sf):
    wide = base.decimal_comma(base.wide(spark, sf, base.quarter_purchases()))
    long = to_long(to_absolute_days(wide, base.reference(spark, sf)))
    return long.select(KEY, iso(F.col(DAY)).alias(DAY), F.expr(scalars.to_number("VALUE")).alias("VALUE"))


def parse_dates(spark, sf):
    """Each event type writes its day in another spelling; two of them are no dates."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "view", F.date_format("ts", "dd/MM/yyyy"))
        .when(kind == "purchase", F.date_format("ts", "d-M-yyyy"))
        .when(kind == "signup", F.date_format("ts", "'31/02/'yyyy"))
        .otherwise(F.col("props"))
    )
    return table(spark, sf, "events").select("event_id", iso(parse_date(text)).alias("day"))


def order_months(spark, sf):
    return table(spark, sf, "orders").select(F.trunc("o_orderdate", "month").alias("month")).distinct()


def order_calendar(spark, sf, lookback):
    days = order_months(spark, sf).select("month", F.explode(calendar_of(F.col("month"), lookback)).alias(DAY))
    return days.select(iso(F.col("month")).alias("month"), iso(F.col(DAY)).alias(DAY))


def month_calendar(spark, sf):
    return order_calendar(spark, sf, 0)


def lookback_calendar(spark, sf):
    return order_calendar(spark, sf, 5)


def export_windows(spark, sf):
    windows = order_months(spark, sf).select(*export_window(F.col("month")))
    return windows.select(iso(F.col("from_date")).alias("from_date"), iso(F.col("to_date")).alias("to_date"), "label")


def sql_calendar(lookback: int) -> str:
    return f"""
SELECT strftime(m, '%Y-%m-%d') AS month, strftime(unnest(generate_series(m - INTERVAL {lookback} DAY, last_day(m), INTERVAL 1 DAY)), '%Y-%m-%d') AS "DATA"
FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)"""


def normalize_key(spark, sf):
    customer = table(spark, sf, "customer")
    raw = F.array(
        base.padded("c_custkey"), F.substring_index("c_name", "#", -1), F.concat(F.lit("00"), "c_mktsegment")
    )
    keys = customer.select(F.explode(raw).alias("raw"))
    return keys.selectExpr("raw", f"{scalars.normalize_key('raw')} AS {KEY}")


def decimal_comma_binarize(spark, sf):
    """Discounts with a decimal comma; rows of one return flag hold a letter in their place."""
    cell = F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")).otherwise(
        F.regexp_replace(F.col("l_discount").cast("string"), r"\.", ",")
    )
    number = scalars.to_number("cell")
    return table(spark, sf, "lineitem").withColumn("cell", cell).selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{number} AS number",
        f"{scalars.to_flag(scalars.binarize(number))} AS communicates",
        f"{scalars.to_flag('l_quantity / 7')} AS `cut`",
        f"{scalars.rejected('cell')} AS is_rejected",
    )


def rejected_cell_count(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    cells = lineitem.select(
        F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")).otherwise(F.col("l_tax").cast("string")).alias("a b"),
        F.col("l_returnflag").alias("c.d"),
    )
    return rejected_cells(cells, cells.columns)


def date_range_projection(spark, sf):
    wide = to_absolute_days(base.wide(spark, sf, base.quarter_purchases()), base.reference(spark, sf))
    return columns_between(wide, date(2024, 1, 10), date(2024, 1, 20))


def sql_wide(first: date, last: date, value: str = "0.25", kind: str = "purchase") -> str:
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    cells = ", ".join(
        f"""sum(CASE WHEN CAST(ts AS DATE) = DATE '{d}' THEN CASE WHEN event_type = '{kind}' THEN CAST({value} AS DOUBLE) ELSE 0 END END) AS "{d:%d/%m/%Y}" """
        for d in days
    )
    return f"""SELECT lpad(CAST(user_id AS VARCHAR), 10, '0') AS "NIO", {cells} FROM events GROUP BY user_id"""


def column_spec_projection(spark, sf):
    return select_columns(table(spark, sf, "lineitem"), "1-3, l_shipdate, l_linestatus-l_discount, l_orderkey, 99, none")


def flagged_orders(spark, sf):
    """Orders as joined rows: large ones communicate; months are days."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias(KEY),
        F.col("o_orderpriority").alias(CITY),
        F.col("o_orderstatus").alias(BRAND),
        F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).cast("tinyint").alias(FLAG),
        F.to_date(F.trunc("o_orderdate", "month")).alias(DAY),
    )


def availability_ratio(spark, sf):
    return availability(flagged_orders(spark, sf))


SQL_ORDER_RATIO = """
SELECT o_orderpriority AS "MUNICIPIO", o_orderstatus AS "INTELIGENTE",
  count(*) FILTER (o_totalprice > 250000) AS "CONTAGEM_COMM", count(o_custkey) AS "CONTAGEM_TOT",
  round_even(count(*) FILTER (o_totalprice > 250000) / count(o_custkey), 4) AS "DISP",
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS "DATA"
FROM orders GROUP BY o_orderpriority, o_orderstatus, date_trunc('month', o_orderdate)
"""


def union_all(spark, sf):
    result = availability_ratio(spark, sf)
    return combine_months(result.unionByName(result))


def union_distinct_sorted(spark, sf):
    result = availability_ratio(spark, sf)
    return combine_months(result.unionByName(result), distinct=True)


def flag_counters(spark, sf):
    flags = flags_table(base.origins(spark, sf), MONTH)
    return flag_counts(flags, DAY).withColumn(DAY, iso(F.col(DAY)))


def brand_counters(spark, sf):
    return brand_counts(base.brands(spark, sf))


def day_total(spark, sf):
    return day_totals(availability_ratio(spark, sf))


def checkpoint(spark, sf):
    stats = checkpoint_stats(flags_table(base.origins(spark, sf), MONTH))
    return stats.withColumn("first_day", iso(F.col("first_day"))).withColumn("last_day", iso(F.col("last_day")))


def days_without_large_orders(spark, sf):
    calendar = order_months(spark, sf).select(F.explode(calendar_of(F.col("month"))).alias(DAY))
    large = table(spark, sf, "orders").where(F.col("o_totalprice") > 400000).select(F.to_date("o_orderdate").alias(DAY))
    return missing_days(large, calendar).select(iso(F.col(DAY)).alias(DAY))


def checkpoint_of_write(spark, sf):
    """The same figures, taken while the flags are written."""
    path = f"{shared_folder(spark)}/flags"
    stats = stored_with_stats(flags_table(base.origins(spark, sf), MONTH), lambda df: write_table(df, path))
    return stats.withColumn("first_day", iso(F.col("first_day"))).withColumn("last_day", iso(F.col("last_day")))


def stored_joined(spark, sf):
    """The month's joined rows as a stored table, and their counts by day, taken while they were written."""
    origins = base.origins(spark, sf)
    joined = join_brands(
        join_universe(base.universe(spark, sf), flags_table(origins, MONTH), days=covered_table(origins, MONTH)),
        base.brands(spark, sf),
        SEGMENTS,
    )
    path = f"{shared_folder(spark)}/joined"
    counts = stored_with_counts(joined, month_days(MONTH), lambda df: write_table(df, path))
    return read_parquet(spark, path), counts


def reconciliation(spark, sf):
    joined, counts = stored_joined(spark, sf)
    return reconcile(availability(joined), counts)


def reconciliation_of_a_loss(spark, sf):
    """The aggregate misses some cities' rows on even days, which the counts show."""
    joined, counts = stored_joined(spark, sf)
    lost = (F.dayofmonth(DAY) % 2 == 0) & (F.col(CITY) < "C")
    return reconcile(availability(joined.where(~lost)), counts)


def value_search(spark, sf):
    return search(table(spark, sf, "documents"), "text", "license").select("doc_id", "lang", "n_chars")


def head_sample(spark, sf):
    return sample_rows(table(spark, sf, "orders").orderBy("o_orderkey"))


SQL_CHECKPOINT = f"""WITH {SQL_READINGS} SELECT count(*) AS total_rows, count(*) FILTER (disp = 1) AS communicating,
        count(*) FILTER (disp IS NULL) AS null_count, strftime(min(d), '%Y-%m-%d') AS first_day,
        strftime(max(d), '%Y-%m-%d') AS last_day FROM merged"""


def sql_reconcile(kept: str) -> str:
    """Totals of the rows that are kept, beside those of all."""
    return f"""WITH {SQL_READINGS}, {SQL_UNIVERSE}, per_day AS (
      SELECT d, CAST(sum(disp) FILTER ({kept}) AS BIGINT) AS comm, count(*) FILTER ({kept}) AS total,
        CAST(sum(disp) AS BIGINT) AS comm_rows, count(*) AS total_rows
      FROM joined JOIN customer ON c_custkey = k
      WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') GROUP BY d)
    SELECT strftime(d, '%Y-%m-%d') AS "DATA", comm, comm_rows, total, total_rows,
      comm = comm_rows AND total = total_rows AS matches FROM per_day"""


QUERIES = {
    "relative_to_absolute": (
        relative_to_absolute,
        """WITH cells AS (
          SELECT user_id AS k, CAST(ts AS DATE) AS d, CAST(sum(CASE WHEN event_type = 'purchase' THEN 0.25 ELSE 0 END) AS DOUBLE) AS v
          FROM events GROUP BY 1, 2),
        days AS (SELECT CAST(unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS DATE) AS d FROM events)
        SELECT lpad(CAST(g.k AS VARCHAR), 10, '0') AS "NIO", strftime(days.d, '%Y-%m-%d') AS "DATA", v AS "VALUE"
        FROM (SELECT DISTINCT user_id AS k FROM events) g CROSS JOIN days LEFT JOIN cells c ON c.k = g.k AND c.d = days.d""",
    ),
    "parse_dates": (
        parse_dates,
        """SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN strftime(ts, '%Y-%m-%d') END AS day
        FROM events""",
    ),
    "month_calendar": (month_calendar, sql_calendar(0)),
    "lookback_calendar": (lookback_calendar, sql_calendar(5)),
    "export_windows": (
        export_windows,
        """SELECT strftime(m - INTERVAL 5 DAY, '%Y-%m-%d') AS from_date, strftime(last_day(m), '%Y-%m-%d') AS to_date,
        lower(strftime(m, '%b%Y')) AS label
        FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)""",
    ),
    "normalize_key": (
        normalize_key,
        """SELECT raw, regexp_replace(raw, '^0+(.)', '\\1') AS "NIO" FROM (
          SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS raw FROM customer
          UNION ALL SELECT split_part(c_name, '#', 2) FROM customer
          UNION ALL SELECT '00' || c_mktsegment FROM customer)""",
    ),
    "decimal_comma_binarize": (
        decimal_comma_binarize,
        """SELECT l_orderkey, l_linenumber,
          CASE WHEN l_returnflag <> 'R' THEN l_discount END AS number,
          CAST(CASE WHEN l_returnflag <> 'R' AND l_discount > 0 THEN 1 ELSE 0 END AS TINYINT) AS communicates,
          CAST(trunc(l_quantity / 7) AS TINYINT) AS "cut", l_returnflag = 'R' AS is_rejected
        FROM lineitem""",
    ),
    "rejected_cells": (
        rejected_cell_count,
        "SELECT count(*) + count(*) FILTER (l_returnflag = 'R') AS rejected FROM lineitem",
    ),
    "date_range_projection": (date_range_projection, sql_wide(date(2024, 1, 10), date(2024, 1, 20))),
    "column_spec_projection": (
        column_spec_projection,
        """SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus
        FROM lineitem""",
    ),
    "availability_ratio": (availability_ratio, SQL_ORDER_RATIO),
    "union_all": (union_all, f"WITH r AS ({SQL_ORDER_RATIO}) SELECT * FROM r UNION ALL SELECT * FROM r"),
    "union_distinct_sorted": (
        union_distinct_sorted,
        f"""WITH r AS ({SQL_ORDER_RATIO}) SELECT * FROM r UNION SELECT * FROM r
        ORDER BY "DATA", "MUNICIPIO", "INTELIGENTE" """,
    ),
    "flag_counters": (
        flag_counters,
        f"""WITH {SQL_READINGS} SELECT strftime(d, '%Y-%m-%d') AS "DATA", count(*) AS meters,
        count(*) FILTER (disp = 1) AS communicating FROM merged GROUP BY d""",
    ),
    "brand_counts": (
        brand_counters,
        'SELECT c_mktsegment AS "INTELIGENTE", count(*) AS meters FROM customer GROUP BY c_mktsegment',
    ),
    "day_totals": (
        day_total,
        f"""WITH r AS ({SQL_ORDER_RATIO}) SELECT "DATA", CAST(sum("CONTAGEM_COMM") AS BIGINT) AS comm,
        CAST(sum("CONTAGEM_TOT") AS BIGINT) AS total, count(*) AS groups FROM r GROUP BY "DATA" """,
    ),
    "checkpoint_stats": (checkpoint, SQL_CHECKPOINT),
    "missing_days": (
        days_without_large_orders,
        f"""SELECT DISTINCT "DATA" FROM ({sql_calendar(0)})
        WHERE "DATA" NOT IN (SELECT strftime(o_orderdate, '%Y-%m-%d') FROM orders WHERE o_totalprice > 400000)""",
    ),
    "checkpoint_stats_of_write": (checkpoint_of_write, SQL_CHECKPOINT),
    "reconcile": (reconciliation, sql_reconcile("true")),
    "reconcile_loss": (reconciliation_of_a_loss, sql_reconcile("day(d) % 2 = 1 OR city >= 'C'")),
    "value_search": (
        value_search, "SELECT doc_id, lang, n_chars FROM documents WHERE contains(text, 'license')"
    ),
    "head_sample": (head_sample, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5"),
}

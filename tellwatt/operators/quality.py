"""Checks between the steps of a month."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tellwatt.functions.scalars import quoted, rejected
from tellwatt.operators.indicators import day_totals
from tellwatt.vocabulary import DAY, FLAG, KEY


def checkpoint_stats(flags: DataFrame) -> DataFrame:
    """One row: rows, communicating, nulls, first and last day."""
    return flags.agg(*_stats())


def _stats() -> list[Column]:
    return [
        F.count("*").alias("total_rows"),
        F.count_if(F.col(FLAG) == 1).alias("communicating"),
        F.count_if(F.col(FLAG).isNull()).alias("null_count"),
        F.min(DAY).alias("first_day"),
        F.max(DAY).alias("last_day"),
    ]


def stored_with_stats(flags: DataFrame, store) -> DataFrame:
    """The same row as ``checkpoint_stats``, taken while ``store`` writes the flags; they are not read again."""
    seen = Observation()
    store(flags.observe(seen, *_stats()))
    schema = flags.sparkSession.createDataFrame([], flags.schema).agg(*_stats()).schema
    got = seen.get
    return flags.sparkSession.createDataFrame([tuple(got[n] for n in schema.names)], schema)


def stored_with_counts(joined: DataFrame, days: Sequence[date], store) -> DataFrame:
    """Per day (DATA as text) ``comm_rows`` and ``total_rows``, counted while ``store`` writes the joined rows.

    The counts come from the rows that went into the table, independent of whatever is
    made of the table later. ``days`` is a calendar, such as a month's; days without
    rows are left out. A stage that runs again after a lost executor may count rows
    twice, which the check then shows.
    """
    seen = Observation()
    counted = []
    for day in days:
        here = F.col(DAY) == F.lit(day)
        counted.append(F.sum(F.when(here, F.col(FLAG).cast("bigint"))).alias(f"comm {day}"))
        counted.append(F.count_if(here & F.col(KEY).isNotNull()).alias(f"total {day}"))
    store(joined.observe(seen, *counted))
    got = seen.get
    rows = [(str(day), got[f"comm {day}"] or 0, got[f"total {day}"]) for day in days if got[f"total {day}"]]
    return joined.sparkSession.createDataFrame(rows, f"{DAY} string, comm_rows bigint, total_rows bigint")


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def missing_days(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar days for which ``df`` has no row."""
    return calendar.join(df.select(DAY).distinct(), DAY, "left_anti")


def rejected_cells(df: DataFrame, columns: Iterable[str], plain: bool = False) -> DataFrame:
    """One row: how many cells of these columns hold no number, or none that fits a ``plain`` flag."""
    per_column = " + ".join(f"count_if({rejected(quoted(c), plain)})" for c in columns) or "0L"
    return df.selectExpr(f"{per_column} AS rejected")


def reconcile(result: DataFrame, joined: DataFrame) -> DataFrame:
    """Per day, the result's totals beside the counts of the rows it came from.

    ``joined`` is read again here: give rows that are stored, or counts of them (with
    ``comm_rows`` and ``total_rows``) by day.
    """
    if {"comm_rows", "total_rows"} <= set(joined.columns):
        return _compared(result, joined.groupBy(DAY).agg(
            F.sum("comm_rows").alias("comm_rows"), F.sum("total_rows").alias("total_rows")
        ))
    rows = joined.groupBy(DAY).agg(
        F.sum(F.col(FLAG).cast("bigint")).alias("comm_rows"), F.count(KEY).alias("total_rows")
    )
    return _compared(result, rows)


def _compared(result: DataFrame, rows: DataFrame) -> DataFrame:
    sides = day_totals(result).join(rows, DAY, "full")
    equal = F.col("comm").eqNullSafe(F.col("comm_rows")) & F.col("total").eqNullSafe(F.col("total_rows"))
    return sides.select(DAY, "comm", "comm_rows", "total", "total_rows", equal.alias("matches"))

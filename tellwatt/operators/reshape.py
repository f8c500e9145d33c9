"""Wide tables: one column per day, under relative or absolute names."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellwatt.functions.dates import header_date, parse_date
from tellwatt.functions.scalars import quoted
from tellwatt.vocabulary import DAY, HEADER_DATE_PATTERN, KEY, RAW_KEY


def relative_day_names(columns: Iterable[str], reference: date) -> dict[str, str]:
    """New names for relative-day columns; the highest is the day before ``reference``."""
    days = {c: int(c) for c in columns if c.isascii() and c.isdigit()}
    if not days:
        raise ValueError("no relative-day columns")
    latest = max(days.values())
    return {
        c: (reference - timedelta(days=1 + latest - n)).strftime(HEADER_DATE_PATTERN)
        for c, n in days.items()
    }


def to_absolute_days(df: DataFrame, reference: date) -> DataFrame:
    return df.withColumnsRenamed(relative_day_names(df.columns, reference))


def rename_raw_key(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({RAW_KEY: KEY})


def day_columns(columns: Iterable[str]) -> dict[str, date]:
    """Columns whose name is a date, with that date."""
    dated = ((c, header_date(c)) for c in columns)
    return {c: d for c, d in dated if d is not None}


def columns_between(df: DataFrame, first: date, last: date) -> DataFrame:
    """Undated columns, then the day columns from ``first`` to ``last``."""
    dated = day_columns(df.columns)
    undated = [c for c in df.columns if c not in dated]
    chosen = [c for c, d in dated.items() if first <= d <= last]
    return df.select(*(quoted(c) for c in undated + chosen))


def header_row_days(df: DataFrame) -> dict[str, date]:
    """Dates that a table keeps in one data row, under digit-named columns.

    Reads that row only: the search stops at the first match, which older files
    hold as their first record.
    """
    digits = [c for c in df.columns if c.isascii() and c.isdigit()]
    if not digits:
        return {}
    found = df.select(*(parse_date(F.col(quoted(c)).cast("string")).alias(c) for c in digits))
    row = found.where(F.coalesce(*(F.col(quoted(c)) for c in digits)).isNotNull()).first()
    return {c: row[c] for c in digits if row[c] is not None} if row else {}


def drop_header_row(df: DataFrame, days: dict[str, date]) -> DataFrame:
    """The readings: rows where no day column holds a date."""
    if not days:
        return df
    dates = [parse_date(F.col(quoted(c)).cast("string")) for c in days]
    return df.where(F.coalesce(*dates).isNull())


def header_row_to_absolute(df: DataFrame) -> DataFrame:
    """A table with a date row, brought to the form with dates as column names."""
    days = header_row_days(df)
    names = {c: d.strftime(HEADER_DATE_PATTERN) for c, d in days.items()}
    return drop_header_row(df, days).withColumnsRenamed(names)


def columns_between_by_header_row(
    df: DataFrame, first: date, last: date, keep_header: bool = True
) -> DataFrame:
    """``columns_between`` for a table with a date row.

    Columns keep their digit names, so the date row stays unless told otherwise.
    """
    days = header_row_days(df)
    undated = [c for c in df.columns if not (c.isascii() and c.isdigit())]
    chosen = [c for c in df.columns if c in days and first <= days[c] <= last]
    rows = df if keep_header else drop_header_row(df, days)
    return rows.select(*(quoted(c) for c in undated + chosen))


def to_long(df: DataFrame, ids: list[str] | None = None, value: str = "VALUE") -> DataFrame:
    """One row per key and day; null readings stay."""
    ids = ids or [KEY]
    names = list(day_columns(df.columns))
    text = df.selectExpr(*map(quoted, ids), *(f"cast({quoted(c)} AS string) AS {quoted(c)}" for c in names))
    long = text.unpivot([quoted(c) for c in ids], [quoted(c) for c in names], "_day", value)
    return long.select(*(quoted(c) for c in ids), parse_date(F.col("_day")).alias(DAY), value)

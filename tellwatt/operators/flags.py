"""Moving-window flags: did a device report on any of the preceding days?

For a target day D the flag is the largest reading of days D-w to D-1, cut to a
whole number. A day appears only if its origin has a day in that range.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tellwatt.functions.dates import calendar_of, month_days, month_first, month_last
from tellwatt.functions.scalars import cell_level, normalize_key, number_in, quoted
from tellwatt.operators.reshape import day_columns
from tellwatt.vocabulary import DAY, DEFAULT_WINDOW_DAYS, FLAG, KEY, ORIGIN, ORIGINS


def window_columns(dated: dict[str, date], target: date, window_days: int) -> list[str]:
    first, last = target - timedelta(days=window_days), target - timedelta(days=1)
    return [c for c, d in dated.items() if first <= d <= last]


def largest(names: list[str]) -> str:
    """Row-wise maximum that skips nulls."""
    columns = [quoted(n) for n in names]
    return columns[0] if len(columns) == 1 else f"greatest({', '.join(columns)})"


def flags_from_wide(
    df: DataFrame,
    targets: list[date],
    window_days: int = DEFAULT_WINDOW_DAYS,
    binary: bool = False,
    keys: Sequence[str] = (KEY,),
) -> DataFrame:
    """Flags of a wide table for every target day; needs no shuffle."""
    dated = day_columns(df.columns)
    if not dated:
        raise ValueError("no day columns")
    ids = [quoted(k) for k in keys]
    per_day, used = [], {}
    for target in targets:
        names = window_columns(dated, target, window_days)
        if names:
            used.update(dict.fromkeys(names))
            per_day.append(f"struct({largest(names)} AS {FLAG}, DATE'{target}' AS {DAY})")
    if not per_day:
        return df.selectExpr(*ids, f"cast(null AS tinyint) AS {FLAG}", f"cast(null AS date) AS {DAY}").limit(0)
    # Each cell is parsed once here, not once for every window it lies in.
    levels = df.selectExpr(*ids, *(f"{cell_level(number_in(df, c), binary)} AS {quoted(c)}" for c in used))
    return levels.selectExpr(*ids, f"inline(array({', '.join(per_day)}))")


def observed_targets(readings: DataFrame, month: str, window_days: int) -> DataFrame:
    """Month days for which the origin has a day to look back on."""
    first, last = month_first(month), month_last(month)
    # Guarded, as a sequence would run backwards for a window of 0 days.
    ahead = F.sequence(F.lit(1), F.lit(window_days)) if window_days else F.array().cast("array<int>")
    steps = readings.select(ORIGIN, DAY).distinct().select(ORIGIN, DAY, F.explode(ahead).alias("step"))
    targets = steps.select(ORIGIN, F.date_add(DAY, F.col("step")).alias(DAY)).distinct()
    return targets.where(F.col(DAY).between(F.lit(first), F.lit(last)))


def near_levels(readings: DataFrame, month: str, window_days: int, binary: Sequence[str]) -> DataFrame:
    """Readings (ORIGEM, NIO, DATA, VALUE) that matter to a month, as levels."""
    start = month_first(month) - timedelta(days=window_days)
    end = month_last(month) - timedelta(days=1)
    near = readings.where(F.col(DAY).between(F.lit(start), F.lit(end)))
    number = number_in(near, "VALUE")
    level = F.when(F.col(ORIGIN).isin(*binary), F.expr(cell_level(number, True))).otherwise(
        F.expr(cell_level(number, False))
    )
    return near.select(ORIGIN, KEY, DAY, level.alias(FLAG))


def binary_zero(flag: Column, binary: Sequence[str]) -> Column:
    """A binary origin has no null flags."""
    return F.coalesce(flag, F.when(F.col(ORIGIN).isin(*binary), F.lit(0).cast("tinyint")))


def flags_from_long(
    readings: DataFrame,
    month: str,
    window_days: int = DEFAULT_WINDOW_DAYS,
    binary: Sequence[str] = ORIGINS[:1],
) -> DataFrame:
    """Flags of readings (ORIGEM, NIO, DATA, VALUE) for every day of a month.

    Exact for any reading. Readings of a device and day are merged before they are
    shuffled; a device's days then stand side by side, as in a wide table.
    """
    levels = near_levels(readings, month, window_days, binary)
    start = month_first(month) - timedelta(days=window_days)
    days = [start + timedelta(days=i) for i in range(window_days + month_last(month).day - 1)]
    wide = levels.groupBy(ORIGIN, KEY).pivot(DAY, days).agg(F.max(FLAG))
    flags = flags_from_wide(wide, month_days(month), window_days, keys=(ORIGIN, KEY))
    # At most one row per origin and calendar day.
    valid = F.broadcast(observed_targets(levels, month, window_days))
    return flags.join(valid, [ORIGIN, DAY], "left_semi").select(
        ORIGIN, KEY, binary_zero(F.col(FLAG), binary).alias(FLAG), DAY
    )


def flags_by_frame(
    readings: DataFrame,
    month: str,
    window_days: int = DEFAULT_WINDOW_DAYS,
    binary: Sequence[str] = ORIGINS[:1],
) -> DataFrame:
    """The same flags by a range frame over a row for every device and calendar day.

    A frame's group holds no more rows than the calendar has days.
    """
    levels = near_levels(readings, month, window_days, binary)
    daily = levels.groupBy(ORIGIN, KEY, DAY).agg(F.max(FLAG).alias(FLAG))
    days = F.explode(calendar_of(F.lit(month_first(month)), window_days)).alias(DAY)
    grid = levels.select(ORIGIN, KEY).distinct().select(ORIGIN, KEY, days)
    dense = grid.join(daily, [ORIGIN, KEY, DAY], "left")
    preceding = W.partitionBy(ORIGIN, KEY).orderBy(F.unix_date(DAY)).rangeBetween(-window_days, -1)
    framed = dense.withColumn(FLAG, binary_zero(F.max(FLAG).over(preceding), binary))
    valid = F.broadcast(observed_targets(levels, month, window_days))
    return framed.join(valid, [ORIGIN, DAY], "left_semi").select(ORIGIN, KEY, FLAG, DAY)


def sliding_flags(
    readings: DataFrame,
    window_days: int = DEFAULT_WINDOW_DAYS,
    binary: bool = True,
    time: str = "ts",
    late: str | None = None,
) -> DataFrame:
    """Sliding-window flags of (NIO, ts, VALUE), batch or streaming.

    Gives rows only where a window has readings; the universe join supplies the
    zeros. ``late`` sets a watermark, which a stream needs in append mode. Windows
    start at midnight UTC, so a column with a time zone needs a session in UTC.
    """
    if late:
        readings = readings.withWatermark(time, late)
    level = F.expr(cell_level(number_in(readings, "VALUE"), binary))
    sliding = F.window(time, f"{window_days} days", "1 day")
    flags = readings.groupBy(KEY, sliding).agg(F.max(level).alias(FLAG))
    return flags.select(KEY, FLAG, F.to_date("window.end").alias(DAY))


def merge_origins(
    flags: DataFrame,
    precedence: Sequence[str] = ORIGINS,
    order: str | None = None,
) -> DataFrame:
    """One flag per device and day: the first origin's, keys normalised.

    ``order`` names a sequence column that ranks rows within an origin.
    """
    position = F.array_position(F.array(*(F.lit(o) for o in precedence)), F.col(ORIGIN))
    rank = F.when(position > 0, position).otherwise(len(precedence) + 1)
    # Rank and sequence in one number keep the aggregate hash-based.
    place = rank if order is None else F.shiftleft(rank, 58) + F.col(order)
    keyed = flags.select(F.expr(normalize_key(KEY)).alias(KEY), FLAG, DAY, place.alias("_place"))
    first = keyed.groupBy(DAY, KEY).agg(F.min_by(FLAG, "_place").alias(FLAG))
    return first.select(KEY, FLAG, DAY)

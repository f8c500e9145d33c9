"""The month's indicator as one plan.

Each device's readings become one BIGINT of days (``daybits``), merged map-side.
The flags of a month are bit shifts of that number, so the plan shuffles one
small row per device in place of one per device and day, and the universe, by
far the largest input, is shuffled once.

Bits say yes or no and span 63 days. With ``levels`` a device's month is an array with
the largest reading of each day's window instead, which takes any plain reading and any
window; the plan is otherwise the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellwatt.functions import daybits
from tellwatt.functions.dates import month_first, month_last
from tellwatt.functions.scalars import cell_level, normalize_key, number_in, quoted
from tellwatt.operators.indicators import with_ratio
from tellwatt.operators.joins import renamed, smart_brands
from tellwatt.operators.reshape import day_columns
from tellwatt.vocabulary import (
    BRAND, CITY, COMM, DAY, DEFAULT_WINDOW_DAYS, FLAG, KEY, ORIGIN, SMART_BRANDS, TOTAL,
)

# Parts that a device's universe rows are spread over in the join; the device side is
# repeated as often. One is enough where AQE is on: see ``month_indicator``.
SALTS = 1

# Position of a row's day among the bits of a month's flags.
DAY_OF_MONTH = f"dayofmonth({DAY}) - 1"


@dataclass(frozen=True)
class Origin:
    """A source of readings.

    ``frame`` is wide (a key and day columns) or long (NIO, DATA, VALUE). Readings
    of a ``binary`` origin count when positive; those of any other must be 0 or 1
    once cut to whole numbers, unless the month is counted in ``levels``. ``order`` ranks
    the rows of a wide frame whose keys repeat; the first row then stands for the device.
    ``days`` says which days a long frame has; without it, a pass over the frame's day
    column finds them. A ``tagged`` frame is long and holds several origins' readings,
    with the name in ORIGEM; origins that share one are read in one pass. ``key`` is the
    frame's key column.
    """

    name: str
    frame: DataFrame
    binary: bool = False
    order: str | None = None
    days: Sequence[date] | None = None
    tagged: bool = False
    key: str = KEY

    def __post_init__(self) -> None:
        if self.key != KEY:
            object.__setattr__(self, "frame", self.frame.withColumnRenamed(self.key, KEY))
            object.__setattr__(self, "key", KEY)

    @property
    def is_long(self) -> bool:
        return {KEY, DAY, "VALUE"} <= set(self.frame.columns)


@dataclass(frozen=True)
class Month:
    """Bit positions of a month and its look-back."""

    month: str
    window_days: int = DEFAULT_WINDOW_DAYS

    def __post_init__(self) -> None:
        if self.window_days < 0:
            raise ValueError("a window has no days before it begins")

    @property
    def first(self) -> date:
        return month_first(self.month)

    @property
    def last(self) -> date:
        return month_last(self.month)

    @property
    def start(self) -> date:
        """First look-back day, bit 0 of a set of readings' days."""
        return self.first - timedelta(days=self.window_days)

    @property
    def end(self) -> date:
        """Last day whose readings matter."""
        return self.last - timedelta(days=1)

    def flags(self, days: str) -> str:
        if self.window_days > daybits.MAX_WINDOW_DAYS:
            raise ValueError(f"bits span a window of {daybits.MAX_WINDOW_DAYS} days; set levels beyond")
        return daybits.any_of_preceding(days, self.window_days, self.last.day)

    def near(self, df: DataFrame) -> DataFrame:
        """Readings that can matter to the month."""
        return df.where(f"{DAY} BETWEEN DATE'{self.start}' AND DATE'{self.end}'")

    def targets_after(self, day: str) -> str:
        """Month days, as bits, in whose window a day lies."""
        low = f"greatest(datediff({day}, DATE'{self.first}') + 1, 0)"
        high = f"least(datediff({day}, DATE'{self.first}') + {self.window_days}, {self.last.day - 1})"
        return f"CASE WHEN {low} <= {high} THEN shiftleft(1L, {high} + 1) - shiftleft(1L, {low}) ELSE 0L END"

    def targets_of(self, days: Iterable[date]) -> int:
        """The same for all of these days."""
        mask = 0
        for day in days:
            if self.start <= day <= self.end:
                low = max((day - self.first).days + 1, 0)
                high = min((day - self.first).days + self.window_days, self.last.day - 1)
                mask |= (1 << high + 1) - (1 << low) if low <= high else 0
        return mask

    def largest_of_windows(self, cells: str) -> str:
        """For every day of the month, the largest of its window in an array that begins with the first look-back day.

        A window of a month or more is the end of the look-back's first days, what all
        windows share, and the beginning of the month. The middle is looked through
        once, so the work grows with the days, and the text not at all.
        """
        days, window = self.last.day, self.window_days
        each = f"transform(sequence(0, {days - 1}), d -> {{0}})"
        if window < days:
            return each.format(f"array_max(slice({cells}, d + 1, {window}))")
        largest = f"greatest(array_max(slice({cells}, d + 1, {days} - d)), c, array_max(slice({cells}, {window + 1}, d)))"
        return f"transform(array(array_max(slice({cells}, {days + 1}, {window - days}))), c -> {each.format(largest)})[0]"

    def bit_of(self, day: date) -> int:
        return (day - self.start).days

    def position(self) -> str:
        return f"datediff({DAY}, DATE'{self.start}')"


def day_bit(number: str, bit: str, binary: bool) -> str:
    """A day's bit if its reading counts. A plain reading other than 0 or 1 is an error."""
    if binary:
        return f"CASE WHEN {number} > 0 THEN {bit} ELSE 0L END"
    # Compared as they are: a cast could turn what does not fit into a harmless null.
    wrong = "raise_error('plain reading is neither 0 nor 1; set levels')"
    return (
        f"CASE WHEN {number} >= 1 AND {number} < 2 THEN {bit} "
        f"WHEN {number} IS NULL OR {number} > -1 AND {number} < 1 THEN 0L ELSE {wrong} END"
    )


def shared_frames(origins: Sequence[Origin]) -> list[list[int]]:
    """Places of the origins, those that share a tagged frame together."""
    groups: dict[object, list[int]] = {}
    for i, origin in enumerate(origins):
        groups.setdefault(id(origin.frame) if origin.tagged else ("own", i), []).append(i)
    return list(groups.values())


def by_tag(origins: Sequence[Origin], places: Sequence[int], value) -> str:
    """A value for each origin of a frame, told apart by its tag."""
    if not origins[places[0]].tagged:
        return value(places[0])
    cases = " ".join(f"WHEN '{origins[i].name}' THEN {value(i)}" for i in places)
    return f"CASE {ORIGIN} {cases} END"


def long_days(origins: Sequence[Origin], places: Sequence[int], span: Month) -> DataFrame:
    """One row per reading: key, the reading's day as a bit, if it counts, and its origin."""
    near = span.near(origins[places[0]].frame)
    tag = [ORIGIN] if origins[places[0]].tagged else []
    numbers = near.selectExpr(
        f"{normalize_key(KEY)} AS {KEY}", f"{span.position()} AS position", f"{number_in(near, 'VALUE')} AS number", *tag
    )
    day = by_tag(origins, places, lambda i: day_bit("number", daybits.bit("position"), origins[i].binary))
    origin = by_tag(origins, places, str)
    return numbers.selectExpr(KEY, f"{day} AS days", "cast(null AS bigint) AS place", f"{origin} AS origin")


def near_columns(origin: Origin, span: Month) -> dict[str, int]:
    """Day columns of a wide table that matter to the month, with their bit."""
    dated = day_columns(origin.frame.columns)
    return {c: span.bit_of(d) for c, d in dated.items() if span.start <= d <= span.end}


def wide_days(origin: Origin, span: Month) -> DataFrame:
    """One row per device row: key and its days that count. Reads near columns only."""
    df = origin.frame
    near = near_columns(origin, span)
    place = quoted(origin.order) if origin.order else "0"
    numbers = df.selectExpr(
        f"{normalize_key(KEY)} AS {KEY}",
        f"cast({place} AS bigint) AS place",
        *(f"{number_in(df, c)} AS number_{i}" for c, i in near.items()),
    )
    bits = [day_bit(f"number_{i}", f"{1 << i}L", origin.binary) for i in near.values()]
    return numbers.selectExpr(KEY, f"{' | '.join(['0L', *bits])} AS days", "place")


def covered_days(origins: Sequence[Origin], span: Month) -> list[Column]:
    """Target days that each origin can answer for, as bits.

    A wide table shows its days in the header. A long one may be told them; otherwise
    this is a scalar subquery over its day column, one for all origins of a frame.
    """
    found: dict[int, Column] = {}
    for places in shared_frames(origins):
        first = origins[places[0]]
        if first.is_long and any(origins[i].days is None for i in places):
            after = span.targets_after(DAY)
            own = {i: f" FILTER (WHERE {ORIGIN} = '{origins[i].name}')" if first.tagged else "" for i in places}
            masks = ", ".join(f"coalesce(bit_or({after}){own[i]}, 0L) AS c{i}" for i in places)
            seen = span.near(first.frame).selectExpr(f"struct({masks}) AS covered").scalar()
            found.update({i: seen.getField(f"c{i}") for i in places if origins[i].days is None})
        for i in places:
            if i not in found:
                days = origins[i].days if first.is_long else day_columns(first.frame.columns).values()
                found[i] = F.lit(span.targets_of(days)).cast("bigint")
    return [found[i] for i in range(len(origins))]


def covered_table(origins: Sequence[Origin], month: str, window_days: int = DEFAULT_WINDOW_DAYS) -> DataFrame:
    """The month's days (DATA) that any origin can answer for."""
    span = Month(month, window_days)
    days = origins[0].frame.sparkSession.range(1).select(
        month_covered(covered_days(origins, span)).alias("covered"),
        F.explode(F.sequence(F.lit(span.first), F.lit(span.last))).alias(DAY),
    )
    return days.where(daybits.has_bit("covered", DAY_OF_MONTH)).select(DAY)


def month_covered(covered: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), covered)


def device_flags(origins: Sequence[Origin], covered: Sequence[Column], span: Month) -> DataFrame:
    """One row per device: the month's flags as bits, bit 0 for the first day.

    An origin that lists the device decides every day it covers; the next one is
    asked about the rest.
    """
    span.flags("0L")  # refuses a window that the bits can't span
    rows = reduce(
        DataFrame.unionByName,
        [
            long_days(origins, places, span) if origins[places[0]].is_long
            else wide_days(origins[places[0]], span).selectExpr("*", f"{places[0]} AS origin")
            for places in shared_frames(origins)
        ],
    )
    merged = []
    for i, origin in enumerate(origins):
        days = "bit_or(days)" if origin.is_long else "min_by(days, place)"
        merged.append(F.expr(f"{days} FILTER (WHERE origin = {i})").alias(f"days_{i}"))
    devices = rows.where(f"{KEY} IS NOT NULL").groupBy(KEY).agg(*merged)

    devices = devices.withColumns({f"covered_{i}": c for i, c in enumerate(covered[:-1])})
    flags, taken = "0L", "0L"
    for i in range(len(origins)):
        own = f"coalesce({span.flags(f'days_{i}')}, 0L)"
        flags = f"{flags} | {daybits.without(own, taken)}"
        taken = f"{taken} | CASE WHEN days_{i} IS NOT NULL THEN covered_{i} ELSE 0L END"
    return devices.selectExpr(KEY, f"{flags} AS flags")


def origin_levels(origin: Origin, span: Month) -> DataFrame:
    """One row per device row: key, the largest reading of each month day's window, and the row's place."""
    if origin.is_long:
        own = origin.frame.where(F.col(ORIGIN) == origin.name) if origin.tagged else origin.frame
        near = span.near(own)
        level = cell_level(number_in(near, "VALUE"), origin.binary)
        days = [span.start + timedelta(days=i) for i in range((span.end - span.start).days + 1)]
        frame = (
            near.selectExpr(f"{normalize_key(KEY)} AS {KEY}", DAY, f"{level} AS level")
            .groupBy(KEY).pivot(DAY, days).agg(F.max("level"))
        )
        levels, place = {d: quoted(str(d)) for d in days}, "0"
    else:
        dated = day_columns(origin.frame.columns)
        near_names = {c: d for c, d in dated.items() if span.start <= d <= span.end}
        place = quoted(origin.order) if origin.order else "0"
        frame = origin.frame.selectExpr(
            f"{normalize_key(KEY)} AS {KEY}", f"cast({place} AS bigint) AS place",
            *(f"{cell_level(number_in(origin.frame, c), origin.binary)} AS level_{i}" for i, c in enumerate(near_names)),
        )
        levels, place = {}, "place"
        for i, day in enumerate(near_names.values()):
            levels[day] = f"greatest({levels[day]}, level_{i})" if day in levels else f"level_{i}"
    span_days = (span.end - span.start).days + 1
    cells = ", ".join(levels.get(span.start + timedelta(days=i), "cast(null AS tinyint)") for i in range(span_days))
    return frame.selectExpr(KEY, f"cast(array({cells}) AS array<tinyint>) AS cells", f"cast({place} AS bigint) AS place").selectExpr(
        KEY, f"{span.largest_of_windows('cells')} AS levels", "place"
    )


def device_levels(origins: Sequence[Origin], covered: Sequence[Column], span: Month) -> DataFrame:
    """One row per device: the month's levels, by day. The first origin that lists a device decides, as for flags."""
    rows = reduce(
        DataFrame.unionByName,
        [origin_levels(o, span).selectExpr("*", f"{i} AS origin") for i, o in enumerate(origins)],
    )
    merged = [F.expr(f"min_by(levels, place) FILTER (WHERE origin = {i})").alias(f"levels_{i}") for i in range(len(origins))]
    devices = rows.where(f"{KEY} IS NOT NULL").groupBy(KEY).agg(*merged)
    devices = devices.withColumns({f"covered_{i}": c for i, c in enumerate(covered)})
    cases = " ".join(
        f"WHEN levels_{i} IS NOT NULL AND {daybits.has_bit(f'covered_{i}', 'd')} THEN coalesce(levels_{i}[d], 0Y)"
        for i in range(len(origins))
    )
    return devices.selectExpr(KEY, f"transform(sequence(0, {span.last.day - 1}), d -> CASE {cases} ELSE 0Y END) AS flags")


def device_month(origins: Sequence[Origin], covered: Sequence[Column], span: Month, levels: bool) -> DataFrame:
    return (device_levels if levels else device_flags)(origins, covered, span)


def level_of_day(levels: bool) -> str:
    """A row's flag, from its device's month."""
    if levels:
        return f"coalesce(flags[{DAY_OF_MONTH}], 0Y)"
    return f"cast({daybits.has_bit('coalesce(flags, 0L)', DAY_OF_MONTH)} AS tinyint)"


def flags_table(
    origins: Sequence[Origin], month: str, window_days: int = DEFAULT_WINDOW_DAYS, levels: bool = False
) -> DataFrame:
    """The merged flags as rows (NIO, DISP, DATA), one per device and covered day."""
    span = Month(month, window_days)
    covered = covered_days(origins, span)
    devices = device_month(origins, covered, span, levels).withColumn("covered", month_covered(covered))
    rows = devices.selectExpr(
        KEY, "flags", "covered", f"explode(sequence(DATE'{span.first}', DATE'{span.last}')) AS {DAY}"
    )
    return rows.where(daybits.has_bit("covered", DAY_OF_MONTH)).selectExpr(KEY, f"{level_of_day(levels)} AS {FLAG}", DAY)


def month_indicator(
    universe: DataFrame,
    brands: DataFrame,
    origins: Sequence[Origin],
    month: str,
    window_days: int = DEFAULT_WINDOW_DAYS,
    kept: Sequence[str] = SMART_BRANDS,
    salts: int = SALTS,
    levels: bool = False,
    key: str = KEY,
    city: str = CITY,
) -> DataFrame:
    """Availability by city, brand and day of a month.

    ``key`` and ``city`` are the columns' names in the universe and brand tables.


    ``levels`` is for plain readings beyond 1 and windows beyond 32 days: a device then
    adds its largest reading of the window, not just one, to the communicating count.

    ``universe`` has NIO, MUNICIPIO and DATA (date). Repeated brand rows enter as a
    weight, which gives the same sums as joining each of them.

    A device may hold any share of the universe's rows. The salt in the join key puts
    an exchange right below each side of the join, which is what AQE needs to split
    a skewed partition; without it the device side would stay as its aggregation left
    it. More ``salts`` spread such a device by row content even without AQE.
    """
    span = Month(month, window_days)
    covered = covered_days(origins, span)
    # Brands become columns, so that brands and flags both come hashed by device alone.
    universe = renamed(universe, key, city)
    weighted = smart_brands(brands, kept, key).groupBy(KEY).agg(
        *(F.count_if(F.col(BRAND) == b).alias(f"n_{i}") for i, b in enumerate(kept))
    )
    by_brand = F.array(*(F.struct(F.lit(b).alias(BRAND), F.col(f"n_{i}").alias("weight")) for i, b in enumerate(kept)))
    devices = (
        weighted.join(device_month(origins, covered, span, levels), KEY, "left")
        .select(KEY, "flags", F.inline(by_brand))
        .where("weight > 0")
        .selectExpr(KEY, BRAND, "weight", "flags", f"explode(sequence(0, {salts - 1})) AS salt")
    )
    listed = (
        universe.where(f"{DAY} BETWEEN DATE'{span.first}' AND DATE'{span.last}'")
        .withColumn("covered", month_covered(covered))
        .where(daybits.has_bit("covered", DAY_OF_MONTH))
        .selectExpr(
            f"{normalize_key(KEY)} AS {KEY}", CITY, DAY, f"cast(pmod(xxhash64({CITY}, {DAY}), {salts}) AS int) AS salt"
        )
    )
    joined = listed.join(devices, [KEY, "salt"])
    counted = joined.groupBy(CITY, BRAND, DAY).agg(
        F.expr(f"sum(weight * {level_of_day(levels)})").alias(COMM), F.sum("weight").alias(TOTAL)
    )
    return with_ratio(counted)

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tellwatt.functions.dates import month_days
from tellwatt.operators.flags import (
    flags_by_frame, flags_from_long, flags_from_wide, merge_origins, sliding_flags,
)
from tellwatt.operators.quality import rejected_cells
from tellwatt.operators.reshape import header_row_to_absolute, to_long
from tellwatt.plans.month import Origin, flags_table
from tellwatt.vocabulary import DAY, FLAG, KEY, ORIGIN

DAYS = ["20/01/2026", "21/01/2026", "22/01/2026", "23/01/2026", "24/01/2026"]
TARGET = date(2026, 1, 25)


def table(spark, rows, names=DAYS, kind="string"):
    schema = f"{KEY} string, " + ", ".join(f"`{n}` {kind}" for n in names)
    return spark.createDataFrame(rows, schema)


def flags(df):
    return {r[KEY]: r[FLAG] for r in df.collect()}


@pytest.fixture
def meters(spark):
    return table(spark, [("A", "1", "0", "0", "0", "0"), ("B", *"00000"), ("C", "0", "0", "1", "0", "0")])


def test_any_of_five_days(meters):
    assert flags(flags_from_wide(meters, [TARGET])) == {"A": 1, "B": 0, "C": 1}


def test_shorter_window(meters):
    assert flags(flags_from_wide(meters, [TARGET], window_days=2)) == {"A": 0, "B": 0, "C": 0}


def test_one_column_in_window(meters):
    assert flags(flags_from_wide(meters, [date(2026, 1, 21)])) == {"A": 1, "B": 0, "C": 0}


@pytest.mark.parametrize("target, window", [(date(2027, 1, 1), 5), (TARGET, 0)])
def test_no_column_in_window(meters, target, window):
    empty = flags_from_wide(meters, [target], window_days=window)
    assert empty.columns == [KEY, FLAG, DAY] and empty.count() == 0
    assert dict(empty.dtypes)[FLAG] == "tinyint"


def test_no_day_columns(spark):
    with pytest.raises(ValueError):
        flags_from_wide(spark.createDataFrame([("A", 1)], "NIO string, x int"), [TARGET])


def test_decimal_comma(spark):
    rows = [("X", "0,25", "0"), ("Y", "0", "0,75"), ("Z", "0", "0")]
    df = table(spark, rows, ["23/01/2026", "24/01/2026"])
    assert flags(flags_from_wide(df, [TARGET], binary=True)) == {"X": 1, "Y": 1, "Z": 0}


def test_nulls_fractions_and_bad_cells(spark):
    rows = [("N", None, None), ("F", 0.75, 0.5), ("P", None, 1.0), ("Q", 1.9, 3.2)]
    df = table(spark, rows, ["23/01/2026", "24/01/2026"], "double")
    assert flags(flags_from_wide(df, [TARGET], binary=True)) == {"N": 0, "F": 1, "P": 1, "Q": 1}
    assert flags(flags_from_wide(df, [TARGET])) == {"N": None, "F": 0, "P": 1, "Q": 3}
    bad = table(spark, [("A", "abc", "1"), ("B", "abc", "0")], ["23/01/2026", "24/01/2026"])
    assert flags(flags_from_wide(bad, [TARGET])) == {"A": 1, "B": 0}


def test_table_with_date_row(spark):
    rows = [(None, "23/01/2026", "24/01/2026", None), ("A", "1", "0", "7"), ("B", "0", "0", "7")]
    df = spark.createDataFrame(rows, "NIO string, `2` string, `1` string, `3` string")
    brought = header_row_to_absolute(df)
    assert brought.columns == [KEY, "23/01/2026", "24/01/2026", "3"]
    assert flags(flags_from_wide(brought, [TARGET])) == {"A": 1, "B": 0}


def test_wide_flags_need_no_shuffle(meters):
    plan = flags_from_wide(meters, month_days("2026-01"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def tagged(spark, rows):
    return spark.createDataFrame(rows, f"{KEY} string, {FLAG} tinyint, {DAY} date, {ORIGIN} string, seq bigint")


def test_first_origin_decides(spark):
    rows = [("7", 1, TARGET, "SANPLAT", 0), ("7", 0, TARGET, "ORCA", 1), ("8", 1, TARGET, "SANPLAT", 2)]
    assert flags(merge_origins(tagged(spark, rows))) == {"7": 0, "8": 1}


def test_null_flag_of_first_origin_stays(spark):
    rows = [("7", None, TARGET, "ORCA", 0), ("7", 1, TARGET, "SANPLAT", 1)]
    assert flags(merge_origins(tagged(spark, rows))) == {"7": None}


def test_padded_keys_are_one_device(spark):
    rows = [("0043", 1, TARGET, "ORCA", 0), ("43", 0, TARGET, "SANPLAT", 1)]
    assert flags(merge_origins(tagged(spark, rows))) == {"43": 1}


def test_file_order_decides_within_an_origin(spark):
    rows = [("5", 0, TARGET, "ORCA", 9), ("05", 1, TARGET, "ORCA", 3), ("5", 0, TARGET, "ORCA", 4)]
    assert flags(merge_origins(tagged(spark, rows), order="seq")) == {"5": 1}


def test_unknown_origin_comes_last(spark):
    rows = [("5", 0, TARGET, "OTHER", 0), ("5", 1, TARGET, "SANPLAT", 1)]
    assert flags(merge_origins(tagged(spark, rows))) == {"5": 1}


# --- The plans agree -------------------------------------------------------

MONTH = "2026-01"


def grid(seed, devices=12, first=date(2025, 12, 20), days=45, values=("0", "0", "0", "0,25", "1", None)):
    """Cells of some devices on some days; days themselves may be missing."""
    rng = random.Random(seed)
    kept = [first + timedelta(days=i) for i in range(days) if rng.random() < 0.4]
    kept = [d for d in kept if not date(2026, 1, 8) <= d <= date(2026, 1, 16)] or [first]
    return {str(k): {d: rng.choice(values) for d in kept} for k in range(devices)}, kept


def frames(spark, cells, days):
    names = [f"{d:%d/%m/%Y}" for d in days]
    wide = table(spark, [(f"00{k}", *(row[d] for d in days)) for k, row in cells.items()], names)
    return wide, to_long(wide)


def expected(cells, days, window, binary):
    """Straight from the definition."""
    result = {}
    for target in month_days(MONTH):
        near = [d for d in days if timedelta(days=1) <= target - d <= timedelta(days=window)]
        if not near:
            continue
        for k, row in cells.items():
            numbers = [float(row[d].replace(",", ".")) for d in near if row[d] is not None]
            if binary:
                result[k, target] = int(any(n > 0 for n in numbers))
            else:
                result[k, target] = int(max(numbers)) if numbers else None
    return result


def by_key(df):
    return {(r[KEY].lstrip("0") or "0", r[DAY]): r[FLAG] for r in df.collect()}


@pytest.mark.parametrize("seed, window", [(1, 5), (2, 1), (4, 32)])
@pytest.mark.parametrize("binary", [True, False])
def test_all_plans_agree(spark, seed, window, binary):
    cells, days = grid(seed)
    wide, long = frames(spark, cells, days)
    want = expected(cells, days, window, binary)
    readings = long.withColumn(ORIGIN, F.lit("ORCA"))
    declared = ("ORCA",) if binary else ()
    assert by_key(flags_from_wide(wide, month_days(MONTH), window, binary)) == want
    assert by_key(flags_from_long(readings, MONTH, window, declared)) == want
    assert by_key(flags_by_frame(readings, MONTH, window, declared)) == want
    zeros = {k: v or 0 for k, v in want.items()}
    assert by_key(flags_table([Origin("ORCA", wide, binary)], MONTH, window)) == zeros
    assert by_key(flags_table([Origin("ORCA", long, binary)], MONTH, window)) == zeros
    stream = long.withColumn("ts", F.col(DAY).cast("timestamp"))
    sliding = by_key(sliding_flags(stream, window, binary))
    ones = {k for k, v in want.items() if v == 1}
    assert {k for k, v in sliding.items() if v == 1 and k[1] in month_days(MONTH)} == ones


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_bits_merge_origins_like_rows(spark, seed):
    first, first_days = grid(seed, devices=8)
    second, second_days = grid(seed + 100, devices=14, values=("0", "1", None))
    wide_1, long_1 = frames(spark, first, first_days)
    wide_2, long_2 = frames(spark, second, second_days)
    rows = long_1.withColumn(ORIGIN, F.lit("ORCA")).unionByName(long_2.withColumn(ORIGIN, F.lit("SANPLAT")))
    want = {k: v or 0 for k, v in by_key(merge_origins(flags_from_long(rows, MONTH))).items()}
    told = [Origin("ORCA", long_1, True, days=first_days), Origin("SANPLAT", long_2, days=second_days)]
    pairs = [(wide_1, wide_2), (long_1, long_2), (wide_1, long_2)]
    for origins in [told, *([Origin("ORCA", a, True), Origin("SANPLAT", b)] for a, b in pairs)]:
        got = by_key(flags_table(origins, MONTH))
        assert {k: v for k, v in got.items() if k in want} == want
        # Bits give a device a row on every covered day; rows only where its origin has one.
        assert all(v == 0 for k, v in got.items() if k not in want)


def test_first_row_of_a_wide_table_stands_for_the_device(spark):
    df = spark.createDataFrame(
        [("007", "0", 2), ("7", "1", 1), ("07", "0", 3)], f"{KEY} string, `10/01/2026` string, seq bigint"
    )
    got = by_key(flags_table([Origin("ORCA", df, True, order="seq")], MONTH))
    assert got["7", date(2026, 1, 11)] == 1


def test_plain_reading_beyond_one_needs_levels(spark):
    df = table(spark, [("A", "2"), ("B", "200"), ("C", "1d"), ("D", "-3")], ["10/01/2026"])
    for key in "ABD":
        with pytest.raises(Exception, match="set levels"):
            flags_table([Origin("SANPLAT", df.where(f"{KEY} = '{key}'"))], MONTH).collect()
    day = date(2026, 1, 12)
    assert by_key(flags_from_wide(df, [day])) == {("A", day): 2, ("B", day): None, ("C", day): None, ("D", day): -3}
    got = by_key(flags_table([Origin("SANPLAT", df)], MONTH, levels=True))
    assert {k: v for k, v in got.items() if k[1] == day} == {("A", day): 2, ("B", day): 0, ("C", day): 0, ("D", day): -3}
    assert rejected_cells(df, ["10/01/2026"], plain=True).first()[0] == 2


@pytest.mark.parametrize("window", [33, 45, 70])
def test_window_beyond_the_bits_needs_levels(spark, window):
    early, late = date(2026, 1, 1) - timedelta(days=window), date(2026, 1, 20)
    names = [f"{d:%d/%m/%Y}" for d in (early, late)]
    wide = table(spark, [("A", "1", "0"), ("B", "0", "3")], names)
    rows = [("SANPLAT", k, d, v) for k, vs in (("A", "10"), ("B", "03")) for d, v in zip((early, late), vs)]
    long = spark.createDataFrame(rows, f"{ORIGIN} string, {KEY} string, {DAY} date, VALUE string")
    with pytest.raises(ValueError):
        flags_table([Origin("SANPLAT", wide)], MONTH, window)
    want = by_key(flags_from_wide(wide, month_days(MONTH), window))
    assert want["A", date(2026, 1, 1)] == 1 and want["B", date(2026, 1, 21)] == 3
    for origin in (Origin("SANPLAT", wide), Origin("SANPLAT", long.drop(ORIGIN)), Origin("SANPLAT", long, tagged=True)):
        assert by_key(flags_table([origin], MONTH, window, levels=True)) == want


def test_levels_equal_bits_where_both_hold(spark):
    wide = table(spark, [("A", "0,5", "1"), ("B", "0", None), (None, "1", "1")], ["31/12/2025", "10/01/2026"])
    second = spark.createDataFrame([("A", date(2026, 1, 3), "0"), ("C", date(2026, 1, 3), "1")], f"{KEY} string, {DAY} date, VALUE string")
    origins = [Origin("ORCA", wide, True), Origin("SANPLAT", second)]
    assert by_key(flags_table(origins, MONTH, levels=True)) == by_key(flags_table(origins, MONTH))


def test_sliding_flags_on_a_stream(spark, folder):
    ts = [datetime(2026, 1, d, 12) for d in (1, 2, 9)]
    rows = [("A", ts[0], "0,5"), ("A", ts[1], "0"), ("B", ts[2], "1"), ("C", datetime(2026, 3, 1), "1")]
    spark.createDataFrame(rows, f"{KEY} string, ts timestamp, VALUE string").write.parquet(f"{folder}/in")
    source = spark.readStream.schema(f"{KEY} string, ts timestamp, VALUE string").parquet(f"{folder}/in")
    stream = sliding_flags(source, late="1 day")
    query = (
        stream.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    # What the watermark has passed is final and equals the batch result.
    streamed = by_key(spark.read.parquet(f"{folder}/out"))
    batch = by_key(sliding_flags(spark.read.parquet(f"{folder}/in")))
    assert streamed == {k: v for k, v in batch.items() if k[0] != "C"}

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tellwatt.operators.indicators import availability, brand_counts, day_totals, flag_counts
from tellwatt.operators.joins import join_brands, join_universe
from tellwatt.operators.quality import (
    checkpoint_stats, missing_columns, missing_days, reconcile, rejected_cells, stored_with_counts, stored_with_stats,
)
from tellwatt.functions.dates import month_calendar, month_days
from tellwatt.plans.files import OriginFiles, flags_from_files, month_from_files, read_origins, store_month
from tellwatt.plans.month import Month, Origin, flags_table, month_indicator
from tellwatt.plans.reports import month_report
from tellwatt.sources.dated import read_brands, read_universe
from tellwatt.vocabulary import BRAND, CITY, DAY, FLAG, KEY, RESULT_SCHEMA, UNIVERSE_SCHEMA

TARGET = date(2026, 1, 25)


def flags_of(spark, pairs, day=TARGET):
    return spark.createDataFrame([(k, v, day) for k, v in pairs], f"{KEY} string, {FLAG} tinyint, {DAY} date")


def universe_of(spark, pairs, day=TARGET):
    return spark.createDataFrame([(k, c, day) for k, c in pairs], UNIVERSE_SCHEMA)


@pytest.fixture
def universe(spark):
    return universe_of(spark, [("A", "CURITIBA"), ("B", "LONDRINA"), ("C", "CURITIBA"), ("D", "MARINGA")])


@pytest.fixture
def brands(spark):
    rows = [("A", "Hexing"), ("B", "Outro"), ("C", "Nansen"), ("E", "Nansen Ipiranga"), ("F", None), ("G", "hexing")]
    return spark.createDataFrame(rows, f"{KEY} string, {BRAND} string")


def test_universe_keeps_all_its_rows(spark, universe):
    joined = join_universe(universe, flags_of(spark, [("A", 1), ("B", 0), ("Z", 1)]))
    assert joined.columns == [KEY, CITY, "ORIGEM", FLAG, DAY]
    assert {r[KEY]: (r[FLAG], r[CITY]) for r in joined.collect()} == {
        "A": (1, "CURITIBA"), "B": (0, "LONDRINA"), "C": (0, "CURITIBA"), "D": (0, "MARINGA"),
    }


def test_day_without_universe_or_flags_has_no_rows(spark, universe):
    other = flags_of(spark, [("A", 1)], date(2099, 1, 1))
    assert join_universe(universe, other).count() == 0


def test_null_flags_and_null_keys(spark):
    universe = universe_of(spark, [("A", "X"), (None, "X")])
    joined = join_universe(universe, flags_of(spark, [("A", None), (None, 1)]))
    assert sorted((r[KEY] or "", r[FLAG]) for r in joined.collect()) == [("", 0), ("A", 0)]


def test_brand_join(spark, universe, brands):
    joined = join_universe(universe.where("NIO != 'C'"), flags_of(spark, [("A", 1)]))
    assert [(r[KEY], r[BRAND]) for r in join_brands(joined, brands).collect()] == [("A", "Hexing")]


def test_missing_files_give_typed_empty_tables(spark, folder):
    assert read_universe(spark, folder, "2026-01").schema == UNIVERSE_SCHEMA
    empty = read_brands(spark, f"{folder}/none.parquet")
    assert empty.columns == [KEY, BRAND] and empty.count() == 0


def joined_rows(spark, rows):
    return spark.createDataFrame(
        [(k, c, f, b, TARGET) for k, c, f, b in rows], f"{KEY} string, {CITY} string, {FLAG} tinyint, {BRAND} string, {DAY} date"
    )


def result(df):
    return {(r[CITY], r[BRAND], r[DAY]): (r["CONTAGEM_COMM"], r["CONTAGEM_TOT"], r["DISP"]) for r in df.collect()}


def test_availability(spark):
    got = availability(joined_rows(spark, [
        ("A", "CWB", 1, "Hexing"), ("B", "CWB", 0, "Nansen"), ("C", "LDA", 1, "Hexing"), ("D", "LDA", 1, "Hexing"),
        ("E", None, 1, "Hexing"), ("F", None, 0, "Hexing"), (None, "LDA", 0, "Hexing"),
    ]))
    assert got.schema == RESULT_SCHEMA or got.columns == RESULT_SCHEMA.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in RESULT_SCHEMA]
    assert result(got) == {
        ("CWB", "Hexing", "2026-01-25"): (1, 1, 1.0),
        ("CWB", "Nansen", "2026-01-25"): (0, 1, 0.0),
        ("LDA", "Hexing", "2026-01-25"): (2, 2, 1.0),
        (None, "Hexing", "2026-01-25"): (1, 2, 0.5),
    }


def test_availability_of_nothing(spark):
    empty = availability(joined_rows(spark, []))
    assert empty.columns == RESULT_SCHEMA.names and empty.count() == 0


def test_counts(spark, brands):
    flags = flags_of(spark, [("A", 1), ("B", 0), ("C", None), ("D", 1)])
    assert tuple(flag_counts(flags).first()) == (4, 2)
    assert {r[BRAND]: r["meters"] for r in brand_counts(brands).collect()}["Nansen"] == 1
    assert tuple(checkpoint_stats(flags).first()) == (4, 2, 1, TARGET, TARGET)
    assert missing_columns(flags, [KEY, "X"]) == ["X"]
    assert missing_days(flags, month_calendar(spark, "2026-01")).count() == 30
    cells = spark.createDataFrame([("a", "1"), ("0,5", None)], "`x y` string, `z.z` string")
    assert rejected_cells(cells, cells.columns).first()[0] == 1


def test_reconcile(spark):
    joined = joined_rows(spark, [("A", "CWB", 1, "Hexing"), ("B", "CWB", 0, "Nansen")]).withColumn(DAY, F.lit("2026-01-25"))
    full = availability(joined.withColumn(DAY, F.to_date(DAY)))
    assert [r["matches"] for r in reconcile(full, joined).collect()] == [True]
    assert [r["matches"] for r in reconcile(full.where(f"{BRAND} = 'Nansen'"), joined).collect()] == [False]
    assert day_totals(full).first()["groups"] == 2


# --- The month as one plan --------------------------------------------------

MONTH = "2026-01"
JANUARY = [date(2026, 1, 1) + timedelta(days=i) for i in range(31)]


@pytest.fixture
def month(spark):
    """Two origins with gaps, repeated universe and brand rows, padded keys."""
    days = [date(2025, 12, 29), date(2026, 1, 2), date(2026, 1, 20)]
    names = ", ".join(f"`{d:%d/%m/%Y}` string" for d in days)
    first = spark.createDataFrame(
        [("0001", "0,5", "0", "0"), ("2", "0", "0", "0"), ("3", None, None, "0,25")], f"{KEY} string, {names}"
    )
    second = spark.createDataFrame(
        [("2", "1", "1"), ("4", "1", "0"), ("5", None, None)], f"{KEY} string, `03/01/2026` string, `10/01/2026` string"
    )
    listed = [("1", "X"), ("2", "X"), ("02", "Y"), ("3", "Y"), ("4", "X"), ("4", "X"), ("5", None), ("9", "Z"), (None, "X")]
    gap = date(2026, 1, 5)
    universe = spark.createDataFrame(
        [(k, c, d) for k, c in listed for d in JANUARY if d != gap], UNIVERSE_SCHEMA
    )
    brands = spark.createDataFrame(
        [("1", "Hexing"), ("2", "Nansen"), ("2", "Nansen"), ("2", "Hexing"), ("03", "Nansen Ipiranga"),
         ("4", "Hexing"), ("5", "Hexing"), ("9", "Outro")],
        f"{KEY} string, {BRAND} string",
    )
    return [Origin("ORCA", first, binary=True), Origin("SANPLAT", second)], universe, brands


def test_one_plan_equals_the_steps(month):
    origins, universe, brands = month
    one = result(month_indicator(universe, brands, origins, MONTH))
    steps = result(availability(join_brands(join_universe(universe, flags_table(origins, MONTH)), brands)))
    assert one == steps
    days = {k[2] for k in one}
    assert "2026-01-05" not in days  # no universe
    assert "2026-01-19" not in days  # no reading in the five days before
    assert "2026-01-31" not in days
    assert {"2026-01-01", "2026-01-03", "2026-01-15", "2026-01-25"} <= days
    # Device 2 is listed in X and Y, has three brand rows, and its first origin decides.
    assert one["X", "Nansen", "2026-01-04"] == (0, 2, 0.0)
    # On 11 January only the second origin covers the day.
    assert one["X", "Nansen", "2026-01-11"] == (2, 2, 1.0)
    # Device 4 is listed twice.
    assert one["X", "Hexing", "2026-01-04"] == (2, 4, 0.5)


@pytest.mark.parametrize("salts", [1, 2, 7])
def test_salts_change_nothing(month, salts):
    origins, universe, brands = month
    want = result(month_indicator(universe, brands, origins, MONTH))
    assert result(month_indicator(universe, brands, origins, MONTH, salts=salts)) == want


def test_window_of_no_days(month):
    origins, universe, brands = month
    assert month_indicator(universe, brands, origins, MONTH, window_days=0).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_universe_is_shuffled_once_and_split_when_skewed(spark):
    """A third of the universe is one device: AQE splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        keys = F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise(F.col("id").cast("string"))
        universe = spark.range(0, n, 1, 8).select(
            keys.alias(KEY),
            F.concat(F.lit("city "), F.col("id") % 50).alias(CITY),
            F.date_add(F.lit(date(2026, 1, 2)), (F.col("id") % 5).cast("int")).alias(DAY),
        )
        brands = spark.range(n).select(F.col("id").cast("string").alias(KEY), F.lit("Hexing").alias(BRAND))
        readings = spark.range(n).select(
            F.col("id").cast("string").alias(KEY), F.lit(date(2026, 1, 1)).alias(DAY), F.lit("1").alias("VALUE")
        )
        df = month_indicator(universe, brands, [Origin("ORCA", readings, True)], MONTH)
        rows = df.collect()
        assert sum(r["CONTAGEM_TOT"] for r in rows) == n
        assert all(r["DISP"] == 1.0 for r in rows)
        plan = plan_of(df)
        assert "skew=true" in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- From files -------------------------------------------------------------


@pytest.fixture
def stored(spark, folder):
    spark.createDataFrame([("0043", "0,25", "0"), ("44", "0", "0")], f"{KEY} string, `2` string, `1` string").write.parquet(
        f"{folder}/first.parquet"
    )
    with open(f"{folder}/second.csv", "w") as f:
        f.write("Device No.,3,2,1\n045,0,1,0\n046,0,0,0\n")
    for name, text in (("ref", "11/01/2026"), ("ref_2", "2026-01-11")):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(f"Data Referencia\n{text}\n")
    for day in ("2026-01-11", "2026-01-12"):
        spark.createDataFrame([(k, "X") for k in ("43", "44", "45", "46", "47")], f"{KEY} string, {CITY} string").coalesce(
            1
        ).write.parquet(f"{folder}/daily/Diario_{day}.parquet")
    spark.createDataFrame([(f"00{k}", "Nansen") for k in range(43, 47)], f"{KEY} string, {BRAND} string").write.parquet(
        f"{folder}/brands.parquet"
    )
    return [
        OriginFiles("ORCA", f"{folder}/first.parquet", f"{folder}/ref.csv", binary=True),
        OriginFiles("SANPLAT", f"{folder}/second.csv", f"{folder}/ref_2.csv"),
    ]


def test_month_from_files(spark, folder, stored):
    df = month_from_files(spark, MONTH, stored, f"{folder}/daily", f"{folder}/brands.parquet")
    want = {("X", "Nansen", "2026-01-11"): (2, 4, 0.5), ("X", "Nansen", "2026-01-12"): (2, 4, 0.5)}
    assert result(df) == want
    store_month(df, f"{folder}/out", MONTH)
    report = month_report(spark, f"{folder}/out", prefer="parquet")
    assert result(report) == want
    assert report.schema.names == RESULT_SCHEMA.names
    assert month_report(spark, f"{folder}/out").count() == 4
    assert month_report(spark, f"{folder}/out", distinct=True).count() == 2


def test_origin_without_files_is_left_out(spark, folder, stored):
    gone = OriginFiles("ORCA", f"{folder}/gone.parquet", f"{folder}/ref.csv")
    no_reference = OriginFiles("ORCA", f"{folder}/first.parquet", f"{folder}/gone.csv")
    assert [o.name for o in read_origins(spark, [gone, no_reference, stored[1]])] == ["SANPLAT"]
    with pytest.raises(FileNotFoundError):
        read_origins(spark, [gone])


def test_stored_table_with_dates_or_a_date_row(spark, folder):
    with open(f"{folder}/dated.csv", "w") as f:
        f.write("NIO,09/01/2026,10/01/2026\n043,1,0\n")
    with open(f"{folder}/legacy.csv", "w") as f:
        f.write("NIO,2,1\n,09/01/2026,10/01/2026\n043,1,0\n")
    for name in ("dated", "legacy"):
        rows = flags_from_files(spark, MONTH, [OriginFiles("ORCA", f"{folder}/{name}.csv", binary=True)]).collect()
        assert {(r[KEY], r[DAY].day) for r in rows if r[FLAG] == 1} == {("43", d) for d in range(10, 15)}
        assert {r[DAY].day for r in rows} == set(range(10, 16))


def test_only_needed_columns_and_files_are_read(spark, folder, stored):
    df = month_from_files(spark, MONTH, stored, f"{folder}/daily", f"{folder}/brands.parquet")
    plan = df._jdf.queryExecution().toString()
    assert "PushedFilters: [In(INTELIGENTE" in plan
    one_day = read_universe(spark, f"{folder}/daily").where(F.col(DAY) == F.lit(date(2026, 1, 12)))
    one_day.collect()
    metrics = one_day._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert metrics.get("numFiles").get().value() == 1


@pytest.mark.parametrize("window", [0, 1, 2, 5, 27, 28, 29, 45, 365])
def test_largest_of_windows(spark, window):
    """Arrays of any length against slices, nulls and empty windows included."""
    span, dice = Month("2026-02", window), random.Random(window)
    length = (span.end - span.start).days + 1
    rows = [[dice.choice([None, 0, 1, 2, 3]) if dice.random() < 0.3 else None for _ in range(length)] for _ in range(20)]
    df = spark.createDataFrame([(r,) for r in rows], "cells array<tinyint>").selectExpr(f"{span.largest_of_windows('cells')} AS best", "cells")
    for row in df.collect():
        want = [max((x for x in row["cells"][d:d + window] if x is not None), default=None) for d in range(28)]
        assert row["best"] == want
    assert abs(len(span.largest_of_windows("cells")) - len(Month("2026-02", 9999).largest_of_windows("cells"))) < 200


def test_known_days_cover_what_their_windows_reach():
    span = Month("2026-02", 3)
    days = [span.start, date(2026, 2, 10), date(2026, 3, 1), date(2025, 1, 1)]
    want = {d for d in range(28) for x in days if 1 <= (span.first - x).days + d <= 3}
    assert span.targets_of(days) == sum(1 << d for d in want)


def test_counts_of_stored_rows_show_a_loss(spark, folder):
    rows = [("1", "A", 1, date(2026, 2, 1)), ("2", "A", 0, date(2026, 2, 1)), ("3", "B", 1, date(2026, 2, 3)), (None, "B", 1, date(2026, 2, 3))]
    joined = spark.createDataFrame([(*r, "Nansen") for r in rows], "NIO string, MUNICIPIO string, DISP tinyint, DATA date, INTELIGENTE string")
    path = f"{folder}/joined"
    counts = stored_with_counts(joined, month_days("2026-02"), lambda df: df.write.parquet(path))
    assert sorted(map(tuple, counts.collect())) == [("2026-02-01", 1, 2), ("2026-02-03", 2, 1)]
    whole = spark.read.parquet(path)
    same = {r["DATA"]: r["matches"] for r in reconcile(availability(whole), counts).collect()}
    lost = {r["DATA"]: r["matches"] for r in reconcile(availability(whole.where("NIO <> '2' OR NIO IS NULL")), counts).collect()}
    assert same == {"2026-02-01": True, "2026-02-03": True} and lost == {"2026-02-01": False, "2026-02-03": True}


def test_stats_of_a_write_are_those_of_the_table(spark, folder):
    flags = spark.createDataFrame([("1", 1, date(2026, 2, 1)), ("2", None, date(2026, 2, 2))], "NIO string, DISP tinyint, DATA date")
    stats = stored_with_stats(flags, lambda df: df.write.parquet(f"{folder}/a"))
    assert stats.collect() == checkpoint_stats(spark.read.parquet(f"{folder}/a")).collect() == checkpoint_stats(flags).collect()
    none = stored_with_stats(flags.limit(0), lambda df: df.write.parquet(f"{folder}/b"))
    assert none.collect() == checkpoint_stats(flags.limit(0)).collect()

import gzip
import re
from datetime import date
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tellwatt.operators.columns import canonical_order, resolve_columns, sample_rows, search, select_columns
from tellwatt.operators import pages
from tellwatt.operators.pages import file_boundaries, first_file_columns, folder_totals, page, with_position
from tellwatt.operators.reshape import (
    columns_between, columns_between_by_header_row, relative_day_names, rename_raw_key, to_absolute_days, to_long,
)
from tellwatt.plans.reports import combine_months, enrich, export_columns, export_days, month_columns, month_report
from tellwatt.session import shared_folder
from tellwatt.sinks.writers import append_days, csv_to_parquet, write_csv, write_flags, write_table
from tellwatt.sources.dated import month_files, read_month_results, read_reference_date, read_universe
from tellwatt.sources.tables import (
    delimiters_by_file, detect_delimiter, first_lines, read_csv, read_folder, read_if_present, read_table, with_file_order,
)
from tellwatt.streaming.daily import append_days_stream
from tellwatt.vocabulary import BRAND, CITY, DAY, KEY, RESULT_SCHEMA
from tellwatt.workloads import files


def put(path, text):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text)
    return str(path)


# --- Wide tables ------------------------------------------------------------


def test_relative_day_names():
    reference = date(2026, 2, 24)
    assert relative_day_names(["NIO", "3", "2", "1"], reference) == {
        "3": "23/02/2026", "2": "22/02/2026", "1": "21/02/2026",
    }
    assert relative_day_names(["3", "1"], reference) == {"3": "23/02/2026", "1": "21/02/2026"}
    assert relative_day_names([str(i) for i in range(90, 0, -1)], reference)["1"] == "26/11/2025"
    with pytest.raises(ValueError):
        relative_day_names(["NIO"], reference)


def test_rename_keeps_values(spark):
    df = spark.createDataFrame([("a", 1, 0)], "`Device No.` string, `2` int, `1` int")
    renamed = enrich(df, date(2026, 2, 24))
    assert renamed.columns == [KEY, "23/02/2026", "22/02/2026"]
    assert tuple(renamed.first()) == ("a", 1, 0)
    assert rename_raw_key(to_absolute_days(df.withColumnRenamed("Device No.", KEY), date(2026, 2, 24))).columns[0] == KEY


def test_long_form_keeps_nulls(spark):
    df = spark.createDataFrame([("a", "1", None)], "NIO string, `23/02/2026` string, `22/02/2026` string")
    assert {tuple(r) for r in to_long(df).collect()} == {("a", date(2026, 2, 23), "1"), ("a", date(2026, 2, 22), None)}


def test_columns_between(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, 4, 5)], "`31/01/2026` int, NIO int, `2026-02-01` int, `a b` int, `02-02-2026` int"
    )
    assert columns_between(df, date(2026, 1, 31), date(2026, 2, 1)).columns == ["NIO", "a b", "31/01/2026", "2026-02-01"]
    assert month_columns(df, "2026-02", 0).columns == ["NIO", "a b", "2026-02-01", "02-02-2026"]


def test_columns_between_by_header_row(spark):
    rows = [(None, "01/02/2026", "02/02/2026", "x", None), ("k", "1", "0", "y", "1")]
    df = spark.createDataFrame(rows, "NIO string, `2` string, `1` string, kind string, `3` string")
    kept = columns_between_by_header_row(df, date(2026, 2, 2), date(2026, 2, 9))
    assert kept.columns == ["NIO", "kind", "1"] and kept.count() == 2
    assert columns_between_by_header_row(df, date(2026, 2, 2), date(2026, 2, 9), keep_header=False).count() == 1


# --- Columns and rows ---------------------------------------------------------

NAMES = ["NIO", "TIPO", "90", "89"]


@pytest.mark.parametrize(
    "spec, want",
    [
        ("2-3", ["TIPO", "90"]),
        ("TIPO-90", ["TIPO", "90"]),
        ("90-TIPO", ["TIPO", "90"]),
        ("9", []),
        ("0-2", ["NIO", "TIPO"]),
        ("3-99", ["90", "89"]),
        ("TIPO,1-2, 89 ,", ["TIPO", "NIO"]),
        ("TIPO, 4", ["TIPO", "89"]),
        ("none-90", []),
        ("none", []),
        ("²", []),
        ("*", NAMES),
        ("3-1", []),
    ],
)
def test_column_spec(spec, want):
    # A number alone is a position, even where a column has that name.
    assert resolve_columns(NAMES, spec) == want


def test_select_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, `c d` int, e int")
    assert select_columns(df, "2-3").columns == ["c d", "e"]
    with pytest.raises(ValueError):
        select_columns(df, "7")


def test_canonical_order(spark):
    df = spark.createDataFrame([(1, "x", "y", 2)], "extra int, DATA string, MUNICIPIO string, CONTAGEM_TOT int")
    assert canonical_order(df).columns == [CITY, "CONTAGEM_TOT", DAY, "extra"]


def test_search_and_sample(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "i int, name string")
    assert {r[0] for r in search(df, "name", "n1").collect()} == {1, *range(10, 20)}
    assert {r[0] for r in search(df, "i", "9").collect()} == {9, 19}
    assert sample_rows(df).count() == 5


@pytest.mark.parametrize("suffix", ["parquet", "csv"])
def test_page(spark, folder, suffix):
    df = spark.range(1000).selectExpr("cast(id as string) AS id", "cast(id * 2 as string) AS twice")
    write_table(df.orderBy(F.col("id").cast("int")).repartitionByRange(5, F.col("id").cast("int")), f"{folder}/t", suffix)
    csv = suffix == "csv"
    found = page(spark, f"{folder}/t", 498, 3, csv).collect()
    assert sorted((r["row_number"], r["id"]) for r in found) == [(i, str(i)) for i in range(495, 502)]
    assert page(spark, f"{folder}/t", 0, 3, csv).count() == 4
    assert page(spark, f"{folder}/t", 999, 3, csv).count() == 4
    for outside in (-1, 1000):
        with pytest.raises(IndexError):
            page(spark, f"{folder}/t", outside, 3, csv)


def test_page_of_a_csv_in_blocks(spark, folder):
    put(f"{folder}/big.csv", "a,b\n" + "".join(f"{i},{'x' * 20}\n" for i in range(30000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100KB")
    try:
        found = page(spark, f"{folder}/big.csv", 20000, 50, csv=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["row_number"], int(r["a"])) for r in found) == [(i, i) for i in range(19950, 20051)]


def test_boundaries_and_totals(spark, folder):
    for name, n in (("b", 3), ("a", 5), ("c", 0)):
        put(f"{folder}/{name}.csv", "k,v\n" + "".join(f"{i},1\n" for i in range(n)))
    df = with_position(read_csv(spark, folder))
    got = {r["file_path"][-5:]: (r["start_row"], r["end_row"], r["rows"]) for r in file_boundaries(df).collect()}
    assert got == {"a.csv": (0, 4, 5), "b.csv": (5, 7, 3)}
    assert tuple(folder_totals(df, 2).first()) == (2, 8, 2)


def test_file_order(spark, folder):
    put(f"{folder}/t.csv", "k\n" + "".join(f"{i}\n" for i in range(100)))
    rows = with_file_order(read_csv(spark, f"{folder}/t.csv")).orderBy("_order").collect()
    assert [int(r["k"]) for r in rows] == list(range(100))


# --- Sources ------------------------------------------------------------------


@pytest.mark.parametrize("text", ["2026-02-24", "24-02-2026", "24/02/2026"])
def test_reference_date(spark, folder, text):
    put(f"{folder}/ref.csv", f"Data Ref.\n{text}\n")
    assert read_reference_date(spark, f"{folder}/ref.csv") == date(2026, 2, 24)


@pytest.mark.parametrize("text", ["a\nsoon\n", "a\n"])
def test_bad_reference_date(spark, folder, text):
    put(f"{folder}/ref.csv", text)
    with pytest.raises(ValueError):
        read_reference_date(spark, f"{folder}/ref.csv")


@pytest.mark.parametrize(
    "line, want", [("a;b,c", ";"), ("a,b\tc", ","), ("a\tb|c", "\t"), ("a|b", "|"), ("a", ","), ("", ",")]
)
def test_delimiter(spark, folder, line, want):
    put(f"{folder}/t.csv", f"{line}\n1;2,3\n")
    assert detect_delimiter(spark, f"{folder}/t.csv") == want


def test_delimiter_of_each_file(spark, folder):
    put(f"{folder}/a.csv", "x;y\n1,2\n")
    put(f"{folder}/b.csv", "x|y\n1;2\n")
    assert detect_delimiter(spark, folder) == ";"
    got = {r["file_path"][-5:]: r["delimiter"] for r in delimiters_by_file(spark, folder).collect()}
    assert got == {"a.csv": ";", "b.csv": "|"}


def jobs_of(spark, run):
    """What ``run`` gives, and how many Spark jobs it took."""
    spark.sparkContext.setJobGroup(name := f"jobs {id(run)}", "counted")
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_first_lines_of_ten_thousand_files(spark, folder):
    for i in range(10_000):
        Path(f"{folder}/{i}.csv").write_text(f"a{';,|'[i % 3]}b\n{i}\n")
    counts, jobs = jobs_of(
        spark, lambda: dict(map(tuple, delimiters_by_file(spark, folder).groupBy("delimiter").count().collect()))
    )
    assert counts == {";": 3334, ",": 3333, "|": 3333}
    assert jobs <= 4  # Spark's listing, then one query in stages


def test_first_lines_of_odd_files(spark, folder):
    put(f"{folder}/with space/é.csv", "a|b\r\n1;2\n")
    put(f"{folder}/empty.csv", "")
    put(f"{folder}/old.csv", "c;d\re")
    put(f"{folder}/no break.txt", "x\ty")
    put(f"{folder}/long.csv", "z" * 200_000 + ";\n|")
    Path(f"{folder}/packed.csv.gz").write_bytes(gzip.compress(b"p;q\n1,2\n"))
    got = {Path(r["file_path"]).name: r["first_line"] for r in first_lines(spark, folder).collect()}
    assert got == {
        "é.csv": "a|b", "old.csv": "c;d", "no break.txt": "x\ty", "long.csv": "z" * 200_000 + ";", "packed.csv.gz": "p;q",
    }
    assert first_lines(spark, f"{folder}/gone").collect() == []


def test_endings_in_any_case(spark, folder):
    put(f"{folder}/A.CSV", "a,b\n1,2\n")
    put(f"{folder}/b.csv", "a,b\n3,4\n")
    assert sorted(r["a"] for r in read_folder(spark, folder).collect()) == ["1", "3"]


def test_formats(spark, folder):
    put(f"{folder}/t.txt", "NIO,v\n0043,1\n")
    assert tuple(read_table(spark, f"{folder}/t.txt").first()) == ("0043", "1")
    spark.range(3).write.parquet(f"{folder}/t.pq")
    assert read_table(spark, f"{folder}/t.pq").count() == 3
    with pytest.raises(ValueError):
        read_table(spark, f"{folder}/t.xlsx")
    assert read_if_present(lambda: read_table(spark, f"{folder}/gone.csv")) is None


def test_encoding_and_bad_fields(spark, folder):
    Path(f"{folder}/latin.csv").write_bytes("k;v\nSão;1\nb;x\n".encode("latin-1"))
    df = read_csv(spark, f"{folder}/latin.csv", schema="k string, v int, bad string", delimiter=";",
                  encoding="ISO-8859-1", rejects="bad")
    assert [tuple(r) for r in df.collect()] == [("São", 1, None), ("b", None, "b;x")]


def test_folder_of_both_formats(spark, folder):
    spark.createDataFrame([(1, "a")], "n int, s string").write.parquet(f"{folder}/p.parquet")
    spark.createDataFrame([(4, "d")], "n int, s string").write.parquet(f"{folder}/q.pq")
    put(f"{folder}/c.csv", "s;n\nb;2\nc;x\n")
    df = read_folder(spark, folder)
    assert sorted((r["n"] or 0, r["s"]) for r in df.collect()) == [(0, "c"), (1, "a"), (2, "b"), (4, "d")]
    assert dict(df.dtypes)["n"] == "int"
    assert {r[0].rsplit(".", 1)[-1] for r in df.select("file_path").collect()} == {"parquet", "csv"}


def test_folder_problems(spark, folder):
    with pytest.raises(FileNotFoundError):
        read_folder(spark, folder)
    put(f"{folder}/c.csv", "a,b\n1,2\n")
    assert read_folder(spark, folder).columns == ["a", "b", "file_path"]
    spark.range(1).write.parquet(f"{folder}/p.parquet")
    with pytest.raises(ValueError):
        read_folder(spark, folder)


def test_first_file_columns(spark, folder):
    spark.range(1).selectExpr("1 AS a", "2 AS b").coalesce(1).write.parquet(f"{folder}/b.parquet")
    spark.range(1).selectExpr("1 AS a").coalesce(1).write.parquet(f"{folder}/a.parquet")
    scan = spark.read.parquet(f"{folder}/b.parquet", f"{folder}/a.parquet")
    assert first_file_columns(spark, scan) == ["a"]


def test_universe_of_a_month(spark, folder):
    rows = spark.createDataFrame([("01", "X")], f"{KEY} string, {CITY} string")
    for day in ("2026-01-31", "2026-02-01", "2026-02-03"):
        rows.write.parquet(f"{folder}/Diario_{day}.parquet")
    spark.range(1).write.parquet(f"{folder}/Other_2026-02-02.parquet")
    rows.write.parquet(f"{folder}/OldDiario_2026-02-02.parquet")
    rows.write.parquet(f"{folder}/file=Diario_2026-02-04.parquet")
    assert read_universe(spark, folder).count() == 4
    february = read_universe(spark, folder, "2026-02").collect()
    assert sorted(r[DAY] for r in february) == [date(2026, 2, d) for d in (1, 3, 4)]


def test_universe_days_of_several_types(spark, folder):
    def day(name, rows, kind, more=""):
        spark.createDataFrame(rows, f"device {kind}, town string{more}").coalesce(1).write.mode("append").parquet(f"{folder}/Diario_{name}.parquet")

    day("2026-02-01", [("007", "X")], "string")
    day("2026-02-02", [(7, "X")], "bigint")
    day("2026-02-03", [(7, "X", 1)], "int", ", other int")
    day("2026-02-04", [("07", "Y")], "string")
    day("2026-02-05", [(8, "Z")], "bigint")
    day("2026-02-05", [("08", "Z")], "string")  # a day whose own files differ
    found = read_universe(spark, folder, "2026-02", "device", "town")
    assert found.columns == [KEY, CITY, DAY]
    assert sorted((r[DAY].day, r[KEY], r[CITY]) for r in found.collect()) == [
        (1, "007", "X"), (2, "7", "X"), (3, "7", "X"), (4, "07", "Y"), (5, "08", "Z"), (5, "8", "Z"),
    ]
    fourth = found.where(F.col(DAY) == date(2026, 2, 4))
    for path in Path(folder).glob("Diario_2026-02-0[1235].parquet/part-*"):
        path.write_bytes(b"not to be read")
    assert [r[KEY] for r in fourth.collect()] == ["07"]
    assert read_universe(spark, folder, "2026-03").schema == read_universe(spark, f"{folder}/gone").schema


def test_universe_of_one_type_is_one_scan(spark, folder):
    for day in ("2026-02-01", "2026-02-02"):
        spark.createDataFrame([("1", "X")], f"{KEY} string, {CITY} string").write.parquet(f"{folder}/Diario_{day}.parquet")
    plan = read_universe(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


# --- Sinks and reports ----------------------------------------------------------


def batch(spark, *days):
    rows = [(c, "Hexing", 1, 2, 0.5, d) for d in days for c in ("CURITIBA", "LONDRINA")]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_appended_days(spark, folder, fmt):
    path = f"{folder}/deep/nested/days"
    append_days(batch(spark, "2026-01-20"), path, fmt, fresh=True)
    append_days(batch(spark, "2026-01-25"), path, fmt, fresh=True)
    append_days(batch(spark).limit(0), path, fmt)
    append_days(batch(spark, "2026-01-26"), path, fmt)
    append_days(batch(spark, "2026-01-26"), path, fmt)
    read = read_csv(spark, path, schema=RESULT_SCHEMA) if fmt == "csv" else spark.read.schema(RESULT_SCHEMA).parquet(path)
    assert sorted(tuple(r) for r in read.select(*RESULT_SCHEMA.names).collect()) == sorted(
        tuple(r) for r in batch(spark, "2026-01-25", "2026-01-26").collect()
    )


def test_stream_of_days(spark, folder):
    def run():
        source = spark.readStream.schema(RESULT_SCHEMA).parquet(f"{folder}/in")
        append_days_stream(source, f"{folder}/out", f"{folder}/cp").awaitTermination()
        return read_csv(spark, f"{folder}/out", schema=RESULT_SCHEMA).count()

    batch(spark, "2026-01-25").write.parquet(f"{folder}/in")
    assert run() == 2
    assert run() == 2
    batch(spark, "2026-01-26").write.mode("append").parquet(f"{folder}/in")
    assert run() == 4


def test_csv_and_parquet_hold_the_same(spark, folder):
    df = batch(spark, "2026-01-25")
    write_table(df, f"{folder}/r.csv", "csv")
    csv_to_parquet(spark, f"{folder}/r.csv", f"{folder}/r.parquet", RESULT_SCHEMA)
    assert spark.read.parquet(f"{folder}/r.parquet").exceptAll(df).count() == 0
    assert read_csv(spark, f"{folder}/r.csv", schema=RESULT_SCHEMA).exceptAll(df).count() == 0


def test_flags_by_origin(spark, folder):
    rows = [("a", 1, date(2026, 1, 1), "ORCA"), ("a", 0, date(2026, 1, 1), "SANPLAT")]
    write_flags(spark.createDataFrame(rows, "NIO string, DISP tinyint, DATA date, ORIGEM string"), f"{folder}/f")
    one = spark.read.parquet(f"{folder}/f").where("ORIGEM = 'SANPLAT'")
    assert [r["DISP"] for r in one.collect()] == [0]
    assert "PartitionFilters: [isnotnull(ORIGEM" in one._jdf.queryExecution().executedPlan().toString()


def test_exports(spark, folder):
    put(f"{folder}/t.csv", "NIO,31/01/2026,01/02/2026,TIPO\n07,1,x,t\n")
    export_days(spark, f"{folder}/t.csv", f"{folder}/out.csv", date(2026, 2, 1), date(2026, 2, 28))
    out = read_csv(spark, f"{folder}/out.csv")
    assert out.columns == ["NIO", "TIPO", "01/02/2026"] and tuple(out.first()) == ("07", "t", "x")
    with pytest.raises(Exception, match="(?i)exists"):
        export_days(spark, f"{folder}/t.csv", f"{folder}/out.csv", date(2026, 2, 1), date(2026, 2, 28))
    export_days(spark, f"{folder}/t.csv", f"{folder}/out.csv", date(2026, 1, 1), date(2026, 1, 31), overwrite=True)
    assert read_csv(spark, f"{folder}/out.csv").columns == ["NIO", "TIPO", "31/01/2026"]
    export_columns(read_csv(spark, f"{folder}/t.csv"), "TIPO,1", f"{folder}/cols.csv")
    assert read_csv(spark, f"{folder}/cols.csv").columns == ["TIPO", "NIO"]


def test_report(spark, folder):
    assert month_report(spark, folder) is None
    header = ",".join(RESULT_SCHEMA.names)
    put(f"{folder}/municipio_2026-02.csv", f"{header}\nB,Nansen,1,2,0.5,2026-02-02\nA,Nansen,1,2,0.5,2026-02-02\n")
    put(f"{folder}/MUNICIPIO_2026-01.CSV", f"{header}\n,Hexing,0,2,0.0,2026-01-31\n")
    put(f"{folder}/municipio_2026-1.csv", f"{header}\nbad,Hexing,0,2,0.0,2026-01-01\n")
    put(f"{folder}/other.csv", "x\n1\n")
    read_csv(spark, f"{folder}/municipio_2026-02.csv", schema=RESULT_SCHEMA).write.parquet(
        f"{folder}/municipio_2026-02.parquet"
    )
    keys = lambda df: [(r[DAY], r[CITY]) for r in df.collect()]
    a, b = ("2026-02-02", "A"), ("2026-02-02", "B")
    assert keys(month_report(spark, folder)) == [("2026-01-31", None), a, a, b, b]
    assert keys(month_report(spark, folder, distinct=True)) == [("2026-01-31", None), a, b]
    assert keys(month_report(spark, folder, prefer="parquet")) == [("2026-01-31", None), a, b]
    assert [tuple(r) for r in month_files(spark, folder).collect()] == [
        ("2026-01", "csv"), ("2026-02", "csv"), ("2026-02", "parquet"),
    ]


def test_report_of_all_kinds_of_results(spark, folder):
    header = ",".join(RESULT_SCHEMA.names)
    put(f"{folder}/municipio_2026-01.csv", f"{header}\nA,Nansen,1,2,0.5,2026-01-31\n")
    append_days(batch(spark, "2026-02-01"), f"{folder}/municipio_2026-02.csv", "csv")
    append_days(batch(spark, "2026-02-02"), f"{folder}/municipio_2026-02.csv", "csv")
    append_days(batch(spark, "2026-03-01"), f"{folder}/municipio_2026-03.parquet")
    write_table(batch(spark, "2026-04-01"), f"{folder}/municipio_2026-04.parquet")
    report = month_report(spark, folder)
    assert report.columns == RESULT_SCHEMA.names
    days = [r[DAY] for r in report.collect()]
    assert days == ["2026-01-31", *(d for d in ("2026-02-01", "2026-02-02", "2026-03-01", "2026-04-01") for _ in "ab")]


def test_report_columns_and_order(spark):
    df = spark.createDataFrame([("2026-01-02", 1), ("2026-01-01", 2)], "DATA string, more int")
    assert [tuple(r) for r in combine_months(df).collect()] == [("2026-01-01", 2), ("2026-01-02", 1)]
    bare = spark.createDataFrame([(1,)], "more int")
    assert combine_months(bare).columns == ["more"]
    assert BRAND in combine_months(batch(spark, "2026-01-01")).columns


def test_unreadable_month_is_skipped_and_named(spark, folder):
    batch(spark, "2026-01-25").coalesce(1).write.parquet(f"{folder}/municipio_2026-01.parquet")
    put(f"{folder}/municipio_2026-02.parquet", "not parquet at all")
    batch(spark, "2026-03-01").coalesce(1).write.parquet(f"{folder}/municipio_2026-03.parquet")
    part = next(Path(f"{folder}/municipio_2026-03.parquet").glob("part-*"))
    whole = part.read_bytes()
    part.write_bytes(whole[:8] + bytes(60) + whole[68:])  # breaks behind its first bytes, with a sound footer
    next(Path(f"{folder}/municipio_2026-03.parquet").glob(".part-*.crc")).write_bytes(b"")
    assert month_report(spark, folder).count() == 2
    results, skipped = read_month_results(spark, folder)
    assert results.count() == 2
    assert sorted(re.search(r"municipio_....-..", r["file_path"])[0] for r in skipped.collect()) == [
        "municipio_2026-02", "municipio_2026-03",
    ]


def test_months_of_any_shape(spark, folder):
    """Another order, a column more, a date as date, counts with a fraction, and no rows."""
    header = ",".join(RESULT_SCHEMA.names)
    put(f"{folder}/municipio_2026-01.csv", f"{header}\nA,Nansen,1,2,0.5,2026-01-31\n")
    put(f"{folder}/municipio_2026-02.csv", "DATA,INTELIGENTE,MUNICIPIO,DISP,CONTAGEM_TOT,CONTAGEM_COMM\n2026-02-01,Nansen,B,0.5,4.0,2.0\n")
    put(f"{folder}/municipio_2026-03.csv", f"{header},NOTE\nC,Nansen,1,2,0.5,2026-03-01,\"new, \"\"here\"\"\"\n")
    batch(spark, "2026-04-01").withColumn("DATA", F.to_date("DATA")).write.parquet(f"{folder}/municipio_2026-04.parquet")
    put(f"{folder}/municipio_2026-05.csv", f"{header}\n")
    report = month_report(spark, folder)
    assert report.columns == [*RESULT_SCHEMA.names, "NOTE"]
    assert [(r[DAY], r["CONTAGEM_TOT"], r["NOTE"]) for r in report.collect()][:3] == [
        ("2026-01-31", 2, None), ("2026-02-01", 4, None), ("2026-03-01", 2, 'new, "here"'),
    ]
    assert report.count() == 3 + batch(spark, "2026-04-01").count()
    assert [r["month"] for r in month_files(spark, folder).collect()] == [f"2026-0{m}" for m in range(1, 6)]


def test_months_are_read_in_two_jobs(spark, folder):
    header = ",".join(RESULT_SCHEMA.names)
    for m in range(1, 13):
        for y in (2024, 2025):
            put(f"{folder}/municipio_{y}-{m:02}.csv", f"{header}\nA,Nansen,1,2,0.5,{y}-{m:02}-01\n,,,,,\n")
    put(f"{folder}/municipio_2026-01.csv", "")
    (results, skipped), jobs = jobs_of(spark, lambda: read_month_results(spark, folder))
    assert jobs == 2  # one that reads and stores, one for the columns
    assert results.count() == 48 and skipped.count() == 0
    assert [tuple(r) for r in results.where(f"{CITY} IS NULL").select("CONTAGEM_TOT", "DISP").distinct().collect()] == [(None, None)]


AWKWARD = ['He said "hi", x', "two\nlines", "\r\n", " spaced ", "", None, 'back\\"slash', "tab\t", '"', "a,b;c", "é日"]


def test_csv_text_survives(spark, folder):
    df = spark.createDataFrame(list(enumerate(AWKWARD)), "n int, s string").coalesce(1)
    write_csv(df, f"{folder}/t.csv")
    back = read_csv(spark, f"{folder}/t.csv", schema=df.schema, multi_line=True)
    assert [r["s"] for r in back.orderBy("n").collect()] == AWKWARD
    con = duckdb.connect()
    rows = con.execute(
        f"SELECT n, s FROM read_csv('{folder}/t.csv/*.csv', header=true, quote='\"', escape='\"', "
        "columns={'n': 'INT', 's': 'VARCHAR'}, allow_quoted_nulls=false, new_line='\\n') ORDER BY n"
    ).fetchall()
    assert [s for _, s in rows] == AWKWARD
    days = df.withColumn("DATA", F.lit("2026-01-01"))
    append_days(days, f"{folder}/days", "csv")
    again = read_csv(spark, f"{folder}/days", multi_line=True)
    assert sorted(str(r["s"]) for r in again.collect()) == sorted(map(str, AWKWARD))


def test_page_in_a_folder_of_both_formats_with_a_space(spark, folder):
    root = f"{folder}/a b"
    spark.range(100).selectExpr("id AS n", "'p' AS s").coalesce(1).write.parquet(f"{root}/1.parquet")
    put(f"{root}/2.csv", "n,s\n" + "".join(f"{i},c\n" for i in range(100, 200)))
    found = page(spark, root, 99, 2).collect()
    assert sorted((r["row_number"], r["n"], r["s"]) for r in found) == [
        (k, str(k), "p" if k < 100 else "c") for k in range(97, 102)
    ]


def test_page_without_a_row_fails(spark, folder, monkeypatch):
    spark.range(50).coalesce(1).write.parquet(f"{folder}/t")
    real = pages.numbered
    monkeypatch.setattr(pages, "numbered", lambda *a: real(*a).where("id != 21"))
    with pytest.raises(Exception, match="no row with number 21"):
        page(spark, f"{folder}/t", 20, 3).collect()


def test_shared_folder(spark):
    assert shared_folder(spark) != shared_folder(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert shared_folder(spark).startswith(root)


def test_stored_csv_has_header(spark, folder):
    write_csv(batch(spark, "2026-01-25").coalesce(1), f"{folder}/x.csv")
    part = next(Path(f"{folder}/x.csv").glob("part-*"))
    assert part.read_text().splitlines()[0] == ",".join(RESULT_SCHEMA.names)


def test_long_lines_are_as_many_files_as_they_need(spark, folder, monkeypatch):
    rows = [(k * 7 % 300 if k % 50 else None, k % 5, "ANR"[k % 3]) for k in range(1000)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(files, "shared_folder", lambda _: f"{folder}/shared")
    monkeypatch.setattr(files, "LINES", 100, raising=False)
    got = files.row_page_deep(spark, folder).collect()
    order = sorted((r[:2] for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(map(tuple, got), key=lambda r: r[2]) == [(*order[k], k) for k in range(795, 806)]
    assert len(list(Path(folder, "shared", "long lines").glob("*.csv"))) >= 8


def test_many_long_lines_are_packed(spark, folder, monkeypatch):
    rows = [(k // 4 if k % 50 else None, k % 5, "ANR"[k % 3] if k % 7 else None) for k in range(3000)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(files, "shared_folder", lambda _: f"{folder}/shared")
    monkeypatch.setattr(files, "LINES", 500)
    monkeypatch.setattr(files, "PLAIN", 1000, raising=False)
    got = files.row_page_deep(spark, folder).collect()
    order = sorted((r[:2] for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(map(tuple, got), key=lambda r: r[2]) == [(*order[k], k) for k in range(2395, 2406)]
    stored = Path(folder, "shared", "long lines")
    assert sum(f.stat().st_size for f in stored.glob("part-*")) < 40 * len(rows)
    lines = read_csv(spark, str(stored), schema="l_orderkey long, l_linenumber int, pad string")
    want = [(a, b, flag and flag + "x" * 399) for a, b, flag in rows]
    assert sorted(map(str, map(tuple, lines.collect()))) == sorted(map(str, want))
    starts = sorted(r["start_row"] for r in file_boundaries(with_position(lines)).collect())
    assert len(starts) >= 4
    for start in starts[1:3]:
        found = page(spark, str(stored), start, 2, csv=True).collect()
        shown = sorted((r["row_number"], int(r["l_orderkey"] or -1), int(r["l_linenumber"])) for r in found)
        assert shown == [(k, -1 if order[k][0] is None else order[k][0], order[k][1]) for k in range(start - 2, start + 3)]


def test_numbering_leaves_rows_where_they_are(spark, folder, monkeypatch):
    spark.range(1000).write.option("header", True).csv(f"{folder}/t")
    starts = {r.p: 0 for r in spark.read.csv(f"{folder}/t").selectExpr("_metadata.file_path AS p").distinct().collect()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pages.numbered(spark, starts, csv=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert found.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

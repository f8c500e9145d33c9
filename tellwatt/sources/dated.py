"""Sources whose file names or single cells hold dates."""

from __future__ import annotations

import logging
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.functions.dates import parse_date
from tellwatt.functions.scalars import quoted
from tellwatt.session import shared_folder
from tellwatt.sources.tables import any_case, listed_files, read_csv, read_if_present, read_or_empty, read_parquet
from tellwatt.vocabulary import (
    BRAND, BRAND_SCHEMA, CITY, DAY, KEY, MONTH_RESULT_NAME, RESULT_SCHEMA, UNIVERSE_GLOB, UNIVERSE_NAME,
    UNIVERSE_SCHEMA,
)

logger = logging.getLogger(__name__)


def read_reference_date(spark: SparkSession, path: str) -> date:
    """The date in the first cell of a one-row CSV."""
    table = read_csv(spark, path)
    row = table.select(
        F.col(quoted(table.columns[0])).alias("text"), parse_date(F.col(quoted(table.columns[0]))).alias("day")
    ).first()
    if row is None or row["day"] is None:
        raise ValueError(f"no date in {path}: {row['text'] if row else None!r}")
    return row["day"]


def read_universe(
    spark: SparkSession, folder: str, month: str | None = None, key: str = KEY, city: str = CITY
) -> DataFrame:
    """Daily universe files as one table (NIO, MUNICIPIO, DATA).

    The day comes from the file name, so a filter on DATA leaves the other days'
    files unread. Missing days have no rows. ``key`` and ``city`` are the files' column
    names. Days may differ in their columns' types: their footers are read on
    executors, and days of equal types make one scan.
    """
    root = folder.rstrip("/")
    pattern = f"{root}/{UNIVERSE_GLOB.format(day=f'{month}-??' if month else '????-??-??')}"

    def rows(*paths: str) -> DataFrame:
        from_name = F.regexp_extract(F.col("_metadata.file_path"), UNIVERSE_NAME, 1)
        return read_parquet(spark, *paths).select(
            F.col(quoted(key)).cast("string").alias(KEY),
            F.col(quoted(city)).cast("string").alias(CITY),
            F.to_date(from_name).alias(DAY),
        )

    groups = _alike_days(spark, root, pattern, key, city)
    if not groups:
        return spark.createDataFrame([], UNIVERSE_SCHEMA)
    return reduce(DataFrame.unionByName, [rows(*paths) for paths in groups])


def _alike_days(spark: SparkSession, root: str, pattern: str, key: str, city: str) -> list[list[str]]:
    """Paths of the days whose files have the same types.

    A pattern names the days of a group, of which there are no more than the calendar
    has; only a day whose own files differ is named file by file.
    """
    types = listed_files(spark, pattern).mapInArrow(_footers([key, city]), "path string, types string")
    days = types.withColumn("day", F.regexp_extract("path", UNIVERSE_NAME, 1)).groupBy("day").agg(
        F.collect_set("types").alias("types")
    )
    groups = days.groupBy("types").agg(F.sort_array(F.collect_list("day")).alias("days")).collect()
    if len(groups) == 1 and len(groups[0]["types"]) == 1:
        return [[pattern]]
    of = lambda days: f"{root}/{UNIVERSE_GLOB.format(day='{' + ','.join(days) + '}')}"
    paths = [[of(g["days"])] for g in groups if len(g["types"]) == 1]
    if mixed := [day for g in groups if len(g["types"]) > 1 for day in g["days"]]:
        files = listed_files(spark, of(mixed)).mapInArrow(_footers([key, city]), "path string, types string")
        named = files.groupBy("types").agg(F.collect_list("path").alias("paths"))
        paths += [g["paths"] for g in named.collect()]
    return paths


def _footers(names: list[str]):
    """The types of some columns of Parquet files, read from their footers alone."""

    def run(batches):
        import re
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def types(path):
            if path.startswith("file:"):
                files, path = fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
            else:
                files, path = fs.FileSystem.from_uri(quote(path, safe=":/@"))
            schema = pq.read_schema(path, filesystem=files)
            return str([str(schema.field(n).type) if n in schema.names else None for n in names])

        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array([types(p) for p in paths], pa.string())], ["path", "types"]
            )

    return run


def read_brands(spark: SparkSession, path: str, key: str = KEY, brand: str = BRAND) -> DataFrame:
    """The brand table under its usual names, empty if it does not exist."""
    return read_or_empty(
        spark,
        lambda: read_parquet(spark, path).select(
            F.col(quoted(key)).cast("string").alias(KEY), F.col(quoted(brand)).cast("string").alias(BRAND)
        ),
        BRAND_SCHEMA,
    )


def month_pattern(folder: str, suffix: str) -> str:
    return f"{folder.rstrip('/')}/{any_case('municipio_')}????-??.{any_case(suffix)}"


def _stored_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``month`` and ``suffix`` of the files of stored month results."""
    files = listed_files(spark, *(month_pattern(folder, suffix) for suffix in ("csv", "parquet")))
    month = F.regexp_extract("path", MONTH_RESULT_NAME, 1)
    return files.select(
        "path", month.alias("month"), F.lower(F.regexp_extract("path", MONTH_RESULT_NAME, 2)).alias("suffix")
    ).where(month != "")


def month_files(spark: SparkSession, folder: str) -> DataFrame:
    """The stored month results of a folder (``month``, ``suffix``), those without rows included."""
    return _stored_files(spark, folder).select("month", "suffix").distinct().orderBy("month", "suffix")


MONTH_ROWS = (
    "file_path string, month string, suffix string, reason string,"
    " names array<string>, types array<string>, cells array<string>"
)


def read_month_results(spark: SparkSession, folder: str) -> tuple[DataFrame | None, DataFrame]:
    """All stored month results, and the files that can't be read.

    The rows have the result's columns by name and type, in whatever order or type a
    file has them; columns beyond these, as text unless all files agree on their type;
    and ``file_path``, ``month`` and ``suffix``. They are None if there is nothing to
    read. A result may be a file, a folder of files or a table that grew by day. The
    other table has ``file_path`` and ``reason``; each such file is also logged.

    One pass reads every file once, in tasks, and stores its rows as text under its
    own column names, or why it can't be read; a file that breaks midway is left out
    whole. A second, small job brings each file's column names and types to the
    driver. Month results are small, a row per city, brand and day: a task holds one
    file at a time.
    """
    path = shared_folder(spark)
    _stored_files(spark, folder).mapInArrow(_month_rows(), MONTH_ROWS).write.parquet(path)
    stored = spark.read.schema(MONTH_ROWS).parquet(path)
    files = stored.where("cells IS NULL").select("file_path", "reason", "names", "types").collect()
    for file in sorted(files, key=lambda f: f["file_path"]):
        if file["reason"]:
            logger.warning("left out %s: %s", file["file_path"], file["reason"])
    left_out = stored.where("cells IS NULL AND reason IS NOT NULL").select("file_path", "reason")
    kinds: dict[str, set[str]] = {}
    for file in sorted(files, key=lambda f: f["file_path"]):
        for name, kind in zip(file["names"] or (), file["types"] or ()):
            kinds.setdefault(name, set()).add(kind)
    if not kinds:
        return None, left_out
    wanted = {f.name: f.dataType.simpleString() for f in RESULT_SCHEMA}
    ordered = [n for n in wanted if n in kinds] + [n for n in kinds if n not in wanted]
    columns = [_month_column(n, wanted.get(n) or (min(kinds[n]) if len(kinds[n]) == 1 else "string")) for n in ordered]
    return stored.where("cells IS NOT NULL").select(*columns, "file_path", "month", "suffix"), left_out


def _month_column(name: str, kind: str) -> Column:
    """A column of the stored cells under its type; counts may be written with a fraction of zero."""
    place = F.array_position("names", name).cast("int")
    text = F.when(place > 0, F.get("cells", place - 1))
    if kind == "bigint":
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint")).alias(name)
    return (text if kind == "string" else text.try_cast(kind)).alias(name)


def _month_rows():
    """A file's rows as text, after a row with its columns; or a row with the reason why it has none."""

    def run(batches):
        import re
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.csv as pc
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_type

        def read(path, suffix):
            if path.startswith("file:"):
                files, path = fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
            else:
                files, path = fs.FileSystem.from_uri(quote(path, safe=":/@"))
            if suffix == "parquet":
                return pq.read_table(path, filesystem=files, partitioning=None)
            with files.open_input_stream(path, compression="detect") as stream:
                data = stream.read()
            if not data.strip():
                return pa.table({})
            parse = pc.ParseOptions(newlines_in_values=True)
            names = pc.read_csv(pa.py_buffer(data), parse_options=parse).column_names
            convert = pc.ConvertOptions(
                column_types={n: pa.string() for n in names}, null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=False
            )
            return pc.read_csv(pa.py_buffer(data), parse_options=parse, convert_options=convert)

        def kind(type_):
            try:
                return from_arrow_type(type_).simpleString()
            except Exception:  # a type that Spark doesn't have is shown as text
                return "string"

        def text(column):
            try:
                return column.cast(pa.string()).to_pylist()
            except pa.ArrowException:
                return [None if v is None else str(v) for v in column.to_pylist()]

        def batch(rows):
            types = [pa.string()] * 4 + [pa.list_(pa.string())] * 3
            names = ["file_path", "month", "suffix", "reason", "names", "types", "cells"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for listed in batches:
            for path, month, suffix in zip(*(c.to_pylist() for c in listed.columns)):
                try:
                    table = read(path, suffix)
                    cells = [text(c) for c in table.columns]
                except (pa.ArrowException, OSError, UnicodeDecodeError) as error:
                    reason = str(error).strip().split("\n")[0][:300] or type(error).__name__
                    yield batch([(path, month, suffix, reason, None, None, None)])
                    continue
                names, types = table.column_names, [kind(t) for t in table.schema.types]
                yield batch([(path, month, suffix, None, names, types, None)])
                for at in range(0, table.num_rows, 4096):
                    rows = zip(*(c[at:at + 4096] for c in cells))
                    yield batch([(path, month, suffix, None, names, None, r) for r in rows])

    return run

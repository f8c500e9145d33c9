"""Tables from CSV and Parquet, one file or a folder of both."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellwatt.functions.scalars import quoted
from tellwatt.vocabulary import CSV_NOTHING, CSV_TEXT, DEFAULT_DELIMITER, DELIMITERS

CSV_SUFFIXES = (".csv", ".txt")
PARQUET_SUFFIXES = (".parquet", ".pq")


def read_parquet(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_csv(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    delimiter: str = DEFAULT_DELIMITER,
    encoding: str = "UTF-8",
    rejects: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. Without a schema every column is text, so keys keep their zeros.

    A field that does not fit its type becomes null. ``rejects`` names a column of
    the schema that takes the text of such a record. A quoted empty field is an empty
    text, one with nothing in it null. Fields with line breaks need ``multi_line``,
    with which a file is read by one task.
    """
    reader = (
        spark.read.options(**CSV_TEXT)
        .option("nullValue", CSV_NOTHING)
        .option("multiLine", multi_line)
        .option("header", True)
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
    )
    if rejects:
        reader = reader.option("columnNameOfCorruptRecord", rejects)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(list(paths))


def read_table(spark: SparkSession, path: str, delimiter: str = DEFAULT_DELIMITER) -> DataFrame:
    """CSV or Parquet, told apart by the file name's ending."""
    name = path.rstrip("/").lower()
    if name.endswith(CSV_SUFFIXES):
        return read_csv(spark, path, delimiter=delimiter)
    if name.endswith(PARQUET_SUFFIXES):
        return read_parquet(spark, path)
    raise ValueError(f"neither CSV nor Parquet: {path}")


def any_case(text: str) -> str:
    """A path pattern that matches ``text`` in upper and lower case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)


def read_if_present(read) -> DataFrame | None:
    """What ``read`` returns, or None when its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    found = read_if_present(read)
    return spark.createDataFrame([], schema) if found is None else found


def listed_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path`` of each file at these paths or patterns, however deep; contents stay unread.

    Paths that don't exist have no files.
    """
    parts = [
        read_if_present(lambda p=p: spark.read.format("binaryFile").option("recursiveFileLookup", True).load(p).select("path"))
        for p in paths
    ]
    found = [p for p in parts if p is not None]
    if not found:
        return spark.createDataFrame([], "path string")
    return reduce(DataFrame.unionByName, found)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files at a path or pattern, in order; it brings a name per file to the driver."""
    return sorted(r["path"] for r in listed_files(spark, path).collect())


def first_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``file_path`` and ``first_line`` of each file at these paths or patterns, however deep.

    Tasks take the listed paths in groups and read each file's beginning up to its
    first line break, so the work follows the number of files, not their size, and
    neither paths nor lines meet on the driver. A file with an ending such as ``.gz``
    is unpacked; empty files have no row. Files are opened by their scheme, from
    within Python: what only Hadoop's clients can open needs these on the executors.
    """
    return listed_files(spark, *paths).mapInArrow(_beginnings(), "file_path string, first_line string")


def _beginnings():
    def run(batches):
        import re
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        def line(path):
            if path.startswith("file:"):
                files, path = fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
            else:
                files, path = fs.FileSystem.from_uri(quote(path, safe=":/@"))
            with files.open_input_stream(path, compression="detect") as stream:
                text = b""
                while part := stream.read(1 << 16):
                    ends = [at for at in (part.find(b"\n"), part.find(b"\r")) if at >= 0]
                    text += part[: min(ends)] if ends else part
                    if ends:
                        return text.decode("utf-8", "replace")
                return text.decode("utf-8", "replace") if text else None

        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array([line(p) for p in paths], pa.string())], ["file_path", "first_line"]
            )

    return run


def delimiter_in(line: Column) -> Column:
    """The first of the known delimiters, by preference, that a line has."""
    return F.coalesce(*(F.when(F.contains(line, F.lit(d)), F.lit(d)) for d in DELIMITERS), F.lit(DEFAULT_DELIMITER))


def detect_delimiter(spark: SparkSession, path: str) -> str:
    """The preferred delimiter in the first line of a file, or of the first by path.

    Reads only the beginning of that file.
    """
    file = listed_files(spark, path).agg(F.min("path")).first()[0]
    line = spark.read.text(file).limit(1) if file else None
    found = line.select(delimiter_in(F.col("value"))).first() if line is not None else None
    return found[0] if found else DEFAULT_DELIMITER


def delimiters_by_file(spark: SparkSession, path: str) -> DataFrame:
    """``file_path``, ``first_line`` and ``delimiter`` of each file below ``path``."""
    return first_lines(spark, path).withColumn("delimiter", delimiter_in(F.col("first_line")))


def read_folder(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """All CSV and Parquet files of a folder as one table, with their ``file_path``.

    Parquet files give the types when there are any; CSV fields that do not fit
    become null. Without Parquet, every column is text.
    """
    root = path.rstrip("/")

    def parquet() -> DataFrame | None:
        return read_if_present(lambda: read_parquet(spark, f"{root}/*.{{{any_case('parquet')},{any_case('pq')}}}"))

    def csv() -> DataFrame | None:
        pattern = f"{root}/*.{any_case('csv')}"
        return read_if_present(
            lambda: read_csv(spark, pattern, delimiter=delimiter or detect_delimiter(spark, pattern))
        )

    typed, text = parquet(), csv()
    parts = []
    if typed is not None:
        parts.append(typed.select("*", F.col("_metadata.file_path").alias("file_path")))
    if text is not None:
        fields = typed.schema if typed is not None else text.schema
        missing = set(fields.names) ^ set(text.columns)
        if missing:
            raise ValueError(f"CSV and Parquet columns differ: {sorted(missing)}")
        cells = [F.col(quoted(f.name)).try_cast(f.dataType).alias(f.name) for f in fields]
        parts.append(text.select(*cells, F.col("_metadata.file_path").alias("file_path")))
    if not parts:
        raise FileNotFoundError(f"no CSV or Parquet in {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def with_file_order(df: DataFrame, name: str = "_order") -> DataFrame:
    """A number that grows with a row's place in its file; put it right above the read."""
    return df.withColumn(name, F.monotonically_increasing_id())

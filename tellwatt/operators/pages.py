"""Row positions in files: pages, file boundaries and totals."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tellwatt.functions.scalars import quoted
from tellwatt.sources.tables import (
    CSV_SUFFIXES, PARQUET_SUFFIXES, list_files, read_csv, read_folder, read_parquet, read_table,
)


def block_boundaries(df: DataFrame) -> DataFrame:
    """First and last row number of each block, blocks in path and offset order.

    ``df`` has ``file_path`` and ``block``. Numbering runs over one row per block,
    not over the table.
    """
    counts = df.groupBy("file_path", "block").agg(F.count("*").alias("rows"))
    return running_bounds(counts, "file_path", "block")


def running_bounds(counts: DataFrame, *order: str) -> DataFrame:
    end = F.sum("rows").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return counts.withColumn("end_row", end - 1).withColumn("start_row", F.col("end_row") - F.col("rows") + 1)


def with_position(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def rows_by_file(df: DataFrame) -> DataFrame:
    return df.groupBy("file_path").agg(F.count("*").alias("rows"))


def file_boundaries(df: DataFrame) -> DataFrame:
    """Per file: rows, first and last row number over all files in path order.

    ``df`` has ``file_path``, as ``with_position`` and ``read_folder`` give it.
    """
    return running_bounds(rows_by_file(df), "file_path")


def folder_totals(df: DataFrame, columns: int) -> DataFrame:
    """One row: files, rows and the number of columns."""
    return rows_by_file(df).agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.lit(columns).alias("columns"),
    )


def path_of(file_path: str) -> str:
    """A file's path as readers take it; metadata columns have it encoded as a URL."""
    return unquote(file_path)


def first_file_columns(spark: SparkSession, df: DataFrame) -> list[str]:
    """Column names of the first file by path, which speaks for a whole folder.

    ``df`` has ``file_path`` or comes right from files.
    """
    path = "file_path" if "file_path" in df.columns else "_metadata.file_path"
    first = df.agg(F.min(path)).first()[0]
    return read_table(spark, path_of(first)).columns if first else []


def _is_csv(path: str) -> bool:
    return path.lower().endswith(CSV_SUFFIXES)


def numbered(spark: SparkSession, starts: dict[str, int], csv: bool) -> DataFrame:
    """The rows of these files with ``row_number``, counted on from each file's start.

    Rows stay in the tasks that read them: what is joined to them is a row per block.

    Parquet knows a row's place in its file. A CSV file is read in blocks; rows are
    counted per block and numbered in the same query over the same files, so both see
    the same blocks.
    """
    first = F.create_map(*(F.lit(x) for pair in starts.items() for x in pair))
    paths = [path_of(p) for p in sorted(starts)]
    if not csv:
        place = first[F.col("_metadata.file_path")] + F.col("_metadata.row_index")
        return read_parquet(spark, *paths).select("*", place.alias("row_number"))
    rows = with_position(read_csv(spark, *paths)).withColumn("_order", F.monotonically_increasing_id())
    blocks = rows.groupBy("file_path", "block").agg(F.count("*").alias("_rows"), F.min("_order").alias("_first"))
    before = F.sum("_rows").over(W.partitionBy("file_path").orderBy("block")) - F.col("_rows")
    blocks = blocks.withColumn("_start", first[F.col("file_path")] + before)
    placed = rows.join(F.broadcast(blocks), ["file_path", "block"])
    number = F.col("_start") + F.col("_order") - F.col("_first")
    return placed.withColumn("row_number", number).drop("file_path", "block", "_order", "_rows", "_first", "_start")


def page(spark: SparkSession, path: str, row: int, context: int = 5, csv: bool = False) -> DataFrame:
    """Rows ``row - context`` to ``row + context`` of a table, with their ``row_number``.

    ``path`` is a file or a folder of files; ``csv`` says that files without an ending
    are CSV. A folder may hold both formats under the same columns, all text then.
    Two steps: count rows per file (Parquet counts come from footers), then number
    those of the files that hold the page; at most one file per page row is named to
    the driver. Every number of the page has a row, or the query fails.
    """
    files = list_files(spark, path)
    kinds = {"csv" if _is_csv(f) else "parquet" if f.lower().endswith(PARQUET_SUFFIXES) else "" for f in files} - {""}
    if len(kinds) == 2:
        rows = read_folder(spark, path)
    else:
        rows = with_position(read_csv(spark, path) if csv or kinds == {"csv"} else read_parquet(spark, path))
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    bounds = file_boundaries(rows.select("file_path")).withColumn("last_row", F.max("end_row").over(whole))
    low, high = max(row - context, 0), row + context
    holding = bounds.where((F.col("rows") > 0) & (F.col("end_row") >= low) & (F.col("start_row") <= high))
    held = holding.select("file_path", "start_row", "last_row").collect()
    last = held[0]["last_row"] if held else -1
    if not 0 <= row <= last:
        raise IndexError(f"row {row} is outside the table")
    starts = {b["file_path"]: b["start_row"] for b in held}
    parts = []
    for kind in (True, False):
        of_kind = {p: s for p, s in starts.items() if (_is_csv(p) or csv and not p.lower().endswith(PARQUET_SUFFIXES)) == kind}
        if of_kind:
            parts.append(numbered(spark, of_kind, kind))
    if len(parts) == 2:
        parts = [p.select(*(F.col(quoted(c)).cast("string").alias(c) if c != "row_number" else F.col(c) for c in p.columns)) for p in parts]
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    found = found.where(F.col("row_number").between(low, high)).withColumn("_found", F.lit(True))
    wanted = spark.range(low, min(high, last) + 1).withColumnRenamed("id", "row_number")
    missed = F.raise_error(F.concat(F.lit("no row with number "), F.col("row_number").cast("string"))).cast("bigint")
    checked = F.when(F.col("_found").isNull(), missed).otherwise(F.col("row_number"))
    joined = wanted.join(found, "row_number", "left").withColumn("row_number", checked)
    return joined.select(*(quoted(c) for c in found.columns if c not in ("row_number", "_found")), "row_number")

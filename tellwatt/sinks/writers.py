"""Writing tables. Spark's task retries and commit protocol cover failed writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tellwatt.functions.dates import iso
from tellwatt.sources.tables import read_csv
from tellwatt.vocabulary import CSV_TEXT, DAY, DAY_FOLDER, ORIGIN


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """CSV with a header. With ``compression``, a codec's name, files get its ending, by which readers unpack them."""
    df.write.mode(mode).options(**CSV_TEXT).option("header", True).csv(path, compression=compression)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet when asked for, CSV for any other format name."""
    if fmt.lower() == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        write_csv(df, path, mode)


def append_days(df: DataFrame, path: str, fmt: str = "parquet", fresh: bool = False) -> None:
    """Add a batch of days to a table with a folder per day.

    A day written before is replaced, so a repeated run changes nothing; an empty
    batch leaves the table as it is. ``fresh`` starts over. Folders are named by a
    copy of DATA, so that each file holds all columns.
    """
    overwrite = "static" if fresh else "dynamic"
    (
        # Groups a day's rows into few files and lets AQE split a large day.
        df.withColumn(DAY_FOLDER, df[DAY])
        .hint("rebalance", DAY_FOLDER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .options(**CSV_TEXT)
        .option("header", True)
        .partitionBy(DAY_FOLDER)
        .format("parquet" if fmt.lower() == "parquet" else "csv")
        .save(path)
    )


def write_flags(flags: DataFrame, path: str) -> None:
    """Flags of all origins in one table; an origin's flags are a partition of it."""
    days = flags.withColumn(DAY, iso(flags[DAY])).hint("rebalance", ORIGIN, DAY)
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(ORIGIN, DAY).parquet(path)


def csv_to_parquet(spark, csv: str, parquet: str, schema: T.StructType | None = None) -> None:
    read_csv(spark, csv, schema=schema).write.mode("overwrite").parquet(parquet)

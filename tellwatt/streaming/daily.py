"""Days that arrive one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tellwatt.vocabulary import CSV_TEXT, DAY, DAY_FOLDER


def append_days_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "csv") -> StreamingQuery:
    """Append the batches at hand to a table with a folder per day, each exactly once."""
    return (
        df.withColumn(DAY_FOLDER, df[DAY])
        .writeStream.format(fmt)
        .options(**CSV_TEXT)
        .option("header", True)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(DAY_FOLDER)
        .trigger(availableNow=True)
        .start()
    )

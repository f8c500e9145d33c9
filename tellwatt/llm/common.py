"""What several of the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tellwatt.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
LOWER_BYTES = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows written to a new table in the shared folder, and read from it.

    It cuts the lineage: work above is done once, and a lost executor costs only
    the reading of that table.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hands memory that is free within a Python worker back to the system.

    Workers outlive their tasks and would keep it, beside an executor's heap.
    """
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def giving_back(run):
    """The function of a task, which gives memory back when it is through."""

    def through(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return through


def pieces(batches, rows: int = 256):
    """Arrow batches in slices of so many rows, to bound what a task holds decoded."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column) -> list:
    """A text column as bytes; nulls stay None."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def word_lists(text: bytes, size: int = 1 << 18):
    """The words of a text in lists made of about ``size`` bytes each."""
    import re

    space = re.compile(rb"[\x20\x09-\x0D]")
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > size and (cut := space.search(text, start + size)):
            end = cut.start()
        yield text[start:end].split()
        start = end + 1


def documents(df: DataFrame) -> DataFrame:
    """Only the columns of ``documents``, so that no other can clash with one that is added."""
    return df.select(*DOCUMENT_COLUMNS)


def packed(*columns) -> bytes:
    """Numpy columns as bytes: lengths and types, then each column's bytes by significance, compressed."""
    import pickle

    import numpy as np
    import zstandard

    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    head = pickle.dumps([(c.dtype.str, len(c)) for c in columns])
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(planes))


def unpacked(data: bytes) -> list:
    import pickle

    import numpy as np
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    at = 4 + int.from_bytes(raw[:4], "little")
    columns = []
    for kind, length in pickle.loads(raw[4:at]):
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, length * size, at).reshape(size, length)
        columns.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += length * size
    return columns

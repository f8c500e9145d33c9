"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellwatt.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every linked node but roots.

    Alternates the two star steps: each node passes its smallest neighbour first to
    its larger neighbours, then to its smaller ones, until nothing changes. Every
    pass leaves a table of links no longer than the one before; nothing but its
    length and checksum reaches the driver. Links with a null end and loops count
    for nothing; no links give no rows.
    """
    now = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    before, state = None, _state(now)
    while state != before:
        now = stored(_small_star(_large_star(now)))
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(links: DataFrame) -> tuple:
    # Sums of two hashes, each short enough that the sum of very many of them fits.
    mixed = F.xxhash64("u", "v")
    row = links.agg(
        F.count("*"), F.sum(F.shiftrightunsigned(mixed, 32)), F.sum(mixed.bitwiseAND(0xFFFFFFFF))
    ).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # Here u > v on every row.
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    lower = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.union(least.select("u", F.col("m").alias("v"))).distinct()

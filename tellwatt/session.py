"""Session settings that the plans in this package count on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# AQE joins small sides by broadcast and large ones by shuffled hash or sort-merge,
# by the sizes it measures; it also splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # The JVM never compiles methods longer than this. Wide tables make such methods;
    # Spark then runs the operator in smaller ones, about twice as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tellwatt")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder that every executor can read and write.

    It lies below ``spark.checkpoint.dir``; a local master may do without that
    setting, and its warehouse takes the folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tellwatt-{uuid.uuid4().hex}"

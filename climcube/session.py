"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: partition coalescing, skew splits, and joins changed
    # to a broadcast once the shuffled size of a side has been measured.  Sides
    # that are small by estimate are broadcast by the static threshold as usual.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the Python call site of every column costs more than building
    # the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    """The settings on any builder, a cluster's too; ``extra`` comes on top."""
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder


def local_session(cores: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("climcube")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    spark = configure(builder, **extra).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Expected coverage, generated on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def request_calendar(spark: SparkSession, first_year: int = 1950, last_year: int = 2024) -> DataFrame:
    """One row per requested year and month."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return years.select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))


"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climcube.functions import values
from climcube.schema import SERIES_KEYS


def duplicate_report(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, year: str = "year") -> DataFrame:
    """Times that occur more than once in a series."""
    return df.groupBy(*keys, year).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def series_profile(df: DataFrame, keys: Sequence[str], year: str = "year",
                   variable: str = "variable") -> DataFrame:
    """Extent, number of distinct years and variables of each series.

    Rows are first reduced to distinct (series, year, variable), so the second
    step sees a handful of rows per series.
    """
    distinct = df.groupBy(*keys, year, variable).agg(F.count(F.lit(1)).alias("_n"))
    return distinct.groupBy(*keys).agg(
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        F.count_distinct(year).alias("n_years"),
        F.sum("_n").alias("n_rows"),
        F.array_sort(F.collect_set(variable)).alias("variables"),
    )


def coverage_gaps(
    observed: DataFrame, keys: Sequence[str], first_year: int, last_year: int
) -> DataFrame:
    """Expected months of each series that have no data."""
    masks = month_masks(observed, keys, first_year, last_year)
    missing = F.filter(
        F.sequence(F.lit(1), F.lit(12)), lambda m: F.getbit(F.col("mask"), m - 1) == 0
    )
    return masks.select(*keys, "year", F.explode(missing).alias("month"))


def month_masks(observed: DataFrame, keys: Sequence[str], first_year: int, last_year: int) -> DataFrame:
    """Months with data as bits of ``mask``, for every expected year of each series.

    One scan and no join: months are united per year with map-side combine,
    then the years of a series, as many as the span has, meet in one row.
    """
    per_year = observed.groupBy(*keys, "year").agg(
        F.bit_or(F.expr("shiftleft(1, month - 1)")).alias("mask")
    )
    expected = F.when(
        F.col("year").between(first_year, last_year), F.struct("year", F.coalesce("mask", F.lit(0)).alias("mask"))
    )
    years = per_year.groupBy(*keys).agg(F.map_from_entries(F.collect_list(expected)).alias("_years"))
    spread = years.select(
        *keys, "_years", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year")
    )
    return spread.select(
        *keys, "year", F.coalesce(F.try_element_at("_years", F.col("year")), F.lit(0)).alias("mask")
    )


def missing_months(calendar: DataFrame, observed: DataFrame) -> DataFrame:
    """Requested months without data, counted per year (years without a gap stay, with 0)."""
    have = observed.select("year", "month").distinct().withColumn("_have", F.lit(1))
    return (
        calendar.join(have, ["year", "month"], "left")
        .groupBy("year")
        .agg((F.count(F.lit(1)) - F.count("_have")).alias("n_missing"))
    )


def split_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the first reason that applies.

    A rule is a reason and a condition that is true for a bad row.  Bad rows
    never stop a run; they end in the second table.  Either table works out the rules
    once a row.
    """
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules])
    marked = df.withColumn("reason", values.finished(reason))
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")

"""Reductions along time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from climcube.config import HISTORICAL
from climcube.schema import BASELINE_KEYS, CELL, SERIES_KEYS


def select_years(df: DataFrame, first: int, last: int, by: str = "year") -> DataFrame:
    """Years from ``first`` to ``last``, both included.

    ``by="time_label"`` tests the raw decimal label instead, which drops a
    mid-year label of the last year.
    """
    return df.filter(F.col(by).between(first, last))


def merge_time(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Concatenate tables of one kind along time."""
    return reduce(lambda a, b: a.unionByName(b), others, first)


def yearly_mean(grid: DataFrame, keys: Sequence[str] = (*SERIES_KEYS, *CELL)) -> DataFrame:
    """Plain mean of a year's time steps, missing values skipped.

    The mean is combined on the map side, so what is shuffled is one row per
    key and task however often a key occurs.
    """
    return grid.groupBy(*keys, "year").agg(
        F.avg("value").alias("value"), F.count("value").alias("n_steps")
    )


def mean_over_time(grid: DataFrame, keys: Sequence[str], result: str = "value") -> DataFrame:
    return grid.groupBy(*keys).agg(F.avg("value").alias(result), F.count("value").alias("n_steps"))


def climatology(
    grid: DataFrame,
    first: int,
    last: int,
    experiment: str | None = HISTORICAL,
    keys: Sequence[str] = BASELINE_KEYS,
) -> DataFrame:
    """Baseline mean per model and cell.

    ``experiment=None`` takes the baseline from the table's own rows, as for an
    observation set.
    """
    rows = select_years(grid, first, last)
    if experiment is not None:
        rows = rows.filter(F.col("experiment") == experiment)
    return mean_over_time(rows, keys, "clim")


def period_mean(
    grid: DataFrame, first: int, last: int, keys: Sequence[str] = (*SERIES_KEYS, *CELL)
) -> DataFrame:
    """Mean over a period per series and cell."""
    return mean_over_time(select_years(grid, first, last), keys)


def monthly_to_annual(monthly: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    """Annual climatology: mean of the monthly layers, each with equal weight."""
    return monthly.groupBy(*keys).agg(F.avg("climatology").alias("climatology"))


def dedupe_time(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], year: str = "year"
) -> DataFrame:
    """First row per series and year in a stated order.

    The test ``row_number() = 1`` lets the optimizer trim every group to one
    row per task before the shuffle, so an often repeated time stays cheap.
    """
    w = Window.partitionBy(*keys, year).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")

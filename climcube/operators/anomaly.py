"""Alignment with a climatology, and anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climcube.config import HISTORICAL
from climcube.schema import BASELINE_KEYS


def align(
    grid: DataFrame, layer: DataFrame, keys: Sequence[str] = BASELINE_KEYS, salts: int = 1
) -> DataFrame:
    """Repeat a time-independent layer over the time steps of a grid.

    Only cells on both sides survive.  There is no broadcast hint: AQE decides
    from the measured size of the layer, which grows with the resolution.  A
    cell with very many time steps is split by AQE's skew join, or, where the
    plan gives AQE no such choice, by ``salts``: the layer (one row per key) is
    repeated that often and the grid rows are spread by a hash of their values,
    which a re-run task reproduces.
    """
    if salts <= 1:
        return grid.join(layer, list(keys))
    spread = F.pmod(F.xxhash64(*grid.columns), F.lit(salts)).cast("int")
    copies = layer.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    return grid.withColumn("_salt", spread).join(copies, [*keys, "_salt"]).drop("_salt")


def subtract(aligned: DataFrame, value: str = "value", base: str = "clim",
             result: str = "anomaly") -> DataFrame:
    """Cell-wise difference, missing when either side is."""
    return aligned.withColumn(result, F.col(value) - F.col(base))


def add(aligned: DataFrame, anomaly: str, base: str, result: str = "value") -> DataFrame:
    """Cell-wise sum: an anomaly on top of a climatology is an absolute value."""
    return aligned.withColumn(result, F.col(anomaly) + F.col(base))


def anomalies(
    grid: DataFrame, clim: DataFrame, keys: Sequence[str] = BASELINE_KEYS, salts: int = 1
) -> DataFrame:
    """Anomalies of any grid against a stored climatology."""
    layer = clim.select(*keys, "clim")
    return subtract(align(grid, layer, keys, salts))


def rebase(
    yearly: DataFrame,
    first: int,
    last: int,
    experiment: str | None = HISTORICAL,
    keys: Sequence[str] = BASELINE_KEYS,
) -> DataFrame:
    """Anomalies of a *yearly* grid against its own baseline period, without a join.

    Equal to ``anomalies(yearly, climatology(yearly, ...))``, but the table is
    read and shuffled once.  Use it only behind ``yearly_mean``: then one window
    group holds at most one row per experiment and year of one cell.
    """
    in_baseline = F.col("year").between(first, last)
    if experiment is not None:
        in_baseline = in_baseline & (F.col("experiment") == experiment)
    w = Window.partitionBy(*keys)
    based = yearly.withColumns(
        {
            "clim": F.avg(F.when(in_baseline, F.col("value"))).over(w),
            "_baseline_rows": F.count(F.when(in_baseline, F.lit(1))).over(w),
        }
    )
    return subtract(based.filter("_baseline_rows > 0").drop("_baseline_rows"))


def series_without_baseline(
    grid: DataFrame, first: int, last: int, experiment: str = HISTORICAL,
    keys: Sequence[str] = ("variable", "model"),
) -> DataFrame:
    """The same as ``models_without_baseline`` from the grid itself, read once and without a climatology."""
    in_baseline = (F.col("experiment") == experiment) & F.col("year").between(first, last)
    found = grid.groupBy(*keys, "experiment").agg(F.bool_or(in_baseline).alias("_has"))
    of_model = Window.partitionBy(*keys)
    return found.withColumn("_has", F.bool_or("_has").over(of_model)).filter(
        "NOT coalesce(_has, false)"
    ).drop("_has")


def models_without_baseline(
    grid: DataFrame, clim: DataFrame, keys: Sequence[str] = ("variable", "model")
) -> DataFrame:
    """Series that ``anomalies`` must skip because their model has no climatology."""
    have = clim.select(*keys).distinct()
    series = grid.select(*keys, "experiment").distinct()
    return series.join(have, list(keys), "left_anti")

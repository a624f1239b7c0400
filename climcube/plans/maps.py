"""Ensemble maps of the change between the baseline and a future period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climcube.config import LEVEL_EDGES, RunConfig
from climcube.functions.geometry import cell_degrees
from climcube.operators import catalog, ensemble, space
from climcube.plans.series import regional_yearly


def change_per_model(grid: DataFrame, cfg: RunConfig) -> DataFrame:
    """Change per model, scenario and cell inside the regions of a run."""
    chosen = catalog.keep_series(grid, cfg.variable, cfg.experiments)
    yearly = regional_yearly(catalog.keep_models(chosen, cfg.map_models), cfg)
    return ensemble.change_per_model(yearly, cfg.baseline, cfg.future, cfg.scenarios)


def change_map(grid: DataFrame, cfg: RunConfig) -> DataFrame:
    """Mean change over models per scenario, region and cell.

    A cell in several regions of the run is a row of each; the mean is computed once.
    """
    means = ensemble.ensemble_mean(change_per_model(grid, cfg))
    cells = means.select(
        "variable",
        "experiment",
        cell_degrees(F.col("lat_q")).alias("lat"),
        cell_degrees(F.col("lon_q")).alias("lon"),
        "anomaly",
        "n_models",
    )
    return space.assign_regions(cells, cfg.regions)


def classified_map(grid: DataFrame, cfg: RunConfig, digits: int | None = None) -> DataFrame:
    """The change map with the index of its display level.

    ``digits`` rounds the change first, so a value that is an edge up to
    floating-point noise falls into a defined level.
    """
    maps = change_map(grid, cfg)
    if digits is not None:
        maps = maps.withColumn("anomaly", F.round("anomaly", digits))
    return ensemble.classify(maps, LEVEL_EDGES[cfg.variable])

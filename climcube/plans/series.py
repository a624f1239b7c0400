"""Anomaly series of models and observations, and their ensemble spread."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climcube.config import HISTORICAL, REANALYSIS, STATIONS, RunConfig
from climcube.functions import geometry, values
from climcube.operators import anomaly, catalog, ensemble, space, temporal
from climcube.schema import CELL, SERIES_KEYS, require_columns, require_table
from climcube.sources import grids

SERIES_COLUMNS = (*SERIES_KEYS, "region", "year", "anomaly", "n_cells")


def regional_yearly(grid: DataFrame, cfg: RunConfig) -> DataFrame:
    """Yearly means of one variable inside the regions of a run.

    The box test is applied to stored columns before anything else, so it
    reaches the scan.
    """
    require_columns(grid, *SERIES_KEYS, "lat", "lon", "lat_q", "lon_q", "year", "value", what="grid")
    rows = space.select_boxes(grid.filter(F.col("variable") == cfg.variable), cfg.regions)
    return temporal.yearly_mean(rows)


def with_degrees(df: DataFrame) -> DataFrame:
    """Coordinates back from the integer cell keys, which is all that is shuffled."""
    return df.withColumns(
        {
            "lat": geometry.cell_degrees(F.col("lat_q")),
            "lon": geometry.cell_degrees(F.col("lon_q")),
        }
    )


def yearly_table(grid: DataFrame) -> DataFrame:
    """The reduced grid that series and maps share, worth storing once.

    It has the columns of a grid, so it can stand in for one in every analysis.
    """
    return with_degrees(temporal.yearly_mean(grid)).select(
        *SERIES_KEYS, "lat_q", "lon_q", "year", "lat", "lon", "value"
    )


def _regional_means(anomalies: DataFrame, cfg: RunConfig, weighting: str) -> DataFrame:
    placed = space.assign_regions(with_degrees(anomalies), cfg.regions)
    return space.field_mean(placed, weighting=weighting, spacing=cfg.spacing).select(*SERIES_COLUMNS)


def model_series(grid: DataFrame, cfg: RunConfig) -> DataFrame:
    """Area-mean anomaly per model, experiment and year.

    Every experiment meets the historical baseline of its own model; a model
    without one drops out (``models_without_baseline`` lists it).
    """
    yearly = regional_yearly(
        catalog.keep_models(catalog.keep_series(grid, cfg.variable, cfg.experiments),
                            cfg.series_models),
        cfg,
    )
    return _regional_means(anomaly.rebase(yearly, *cfg.baseline, HISTORICAL), cfg, "area")


def reanalysis_series(grid: DataFrame, cfg: RunConfig) -> DataFrame:
    """Area-mean anomaly of a reanalysis against its own baseline period."""
    yearly = regional_yearly(grid, cfg)
    return _regional_means(anomaly.rebase(yearly, *cfg.baseline, None), cfg, "area")


def station_series(stations: DataFrame, climatology: DataFrame, cfg: RunConfig) -> DataFrame:
    """Plain-mean anomaly of a station-based set.

    Its anomalies refer to another period, so they are put on top of its annual
    climatology and rebased.  ``stations`` holds ``temperature`` anomalies, one
    per cell and time step; ``climatology`` has one layer per month.  The
    stored longitude is compared without wrapping.
    """
    require_columns(stations, "year", "lat", "lon", "lat_q", "lon_q", "temperature",
                    what="station table")
    require_columns(climatology, "month_number", "lat", "lon", "lat_q", "lon_q", "climatology",
                    what="station climatology")
    rows = space.select_boxes(stations, cfg.regions, wrap=False)
    yearly = temporal.yearly_mean(rows.withColumnRenamed("temperature", "value"), CELL)
    layers = space.select_boxes(climatology, cfg.regions, wrap=False)
    absolute = anomaly.add(
        anomaly.align(yearly, temporal.monthly_to_annual(layers), CELL), "value", "climatology"
    )
    label = F.lit(STATIONS)
    labelled = absolute.withColumns(
        {"variable": F.lit(cfg.variable), "source": label, "model": label, "experiment": label}
    )
    based = with_degrees(anomaly.rebase(labelled, *cfg.baseline, None))
    placed = space.assign_regions(based, cfg.regions, wrap=False)
    return space.field_mean(placed, weighting="none").select(*SERIES_COLUMNS)


def all_series(
    models: DataFrame,
    cfg: RunConfig,
    reanalysis: DataFrame | None = None,
    stations: DataFrame | None = None,
    station_climatology: DataFrame | None = None,
) -> DataFrame:
    """Model and observation series in one table, as the run enables them.

    The station set holds temperature only and is left out for precipitation.
    A set that the run enables must be given.
    """
    parts = [model_series(models, cfg)]
    if REANALYSIS in cfg.observations:
        parts.append(reanalysis_series(require_table(reanalysis, REANALYSIS), cfg))
    if STATIONS in cfg.observations and cfg.variable == "tas":
        parts.append(
            station_series(
                require_table(stations, STATIONS), require_table(station_climatology, f"{STATIONS} climatology"), cfg
            )
        )
    return temporal.merge_time(*parts)


def load_series(files: DataFrame, variable: str) -> DataFrame:
    """One value per file, experiment and year from series as providers write them.

    ``files`` has ``file_name``, ``experiment``, ``variable``, ``value`` and a ``time`` stamp or a decimal
    ``time_label``; ``position`` is the order in the file.  A file's values are those of the best alias it holds;
    a fraction of a year is cut off, and of a repeated year the first value stays.  ``n_repeats`` counts
    the rows that gave way, and a file without any alias has no row.

    One aggregation does all of it: per alias and year the first value is a ``min_by``, which combines
    before the shuffle.  Only then, on a row per year, the best alias of a file is found.
    """
    rank = grids.alias_rank(variable, "variable")
    given = set(files.columns)
    none = F.lit(None)
    year = values.year_of_time(
        F.col("time") if "time" in given else none.cast("timestamp_ntz"),
        F.col("time_label") if "time_label" in given else none.cast("double"),
    )
    rows = files.withColumns({
        "_rank": rank, "year": year,
        "_value": values.convert_units(F.lit(variable), values.nan_to_null(F.col("value"))),
    }).filter("_rank IS NOT NULL AND year IS NOT NULL")
    # rows of one time in one file are told apart by their values, so the choice does not depend on the run
    first = F.struct("position", "_value")
    per_year = rows.groupBy("file_name", "experiment", "_rank", "year").agg(
        F.min_by(F.struct("_value"), first).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    of_file = Window.partitionBy("file_name", "experiment")
    best = per_year.withColumn("_best", F.min("_rank").over(of_file)).filter("_rank = _best")
    return best.select(
        F.lit(variable).alias("variable"), F.col("file_name").alias("model"), "experiment", "year",
        F.col("_first._value").alias("anomaly"), (F.col("_n") - 1).alias("n_repeats"),
    )


def spread_from_files(files: DataFrame, cfg: RunConfig, region: str) -> DataFrame:
    """Ensemble spread of stored series: names, units, times and repeats settled, then the quantiles.

    The series are spatial means of one region already; an experiment's files are its models.
    """
    loaded = load_series(files, cfg.variable).withColumn("region", F.lit(region))
    return ensemble_spread(loaded, cfg)


def ensemble_spread(series: DataFrame, cfg: RunConfig, dedupe: bool = False) -> DataFrame:
    """Median and quartiles over models per year, with centred running means.

    ``dedupe`` keeps the first row of a repeated year; series made here have
    none, series read from elsewhere may.
    """
    if dedupe:
        series = temporal.dedupe_time(
            series, (*SERIES_KEYS, "region"), [F.col("anomaly").asc_nulls_last()]
        )
    spread = ensemble.ensemble_quantiles(series)
    return ensemble.running_mean(spread, ["p25", "p50", "p75"], cfg.running_years)

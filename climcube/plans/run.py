"""A whole run: series, ensemble spread and change maps, each stage stored once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from climcube.config import RunConfig
from climcube.plans import maps, series
from climcube.schema import BASELINE_KEYS
from climcube.sources.store import Store


@dataclass(frozen=True)
class RunResult:
    series: DataFrame
    spread: DataFrame
    maps: DataFrame


def run(
    store: Store,
    cfg: RunConfig,
    inputs: Mapping[str, str],
    models: DataFrame,
    reanalysis: DataFrame | None = None,
    stations: DataFrame | None = None,
    station_climatology: DataFrame | None = None,
    buckets: int | None = None,
) -> RunResult:
    """Compute what is not stored yet and return all three results.

    ``inputs`` identifies the input tables (paths or versions).  Together with
    the configuration and the tables that are given it names the stored stages,
    so neither new data nor a changed setting ever meets an old result.  The
    yearly grid is the expensive stage; it is stored bucketed by cell, so series
    and maps of every region and period group its rows without a shuffle.
    """
    source = dict(inputs)
    given = [t is not None for t in (reanalysis, stations, station_climatology)]
    whole = {"inputs": source, "config": cfg, "given": given}

    yearly = store.materialize_bucketed(
        "yearly",
        {"inputs": source, "variable": cfg.variable},
        lambda: series.yearly_table(models.filter(models["variable"] == cfg.variable)),
        buckets or int(store.spark.conf.get("spark.sql.shuffle.partitions")),
        BASELINE_KEYS,
    )
    found = store.materialize(
        "series",
        whole,
        lambda: series.all_series(yearly, cfg, reanalysis, stations, station_climatology),
    )
    spread = store.materialize("spread", whole, lambda: series.ensemble_spread(found, cfg))
    change = store.materialize("maps", whole, lambda: maps.classified_map(yearly, cfg))
    return RunResult(found, spread.orderBy("experiment", "region", "year"), change)

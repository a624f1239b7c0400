"""Run configuration and the fixed dimension values."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Region:
    """A latitude/longitude box, both ends inclusive."""

    name: str
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    @property
    def spans_globe(self) -> bool:
        return self.lon_max - self.lon_min >= 360.0

    def covers(self, other: Region) -> bool:
        """Whether every cell of ``other`` lies in this box, in any longitude convention."""
        return (
            self.lat_min <= other.lat_min
            and other.lat_max <= self.lat_max
            and self.lon_min <= other.lon_min
            and other.lon_max <= self.lon_max
        )


# The priority list of climate models.
MODELS = (
    "GFDL-ESM4", "IPSL-CM6A-LR", "MPI-ESM1-2-HR", "MRI-ESM2-0", "UKESM1-0-LL",
    "CNRM-CM6-1", "CNRM-ESM2-1", "CanESM5", "EC-Earth3", "MIROC6",
)

# Region presets (lat_min, lat_max, lon_min, lon_max).
REGIONS = {
    r.name: r
    for r in (
        Region("central_asia", 35.0, 57.0, 46.0, 88.0),
        Region("global", -90.0, 90.0, -180.0, 180.0),
        Region("germany", 47.0, 55.0, 5.5, 15.5),
        Region("europe", 35.0, 72.0, -25.0, 45.0),
        Region("conus", 24.0, 49.0, -125.0, -66.5),
        Region("global_north", 0.0, 90.0, -180.0, 180.0),
    )
}

HISTORICAL = "historical"

# Future scenarios.
SCENARIOS = ("ssp126", "ssp245", "ssp370", "ssp585")

# Names under which a variable may be stored, best first.
VARIABLE_ALIASES = {
    "tas": ("tas", "var167", "temperature_anomaly"),
    "pr": ("pr", "tp", "var228"),
}

# Edges of the map levels.  They are the accumulated doubles of
# arange on purpose: the middle edge of "pr" is 5.55e-16, not 0.
LEVEL_EDGES = {
    "pr": tuple(float(e) for e in np.arange(-0.6, 0.61, 0.05)),
    "tas": tuple(float(e) for e in np.arange(-1, 8, 0.5)),
}

# Countries that get a label on the regional maps.
LABELLED_COUNTRIES = ("Kazakhstan", "Uzbekistan", "Turkmenistan", "Tajikistan", "Kyrgyzstan")

REANALYSIS = "ERA5"
STATIONS = "Berkeley"


@dataclass(frozen=True)
class RunConfig:
    """Everything that changes a result; passed explicitly, never global."""

    variable: str = "tas"
    regions: tuple[Region, ...] = (REGIONS["global_north"],)
    baseline: tuple[int, int] = (1981, 2010)
    future: tuple[int, int] = (2070, 2099)
    scenarios: tuple[str, ...] = SCENARIOS
    running_years: int = 1
    series_models: tuple[str, ...] | None = None  # None admits every model
    map_models: tuple[str, ...] | None = MODELS
    observations: tuple[str, ...] = (REANALYSIS, STATIONS)
    spacing: float | None = None  # latitude step in degrees; None uses cos(lat)

    def __post_init__(self):
        if self.variable not in VARIABLE_ALIASES:
            raise ValueError(f"unknown variable {self.variable!r}")
        for label, (first, last) in (("baseline", self.baseline), ("future", self.future)):
            if first > last:
                raise ValueError(f"{label} period ends before it starts")
        if self.running_years < 1:
            raise ValueError("running_years must be at least 1")

    @property
    def experiments(self) -> tuple[str, ...]:
        return (HISTORICAL, *self.scenarios)

"""Columns derived from values and time labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400

# Unit labels after conversion.
UNITS = {"pr": "mm/day", "tas": "°C"}


def finished(c: Column) -> Column:
    """The column through a generator, for one column of a ``select`` or ``withColumn``.

    A filter tests the finished column then.  On a plain computed one the filter is pushed below the projection,
    with a copy of all that the column is made of for every reference.
    """
    return F.explode(F.array(c))


def nan_to_null(value: Column) -> Column:
    """Missing data is NULL everywhere: NaN would poison sums and means."""
    return F.nullif(value, F.lit(float("nan")))


def convert_units(variable: Column, value: Column, unit: Column | None = None) -> Column:
    """Precipitation flux in kg/m²/s to mm/day; other variables, and values already in mm/day, unchanged."""
    flux = variable == "pr"
    if unit is not None:
        flux = flux & ~unit.eqNullSafe(F.lit(UNITS["pr"]))
    return F.when(flux, value * SECONDS_PER_DAY).otherwise(value)


def unit_label(variable: Column) -> Column:
    pairs = [p for name, unit in UNITS.items() for p in (F.lit(name), F.lit(unit))]
    return F.element_at(F.create_map(*pairs), variable)


def year_of_time(timestamp: Column, label: Column) -> Column:
    """Calendar year of a timestamp, else the truncated numeric time label."""
    return F.coalesce(F.year(timestamp), label.cast("int"))


def level_index(value: Column, edges: Sequence[float]) -> Column:
    """Index of the half-open bin holding ``value``.

    Below the first edge is -1, at or above the last edge is the number of
    bins, missing stays missing.  A sum of comparisons stays in generated code,
    which a lambda over an array of edges would not.
    """
    reached = reduce(add, [(value >= F.lit(e)).cast("int") for e in edges])
    return F.when(value.isNotNull(), reached - 1)

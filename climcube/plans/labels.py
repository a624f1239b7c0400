"""Label tables for country names on a map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from climcube.config import LABELLED_COUNTRIES, Region
from climcube.operators import countries as ops


def labels_in_box(countries: DataFrame, box: Region) -> DataFrame:
    """Name and centroid of every country that meets the box."""
    return ops.centroids(countries).join(ops.meets_box(countries, box), "name", "left_semi")


def selected_labels(
    countries: DataFrame, names: Sequence[str] = LABELLED_COUNTRIES
) -> DataFrame:
    """Name and centroid of the listed countries."""
    return ops.centroids(ops.select_countries(countries, names))

"""Country polygons: selection, box test and label positions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climcube.config import LABELLED_COUNTRIES, Region
from climcube.functions import geometry
from climcube.operators import space


#: Height of the bands that edges and cells meet on, in cell keys: a bit over a tenth of a degree.
BAND_BITS = 10
#: Most bands of one size that an edge stands under.
MOST_BANDS = 16


def edges_from_points(points: DataFrame) -> DataFrame:
    """Edges of polygons given as one corner a row: ``name, ring_id, seq, x, y``.

    Each corner meets the next one of its ring, the last one the first.  A ring
    is sorted and never gathered, so it may have any number of corners; a ring that
    repeats its first corner at the end has an edge of no length, which counts nowhere.
    """
    ring = Window.partitionBy("name", "ring_id").orderBy("seq")
    first = ring.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.struct("x", "y")
    following = F.coalesce(F.lead(here).over(ring), F.first(here).over(first))
    return points.withColumn("_next", following).select(
        "name", "ring_id", F.col("x").alias("x1"), F.col("y").alias("y1"),
        F.col("_next.x").alias("x2"), F.col("_next.y").alias("y2"),
    )


def edges_from_rings(countries: DataFrame) -> DataFrame:
    """The same from rings that are arrays."""
    edges = countries.select("name", "ring_id", F.explode(geometry.ring_edges(F.col("ring"))).alias("e"))
    return edges.select("name", "ring_id", "e.*")


def cells_in_countries(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """Cells and the countries that hold them, ``name`` added to the cell's columns.

    A cell is inside if the ray from it to the east crosses the country's edges an
    odd number of times, so holes count however they run, and so do islands in them.
    Cells meet the countries whose box holds them, then only the edges of those that reach
    their latitude, on bands: an edge stands under the bands it spans, a tall one
    under larger ones.  Crossings are added up before the shuffle.  A cell on an edge
    belongs to the country if the country lies east of it.
    """
    lat, lon = F.col("lat"), F.col("lon")
    boxes = edges.groupBy(F.col("name").alias("region")).agg(
        F.min(F.least("y1", "y2")).alias("lat_min"), F.max(F.greatest("y1", "y2")).alias("lat_max"),
        F.min(F.least("x1", "x2")).alias("lon_min"), F.max(F.greatest("x1", "x2")).alias("lon_max"),
    )
    keyed = cells.select(F.struct("*").alias("_cell"), "lat", "lon").distinct()
    near = space.region_cells(keyed, boxes).withColumnRenamed("region", "name")
    levels = range(BAND_BITS, 22, 4)
    under = [F.struct(F.lit(n).alias("_level"), F.shiftright(_key(lat), n).alias("_band")) for n in levels]
    placed = near.select("*", F.explode(F.array(*under)).alias("_b")).select("name", "_cell", "lat", "lon", "_b.*")
    crossed = placed.join(_banded(edges, levels), ["name", "_level", "_band"])
    straddles = (F.col("y1") > lat) != (F.col("y2") > lat)
    at = F.col("x1") + (lat - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    hits = crossed.filter(straddles & (_west_of(lon, F.col("x0")) < at))
    counted = hits.groupBy("name", "_cell").agg(F.count(F.lit(1)).alias("_n")).filter("_n % 2 = 1")
    return counted.select("name", "_cell.*")


def _banded(edges: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Edges that a ray can cross, under every band they reach, with the western end of their country."""
    low, high = _key(F.least("y1", "y2")), _key(F.greatest("y1", "y2"))
    level = reduce(
        lambda acc, n: acc.when(F.shiftright(high, n) - F.shiftright(low, n) < MOST_BANDS, n), levels[:-1], F
    ).otherwise(levels[-1])
    west = edges.groupBy("name").agg(F.min(F.least("x1", "x2")).alias("x0"))
    slanted = edges.filter("y1 <> y2").withColumns({"_low": low, "_high": high, "_level": level})
    bands = F.expr("sequence(shiftright(_low, _level), shiftright(_high, _level))")
    return slanted.select("*", F.explode(bands).alias("_band")).drop("_low", "_high").join(west, "name")


def _key(lat):
    return geometry.cell_key(lat) + 90 * geometry.KEY_SCALE


def _west_of(lon, west):
    """A longitude on the branch on which the country's corners are given."""
    return geometry.wrap_longitude(lon, west)


def centroids_of_edges(edges: DataFrame) -> DataFrame:
    """The centroid by signed areas of edge rows; a hole must run against its outer ring."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    sums = edges.groupBy("name").agg(
        F.sum(cross).alias("area2"), F.sum((F.col("x1") + F.col("x2")) * cross).alias("mx"),
        F.sum((F.col("y1") + F.col("y2")) * cross).alias("my"),
    )
    return sums.select(
        "name",
        F.try_divide(F.col("mx"), F.col("area2") * 3).alias("x"),
        F.try_divide(F.col("my"), F.col("area2") * 3).alias("y"),
    )


def select_countries(countries: DataFrame, names: Sequence[str] = LABELLED_COUNTRIES) -> DataFrame:
    return countries.filter(F.col("name").isin(list(names)))


def centroids(countries: DataFrame) -> DataFrame:
    """Area-weighted centroid per country over all its rings.

    Signed areas are summed, so a hole, which runs the other way round than its
    outer ring, is taken out.  A country without area has no centroid.
    """
    moments = countries.select("name", geometry.ring_moments(F.col("ring")).alias("m"))
    sums = moments.groupBy("name").agg(
        F.sum("m.area2").alias("area2"), F.sum("m.mx").alias("mx"), F.sum("m.my").alias("my")
    )
    return sums.select(
        "name",
        F.try_divide(F.col("mx"), F.col("area2") * 3).alias("x"),
        F.try_divide(F.col("my"), F.col("area2") * 3).alias("y"),
    )


def meets_box(countries: DataFrame, box: Region) -> DataFrame:
    """Countries that share at least a point with the box.

    Either an edge touches the box, or the box lies inside the country: a ray
    from a corner of the box then crosses its rings an odd number of times,
    which holes and islands also satisfy.
    """
    ring = F.col("ring")
    per_ring = countries.select(
        "name",
        geometry.ring_meets_box(ring, box).alias("touches"),
        geometry.ring_crossings(ring, box.lon_min, box.lat_min).alias("crossings"),
    )
    return (
        per_ring.groupBy("name")
        .agg(F.bool_or("touches").alias("touches"), F.sum("crossings").alias("crossings"))
        .filter("touches OR crossings % 2 = 1")
        .select("name")
    )

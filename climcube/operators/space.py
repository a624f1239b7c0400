"""Boxes, regions and spatial means."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climcube.config import Region
from climcube.functions import geometry
from climcube.schema import SERIES_KEYS

#: Tile sizes as powers of two of the cell key: from 0.1 to 419 degrees.
TILE_LEVELS = (10, 12, 14, 16, 18, 20, 22)
#: Most tiles that cover a box.
MOST_TILES = 64


def select_box(grid: DataFrame, box: Region, wrap: bool = True) -> DataFrame:
    """Cells whose centre lies in the box, longitudes moved to the box's branch.

    With ``wrap=False`` the stored longitude is compared as it is.
    """
    inside = grid.filter(geometry.in_box(F.col("lat"), F.col("lon"), box, wrap))
    if not wrap:
        return inside
    lon = geometry.wrap_longitude(F.col("lon"), box.lon_min)
    moved = {"lon": lon}
    if "lon_q" in grid.columns:
        moved["lon_q"] = geometry.cell_key(lon)
    return inside.withColumns(moved)


def select_boxes(grid: DataFrame, boxes: Sequence[Region], wrap: bool = True) -> DataFrame:
    """Cells in at least one box; one pushable filter over the stored columns.

    A box inside another one adds nothing to the filter and is left out of it.
    """
    lat, lon = F.col("lat"), F.col("lon")
    return grid.filter(reduce(or_, [geometry.in_box(lat, lon, b, wrap) for b in outer_boxes(boxes)]))


def outer_boxes(boxes: Sequence[Region]) -> list[Region]:
    """The boxes that no other box of the list covers."""
    kept: list[Region] = []
    widest_first = sorted(
        boxes, key=lambda b: (b.lat_max - b.lat_min) * (b.lon_max - b.lon_min), reverse=True
    )
    for box in widest_first:
        if not any(other.covers(box) for other in kept):
            kept.append(box)
    return kept


def assign_regions(df: DataFrame, boxes: Sequence[Region], wrap: bool = True) -> DataFrame:
    """One row per cell and box that holds it.

    The boxes are a short list from the configuration, so membership is an
    expression: no join, no shuffle.
    """
    names = geometry.region_names(F.col("lat"), F.col("lon"), boxes, wrap)
    return df.select("*", F.explode(names).alias("region"))


def region_cells(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """Cell-to-region table for boxes that come from a table of any size.

    Boxes and cells meet on tiles, an equi-join, and the exact test follows.
    Tiles come in a few sizes, each four times as wide as the one before.  A box
    is covered by the smallest tiles of which ``MOST_TILES`` are enough: a globe by a
    few large ones, a box of a tenth of a degree by one or two small ones.  A
    cell stands under its tile of every size, and a box uses one size and lists a
    tile once, so no pair comes out twice.
    """
    box_tiles = cover_boxes(regions)
    lat, lon = _row(F.col("lat")), _column(F.col("lon"))
    ancestors = [
        F.struct(F.lit(level).alias("_level"), F.shiftright(lat, level).alias("_row"), F.shiftright(lon, level).alias("_column"))
        for level in TILE_LEVELS
    ]
    cell_tiles = cells.select("*", F.explode(F.array(*ancestors)).alias("_t")).select("*", "_t.*").drop("_t")
    inside = geometry.in_box_columns(
        F.col("lat"), F.col("lon"),
        F.col("lat_min"), F.col("lat_max"), F.col("lon_min"), F.col("lon_max"),
    )
    return (
        cell_tiles.join(box_tiles, ["_level", "_row", "_column"])
        .filter(inside)
        .drop("_level", "_row", "_column", "lat_min", "lat_max", "lon_min", "lon_max")
    )


def cover_boxes(regions: DataFrame) -> DataFrame:
    """Each box with every tile of its cover: ``_level, _row, _column``, at most ``MOST_TILES`` a box."""
    around = 360 * geometry.KEY_SCALE
    low, high = _row(F.col("lat_min")), _row(F.col("lat_max"))
    west = _column(F.col("lon_min"))
    width = F.least(geometry.cell_key(F.col("lon_max")) - geometry.cell_key(F.col("lon_min")), F.lit(around - 1))
    east = west + width
    bounds = regions.withColumns({"_low": low, "_high": high, "_west": west, "_east": east})

    def columns(level: int):
        """Tiles up to the seam at 360 degrees, and those beyond it from 0 on."""
        first = F.sequence(F.shiftright("_west", level), F.shiftright(F.least("_east", F.lit(around - 1)), level))
        beyond = F.when(F.col("_east") >= around, F.sequence(F.lit(0), F.shiftright(F.col("_east") - around, level)))
        return F.array_distinct(F.concat(first, F.coalesce(beyond, F.array().cast("array<int>"))))

    def n_tiles(level: int):
        rows = F.shiftright("_high", level) - F.shiftright("_low", level) + 1
        first = F.shiftright(F.least("_east", F.lit(around - 1)), level) - F.shiftright("_west", level) + 1
        beyond = F.when(F.col("_east") >= around, F.shiftright(F.col("_east") - around, level) + 1)
        return rows * (first + F.coalesce(beyond, F.lit(0)))

    usable = bounds.filter("_low <= _high AND _west <= _east")
    level = reduce(lambda acc, n: acc.when(n_tiles(n) <= MOST_TILES, n), TILE_LEVELS[:-1], F).otherwise(TILE_LEVELS[-1])
    leveled = usable.withColumn("_level", level)
    rows = F.expr("sequence(shiftright(_low, _level), shiftright(_high, _level))")
    across = reduce(lambda acc, n: acc.when(F.col("_level") == n, columns(n)), TILE_LEVELS, F)
    tall = leveled.withColumn("_columns", across).select("*", F.explode(rows).alias("_row"))
    return tall.select("*", F.explode("_columns").alias("_column")).drop("_low", "_high", "_west", "_east", "_columns")


def _row(lat):
    """Latitude as a key from the south pole on."""
    return geometry.cell_key(lat) + 90 * geometry.KEY_SCALE


def _column(lon):
    """Longitude as a key from 0 to 360 degrees."""
    return F.pmod(geometry.cell_key(lon), F.lit(360 * geometry.KEY_SCALE))


def band_weights(grid: DataFrame, axis: Sequence[str]) -> DataFrame:
    """Area of the band around each latitude of a grid's own axis: ``lat_q, weight`` per axis.

    Bounds lie half-way between neighbours and are closed at the poles, whatever
    the steps are, so the weights of an axis add up to 2.  ``axis`` names the
    columns that tell grids of different resolution apart.  Only the distinct
    latitudes of an axis, some hundreds, meet in a window.
    """
    lats = grid.select(*axis, "lat_q").filter("lat_q IS NOT NULL").distinct()
    along = Window.partitionBy(*axis).orderBy("lat_q")
    lat = geometry.cell_degrees(F.col("lat_q"))
    bottom = F.coalesce((F.lag(lat).over(along) + lat) / 2, F.lit(-90.0))
    top = F.coalesce((F.lead(lat).over(along) + lat) / 2, F.lit(90.0))
    return lats.withColumn("weight", F.sin(F.radians(top)) - F.sin(F.radians(bottom)))


def with_band_weights(grid: DataFrame, axis: Sequence[str]) -> DataFrame:
    """A grid with the ``weight`` of each cell's band, for ``field_mean(weighting="column")``."""
    weights = band_weights(grid, axis)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in axis]
    named = weights.select(*[F.col(k).alias(f"_of_{k}") for k in axis], F.col("lat_q").alias("_of_lat_q"), "weight")
    met = reduce(and_, [*same, F.col("lat_q") == F.col("_of_lat_q")])
    return grid.join(named, met, "left").drop("_of_lat_q", *[f"_of_{k}" for k in axis])


def field_mean(
    df: DataFrame,
    value: str = "anomaly",
    keys: Sequence[str] = (*SERIES_KEYS, "region", "year"),
    weighting: str = "area",
    spacing: float | None = None,
) -> DataFrame:
    """Spatial mean per series and time; a missing cell counts on neither side.

    ``weighting`` is ``"area"``, ``"none"``, or ``"column"`` for weights that the
    rows carry (``with_band_weights``).
    """
    if weighting == "none":
        mean = F.avg(value)
    elif weighting in ("area", "column"):
        w = geometry.cell_weight(F.col("lat"), spacing) if weighting == "area" else F.col("weight")
        mean = F.try_divide(
            F.sum(F.col(value) * w), F.sum(F.when(F.col(value).isNotNull(), w))
        )
    else:
        raise ValueError(f"unknown weighting {weighting!r}")
    return df.groupBy(*keys).agg(mean.alias(value), F.count(value).alias("n_cells"))

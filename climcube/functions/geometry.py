"""Columns for cells, boxes and polygon rings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from climcube.config import Region

KEY_SCALE = 10_000


def cell_key(degrees: Column) -> Column:
    """Integer join key of a coordinate; raw doubles are never join keys."""
    return F.round(degrees * KEY_SCALE).cast("int")


def curve_key(lat_q: Column, lon_q: Column) -> Column:
    """Place of a cell on a Z-order curve: the bits of both keys in turn, longitude first."""
    lat = _spread_bits(lat_q.cast("long") + 90 * KEY_SCALE)
    lon = _spread_bits(F.pmod(lon_q.cast("long"), F.lit(360 * KEY_SCALE)))
    return F.shiftleft(lon, 1).bitwiseOR(lat)


def _spread_bits(key: Column) -> Column:
    """The low 23 bits of a key with a free bit between any two, by doubling the distance of ever smaller groups."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        key = key.bitwiseOR(F.shiftleft(key, shift)).bitwiseAND(F.lit(mask))
    return key


def _reach(low: float, high: float) -> tuple[float, float]:
    """A closed range widened by half a key, so that a cell on its edge is inside however it was computed."""
    return low - 0.5 / KEY_SCALE, high + 0.5 / KEY_SCALE


def cell_degrees(key: Column) -> Column:
    return key / F.lit(float(KEY_SCALE))


def wrap_longitude(lon: Column, lon_min: Column | float) -> Column:
    """Move a longitude into the branch ``[lon_min, lon_min + 360)``, at the resolution of the keys.

    The turn is done on integers: on doubles 5.1 could become 5.099999999999994.
    """
    first = cell_key(lon_min if isinstance(lon_min, Column) else F.lit(float(lon_min)))
    return cell_degrees(F.pmod(cell_key(lon) - first, F.lit(360 * KEY_SCALE)) + first)


def in_box(lat: Column, lon: Column, box: Region, wrap: bool = True) -> Column:
    """Cell centre inside a box, ends included.

    The wrapped test is written as ranges over the *stored* longitude, one per
    turn of 360 degrees, because a range on a stored column reaches the Parquet
    scan while a computed longitude does not.  Stored longitudes may use any
    convention within [-360, 360].  Ranges reach half a key further than the
    box, so a cell is inside exactly if its keys are.
    """
    inside = lat.between(*_reach(box.lat_min, box.lat_max))
    if not wrap:
        return inside & lon.between(*_reach(box.lon_min, box.lon_max))
    if box.spans_globe:
        return inside & lon.isNotNull()
    turns = [k for k in range(-3, 4)
             if box.lon_min + 360.0 * k <= 360.0 and box.lon_max + 360.0 * k >= -360.0]
    ranges = [lon.between(*_reach(box.lon_min + 360.0 * k, box.lon_max + 360.0 * k)) for k in turns]
    return inside & reduce(lambda a, b: a | b, ranges)


def in_box_columns(lat: Column, lon: Column, lat_min: Column, lat_max: Column,
                   lon_min: Column, lon_max: Column) -> Column:
    """The wrapped box test when the bounds are columns."""
    around = lon_max - lon_min >= 360.0
    rows = cell_key(lat).between(cell_key(lat_min), cell_key(lat_max))
    return rows & (around | (cell_key(wrap_longitude(lon, lon_min)) <= cell_key(lon_max)))


def region_names(lat: Column, lon: Column, boxes: Sequence[Region], wrap: bool = True) -> Column:
    """Array of the names of all boxes that hold the cell."""
    hits = [F.when(in_box(lat, lon, b, wrap), F.lit(b.name)) for b in boxes]
    return F.array_compact(F.array(*hits))


def cell_weight(lat: Column, spacing: float | None = None) -> Column:
    """Relative area of a cell on a regular grid.

    With a known latitude step it is the exact band area, clipped at the poles;
    without one it is ``cos(lat)``, which is proportional to it except for
    cells centred on a pole.
    """
    if spacing is None:
        return F.cos(F.radians(lat))
    half = spacing / 2.0
    top = F.least(lat + half, F.lit(90.0))
    bottom = F.greatest(lat - half, F.lit(-90.0))
    return F.sin(F.radians(top)) - F.sin(F.radians(bottom))


def ring_edges(ring: Column) -> Column:
    """Edges of a ring as structs ``x1, y1, x2, y2``; the ring may be open or closed."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring), F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        following,
        lambda p, q: F.struct(
            p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")
        ),
    )


def edge_cross(edge: Column) -> Column:
    return edge["x1"] * edge["y2"] - edge["x2"] * edge["y1"]


def ring_moments(ring: Column) -> Column:
    """Struct of twice the signed area and the two first moments times six."""
    zero = F.struct(F.lit(0.0).alias("area2"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    return F.aggregate(
        ring_edges(ring),
        zero,
        lambda acc, e: F.struct(
            (acc["area2"] + edge_cross(e)).alias("area2"),
            (acc["mx"] + (e["x1"] + e["x2"]) * edge_cross(e)).alias("mx"),
            (acc["my"] + (e["y1"] + e["y2"]) * edge_cross(e)).alias("my"),
        ),
    )


def _enters(start: Column, step: Column, low: float, high: float) -> tuple[Column, Column, Column]:
    """Parameter range in which one coordinate of an edge lies in [low, high].

    For a constant coordinate the range is open (NULL ends, which ``greatest``
    and ``least`` skip) and the third value tells whether it lies inside.
    """
    at_low = F.when(step != 0, (F.lit(low) - start) / F.nullif(step, F.lit(0.0)))
    at_high = F.when(step != 0, (F.lit(high) - start) / F.nullif(step, F.lit(0.0)))
    constant_ok = (step != 0) | start.between(low, high)
    return F.least(at_low, at_high), F.greatest(at_low, at_high), constant_ok


def edge_meets_box(edge: Column, box: Region) -> Column:
    """Whether any point of an edge lies in the box (touching counts)."""
    x_from, x_to, x_ok = _enters(edge["x1"], edge["x2"] - edge["x1"], box.lon_min, box.lon_max)
    y_from, y_to, y_ok = _enters(edge["y1"], edge["y2"] - edge["y1"], box.lat_min, box.lat_max)
    first = F.greatest(F.lit(0.0), x_from, y_from)
    last = F.least(F.lit(1.0), x_to, y_to)
    return x_ok & y_ok & (first <= last)


def ring_meets_box(ring: Column, box: Region) -> Column:
    return F.exists(ring_edges(ring), lambda e: edge_meets_box(e, box))


def ring_crossings(ring: Column, x: float, y: float) -> Column:
    """Number of ring edges crossed by the ray from ``(x, y)`` to the right."""

    def crosses(e: Column) -> Column:
        straddles = (e["y1"] > y) != (e["y2"] > y)
        at_x = e["x1"] + (F.lit(y) - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(
            e["y2"] - e["y1"], F.lit(0.0)
        )
        return straddles & (F.lit(x) < at_x)

    return F.size(F.filter(ring_edges(ring), crosses))

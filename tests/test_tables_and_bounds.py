"""Tiles of boxes, edges of polygons, bounds of cells, sort order of files, large files, and manifests that add up."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from climcube.functions import geometry
from climcube.operators import catalog, countries, space
from climcube.plans import audit
from climcube.sources import grids, manifest

BOXES = [("globe", -90.0, 90.0, -180.0, 180.0), ("half", -90.0, 90.0, 100.0, 280.0), ("cell", 50.0, 50.0, 5.0, 5.0),
         ("tenth", 50.0, 50.1, 5.0, 5.1), ("band", 10.0, 10.1, -180.0, 180.0), ("seam", -5.0, 5.0, 355.0, 365.0),
         ("dateline", -5.0, 5.0, 170.0, 190.0), ("column", -90.0, 90.0, 7.0, 7.1), ("pole", 89.9, 90.0, 0.0, 20.0)]


@pytest.fixture(scope="module")
def boxes(spark):
    return spark.createDataFrame(BOXES, "region STRING, lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE")


def test_a_box_has_few_tiles(spark, boxes):
    cover = space.cover_boxes(boxes)
    n = {r.region: r["count"] for r in cover.groupBy("region").count().collect()}
    assert set(n) == {b[0] for b in BOXES} and max(n.values()) <= space.MOST_TILES
    assert n["cell"] == 1 and n["tenth"] <= 4
    assert cover.distinct().count() == cover.count()
    sizes = {r.region: r._level for r in cover.collect()}
    assert sizes["cell"] == min(space.TILE_LEVELS) and sizes["globe"] > sizes["dateline"] > sizes["tenth"]


def test_cells_of_boxes_equal_brute_force(spark, boxes):
    rng = random.Random(3)
    points = [(round(rng.uniform(-90, 90), 1), round(rng.uniform(-180, 360), 1)) for _ in range(1500)]
    points += [(50.0, 5.0), (50.1, 5.1), (10.1, -180.0), (90.0, 20.0), (-90.0, 0.0), (0.0, 355.0), (0.0, 5.0), (0.0, -170.0)]
    points = sorted(set(points))
    cells = spark.createDataFrame(points, "lat DOUBLE, lon DOUBLE")
    got = sorted((r.region, r.lat, r.lon) for r in space.region_cells(cells, boxes).collect())

    def tenths(x):
        return round(x * 10)

    want = [(name, lat, lon) for name, low, high, west, east in BOXES for lat, lon in points
            if tenths(low) <= tenths(lat) <= tenths(high)
            and (tenths(lon) - tenths(west)) % 3600 <= tenths(east) - tenths(west)]
    assert got == sorted(want)


def corner_rows(spark, rings):
    rows = [(name, ring, i, float(x), float(y)) for name, ring, corners in rings for i, (x, y) in enumerate(corners)]
    return spark.createDataFrame(rows, "name STRING, ring_id INT, seq INT, x DOUBLE, y DOUBLE")


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


@pytest.mark.parametrize("turn", [1, -1])
def test_holes_and_islands_however_they_run(spark, turn):
    rings = [("A", 0, square(0, 0, 30)), ("A", 1, square(5, 5, 20)[::turn]), ("A", 2, square(10, 10, 10)[::turn])]
    cells = spark.createDataFrame([(2.0, 2.0), (7.0, 7.0), (15.0, 15.0), (40.0, 15.0), (15.0, -1.0)], "lat DOUBLE, lon DOUBLE")
    got = countries.cells_in_countries(cells, countries.edges_from_points(corner_rows(spark, rings)))
    assert sorted((r.lat, r.lon) for r in got.collect()) == [(2.0, 2.0), (15.0, 15.0)]


def test_polygons_equal_brute_force(spark):
    rng = random.Random(5)
    shapes = []
    for k in range(6):
        x, y, n = rng.uniform(-160, 150), rng.uniform(-60, 60), rng.choice([3, 7, 200])
        radius = [rng.uniform(1, 25) for _ in range(n)]
        shapes.append((f"P{k}", 0, [(x + radius[i] * math.cos(2 * math.pi * i / n), y + radius[i] * math.sin(2 * math.pi * i / n))
                                    for i in range(n)]))
    points = sorted({(round(rng.uniform(-89, 89), 2), round(rng.uniform(-180, 180), 2)) for _ in range(2500)})

    def inside(corners, lat, lon):
        crossed = 0
        for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1], strict=True):
            crossed += (y1 > lat) != (y2 > lat) and lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1)
        return crossed % 2 == 1

    def around(corners, lat, lon):
        west = min(x for x, _ in corners)
        return inside(corners, lat, west + (lon - west) % 360)

    want = sorted((name, lat, lon) for name, _, corners in shapes for lat, lon in points if around(corners, lat, lon))
    cells = spark.createDataFrame(points, "lat DOUBLE, lon DOUBLE")
    edges = countries.edges_from_points(corner_rows(spark, shapes))
    got = sorted((r.name, r.lat, r.lon) for r in countries.cells_in_countries(cells, edges).collect())
    assert len(want) > 20 and got == want


def test_edges_and_centroid_from_both_forms(spark):
    corners = square(10, 20, 4)
    closed = corner_rows(spark, [("A", 0, corners + corners[:1])])
    ring = spark.createDataFrame([("A", 0, [{"x": float(x), "y": float(y)} for x, y in corners])],
                                 "name STRING, ring_id INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    for edges in (countries.edges_from_points(closed), countries.edges_from_rings(ring)):
        found = countries.centroids_of_edges(edges).first()
        assert (found.x, found.y) == pytest.approx((12.0, 22.0))


def test_weights_of_a_grids_own_bounds(spark):
    axes = {"even": [-60, -30, 0, 30, 60], "poles": [-90, -80, -10, 5, 75, 90], "single": [40]}
    rows = [(m, float(lat), float(lat)) for m, axis in axes.items() for lat in axis for _ in range(3)]
    grid = spark.createDataFrame(rows, "model STRING, lat DOUBLE, value DOUBLE").withColumn("lat_q", geometry.cell_key(F.col("lat")))
    weights = space.band_weights(grid, ("model",))
    assert {r.model: r.total for r in weights.groupBy("model").agg(F.sum("weight").alias("total")).collect()} == pytest.approx(
        dict.fromkeys(axes, 2.0))
    of = {(r.model, r.lat_q): r.weight for r in weights.collect()}
    assert of["poles", 900_000] == pytest.approx(1 - math.sin(math.radians(82.5)))
    weighted = space.with_band_weights(grid, ("model",))
    assert weighted.count() == grid.count()
    means = {r.model: r.value for r in space.field_mean(weighted, "value", ("model",), "column").collect()}
    assert means["even"] == pytest.approx(0) and means["single"] == 40.0


def test_weights_of_a_missing_axis_key(spark):
    grid = spark.createDataFrame([(None, 0.0, 1.0), (None, 50.0, 2.0), ("m", None, 3.0)], "model STRING, lat DOUBLE, value DOUBLE")
    weighted = space.with_band_weights(grid.withColumn("lat_q", geometry.cell_key(F.col("lat"))), ("model",))
    got = {r.value: r.weight for r in weighted.collect()}
    assert got[1.0] + got[2.0] == pytest.approx(2.0) and got[3.0] is None


def test_small_boxes_meet_few_row_groups(spark):
    """Of 1024 groups of a grid of half a degree a box of 10 by 10 degrees meets at most 3 percent; latitude alone gives 6."""
    cells = spark.range(360 * 720).select(
        (F.floor(F.col("id") / 720) * 0.5 - 89.75).alias("lat"), (F.col("id") % 720 * 0.5 - 179.75).alias("lon"))
    keyed = cells.withColumns({"lat_q": geometry.cell_key(F.col("lat")), "lon_q": geometry.cell_key(F.col("lon"))})
    keyed = keyed.withColumn("curve", geometry.curve_key(F.col("lat_q"), F.col("lon_q")))
    assert keyed.select("curve").distinct().count() == 360 * 720

    def share(order):
        rows = keyed.orderBy(*order).select("lat", "lon").toPandas()
        group = rows.groupby([i * 1024 // len(rows) for i in range(len(rows))]).agg(["min", "max"])
        met = [((group["lat"]["max"] >= y) & (group["lat"]["min"] <= y + 10)
                & (group["lon"]["max"] >= x) & (group["lon"]["min"] <= x + 10)).mean()
               for x in range(-175, 165, 23) for y in range(-85, 75, 19)]
        return sum(met) / len(met)

    along_curve, by_latitude = share(["curve"]), share(["lat_q", "lon_q"])
    assert along_curve < 0.03 and along_curve < by_latitude / 1.5


def test_large_files_are_read_in_blocks(spark, tmp_path):
    contents = {"small.nc": b"abc", "large one.nc": b"0123456789" * 1000, "edge.nc": b"x" * 100, "empty.nc": b""}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    digests = manifest.read_digests(spark, str(tmp_path), "*.nc", most_bytes=100, block=64)
    assert {r.file_name: r.actual_md5 for r in digests.collect()} == {
        name: hashlib.md5(content).hexdigest() for name, content in contents.items() if content}


def test_one_file_per_year(spark):
    def name(year, tag=""):
        return f"tas_day_MIROC6_ssp585_r1i1p1f1_gn_{year}{tag}.nc"

    rows = [(name(2015), 1.0), (name(2015, "_v1.2"), 2.0), (name(2015, "_v1.2"), 3.0), (name(2016), 4.0), (name(2017, "_v1.2"), 5.0)]
    grid = spark.createDataFrame(rows, "file_name STRING, value DOUBLE")
    assert sorted(r.value for r in catalog.one_file_per_year(grid).collect()) == [2.0, 3.0, 4.0, 5.0]


def test_losing_files_are_not_read(spark, tmp_path):
    for tag, value in (("", 1.0), ("_v1.2", 2.0)):
        row = spark.range(1).select(
            F.lit("tas").alias("variable"), F.lit("CMIP6").alias("source"), F.lit("MIROC6").alias("model"),
            F.lit("ssp585").alias("experiment"), F.lit(2015).alias("year"), F.lit(1.0).alias("lat"),
            F.lit(2.0).alias("lon"), F.lit(value).alias("value"))
        grids.canonical_grid(row).write.parquet(str(tmp_path / f"tas_day_MIROC6_ssp585_r1i1p1f1_gn_2015{tag}.nc"))
    merged = grids.read_merged(spark, str(tmp_path))
    assert [r.value for r in merged.collect()] == [2.0]
    assert all("_v1.2.nc/" in path for path in merged.inputFiles())
    # beyond the longest list the names are joined; the rows are the same
    assert [r.value for r in grids.read_merged(spark, str(tmp_path), most_listed=0).collect()] == [2.0]


def test_ingest_is_idempotent(spark):
    raw = spark.createDataFrame([("pr", 2000, 1.0, 350.0, 2.0), ("tas", 2000, 1.0, 350.0, 2.0)],
                                "variable STRING, year INT, lat DOUBLE, lon DOUBLE, value DOUBLE")
    once = grids.canonical_grid(raw)
    assert sorted(once.collect(), key=str) == sorted(grids.canonical_grid(once).collect(), key=str)
    assert {r.variable: r.value for r in once.collect()} == {"pr": 172800.0, "tas": 2.0}


def test_every_manifest_row_has_one_status(spark, tmp_path):
    def name(year, model="MIROC6", variable="tas", tag=""):
        return f"{variable}_day_{model}_ssp585_r1i1p1f1_gn_{year}{tag}.nc"

    def uri(file_name):
        return f"https://h/{file_name}"

    md5 = "0123456789abcdef0123456789abcdef"
    lines = [f"{md5},{uri(name(2015))}", f"{md5},{uri(name(2016))}", f"{md5},{uri(name(2016, tag='_v1.2'))}",
             f"{md5},{uri(name(2017))}", f"{md5},{uri(name(2017))}", f"{md5},{uri(name(2018))}", f"{md5},",
             f"{md5},https://h/", f"short,{uri(name(2019))}", f"{md5},{uri(name(2015, 'Unknown'))}",
             f"{md5},{uri(name(2015, variable='hurs'))}", f"{md5},{uri(name(2020))},third", md5]
    path = tmp_path / "manifest.csv"
    path.write_text("md5,uri\n" + "\n".join(lines) + "\n")
    files = "file_name STRING"
    existing = spark.createDataFrame([(name(2015),)], files)
    digests = spark.createDataFrame([(name(2017), md5), (name(2018), "0" * 32)], f"{files}, actual_md5 STRING")
    found = audit.account(manifest.read_manifest_rows(spark, str(path)), existing, digests).collect()
    assert len(found) == len(lines) and all(r.status for r in found)
    assert sorted(r.status for r in found) == sorted([
        "file_exists", "other version", "missing", "ok", "ok", "mismatch", "no uri", "no file name", "no digest",
        "other model", "other variable", "malformed", "malformed"])

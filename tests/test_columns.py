"""Worked values of the column functions."""

import pytest
from pyspark.sql import functions as F

from climcube.config import LEVEL_EDGES, REGIONS, Region
from climcube.functions import geometry, names, values
from climcube.operators import catalog, countries


def evaluate(spark, rows, schema, *columns):
    """One list of results per column, in the order of the rows."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i INT, {schema}")
    out = df.select("i", *[c.alias(f"r{j}") for j, c in enumerate(columns)]).orderBy("i").collect()
    return [[row[f"r{j}"] for row in out] for j in range(len(columns))]


def test_file_names(spark):
    rows = [
        ("tas_day_X_ssp585_r1_gn_2015_v1.2_yearmean.nc",),
        ("tas_gn_2015.nc",),
        ("a_v1.2_v1.2.nc",),
        ("a_b",),
        ("/data_1999_x/pr_day_M0_ssp126_r1_gn_2020_yearmean.nc",),
        (None,),
    ]
    n = F.col("n")
    year, model, base, reissued, reduced = evaluate(
        spark, rows, "n STRING",
        names.year_of_name(n), names.name_token(n, "model"), names.version_base(n),
        names.version_name(n), names.yearmean_name(n),
    )
    assert year == [2015, None, None, None, 2020, None]
    assert model[:4] == ["X", "2015.nc", "v1.2.nc", None]
    assert base[1:4] == ["tas_gn_2015", "a_v1.2", "a_b"]
    assert reissued[1:3] == ["tas_gn_2015_v1.2.nc", "a_v1.2_v1.2.nc"]
    assert reduced[1] == "tas_gn_2015_yearmean.nc"


def test_strict_year_fails_on_a_name_without_one(spark):
    df = spark.createDataFrame([("tas_gn_2015.nc",)], "n STRING")
    with pytest.raises(Exception, match="no year in file name"):
        df.select(names.year_of_name(F.col("n"), strict=True)).collect()


def test_uris_and_white_space(spark):
    rows = [("https://h/a/b/f_1.nc?x=1", "\t a b \n"), ("http://h", "x"), ("not a uri at all", "")]
    name, stripped = evaluate(
        spark, rows, "u STRING, s STRING",
        names.uri_file_name(F.col("u")), names.strip_whitespace(F.col("s")),
    )
    assert name[0] == "f_1.nc" and name[1] == ""
    assert stripped == ["a b", "x", ""]


def test_filters(spark):
    rows = [(v, f"{v}_day_EC-Earth3-Veg-LR_x", "EC-Earth3-Veg-LR") for v in
            ("tas", "tasmin", "tasmax", "pr", "hurs")]
    df = spark.createDataFrame(rows, "v STRING, file_name STRING, model STRING")
    kept = catalog.keep_wanted_variables(df).select("v").collect()
    assert sorted(r.v for r in kept) == ["pr", "tas"]
    assert catalog.keep_models_in_uri(df, column="file_name").count() == 5
    assert catalog.keep_models(df).count() == 0
    assert catalog.keep_models(df, None).count() == 5


def test_values(spark):
    rows = [("tas", 1.0, 2010.958), ("pr", 2.0, 2010.0), ("tas", float("nan"), None)]
    v = F.col("v")
    clean, converted, unit, year = evaluate(
        spark, rows, "name STRING, v DOUBLE, t DOUBLE",
        values.nan_to_null(v), values.convert_units(F.col("name"), values.nan_to_null(v)),
        values.unit_label(F.col("name")),
        values.year_of_time(F.lit(None).cast("timestamp"), F.col("t")),
    )
    assert clean == [1.0, 2.0, None]
    assert converted == [1.0, 172800.0, None]
    assert unit == ["°C", "mm/day", "°C"]
    assert year == [2010, 2010, None]


def test_levels(spark):
    rows = [(-2.0,), (-1.0,), (0.0,), (0.5,), (1.0,), (None,)]
    (level,) = evaluate(spark, rows, "v DOUBLE", values.level_index(F.col("v"), (-1.0, 0.0, 1.0)))
    assert level == [-1, 0, 1, 1, 2, None]
    assert (len(LEVEL_EDGES["pr"]), len(LEVEL_EDGES["tas"])) == (25, 18)
    assert LEVEL_EDGES["pr"][12] == 5.551115123125783e-16
    assert (LEVEL_EDGES["tas"][0], LEVEL_EDGES["tas"][-1]) == (-1.0, 7.5)


def test_longitudes_and_boxes(spark):
    rows = [(50.0, 350.0), (50.0, 180.0), (50.0, -181.0), (50.0, 10.0), (36.0, 45.0), (34.9, 0.0)]
    lat, lon = F.col("lat"), F.col("lon")
    moved, europe, plain, globe = evaluate(
        spark, rows, "lat DOUBLE, lon DOUBLE",
        geometry.wrap_longitude(lon, -180.0),
        geometry.in_box(lat, lon, REGIONS["europe"]),
        geometry.in_box(lat, lon, REGIONS["europe"], wrap=False),
        geometry.in_box(lat, lon, REGIONS["global"]),
    )
    assert moved == [-10.0, -180.0, 179.0, 10.0, 45.0, 0.0]
    assert europe == [True, False, False, True, True, False]
    assert plain == [False, False, False, True, True, False]
    assert all(globe)


def test_box_across_the_180th_meridian(spark):
    box = Region("date_line", -10.0, 10.0, 170.0, 190.0)
    rows = [(0.0, 175.0), (0.0, -175.0), (0.0, 185.0), (0.0, -169.0), (0.0, 0.0)]
    (inside,) = evaluate(
        spark, rows, "lat DOUBLE, lon DOUBLE", geometry.in_box(F.col("lat"), F.col("lon"), box)
    )
    assert inside == [True, True, True, False, False]


def test_polar_weights(spark):
    rows = [(0.0,), (60.0,), (90.0,)]
    lat = F.col("lat")
    cosine, band = evaluate(
        spark, rows, "lat DOUBLE", geometry.cell_weight(lat), geometry.cell_weight(lat, 2.0)
    )
    assert cosine[:2] == pytest.approx([1.0, 0.5])
    assert band[1] / band[0] == pytest.approx(0.5)
    assert band[2] > 0 and cosine[2] == pytest.approx(0, abs=1e-12)


TRIANGLE = [(0.0, 0.0), (6.0, 0.0), (0.0, 3.0)]


@pytest.fixture(scope="module")
def shapes(spark):
    def ring(points):
        return [{"x": float(x), "y": float(y)} for x, y in points]

    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    hole = [(4, 4), (4, 6), (6, 6), (6, 4)]
    rows = [
        ("triangle", 0, ring(TRIANGLE)),
        ("closed", 0, ring([*TRIANGLE, TRIANGLE[0]])),
        ("holed", 0, ring(square)),
        ("holed", 1, ring(hole)),
        ("point", 0, ring([(1, 1)])),
    ]
    return spark.createDataFrame(
        rows, "name STRING, ring_id INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"
    ).cache()


def test_centroids(shapes):
    found = {r["name"]: (r.x, r.y) for r in countries.centroids(shapes).collect()}
    assert found["triangle"] == pytest.approx((2.0, 1.0))
    assert found["closed"] == pytest.approx((2.0, 1.0))
    assert found["holed"] == pytest.approx((5.0, 5.0))
    assert found["point"] == (None, None)


@pytest.mark.parametrize(
    "box, expected",
    [
        (Region("apart", 1.0, 3.0, 5.0, 9.0), {"holed"}),
        (Region("around", -1.0, 11.0, -1.0, 11.0), {"triangle", "closed", "holed", "point"}),
        (Region("inside", 0.5, 1.0, 2.0, 3.0), {"triangle", "closed", "holed"}),
        (Region("across", -1.0, 4.0, 5.0, 7.0), {"triangle", "closed", "holed"}),
        (Region("in the hole", 4.5, 5.5, 4.5, 5.5), set()),
        (Region("corner only", -1.0, 0.0, -1.0, 0.0), {"triangle", "closed", "holed"}),
    ],
)
def test_box_meets_polygon(shapes, box, expected):
    assert {r["name"] for r in countries.meets_box(shapes, box).collect()} == expected


def test_country_selection(spark):
    df = spark.createDataFrame([("Kazakhstan",), ("France",)], "name STRING")
    assert [r["name"] for r in countries.select_countries(df).collect()] == ["Kazakhstan"]

"""Properties that hold whatever the data, on seeded grids."""

import random

import pytest
from pyspark.sql import functions as F

from climcube.config import Region, RunConfig
from climcube.operators import anomaly, ensemble, space, temporal
from climcube.plans import maps, series
from climcube.sources import grids

CFG = RunConfig(
    baseline=(2000, 2002), future=(2005, 2006), scenarios=("ssp126", "ssp585"), map_models=None,
    regions=(Region("north", 0, 90, -180, 180), Region("west", -60, 60, -100, 20)),
)
RAW = ("variable STRING, source STRING, model STRING, experiment STRING, year INT, month INT, "
       "lat DOUBLE, lon DOUBLE, value DOUBLE")


def make_rows(seed=1, shift=0.0):
    """Three models with gaps: a missing cell, a missing year and NaN values."""
    rnd = random.Random(seed)
    rows = []
    for model in ("A", "B", "C"):
        for exp, years in (("historical", range(2000, 2004)), ("ssp126", range(2004, 2008)),
                           ("ssp585", range(2004, 2008))):
            for year in years:
                if (model, year) == ("B", 2006):
                    continue
                for lat in (-30.0, 0.0, 45.0):
                    for lon in (5.0, 95.0, 275.0):
                        if (model, exp, lat, lon) == ("C", "historical", 0.0, 5.0):
                            continue
                        for month in (1, 7):
                            v = rnd.gauss(lat / 10, 2) + shift
                            rows.append(("tas", "CMIP6", model, exp, year, month, lat, lon,
                                         float("nan") if rnd.random() < 0.1 else v))
    return rows


@pytest.fixture(scope="module")
def grid(spark):
    return grids.canonical_grid(spark.createDataFrame(make_rows(), RAW)).cache()


def close(a, b):
    key = sorted
    a, b = key(map(tuple, a.collect()), key=str), key(map(tuple, b.collect()), key=str)
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        assert x == pytest.approx(y, abs=1e-9, nan_ok=True)


def rounded(df):
    return df.select(*[F.round(c, 7).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def test_baseline_anomalies_average_to_zero(grid):
    yearly = temporal.yearly_mean(grid)
    based = anomaly.rebase(yearly, *CFG.baseline)
    means = based.filter("experiment = 'historical' AND year BETWEEN 2000 AND 2002").groupBy(
        "model", "lat_q", "lon_q").agg(F.avg("anomaly").alias("a"))
    assert means.filter("abs(a) > 1e-9").count() == 0 and means.count() > 20


def test_window_form_equals_join_form(grid):
    yearly = temporal.yearly_mean(grid)
    columns = ["model", "experiment", "lat_q", "lon_q", "year", "anomaly"]
    joined = anomaly.anomalies(yearly, temporal.climatology(yearly, *CFG.baseline))
    close(rounded(anomaly.rebase(yearly, *CFG.baseline).select(columns)), rounded(joined.select(columns)))


def test_one_pass_change_equals_step_by_step(grid):
    yearly = temporal.yearly_mean(grid)
    clim = temporal.climatology(yearly, *CFG.baseline).select("variable", "source", "model", "lat_q", "lon_q", "clim")
    future = temporal.period_mean(yearly.filter("experiment <> 'historical'"), *CFG.future)
    steps = anomaly.subtract(anomaly.align(future, clim))
    columns = ["experiment", "model", "lat_q", "lon_q", "anomaly"]
    one = ensemble.change_per_model(yearly, CFG.baseline, CFG.future, CFG.scenarios)
    close(rounded(one.select(columns)), rounded(steps.select(columns)))


def test_constant_shift_leaves_anomalies(spark, grid):
    moved = grids.canonical_grid(spark.createDataFrame(make_rows(shift=273.15), RAW))
    close(rounded(series.model_series(grid, CFG)), rounded(series.model_series(moved, CFG)))


def test_area_mean_of_a_constant_field(grid):
    flat = grid.withColumn("anomaly", F.lit(3.5))
    got = space.field_mean(flat, keys=["year"])
    assert all(r.anomaly == pytest.approx(3.5) for r in got.collect())


def test_quartiles_are_ordered_and_width_one_is_identity(grid):
    spread = series.ensemble_spread(series.model_series(grid, CFG), CFG).collect()
    assert spread and all(r.p25 <= r.p50 <= r.p75 for r in spread)
    assert all((r.p25, r.p50, r.p75) == (r.p25_rm, r.p50_rm, r.p75_rm) for r in spread)
    # model B lacks 2006 only there
    assert {r.n_models for r in spread if r.year == 2006 and r.region == "north"} == {2}
    assert {r.n_models for r in spread if r.year == 2005 and r.region == "north"} == {3}


def test_result_does_not_depend_on_partitions(grid):
    one = series.model_series(grid.coalesce(1), CFG)
    many = series.model_series(grid.repartition(13), CFG)
    close(rounded(one), rounded(many))


def test_both_longitude_conventions_give_the_same_box(spark, grid):
    twin = grid.withColumn("lon", F.when(F.col("lon") < 0, F.col("lon") + 360).otherwise(F.col("lon")))
    box = Region("b", -60, 60, -100, 20)
    columns = ["model", "experiment", "year", "month", "lat", "lon", "lon_q", "value"]
    close(space.select_box(grid, box).select(columns), space.select_box(twin, box).select(columns))


def test_repeated_years_are_dropped_on_request(grid):
    found = series.model_series(grid, CFG)
    twice = found.unionByName(found)
    close(rounded(series.ensemble_spread(found, CFG)), rounded(series.ensemble_spread(twice, CFG, dedupe=True)))


def test_table_regions_equal_inline_regions(spark, grid):
    cells = grid.select("lat", "lon").distinct()
    boxes = [*CFG.regions, Region("date_line", -40, 50, 90, 280), Region("all", -90, 90, 0, 360)]
    table = spark.createDataFrame(
        [(b.name, float(b.lat_min), float(b.lat_max), float(b.lon_min), float(b.lon_max)) for b in boxes],
        "region STRING, lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE")
    columns = ["lat", "lon", "region"]
    close(space.region_cells(cells, table).select(columns), space.assign_regions(cells, boxes).select(columns))


@pytest.mark.parametrize("hot", ["cell", "model"])
def test_a_hot_key_gives_the_same_result(spark, grid, hot):
    """A third of all rows repeat one key; repeating every row of a group keeps its mean."""
    test = (F.col("lat") == 45.0) & (F.col("lon") == 5.0) if hot == "cell" else F.col("model") == "A"
    copies = F.when(test, 40).otherwise(1)
    skewed = grid.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("_c")).drop("_c")
    assert skewed.filter(test).count() * 3 > skewed.count()
    close(rounded(series.model_series(grid, CFG)), rounded(series.model_series(skewed, CFG)))
    close(rounded(maps.change_map(grid, CFG)), rounded(maps.change_map(skewed, CFG)))


def test_a_model_without_history_drops_out(spark, grid):
    orphan = grid.filter("model = 'A' AND experiment = 'ssp126'").withColumn("model", F.lit("Z"))
    both = grid.unionByName(orphan)
    close(rounded(series.model_series(grid, CFG)), rounded(series.model_series(both, CFG)))
    clim = temporal.climatology(both, *CFG.baseline)
    assert [(r.model, r.experiment) for r in anomaly.models_without_baseline(both, clim).collect()] == [("Z", "ssp126")]

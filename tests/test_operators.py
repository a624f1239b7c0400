"""Worked values of the operators on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from climcube.config import REGIONS, Region, RunConfig
from climcube.operators import anomaly, catalog, ensemble, quality, space, temporal
from climcube.plans import series
from climcube.schema import MissingColumnsError, require_columns
from climcube.sources import grids


def numbers(df, order, column):
    return [r[column] for r in df.orderBy(order).collect()]


@pytest.mark.parametrize(
    "width, expected",
    [
        (1, [0, 1, 2, 3, 4, 5, 6, 7]),
        (2, [None, 0.5, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5]),
        (3, [None, 1, 2, 3, 4, 5, 6, None]),
        (4, [None, None, 1.5, 2.5, 3.5, 4.5, 5.5, None]),
    ],
)
def test_running_mean(spark, width, expected):
    df = spark.createDataFrame([("e", i, float(i)) for i in range(8)], "e STRING, year INT, v DOUBLE")
    assert numbers(ensemble.running_mean(df, ["v"], width, ["e"]), "year", "v_rm") == expected


def test_running_mean_with_a_gap(spark):
    rows = [("e", i, None if i == 3 else float(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "e STRING, year INT, v DOUBLE")
    got = numbers(ensemble.running_mean(df, ["v"], 3, ["e"]), "year", "v_rm")
    assert got == [None, 1, None, None, None, 5, 6, None]


def test_quantiles_skip_missing(spark):
    values = [1.5, 2.25, 9.0, -3.0, 4.0, None]
    df = spark.createDataFrame([(1, v) for v in values] + [(2, v) for v in (1.0, 2.0, 3.0, 10.0)],
                               "k INT, anomaly DOUBLE")
    got = ensemble.ensemble_quantiles(df, keys=["k"]).orderBy("k").collect()
    assert tuple(got[0])[1:] == (1.5, 2.25, 4.0, 5)
    assert got[1].p50 == 2.5


def test_field_means(spark):
    rows = [("full", 0.0, 1.0), ("full", 60.0, 4.0), ("gap", 0.0, 1.0), ("gap", 60.0, None),
            ("empty", 0.0, None)]
    df = spark.createDataFrame(rows, "k STRING, lat DOUBLE, anomaly DOUBLE")
    area = {r.k: (r.anomaly, r.n_cells) for r in space.field_mean(df, keys=["k"]).collect()}
    assert area["full"] == (pytest.approx(2.0), 2)
    assert area["gap"] == (pytest.approx(1.0), 1)
    assert area["empty"] == (None, 0)
    plain = {r.k: r.anomaly for r in space.field_mean(df, keys=["k"], weighting="none").collect()}
    assert plain["full"] == 2.5
    with pytest.raises(ValueError, match="weighting"):
        space.field_mean(df, weighting="mass")


GRID = "variable STRING, source STRING, model STRING, experiment STRING, lat_q INT, lon_q INT, year INT, value DOUBLE"


def cell(model, experiment, year, value, lat_q=0):
    return ("tas", "CMIP6", model, experiment, lat_q, 0, year, value)


def test_anomalies(spark):
    rows = [cell("m", "historical", y, v) for y, v in ((1981, 10.0), (1995, 12.0), (2010, 14.0), (2014, 15.0))]
    rows += [cell("m", "ssp585", 2050, 20.0), cell("orphan", "ssp585", 2050, 1.0),
             cell("m", "ssp585", 2050, 7.0, lat_q=10)]
    grid = spark.createDataFrame(rows, GRID)
    clim = temporal.climatology(grid, 1981, 2010)
    assert [(r.clim, r.n_steps) for r in clim.collect()] == [(12.0, 3)]
    expected = {("historical", 1981): -2.0, ("historical", 1995): 0.0, ("historical", 2010): 2.0,
                ("historical", 2014): 3.0, ("ssp585", 2050): 8.0}
    forms = [anomaly.anomalies(grid, clim), anomaly.anomalies(grid, clim, salts=5),
             anomaly.rebase(grid, 1981, 2010)]
    for form in forms:
        assert {(r.experiment, r.year): r.anomaly for r in form.collect()} == expected
    skipped = anomaly.models_without_baseline(grid, clim).collect()
    assert [(r.model, r.experiment) for r in skipped] == [("orphan", "ssp585")]


def test_station_series(spark):
    cfg = RunConfig(regions=(Region("r", -10, 10, -10, 10),))
    base = (0.0, 0.0, 0, 0)
    stations = spark.createDataFrame(
        [(1981, *base, 0.0), (2010, *base, 2.0), (2020, *base, 4.0)],
        "year INT, lat DOUBLE, lon DOUBLE, lat_q INT, lon_q INT, temperature DOUBLE",
    )
    monthly = spark.createDataFrame(
        [(m, *base, 10.0) for m in range(1, 13)],
        "month_number INT, lat DOUBLE, lon DOUBLE, lat_q INT, lon_q INT, climatology DOUBLE",
    )
    got = series.station_series(stations, monthly, cfg)
    assert numbers(got, "year", "anomaly") == [-1.0, 1.0, 3.0]
    with pytest.raises(MissingColumnsError, match="temperature"):
        series.station_series(stations.drop("temperature"), monthly, cfg)


def test_ensemble_mean_counts_models(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None)], "k STRING, anomaly DOUBLE")
    assert tuple(ensemble.ensemble_mean(df, keys=["k"]).first()) == ("a", 2.0, 2)


def test_missing_values_are_skipped_after_ingest(spark):
    raw = spark.createDataFrame(
        [("tas", 0.5, 359.0, 2000, v) for v in (1.0, 2.0, float("nan"))],
        "variable STRING, lat DOUBLE, lon DOUBLE, year INT, value DOUBLE",
    )
    grid = grids.canonical_grid(raw)
    assert grid.first().lon == -1.0 and grid.first().lon_q == -10000
    mean = temporal.yearly_mean(grid, ["lat_q"]).first()
    assert (mean.value, mean.n_steps) == (1.5, 2)
    with pytest.raises(MissingColumnsError):
        grids.canonical_grid(raw.drop("value"))


def test_variable_resolver(spark):
    wide = spark.createDataFrame([(None, 2.0), (1.0, 3.0)], "tas DOUBLE, var167 DOUBLE")
    assert [r.value for r in grids.resolve_variable(wide, "tas").collect()] == [2.0, 1.0]
    with pytest.raises(MissingColumnsError):
        grids.resolve_variable(wide, "pr")
    long = spark.createDataFrame(
        [("a", "var167", 1.0), ("a", "tas", 2.0), ("b", "temperature_anomaly", 3.0), ("c", "hurs", 4.0)],
        "s STRING, variable STRING, value DOUBLE",
    )
    got = grids.resolve_variable_rows(long, "tas", ["s"]).collect()
    assert {(r.s, r.variable, r.value) for r in got} == {("a", "tas", 2.0), ("b", "tas", 3.0)}


def test_dedupe_duplicates_and_profile(spark):
    rows = [("s", 2000, 2, "tas"), ("s", 2000, 1, "pr"), ("s", 2001, 1, "tas"), ("t", 1999, 1, "tas")]
    df = spark.createDataFrame(rows, "s STRING, year INT, step INT, variable STRING")
    first = temporal.dedupe_time(df, ["s"], [F.col("step")])
    assert {(r.s, r.year, r.variable) for r in first.collect()} == {
        ("s", 2000, "pr"), ("s", 2001, "tas"), ("t", 1999, "tas")}
    assert [tuple(r) for r in quality.duplicate_report(df, ["s"]).collect()] == [("s", 2000, 2)]
    profile = {r.s: tuple(r)[1:] for r in quality.series_profile(df, ["s"]).collect()}
    assert profile["s"] == (2000, 2001, 2, 3, ["pr", "tas"])


def test_year_selection_by_label(spark):
    df = spark.createDataFrame([(2010, 2010.5), (2010, 2010.0), (2011, 2011.0)], "year INT, time_label DOUBLE")
    assert temporal.select_years(df, 1981, 2010).count() == 2
    assert temporal.select_years(df, 1981, 2010, by="time_label").count() == 1


def test_dense_alignment(spark):
    df = spark.createDataFrame([("a", 2000, 1.0), ("b", 2001, 2.0)], "model STRING, year INT, anomaly DOUBLE")
    dense = ensemble.dense_alignment(df, ["a", "b"], keys=["year"])
    assert {tuple(r) for r in dense.select("year", "model", "anomaly").collect()} == {
        (2000, "a", 1.0), (2000, "b", None), (2001, "a", None), (2001, "b", 2.0)}


def test_skip_reasons_in_order(spark):
    files = spark.createDataFrame([(n,) for n in ("a.nc", "b.nc", "c.nc", "d_v1.2.nc", "e.nc", "a.nc")],
                                  "file_name STRING")
    there = ["a_yearmean.nc", "a.nc", "b_v1.2.nc", "b.nc", "c.nc", "d_v1.2.nc", "c.nc"]
    existing = spark.createDataFrame([(n,) for n in there], "file_name STRING")
    got = catalog.skip_existing(files, existing).collect()
    assert sorted((r.file_name, r.skip_reason) for r in got if r.skip_reason) == [
        ("a.nc", "yearmean_exists"), ("a.nc", "yearmean_exists"), ("b.nc", "v1_2_exists"),
        ("c.nc", "file_exists"), ("d_v1.2.nc", "v1_2_exists")]
    assert [r.file_name for r in catalog.pending(files, existing).collect()] == ["e.nc"]


def test_version_pick_and_merge_order(spark):
    files = spark.createDataFrame([(n,) for n in ("a.nc", "a_v1.2.nc", "b.nc")], "file_name STRING")
    picked = catalog.pick_version(files).collect()
    assert sorted(r.file_name for r in picked) == ["a_v1.2.nc", "b.nc"]
    listed = spark.createDataFrame([("m", 2001, "x"), ("m", 2000, "z"), ("m", 2000, "y"), ("n", 1999, "w")],
                                   "model STRING, year INT, file_name STRING")
    order = catalog.merge_order(listed, ["model"]).collect()
    assert {(r.model, r.file_name): r.position for r in order} == {
        ("m", "y"): 1, ("m", "z"): 2, ("m", "x"): 3, ("n", "w"): 1}


def test_rejects_keep_the_first_reason(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v INT")
    good, bad = quality.split_rejects(df, [("missing", F.col("v").isNull()), ("negative", F.col("v") < 0)])
    assert [r.v for r in good.collect()] == [1]
    assert {(r.v, r.reason) for r in bad.collect()} == {(None, "missing"), (-1, "negative")}


def test_trend_rank_and_shares(spark):
    line = spark.createDataFrame([("s", y, 0.5 * y) for y in range(2000, 2005)],
                                 "s STRING, year INT, anomaly DOUBLE")
    assert ensemble.trend(line, ["s"]).first().trend == pytest.approx(0.5)
    spread = spark.createDataFrame(
        [("tas", "r", "ssp126", 2080, 1.0), ("tas", "r", "ssp585", 2080, 4.0), ("tas", "r", "ssp585", 2000, 99.0)],
        "variable STRING, region STRING, experiment STRING, year INT, p50 DOUBLE")
    ranked = ensemble.scenario_rank(spread, 2070, 2099).collect()
    assert {r.experiment: (r.change, r.position) for r in ranked} == {"ssp585": (4.0, 1), "ssp126": (1.0, 2)}
    maps = spark.createDataFrame([("pr", "e", v) for v in (1.0, -1.0, 0.0, 2.0, None)],
                                 "variable STRING, experiment STRING, anomaly DOUBLE")
    shares = ensemble.sign_shares(maps).first()
    assert (shares.share_up, shares.share_down, shares.n_cells) == (0.5, 0.25, 4)


def test_required_columns(spark):
    df = spark.range(1)
    assert require_columns(df, "id") is df
    with pytest.raises(MissingColumnsError, match="value"):
        require_columns(df, "id", "value")


def test_run_config_checks_itself():
    with pytest.raises(ValueError):
        RunConfig(variable="hurs")
    with pytest.raises(ValueError):
        RunConfig(baseline=(2010, 1981))
    with pytest.raises(ValueError):
        RunConfig(running_years=0)


def test_covered_boxes_are_left_out_of_the_filter(spark):
    every = list(REGIONS.values())
    assert [b.name for b in space.outer_boxes(every)] == ["global"]
    some = [REGIONS["germany"], REGIONS["conus"], REGIONS["europe"]]
    assert {b.name for b in space.outer_boxes(some)} == {"europe", "conus"}
    cells = spark.createDataFrame([(50.0, 10.0), (30.0, 260.0), (60.0, 40.0), (0.0, 0.0)], "lat DOUBLE, lon DOUBLE")
    assert space.select_boxes(cells, some).count() == 3
    assert space.select_boxes(cells, every).count() == 4

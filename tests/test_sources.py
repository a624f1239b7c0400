"""Readers, sinks and the idempotent store, in scratch folders."""

import hashlib
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from climcube import schema
from climcube.config import REGIONS, RunConfig
from climcube.operators import catalog, quality, space
from climcube.sources import calendar, grids, manifest
from climcube.sources.store import Store, fingerprint


def test_manifest(spark, tmp_path):
    path = tmp_path / "manifest.csv"
    path.write_text("md5,uri\n abc ,\thttps://h/a_1.nc \n")
    rows = manifest.read_manifest(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("abc", "https://h/a_1.nc")]
    path.write_text("md5,uri\na,b,c\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        manifest.read_manifest(spark, str(path)).collect()


def test_path_list_keeps_the_last_line(spark, tmp_path):
    path = tmp_path / "paths.txt"
    path.write_text("a\n\nb")
    assert sorted(r.value for r in manifest.read_path_list(spark, str(path)).collect()) == ["a", "b"]


def test_listing_and_digests(spark, tmp_path):
    name = "tas_day_MIROC6_ssp585_r1i1p1f1_gn_2015_yearmean.nc"
    (tmp_path / name).write_bytes(b"hello")
    (tmp_path / "notes.txt").write_bytes(b"x")
    found = manifest.list_files(spark, str(tmp_path), "*.nc").collect()
    assert [(r.file_name, r.variable, r.model, r.experiment, r.year, r.is_yearmean) for r in found] == [
        (name, "tas", "MIROC6", "ssp585", 2015, True)]
    digests = manifest.read_digests(spark, str(tmp_path), "*.nc")
    assert digests.first().actual_md5 == "5d41402abc4b2a76b9719d911017c592"
    listed = spark.createDataFrame(
        [(name, hashlib.md5(b"hello").hexdigest()), ("notes.txt", "0"), ("gone.nc", "1")],
        "file_name STRING, md5 STRING",
    )
    checked = catalog.verify_digests(listed, manifest.read_digests(spark, str(tmp_path))).collect()
    assert {r.file_name: (r.status, r.verified) for r in checked} == {
        name: ("ok", True), "notes.txt": ("mismatch", False), "gone.nc": ("missing", False)}


@pytest.fixture(scope="module")
def stored_grid(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("grid") / "g")
    raw = spark.range(0, 2000).select(
        F.lit("tas").alias("variable"), F.lit("CMIP6").alias("source"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("model"),
        F.when(F.col("id") % 2 == 0, "historical").otherwise("ssp585").alias("experiment"),
        (F.col("id") % 50 + 1980).cast("int").alias("year"),
        ((F.col("id") % 18) * 10 - 85).cast("double").alias("lat"),
        ((F.col("id") % 36) * 10 + 5).cast("double").alias("lon"),
        F.col("id").cast("double").alias("value"),
    )
    grids.write_grid(grids.canonical_grid(raw), path)
    return path


def test_grid_round_trip(spark, stored_grid):
    back = grids.read_grid(spark, stored_grid)
    assert back.schema.simpleString() == schema.struct_type(schema.GRID).simpleString()
    assert back.count() == 2000
    assert back.agg(F.sum("value")).first()[0] == sum(range(2000))


def test_box_and_year_filters_reach_the_scan(spark, stored_grid):
    chosen = space.select_box(
        grids.read_grid(spark, stored_grid).filter("model = 'A' AND year BETWEEN 1981 AND 1990"),
        REGIONS["europe"],
    ).select("lat", "lon", "value")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    pushed = scan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(lat,34.99995)" in pushed
    assert "GreaterThanOrEqual(year,1981)" in pushed
    assert "LessThanOrEqual(lon" in pushed
    assert "model" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    read = scan.split("ReadSchema")[1]
    assert "lat_q" not in read and "time_label" not in read


def test_store_runs_a_stage_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    stage = f"stage-{uuid.uuid4().hex}"
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert store.materialize(stage, RunConfig(), build).count() == 3
    assert store.materialize(stage, RunConfig(), build).count() == 3
    assert len(calls) == 1
    store.materialize(stage, RunConfig(variable="pr"), build)
    assert len(calls) == 2
    assert store.is_done(stage, RunConfig()) and not store.is_done("other", RunConfig())


def test_store_prefers_the_shared_folder():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=settings.get))

    cluster = session(**{"spark.checkpoint.dir": "hdfs://shared/folder/"})
    assert Store(cluster, "/elsewhere").root == "hdfs://shared/folder"
    assert Store(session(), "/elsewhere").root == "/elsewhere"
    with pytest.raises(ValueError):
        Store(session())


def test_fingerprint_covers_every_setting():
    base = RunConfig()
    others = [RunConfig(variable="pr"), RunConfig(regions=(REGIONS["conus"],)), RunConfig(running_years=5),
              RunConfig(baseline=(1991, 2020)), RunConfig(spacing=1.0)]
    prints = {fingerprint(c) for c in [base, *others]}
    assert len(prints) == 6 and fingerprint(base) == fingerprint(RunConfig())


def test_calendars(spark):
    assert calendar.request_calendar(spark).count() == 900
    have = spark.createDataFrame([("s", 2000, m) for m in range(1, 12)], "k STRING, year INT, month INT")
    gaps = quality.coverage_gaps(have, ["k"], 2000, 2001).collect()
    assert sorted((r.year, r.month) for r in gaps) == [(2000, 12)] + [(2001, m) for m in range(1, 13)]
    yearly = quality.missing_months(calendar.request_calendar(spark, 1999, 2000), have).collect()
    assert {r.year: r.n_missing for r in yearly} == {1999: 12, 2000: 1}


def test_flatten_and_sources(spark):
    df = spark.createDataFrame([(1, [1.0, None]), (2, [])], "k INT, row ARRAY<DOUBLE>")
    got = sorted((tuple(r) for r in grids.flatten_rows(df, "row").collect()), key=str)
    assert got == [(1, 0, 1.0), (1, 1, None), (2, None, None)]
    obs = spark.createDataFrame([("ERA5",), ("Berkeley",)], "source STRING")
    assert grids.enabled_observations(obs, ["ERA5"]).count() == 1


def test_countries_source(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [("X", 0, [{"x": 0.0, "y": 1.0}])]
    spark.createDataFrame(rows, schema.COUNTRY).write.parquet(path)
    assert grids.read_countries(spark, path).first().ring[0].y == 1.0

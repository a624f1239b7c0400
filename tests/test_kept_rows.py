"""Rows that must neither vanish nor multiply."""

import pytest
from pyspark.sql import functions as F

from climcube.config import REANALYSIS, Region, RunConfig
from climcube.operators import catalog, ensemble, quality, space
from climcube.plans import audit, series
from climcube.schema import MissingColumnsError, MissingTableError
from climcube.sources import grids
from climcube.sources.manifest import parse_names, read_manifest
from climcube.workload import bindings as b

SF = "/root/testdata/sf0.001"


def test_cells_on_the_edge_of_a_box(spark):
    cells = [("tas", 50.0 + i * 0.1, 365.0 + j * 0.1, 1.0, 1990) for i in range(3) for j in range(8)]
    grid = grids.canonical_grid(spark.createDataFrame(cells, "variable string, lat double, lon double, value double, year int"))
    box = Region("edge", 50.0, 50.2, 5.1, 5.5)
    assert space.select_box(grid, box).count() == 15
    assert space.assign_regions(grid, (box,)).count() == 15
    table = spark.createDataFrame([("edge", 50.0, 50.2, 5.1, 5.5)], "region string, lat_min double, lat_max double, lon_min double, lon_max double")
    assert space.region_cells(grid.select("lat", "lon"), table).count() == 15


def test_the_year_comes_from_any_kind_of_time(spark):
    rows = [("tas", 0.0, 0.0, 1.0, 1990.5, None), ("tas", 0.0, 0.0, 1.0, 1990.5, "2001-12-31 23:00:00")]
    raw = spark.createDataFrame(rows, "variable string, lat double, lon double, value double, time_label double, t string")
    raw = raw.withColumn("time", F.col("t").cast("timestamp_ntz")).drop("t")
    assert sorted(r.year for r in grids.canonical_grid(raw).collect()) == [1990, 2001]
    assert [r.year for r in grids.canonical_grid(raw.drop("time").limit(1)).collect()] == [1990]
    with pytest.raises(MissingColumnsError, match="time_label"):
        grids.canonical_grid(raw.drop("time", "time_label"))


def test_one_version_of_a_reduced_file(spark):
    names = ["tas_d_M_h_r_g_2015_v1.2_yearmean.nc", "tas_d_M_h_r_g_2015_yearmean.nc", "tas_d_M_h_r_g_2015.nc"]
    files = spark.createDataFrame([(n,) for n in names], "file_name string")
    assert sorted(r.file_name for r in catalog.pick_version(files).collect()) == [names[2], names[0]]


def test_files_without_a_year_come_last(spark):
    files = spark.createDataFrame([("tas_d_M_h_r_g_2015_x.nc",), ("tas_d_M_h_r_g.nc",), ("tas",), ("tas_d_M_h_r_g_2014_x.nc",)], "file_name string")
    got = {r.file_name: r.position for r in catalog.merge_order(parse_names(files)).collect()}
    assert got == {"tas_d_M_h_r_g_2014_x.nc": 1, "tas_d_M_h_r_g_2015_x.nc": 2, "tas_d_M_h_r_g.nc": 3, "tas": 1}


def test_every_manifest_row_is_used_or_rejected(spark, tmp_path):
    digest = "a" * 32
    rows = [
        (digest, "https://h/{a b}/tas_d_M_h_r_g_2015_x.nc"), (digest, " "), (None, None), (digest, "https://h/"),
        ("x", "https://h/tas_d_M_h_r_g_2015_x.nc"), (digest, "https://h/tas_d_M_h_r_g.nc"),
    ]
    good, bad = audit.manifest_rejects(spark.createDataFrame(rows, "md5 string, uri string"))
    assert [r.file_name for r in good.collect()] == ["tas_d_M_h_r_g_2015_x.nc"]
    assert sorted(r.reason for r in bad.collect()) == ["no digest", "no file name", "no uri", "no uri", "no year in name"]
    path = tmp_path / "manifest.csv"
    path.write_text("md5,uri\na,b\na,b,c\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_manifest(spark, str(path)).count()


def _listing(spark):
    """A manifest whose fields are computed columns of stored rows."""
    name = F.concat(F.lit("tas_d_M_h_r_g_2015_"), F.col("id"), F.lit(".nc"))
    uri = F.when(F.col("id") % 3 == 0, " ").otherwise(F.concat(F.lit(" https://h/"), name))
    return spark.range(30).select(F.concat(F.md5(name), F.lit(" ")).alias("md5"), uri.alias("uri"))


def test_rejects_work_out_a_row_once(spark):
    good, bad = audit.manifest_rejects(_listing(spark))
    for df in (good, bad):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.count("regexp_replace(") == 2  # one a field
    assert (good.count(), bad.count()) == (20, 10)
    assert {r.reason for r in bad.collect()} == {"no uri"}


def test_accounting_works_out_a_row_once_and_meets_files_in_one_join(spark):
    existing = spark.createDataFrame([("tas_d_M_h_r_g_2015_1_yearmean.nc",)], "file_name string")
    digests = spark.createDataFrame([("tas_d_M_h_r_g_2015_2.nc", "9")], "file_name string, actual_md5 string")
    df = audit.account(_listing(spark), existing, digests, None)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("Filter isnull(_why") == 1  # the finished column, not what it is made of
    assert text.count("Join") == 3  # file names with those on disk and with digests, rows with file names
    got = df.groupBy("status").count().collect()
    assert {r.status: r["count"] for r in got} == {"no uri": 10, "yearmean_exists": 1, "mismatch": 1, "missing": 18}


def test_rows_without_a_name_are_spread(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 0, "f").alias("file_name"), F.md5(F.col("id").cast("string")).alias("md5"))
    digests = spark.range(9).select(F.col("id").cast("string").alias("file_name"), F.lit("9").alias("actual_md5"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        at = catalog.verify_digests(rows, digests).groupBy(F.spark_partition_id(), "status").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(at) > 1 and {r.status for r in at} == {"missing"}
    assert sum(r["count"] for r in at) == 1000


def test_copies_of_a_file_do_not_multiply_its_manifest_row(spark):
    manifest = spark.createDataFrame([("f", "1"), ("g", "2"), ("h", "3")], "file_name string, md5 string")
    digests = spark.createDataFrame([("f", "9"), ("f", "1"), ("g", "9"), ("g", "8")], "file_name string, actual_md5 string")
    got = {r.file_name: (r.verified, r.status) for r in catalog.verify_digests(manifest, digests).collect()}
    assert got == {"f": (True, "ok"), "g": (False, "mismatch"), "h": (False, "missing")}


def test_skip_meets_existing_files_once(spark):
    plan = catalog.skip_existing(
        spark.createDataFrame([("f.nc",)], "file_name string"), spark.createDataFrame([("f_yearmean.nc",)], "file_name string")
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Join") == 1 and text.count("Exchange") <= 2
    assert plan.collect()[0].skip_reason == "yearmean_exists"


def test_enabled_but_absent_table_is_an_error(spark):
    grid = b.model_grid(spark, SF)
    with pytest.raises(MissingTableError, match=REANALYSIS):
        series.all_series(grid, RunConfig())


def test_single_pass_plans(spark):
    grid = b.model_grid(spark, SF)
    for df in (
        quality.coverage_gaps(grid, ["model"], 1994, 2002),
        ensemble.availability(grid, b.BASELINE, b.FUTURE),
        ensemble.dense_alignment(series.model_series(grid, b.CONFIG), ["A", "B"]),
    ):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 1 and "Join" not in text


def test_month_masks(spark):
    have = spark.createDataFrame([("a", 2000, m) for m in (1, 3, 12)] + [(None, 2001, 5), ("a", 1990, 1)], "k string, year int, month int")
    masks = {(r.k, r.year): r["mask"] for r in quality.month_masks(have, ["k"], 2000, 2001).collect()}
    assert masks == {("a", 2000): 1 + 4 + 2048, ("a", 2001): 0, (None, 2000): 0, (None, 2001): 16}
    assert quality.coverage_gaps(have, ["k"], 2000, 2001).where("k = 'a' and year = 2000").count() == 9


def test_a_run_groups_its_yearly_stage_without_a_shuffle(spark, tmp_path):
    """One small exchange each for series and maps of a stored run, in this session and in one that only finds the files."""
    from climcube.plans import maps
    from climcube.schema import BASELINE_KEYS
    from climcube.sources.store import Store

    store, cfg = Store(spark, str(tmp_path)), RunConfig(baseline=b.BASELINE, future=b.FUTURE, observations=())

    def stage():
        return store.materialize_bucketed("yearly", "x", lambda: series.yearly_table(b.model_grid(spark, SF)), 4, BASELINE_KEYS)

    first = stage()
    for _ in range(2):
        for df in (series.model_series(stage(), cfg), maps.change_map(stage(), cfg)):
            assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert stage().count() == first.count()
        for t in spark.catalog.listTables():
            if t.name.startswith("yearly_") and not t.isTemporary:
                spark.sql(f"DROP TABLE {t.name}")


def test_a_new_table_gives_a_new_result(spark, tmp_path):
    from climcube.plans.run import run
    from climcube.sources.store import Store

    store, inputs = Store(spark, str(tmp_path)), {"models": "x"}
    grid = b.model_grid(spark, SF)
    few = RunConfig(baseline=b.BASELINE, future=b.FUTURE, observations=())
    some = RunConfig(baseline=b.BASELINE, future=b.FUTURE, observations=(REANALYSIS,))
    assert run(store, few, inputs, grid).series.where(F.col("source") == REANALYSIS).count() == 0
    found = run(store, some, inputs, grid, b.reanalysis_grid(spark, SF)).series
    assert found.where(F.col("source") == REANALYSIS).count() > 0

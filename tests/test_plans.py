"""The shape of the physical plans, without running them."""

import pytest
from pyspark.sql import functions as F

from climcube.config import RunConfig
from climcube.operators import catalog, temporal
from climcube.plans import maps, series
from climcube.schema import BASELINE_KEYS
from climcube.sources import grids
from climcube.workload.queries import registry

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry()))
def test_no_query_multiplies_or_leaves_the_jvm(spark, name):
    plan = plan_of(registry()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "Exchange SinglePartition"):
        assert node not in plan, f"{node} in the plan of {name}"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "g")
    row = [("tas", "CMIP6", "MIROC6", "historical", 1990, 1, 45.0, 10.0, 1.0)]
    names = "variable STRING, source STRING, model STRING, experiment STRING, year INT, month INT, lat DOUBLE, lon DOUBLE, value DOUBLE"
    grids.write_grid(grids.canonical_grid(spark.createDataFrame(row, names)), path)
    return grids.read_grid(spark, path)


def test_series_read_the_grid_once_and_join_nothing(stored):
    plan = plan_of(series.model_series(stored, RunConfig()))
    assert plan.count("FileScan") == 1
    assert "Join" not in plan
    assert "partial_avg" in plan and "partial_sum" in plan
    assert "GreaterThanOrEqual(lat,-5.0E-5)" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    partitions = scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "experiment" in partitions and "variable" in partitions


def test_maps_read_the_grid_once_and_join_nothing(stored):
    plan = plan_of(maps.change_map(stored, RunConfig()))
    assert plan.count("FileScan") == 1
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 3
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "model" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "year" in scan.split("PushedFilters")[1].split("ReadSchema")[0]


def test_first_rows_are_trimmed_before_the_shuffle(stored):
    first = temporal.dedupe_time(stored, ["model"], [F.col("month")])
    versions = catalog.pick_version(stored.select(F.col("model").alias("file_name")))
    for df in (first, versions):
        plan = plan_of(df)
        assert plan.count("WindowGroupLimit") == 2
        assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_contents_do_not_travel(spark, tmp_path):
    (tmp_path / "a.nc").write_bytes(b"x")
    from climcube.sources import manifest

    listed = spark.createDataFrame([("a.nc", "0")], "file_name STRING, md5 STRING")
    plan = plan_of(catalog.verify_digests(listed, manifest.read_digests(spark, str(tmp_path))))
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("content" in line for line in exchanges)
    assert "content" not in plan_of(manifest.list_files(spark, str(tmp_path))).split("ReadSchema")[-1]


def test_a_bucketed_yearly_table_is_not_shuffled(spark, stored):
    yearly = series.yearly_table(stored)
    grids.save_bucketed(yearly, "yearly_buckets", 4, BASELINE_KEYS)
    table = spark.table("yearly_buckets")
    cfg = RunConfig()
    spread = plan_of(series.model_series(table, cfg))
    assert spread.count("Exchange") == 1  # the spatial mean only
    change = plan_of(maps.change_map(table, cfg))
    assert change.count("Exchange") == 1  # the mean over models only
    assert table.count() == yearly.count()

"""The yearly state that new files are added to, and the load chain of stored series."""

import pytest
from pyspark.sql import functions as F

from climcube.plans import series
from climcube.schema import CELL, SERIES_KEYS
from climcube.sources.incremental import YearlyState, list_stamped

GRID = "path STRING, variable STRING, source STRING, model STRING, experiment STRING, year INT, lat_q INT, lon_q INT, value DOUBLE"
ROWS = [(f"{e}-{y}-{half}", "tas", "s", "m", e, y, 10 * cell, 0, float(y % 7 + cell + half))
        for e in ("historical", "ssp126") for y in (2000, 2001) for half in (0, 1) for cell in range(3)]


class Folder:
    """Files and their rows; remembers which files an update has read."""

    def __init__(self, spark, rows=ROWS):
        self.rows, self.read_paths, self.spark = spark.createDataFrame(rows, GRID).cache(), set(), spark

    def files(self, where="true", stamp="'1'"):
        return self.rows.filter(where).select("variable", "experiment", "year", "path", F.expr(stamp).alias("stamp")).distinct()

    def read(self, paths):
        self.read_paths = {r.path for r in paths.collect()}
        return self.rows.join(paths, "path", "left_semi")

    def expected(self, where="true"):
        return values(self.rows.filter(where).groupBy(*SERIES_KEYS, *CELL, "year").agg(
            F.avg("value").alias("value"), F.count("value").alias("n_steps")))


def values(means):
    return {tuple(r) for r in means.select("experiment", "year", *CELL, F.round("value", 9), "n_steps").collect()}


def taken(actions):
    return sorted((r.experiment, r.year, r.action, r.n_files) for r in actions.collect())


def test_new_files_cost_their_own_partitions(spark, tmp_path):
    folder, state = Folder(spark), YearlyState(spark, str(tmp_path / "state"))
    first = "path <> 'ssp126-2001-1'"
    assert [a[2] for a in taken(state.update(folder.files(first), folder.read))] == ["rebuild"] * 4
    assert values(state.yearly()) == folder.expected(first)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "state" / "state").rglob("*.parquet")
                 if "experiment=ssp126/year=2001" not in str(p)}
    assert taken(state.update(folder.files(), folder.read)) == [("ssp126", 2001, "add", 1)]
    assert folder.read_paths == {"ssp126-2001-1"}
    assert {p: p.stat().st_mtime_ns for p in untouched} == untouched
    assert values(state.yearly()) == folder.expected()
    assert taken(state.update(folder.files(), folder.read)) == []


def test_changed_and_lost_files(spark, tmp_path):
    folder, state = Folder(spark), YearlyState(spark, str(tmp_path / "state"))
    state.update(folder.files(), folder.read)
    changed = folder.files(stamp="IF(path = 'historical-2000-0', '2', '1')")
    assert taken(state.update(changed, folder.read)) == [("historical", 2000, "rebuild", 2)]
    assert folder.read_paths == {"historical-2000-0", "historical-2000-1"}
    assert values(state.yearly()) == folder.expected()
    rest = "experiment = 'historical' AND path <> 'historical-2001-1'"
    left = changed.filter(rest)
    assert [a[:3] for a in taken(state.update(left, folder.read))] == [
        ("historical", 2001, "rebuild"), ("ssp126", 2000, "empty"), ("ssp126", 2001, "empty")]
    assert values(state.yearly()) == folder.expected(rest)


def test_an_update_that_stopped_is_made_good(spark, tmp_path):
    folder, state = Folder(spark), YearlyState(spark, str(tmp_path / "state"))
    part = "year = 2000"
    state.update(folder.files(part), folder.read)
    replace = state._replace

    def stops_before_the_ledger(rows, name):
        if name == "ledger":
            raise RuntimeError("lost")
        replace(rows, name)

    state._replace = stops_before_the_ledger
    with pytest.raises(RuntimeError, match="lost"):
        state.update(folder.files(), folder.read)
    again = YearlyState(spark, str(tmp_path / "state"))
    # the half-written year is computed anew, or emptied if its files have gone
    assert {a[1:3] for a in taken(again.changes(folder.files()).groupBy("variable", "experiment", "year", "action").agg(
        F.count("path").alias("n_files")))} == {(2001, "rebuild")}
    again.update(folder.files(part), folder.read)
    assert values(again.yearly()) == folder.expected(part)
    again.update(folder.files(), folder.read)
    assert values(again.yearly()) == folder.expected()


def test_first_update_that_stopped(spark, tmp_path):
    folder, state = Folder(spark), YearlyState(spark, str(tmp_path / "state"))
    replace = state._replace
    state._replace = lambda rows, name: replace(rows, name) if name == "state" else 1 / 0
    with pytest.raises(ZeroDivisionError):
        state.update(folder.files(), folder.read)
    state = YearlyState(spark, str(tmp_path / "state"))
    state.update(folder.files("year = 2001"), folder.read)
    assert values(state.yearly()) == folder.expected("year = 2001")


def test_state_refuses_what_it_cannot_place(spark, tmp_path):
    folder, state = Folder(spark), YearlyState(spark, str(tmp_path / "state"))
    with pytest.raises(ValueError, match="lacks"):
        state.update(folder.files().withColumn("year", F.lit(None).cast("int")), folder.read)
    with pytest.raises(ValueError, match="no state"):
        state.yearly()


def test_stamps_change_with_contents(spark, tmp_path):
    (tmp_path / "a.nc").write_text("one")
    before = list_stamped(spark, str(tmp_path), "*.nc").first()
    (tmp_path / "a.nc").write_text("three")
    after = list_stamped(spark, str(tmp_path), "*.nc").first()
    assert before.path == after.path and before.stamp != after.stamp


SERIES = "file_name STRING, experiment STRING, variable STRING, time_label DOUBLE, position BIGINT, value DOUBLE"


def test_load_chain(spark, tmp_path):
    rows = [
        ("a", "ssp126", "var167", 2000.9, 1, 9.0),  # not the best alias of its file
        ("a", "ssp126", "tas", 2000.5, 3, 2.0), ("a", "ssp126", "tas", 2000.0, 2, 1.0),  # a repeated year
        ("a", "ssp126", "tas", 2001.99, 4, 3.0),
        ("b", "ssp126", "temperature_anomaly", 2000.0, 1, float("nan")),  # a first value that is missing stays first
        ("b", "ssp126", "temperature_anomaly", 2000.2, 2, 5.0),
        ("c", "ssp126", "hurs", 2000.0, 1, 7.0), ("d", "ssp126", "tas", None, 1, 7.0),  # no alias; no time
    ]
    spark.createDataFrame(rows, SERIES).write.parquet(str(tmp_path / "s"))
    loaded = series.load_series(spark.read.parquet(str(tmp_path / "s")), "tas")
    assert sorted((r.model, r.year, r.anomaly, r.n_repeats) for r in loaded.collect()) == [
        ("a", 2000, 1.0, 1), ("a", 2001, 3.0, 0), ("b", 2000, None, 1)]
    plan = loaded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan


def test_load_chain_converts_units(spark):
    one = spark.createDataFrame([("a", "ssp126", "tp", 2000.0, 1, 1.0)], SERIES)
    assert series.load_series(one, "pr").first().anomaly == pytest.approx(86400)

"""A stored run equals the direct analyses and is not computed twice."""

import uuid

import pytest
from pyspark.sql import functions as F

from climcube.plans import maps, series
from climcube.plans.run import run
from climcube.sources.store import Store, fingerprint
from climcube.workload import bindings as b

SF = "/root/testdata/sf0.001"


def test_stored_run(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    inputs = {"models": uuid.uuid4().hex}
    tables = (
        b.model_grid(spark, SF), b.reanalysis_grid(spark, SF),
        b.station_anomalies(spark, SF), b.station_climatology(spark, SF),
    )
    first = run(store, b.CONFIG, inputs, *tables)

    direct = series.ensemble_spread(series.all_series(tables[0], b.CONFIG, *tables[1:]), b.CONFIG)
    columns = ["experiment", "region", "year", "p50", "n_models"]
    got = [tuple(r) for r in first.spread.select(columns).collect()]
    want = [tuple(r) for r in direct.orderBy("experiment", "region", "year").select(columns).collect()]
    assert len(got) == len(want) > 0
    for x, y in zip(got, want):
        assert x == pytest.approx(y, abs=1e-9)

    total = F.sum("n_models")
    change = maps.change_map(tables[0], b.CONFIG)
    assert first.maps.agg(total).first()[0] == change.agg(total).first()[0]

    def fail(*_):
        raise AssertionError("computed again")

    monkeypatch.setattr(series, "all_series", fail)
    monkeypatch.setattr(series, "yearly_table", fail)
    monkeypatch.setattr(maps, "classified_map", fail)
    again = run(store, b.CONFIG, inputs, *tables)
    assert again.series.count() == first.series.count()
    assert fingerprint({"inputs": inputs, "config": b.CONFIG}) != fingerprint(
        {"inputs": inputs, "config": b.CONFIG_ALL_REGIONS})

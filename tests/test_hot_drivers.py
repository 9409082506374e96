"""The registered queries over all drivers cut hot drivers into segments."""

import pytest

from checks import queries
from fleetmart.operators.scale import Limits, hot_keys

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["q10_all_drivers", "q11_all_drivers", "win_lag_gap", "win_numbering"])
def test_hot_drivers_are_split(spark, monkeypatch, name):
    monkeypatch.setattr(queries, "_HOT", {})
    plain = queries.registry()[name](spark, SF)
    assert not any("/segments-" in file for file in plain.inputFiles())
    monkeypatch.setattr(queries, "_HOT", {})
    monkeypatch.setattr(queries, "hot_keys", lambda df, key: hot_keys(df, key, Limits(hot_rows=20)))
    split = queries.registry()[name](spark, SF)
    assert any("/segments-" in file for file in split.inputFiles())
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))

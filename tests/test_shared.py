"""All reports from two passes over the fact."""

import pytest

from fleetmart.plans import reports, shared, states, warehouse
from tests.test_increment import frames, raw_rows


def plain(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    rows = raw_rows(11, rides=900)
    # One driver with more rides than a state keeps; rated rides at the same time.
    rows["rides"] = rows["rides"] + [(f"t{k}", "u1", "a", "b", rows["rides"][0][4], None, None, None, "d0") for k in range(130)]
    rows["ratings"] = rows["ratings"] + [(f"q{k}", f"t{k}", "u1", 1 + k % 5, None, None) for k in range(0, 130, 3)]
    return warehouse.build(frames(spark, rows), str(tmp_path_factory.mktemp("shared")), checks="none")


def test_states_equal_those_of_the_whole_fact(built):
    wh = shared.reduced(built, [1, 4])
    for got, want in (
        (wh.driver_states, states.driver_states(built.fact_rides)),
        (wh.user_states, states.user_states(built.fact_rides)),
    ):
        assert got.count() > 3 and plain(got.select(want.columns)) == plain(want)
    sample = built.fact_rides.where("driver_key in (1, 4)").select(wh.fact_rides.columns)
    assert sample.count() > 100 and plain(wh.fact_rides) == plain(sample)
    hours = built.fact_rides.selectExpr("start_date_key", "hour(start_time) as h").distinct()
    assert wh.hour_states.count() == hours.count()


def test_latest_rides_at_one_time(spark, built):
    """More rated rides share the last time than a state keeps."""
    fact = built.fact_rides.where("driver_key = 1").limit(1)
    row = fact.first().asDict()
    many = [row | {"ride_id": f"z{k:03}", "average_driver_rating": row["fare_amount"] * 0 + k % 5} for k in range(250)]
    fact = spark.createDataFrame([tuple(r[c] for c in fact.columns) for r in many], fact.schema)
    latest = shared.kept_rides(fact, []).where("view = 'latest'")
    assert latest.count() == 250
    assert shared.kept_rides(fact, []).where("view = 'first'").count() == states.KEPT
    assert shared.kept_rides(fact.limit(0), [1]).count() == 0


def test_shared_reports_equal_single_ones_and_read_no_fact(built):
    names = ["Driver 0", "Driver 3"]
    one = reports.catalog(built, driver_names=names)
    other = reports.catalog(built, driver_names=names, shared=True)
    assert list(one) == list(other)
    for name in one:
        left, right = one[name](), other[name]()
        assert left.columns == right.columns, name
        assert plain(left) == plain(right), name
        assert not any("/fact_rides/" in file for file in right.inputFiles()), name
    with pytest.raises(ValueError):
        reports.catalog(built, driver_names=None, shared=True)


def test_the_fact_is_scanned_twice(built, monkeypatch):
    scans = []
    real = shared.materialize

    def counted(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans.extend(["fact"] * plan.count("fact_rides"))
        if label == "report-totals":  # one expansion, hash tables only
            assert "SortAggregate" not in plan and plan.count("Expand") == 1
        if label == "report-rides":
            assert "WindowGroupLimit" in plan
        return real(df, label)

    monkeypatch.setattr(shared, "materialize", counted)
    shared.reduced(built, [1])
    assert len(scans) == 2

"""Sequence columns: the split form against the plain window."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetmart.operators.scale import Limits, hot_keys
from fleetmart.operators.sequence import (
    last_value,
    latest_per_key,
    sequence,
    with_group_values,
)

TINY = Limits(hot_rows=6)
WANTED = {
    "row_number": "n",
    "lag": {"prior_end": "finish", "prior_fare": "fare"},
    "lead": {"next_begin": "begin"},
    "first": {"first_fare": "fare"},
}


def _rides(spark, seed=1, same_time=False):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for ride in range(150):
        driver = 1 if ride < 60 else rng.randrange(2, 30)
        begin = start if same_time else start + dt.timedelta(minutes=rng.randrange(200))
        fare = rng.choice([None, 1, 2, 3])
        rows.append((ride, driver, begin, begin + dt.timedelta(minutes=5), fare))
    return spark.createDataFrame(
        rows, "id bigint, driver int, begin timestamp_ntz, finish timestamp_ntz, fare int"
    )


@pytest.mark.parametrize("same_time", [False, True])
def test_split_equals_plain(spark, same_time):
    rides = _rides(spark, same_time=same_time)
    plain = sequence(rides, "driver", ["begin", "id"], **WANTED)
    hot = hot_keys(rides, "driver", TINY)
    split = sequence(rides, "driver", ["begin", "id"], **WANTED, hot=hot, limits=TINY)
    assert split.columns == plain.columns
    assert sorted(split.collect(), key=lambda r: r.id) == sorted(
        plain.collect(), key=lambda r: r.id
    )


def test_hot_driver_is_spread(spark):
    rides = _rides(spark)
    hot = hot_keys(rides, "driver", TINY)
    assert (1, 60) in [tuple(row) for row in hot.counts.collect()]
    assert hot_keys(rides, "driver", Limits(hot_rows=1000)) is None


def test_all_hot_keys_are_split(spark):
    limits = Limits(hot_rows=2)
    rides = _rides(spark)
    hot = hot_keys(rides, "driver", limits)
    assert hot.number == rides.groupBy("driver").count().where("count > 2").count() > 10
    plain = sequence(rides, "driver", ["begin", "id"], **WANTED)
    split = sequence(rides, "driver", ["begin", "id"], **WANTED, hot=hot, limits=limits)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_lag_and_lead_are_inverse(spark):
    rides = _rides(spark)
    linked = sequence(
        rides,
        "driver",
        ["begin", "id"],
        lag={"before": "id"},
        lead={"after": "id"},
        hot=hot_keys(rides, "driver", TINY),
        limits=TINY,
    )
    pairs = {(r.before, r.id) for r in linked.collect() if r.before is not None}
    assert pairs == {(r.id, r.after) for r in linked.collect() if r.after is not None}


def test_single_ride_has_no_neighbours(spark):
    row = spark.createDataFrame([(1, 9, 5)], "id bigint, driver int, t int")
    got = sequence(row, "driver", ["t", "id"], lag={"p": "t"}, lead={"x": "t"}, row_number="n")
    assert (got.first().p, got.first().x, got.first().n) == (None, None, 1)


def test_one_window_and_one_exchange(spark, events):
    plan = sequence(
        events.fact_rides,
        "driver_key",
        ["start_time", "ride_id"],
        lag={"p": "end_time"},
        lead={"x": "start_time"},
        row_number="n",
        first={"f": "fare_amount"},
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(driver_key") == 1
    assert plan.count("SinglePartition") == 0


def test_latest_drops_rows_before_the_shuffle(spark, events):
    latest = latest_per_key(events.fact_rides, "driver_key", ["start_time", "ride_id"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.count() == events.dim_driver.count()


@pytest.mark.parametrize("unset", [0, 1])
def test_group_values(spark, unset):
    """``unset`` is a driver whose key is taken away: NULL is a group like any other."""
    rides = _rides(spark).withColumn("driver", F.when(F.col("driver") != unset, F.col("driver")))
    got = with_group_values(
        rides,
        "driver",
        {"n": F.count(F.lit(1)), "last": last_value("fare", ["begin", "id"])},
    )
    rows = rides.collect()
    assert got.count() == len(rows)
    for row in got.collect():
        mine = sorted((r.begin, r.id, r.fare) for r in rows if r.driver == row.driver)
        assert (row.n, row["last"]) == (len(mine), mine[-1][2])

"""What a load in batches computes once only."""

import re

from test_increment import batch_of, by_time, frames, raw_rows, same

from fleetmart.operators.scale import Limits
from fleetmart.plans import increment


def test_ratings_meet_rides_where_copies_of_an_id_met(spark, tmp_path, monkeypatch):
    plans, put = {}, increment.materialize

    def keep(df, label, *rest):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return put(df, label, *rest)

    monkeypatch.setattr(increment, "materialize", keep)
    rows = raw_rows(11, rides=60)
    wh = increment.load_batch(frames(spark, rows), str(tmp_path / "wh"), groups=2)
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plans["batch"])
    assert sum("ride_id" in keys for keys in moved) == 2  # rides and ratings, each once
    same(spark, wh, rows)


def test_hot_driver_months_come_from_counts(spark, tmp_path, monkeypatch):
    """Joined rides aren't computed once more to count them, and hot ones are still found."""
    asked, found = [], []
    count, places = increment.hot_keys, increment._hot_places

    def spy(df, key, *rest):
        asked.append(key)
        return count(df, key, *rest)

    def seen(*args):
        found.append(places(*args))
        return found[-1]

    monkeypatch.setattr(increment, "hot_keys", spy)
    monkeypatch.setattr(increment, "_hot_places", seen)
    rows, root = raw_rows(13, rides=120), str(tmp_path / "wh")
    for ids in reversed(by_time(rows, 2, 14)):
        wh = increment.load_batch(
            frames(spark, batch_of(rows, ids)), root, groups=2, limits=Limits(hot_rows=6, range_parts=2)
        )
    same(spark, wh, rows)
    assert set(asked) == {"user_id"}
    assert all(hot is None or hot.counts.where("_n <= 6").isEmpty() for hot in found)
    assert sum(hot is not None for hot in found) >= 2


def test_staged_tables_are_not_sampled(spark):
    df = spark.range(100).selectExpr("id % 4 as driver_group", "202401 as start_month", "1 as load", "id")
    laid = increment._together_by(df, "fact_parts")
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan and "rangepartitioning" not in plan
    assert sorted(map(tuple, laid.collect())) == sorted(map(tuple, df.collect()))

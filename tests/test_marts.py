"""Marts on cases the test tables lack, report runner, and plan shapes."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetmart.operators.scale import Limits, hot_keys
from fleetmart.plans import facts, marts, reports
from fleetmart.plans.warehouse import Warehouse

TINY = Limits(hot_rows=20, range_parts=6)


def _same(left, right):
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("mart", "arguments"),
    [
        (marts.leaderboard, {}),
        (marts.revenue_rank, {}),
        (marts.quality_tiers, {}),
        (marts.commission, {}),
        (marts.efficiency_quartiles, {}),
        (marts.value_segments, {"by": "user_key"}),
        (marts.idle_gaps, {"driver_keys": None}),
        (marts.progression, {"driver_names": None}),
    ],
)
def test_split_form_gives_the_same_mart(events, mart, arguments):
    whole = mart(events, limit=None, **arguments)
    if mart in (marts.idle_gaps, marts.progression):
        arguments = arguments | {"hot": hot_keys(events.fact_rides, "driver_key", TINY)}
        assert arguments["hot"].number > 1
    _same(mart(events, limit=None, limits=TINY, **arguments), whole)


def test_limited_marts_are_the_first_rows_of_the_whole(events):
    whole = marts.revenue_rank(events, limit=None).orderBy("revenue_rank", "driver_name")
    assert marts.revenue_rank(events, limit=4).collect() == whole.take(4)


def test_milestones_drop_rows_before_the_shuffle(events):
    assert "WindowGroupLimit" in _plan(marts.driver_milestones(events))


def test_sample_filter_reaches_the_scan(events):
    plan = _plan(marts.idle_gaps(events))
    assert "In(driver_key, [1,10,15,20,5])" in plan.replace(", 5", ",5") or "In(driver_key" in plan


def test_dimensions_are_joined_after_the_reduction(events):
    for mart in (marts.driver_revenue, marts.customer_spend):
        optimized = mart(events)._jdf.queryExecution().optimizedPlan().toString()
        fact_side = optimized[optimized.index("Join") :]
        assert "Aggregate" in fact_side
    for mart in (marts.peak_hours, marts.vip_customers):
        assert "TakeOrderedAndProject" in _plan(mart(events))


def test_unused_fact_columns_are_not_read(events):
    plan = _plan(marts.peak_hours(events))
    assert "average_driver_rating" not in plan and "end_time" not in plan.replace("start_time", "")


def test_last_ride_and_zero_first_fare(spark, events):
    rides = [(1, 1, "2024-01-01 10:00:00", "2024-01-01 10:10:00", Decimal("0.00"))]
    rides += [(2, 1, "2024-01-01 12:10:00", "2024-01-01 12:20:00", Decimal("20.00"))]
    rides += [(3, 1, "2024-01-01 16:20:00.1", "2024-01-01 16:30:00", Decimal("5.00"))]
    fact = spark.createDataFrame(
        rides, "ride_id int, driver_key int, s string, e string, fare_amount decimal(10,2)"
    ).select(
        "ride_id",
        "driver_key",
        F.col("s").cast("timestamp_ntz").alias("start_time"),
        F.col("e").cast("timestamp_ntz").alias("end_time"),
        "fare_amount",
    )
    wh = Warehouse(
        events.dim_user,
        spark.createDataFrame([(1, "Solo")], "driver_key int, driver_name string"),
        events.dim_date,
        fact,
        events.daily_rides,
    )
    gaps = marts.idle_gaps(wh, driver_keys=None, limit=None).orderBy("start_hour").collect()
    # Exactly two hours is normal; just over four is a risk though it rounds to 4.0.
    assert [(g.idle_hours_until_next_ride, g.retention_risk_flag[:6]) for g in gaps] == [
        (Decimal("2.0"), "Normal"),
        (Decimal("4.0"), "CHURN "),
    ]
    grown = marts.progression(wh, driver_names=["Solo"]).orderBy("ride_number").collect()
    assert [g.improvement_percent for g in grown] == [None, None, None]
    assert [g.performance_trend[:6] for g in grown] == ["Stable", "Strong", "Positi"]
    assert [g.ride_number for g in grown] == [1, 2, 3]


def test_empty_warehouse_gives_empty_marts(events):
    none = Warehouse(
        events.dim_user,
        events.dim_driver,
        events.dim_date,
        events.fact_rides.where("false"),
        facts.daily_rides(events.fact_rides.where("false")),
    )
    assert marts.leaderboard(none).isEmpty()
    assert marts.commission(none).isEmpty()
    assert marts.value_segments(none).isEmpty()
    assert marts.quality_trend(none).isEmpty()


def test_segments_add_up(events):
    stats = reports.segment_stats(marts.value_segments(events, limit=None))
    total = events.fact_rides.agg(F.sum("fare_amount")).first()[0]
    assert stats.agg(F.sum("total_fare")).first()[0] == total


def test_report_runner_notes_empty_and_failing_reports(spark, tmp_path):
    def broken():
        raise ValueError("no")

    made = {
        "good": lambda: spark.range(3),
        "empty": lambda: spark.range(0),
        "broken": broken,
    }
    rows = reports.write_reports(made, str(tmp_path), "json").collect()
    assert {(r.report, r.n_rows, r.status) for r in rows} == {
        ("good", 3, "OK"),
        ("empty", 0, "NO DATA"),
        ("broken", 0, "FAILED: ValueError: no"),
    }


def test_no_earlier_report_stands_in_for_a_failing_one(spark, tmp_path):
    runs = []
    for make in (lambda: spark.range(3), lambda: spark.range(1 // 0)):
        made = {"one": lambda: spark.range(2), "other": make}
        rows = reports.write_reports(made, str(tmp_path), "json").collect()
        runs.append({r.report: (r.n_rows, r.status) for r in rows})
    assert runs[0]["other"] == (3, "OK")
    assert runs[1]["other"][0] == 0 and "by zero" in runs[1]["other"][1]
    assert sorted(len(list(run.iterdir())) for run in tmp_path.iterdir()) == [1, 2]


def test_leaderboard_does_not_read_the_fact(spark, events):
    plan = _plan(marts.leaderboard(events))
    assert "waits:bigint" in plan and "ride_id" not in plan and "start_time" not in plan


def test_names_filter_the_scan_of_the_fact(spark, events):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        names = [f"Driver#{n}" for n in range(5)]
        plan = _plan(marts.progression(events, driver_names=names))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "ride_id" in x)
    assert "driver_key" in scan[scan.index("PushedFilters") :]
    assert "LeftSemi" not in plan
    assert plan.count("Exchange hashpartitioning(driver_key") <= 3  # window, join, dimension


def test_many_bearers_of_a_name_are_joined(events, monkeypatch):
    names = [f"Driver#{n}" for n in range(5)]
    want = marts.progression(events, driver_names=names, limit=None)
    listed = want.collect()
    monkeypatch.setattr(marts, "MOST_KEYS", 1)
    _same(marts.progression(events, driver_names=names, limit=None), want)
    assert len({r.driver_name for r in listed}) == 5


def test_labels_are_the_published_ones():
    """Literals, so that a changed label or bound cannot pass on both sides of a comparison."""
    from fleetmart.functions import labels

    assert labels.PEAK_HOURS == [7, 8, 16, 17]
    assert labels.REVENUE_TIERS == [(10, "Top Tier (Rank <=10)"), (30, "Mid Tier (Rank 11-30)")]
    assert labels.QUALITY_TIERS == [
        (1, "Platinum (4.8+)"),
        (2, "Gold (4.5-4.7)"),
        (3, "Silver (4.0-4.4)"),
    ]
    assert [(str(n), t) for n, t in labels.COMMISSION_TIERS] == [
        ("0.20", "Top 20% - +15% Commission"),
        ("0.50", "Top 50% - +10% Commission"),
    ]
    assert [(str(n), t) for n, t in labels.EFFICIENCY_QUARTILES] == [
        ("0.25", "Q1 (Best) - Fleet Stars"),
        ("0.50", "Q2 (Good) - Reliable"),
        ("0.75", "Q3 (Fair) - Training Eligible"),
    ]
    assert labels.IDLE_FLAGS == [(4, "CHURN RISK: >4hr idle"), (2, "WARNING: 2-4hr idle")]
    assert [n for n, _ in labels.PROGRESSION_TRENDS] == [20, 5, 0]
    assert [n for n, _ in labels.LIFECYCLE_STAGES] == [100, 50, 10]
    assert str(labels.TREND_ALERT_BELOW) == "-0.5"
    assert labels.MILESTONES == [1, 10, 50, 100]
    assert labels.SAMPLE_DRIVER_KEYS == [1, 5, 10, 15, 20]


def test_views_answer_sql(spark, events):
    events.register_views()
    total = spark.sql("SELECT sum(total_rides_that_day) FROM v_driver_daily_utilization")
    firsts = events.fact_rides.select("driver_key").distinct().count()
    assert total.first()[0] == events.fact_rides.count() - firsts

"""Dimensions, fact, keys, quality and files on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmart.functions.scalars import (
    exact_avg,
    fingerprint,
    initial,
    minutes_between,
    tier,
)
from fleetmart.operators import keys, quality
from fleetmart.operators.scale import Limits
from fleetmart.plans import facts, warehouse
from fleetmart.schemas import RAW, RULES, STAR, value_kinds
from fleetmart.sources import raw as raw_files
from fleetmart.sources import tables

TINY = Limits(hot_rows=3, range_parts=5)


def _time(text):
    return dt.datetime.fromisoformat(f"2024-01-0{text}")


def _raw(spark):
    """Namesakes, a shared and a missing vehicle, copies, NULLs, overlaps, odd ratings."""
    users = [
        ("1", "Ann", "a@x", "1", dt.date(2023, 1, 1), 30, "F", "  Rome "),
        ("2", "", "b@x", "2", dt.date(2023, 1, 2), 31, "M", "Oslo"),
        ("10", None, None, None, None, None, None, None),
        ("u-x", "Zoe", "z@x", "9", dt.date(2023, 1, 3), 33, "F", "Bern"),
    ]
    drivers = [
        ("1", "Joe", "7", Decimal("4.50"), 3, True),
        ("2", "Joe", "7", None, None, False),
        ("10", "Eve", "404", None, None, None),
    ]
    vehicles = [("7", "Make, Inc", "M", 2001, 4)]
    rides = [
        # id, user, driver, start, end, km, fare
        ("r1", "1", "1", _time("1 07:00:00"), _time("1 07:30:00"), "5.00", "0.00"),
        ("r2", "1", "1", _time("1 07:20:00"), _time("1 08:00:00"), "6.00", "12.00"),
        ("r3", "2", "1", _time("1 23:59:30"), _time("2 00:10:00.500"), "7.00", "9.00"),
        ("r4", "2", "2", _time("2 16:00:00"), None, None, "3.00"),
        ("r5", "10", "10", _time("3 18:00:00"), _time("3 18:05:00"), "1.00", None),
        ("r6", "404", "1", _time("1 09:00:00"), _time("1 09:01:00"), "1.00", "1.00"),
        ("r7", None, "1", _time("1 09:00:00"), _time("1 09:01:00"), "1.00", "1.00"),
        ("r8", "1", "404", _time("1 09:00:00"), _time("1 09:01:00"), "1.00", "1.00"),
        ("r9", "1", "1", None, _time("1 09:01:00"), "1.00", "1.00"),
    ]
    rides = [
        (i, u, None, None, s, e, km and Decimal(km), fare and Decimal(fare), d)
        for i, u, d, s, e, km, fare in rides
    ]
    ratings = [
        ("t1", "r1", "1", 2, None, dt.date(2024, 1, 1)),
        ("t2", "r1", "1", 5, None, dt.date(2024, 1, 2)),
        ("t3", "r2", "1", 1, None, dt.date(2024, 1, 2)),
        ("t4", "r2", "1", 4, None, dt.date(2024, 1, 2)),
    ]
    rows = dict(users=users, drivers=drivers, vehicles=vehicles, rides=rides, ratings=ratings)
    return {name: spark.createDataFrame(rows[name], RAW[name]) for name in RAW}


@pytest.fixture(scope="module", params=["default", "split"])
def built(request, spark, tmp_path_factory):
    limits = TINY if request.param == "split" else Limits()
    return warehouse.build(_raw(spark), str(tmp_path_factory.mktemp("wh")), limits=limits)


def test_tables_have_the_declared_columns(built):
    assert set(STAR) == set(warehouse._TABLES)
    for name, schema in STAR.items():
        assert getattr(built, name).schema.simpleString() == schema.simpleString()


def test_user_keys_follow_numbers_then_text(built):
    rows = built.dim_user.orderBy("user_key").collect()
    assert [(r.user_key, r.user_id) for r in rows] == [(1, "1"), (2, "2"), (3, "10"), (4, "u-x")]
    assert [r.masked_name for r in rows] == ["A.", ".", None, "Z."]
    assert rows[0].location_city == "Rome"
    assert all(r.is_active_subscriber is None for r in rows)


def test_no_personal_data_survives(spark, built):
    clear = {"Ann", "a@x", "Zoe", "z@x"}
    for row in built.dim_user.collect():
        assert not clear & {value for value in row if isinstance(value, str)}


def test_driver_without_vehicle_is_kept(built):
    rows = {r.driver_id: r for r in built.dim_driver.collect()}
    assert rows["10"].vehicle_make is None and rows["10"].is_available_flag is None
    assert rows["1"].vehicle_make == rows["2"].vehicle_make == "Make, Inc"


def test_fact_rows(built):
    rows = {r.ride_id: r for r in built.fact_rides.collect()}
    assert set(rows) == {"r1", "r2", "r3", "r4", "r5"}
    assert rows["r1"].time_to_next_ride_minutes is None
    assert rows["r2"].time_to_next_ride_minutes == Decimal("-10.00")  # overlapping rides
    assert rows["r3"].time_to_next_ride_minutes == Decimal("959.50")
    assert rows["r3"].ride_duration_minutes == Decimal("10.51")
    assert rows["r4"].ride_duration_minutes is None
    assert rows["r3"].start_date_key == 20240101
    assert [rows[f"r{n}"].is_peak_hour for n in range(1, 6)] == [True, True, False, True, False]
    assert rows["r1"].average_driver_rating == Decimal("5.00")  # the later date
    assert rows["r2"].average_driver_rating == Decimal("4.00")  # the higher id
    assert rows["r3"].average_driver_rating is None


def test_fact_is_stored_in_driver_and_time_order(spark, built):
    order = ["driver_key", "start_time", "ride_id"]
    for path in built.fact_rides.inputFiles():
        rows = [tuple(row) for row in spark.read.parquet(path).select(*order).collect()]
        assert rows == sorted(rows)


def test_layout_adds_no_sort_and_star_joins_broadcast(spark, built):
    raw = _raw(spark)
    fact = facts.fact_rides(
        raw["rides"], raw["ratings"], built.dim_user, built.dim_driver, built.dim_date
    )
    plan = tables.fact_layout(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [driver_key") == 1
    assert plan.count("Exchange hashpartitioning(driver_key") == 1
    assert plan.count("BroadcastHashJoin") >= 3


def test_dates_only_where_rides_start(built):
    rows = {r.date_key: r for r in built.dim_date.collect()}
    assert set(rows) == {20240101, 20240102, 20240103}
    monday = rows[20240101]
    assert (monday.day_of_week, monday.day_name, monday.month_name) == (1, "Monday", "January")


def test_load_losses(spark):
    raw = _raw(spark)
    found = quality.load_losses(raw["rides"], raw["ratings"], raw["users"], raw["drivers"])
    assert {r.reason: r.n_rows for r in found.collect()} == {
        "ride without ride_start_time": 1,
        "ride without user_id": 1,
        "ride without driver_id": 0,
        "ride of an unknown user": 1,
        "ride of an unknown driver": 1,
        "further rating of a ride": 2,
    }


def test_repeated_ride_is_reported_or_refused(spark, tmp_path):
    raw = _raw(spark)
    raw["rides"] = raw["rides"].unionByName(raw["rides"].where("ride_id = 'r2'"))
    warehouse.build(raw, str(tmp_path / "a"))
    report = spark.read.parquet(str(tmp_path / "a" / "load_report"))
    found = {(r.check, r.subject): r.n_rows for r in report.collect()}
    assert found["key", "rides.ride_id"] == 1
    assert found["key", "users.user_id"] == 0
    assert found["reference", "rides.user_id"] == 1
    assert found["reference", "drivers.vehicle_id"] == 1
    assert found["loss", "further rating of a ride"] == 2
    with pytest.raises(warehouse.LoadRefused, match="rides.ride_id: 1"):
        warehouse.build(raw, str(tmp_path / "b"), checks="fail")
    assert not (tmp_path / "b" / "fact_rides").exists()
    warehouse.build(_raw(spark), str(tmp_path / "c"), checks="fail")


def test_build_passes_its_options_on(spark, tmp_path):
    root = str(tmp_path / "wh")
    wh = warehouse.build(_raw(spark), root, checks="none", salt="s", peak_hours=[])
    assert not (tmp_path / "wh" / "load_report").exists()
    assert {len(r.masked_email_hash) for r in wh.dim_user.collect() if r.masked_email_hash} == {64}
    assert wh.fact_rides.where("is_peak_hour").count() == 0
    newcomer = spark.createDataFrame([("3", "Kim", "k@x", "3", None, None, None, None)], RAW["users"])
    after = warehouse.refresh_dimensions(_raw(spark) | {"users": newcomer}, root, salt="s")
    assert {len(r.masked_email_hash) for r in after.dim_user.collect() if r.masked_email_hash} == {64}


def test_text_reader_lets_every_bad_value_be_counted(spark, tmp_path):
    path = tmp_path / "rides.csv"
    path.write_text(
        "ride_id,user_id,start_location,end_location,ride_start_time,ride_end_time,"
        "distance_km,fare_amount,driver_id\n"
        "1,1,,,soon,2024-01-01 10:00:00,1.0,far,1\n"
        "2,1,,,2024-01-01 10:00:00,later,123456789.00,2.00,1\n"
        ",1,,,2024-01-01 10:00:00,2024-13-01 10:00:00,1.0,2.00,1\n"
    )
    text = raw_files.read_text(spark, str(path), RAW["rides"])
    found = quality.violations("rides", text, RULES["rides"], value_kinds(RAW["rides"])).collect()
    assert {(r.column_name, r.rule): r.n_rows for r in found if r.n_rows} == {
        ("ride_start_time", "timestamp_ntz"): 1,
        ("ride_end_time", "timestamp_ntz"): 2,
        ("distance_km", "decimal(10,2)"): 1,
        ("fare_amount", "decimal(10,2)"): 1,
        ("ride_id", "not_null"): 1,
    }


def test_refresh_adds_only_what_is_new(spark, tmp_path):
    raw, root = _raw(spark), str(tmp_path / "wh")
    before = warehouse.build(raw, root)
    sizes = {name: getattr(before, name).count() for name in ("dim_user", "dim_driver", "dim_date")}
    again = warehouse.refresh_dimensions(raw, root)
    assert {name: getattr(again, name).count() for name in sizes} == sizes

    newcomer = ("3", "Kim", "k@x", "3", None, None, None, None)
    changed = ("1", "Ann Changed", "a@x", "1", None, None, None, None)
    more = spark.createDataFrame([newcomer, changed], RAW["users"])
    after = warehouse.refresh_dimensions(raw | {"users": more}, root)
    rows = {r.user_id: r for r in after.dim_user.collect()}
    assert rows["3"].user_key == 5 and len(rows) == 5
    assert rows["1"].location_city == "Rome"  # existing rows are never changed


def test_insert_if_absent_first_copy_wins(spark):
    copies = [("b", n, f"name {n}") for n in range(40, 0, -1)] + [("a", 5, "only"), (None, 1, "x")]
    incoming = spark.createDataFrame(copies, "id string, seq int, name string")
    rows = keys.insert_if_absent(None, incoming, "key", "id", ["seq"], limits=TINY).collect()
    assert sorted((r.key, r.id, r.name) for r in rows) == [(1, "a", "only"), (2, "b", "name 1")]


def test_large_dimension_keys_are_dense(spark):
    ids = spark.range(200).select(F.col("id").cast("string").alias("user_id"))
    rows = keys.with_surrogate_key(ids, "user_key", "user_id", limits=TINY).collect()
    assert {int(r.user_id) + 1: r.user_key for r in rows} == {n: n for n in range(1, 201)}


def test_violations(spark):
    df = spark.createDataFrame(
        [("x" * 51, "12345678.00"), (None, "123456789.00"), ("ok", "abc"), ("ok", None)],
        "ride_id string, fare_amount string",
    )
    found = quality.violations("rides", df, RULES["rides"]).collect()
    counts = {(r.column_name, r.rule): r.n_rows for r in found}
    assert counts == {
        ("ride_id", "not_null"): 1,
        ("ride_id", "varchar(50)"): 1,
        ("fare_amount", "decimal(10,2)"): 2,
    }


def test_duplicates_and_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (2,)], "k int")
    assert [tuple(r) for r in quality.duplicate_keys(child, ["k"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.orphans(child, "k", parent, "k").collect()] == [(1, 2)]


# --- files ------------------------------------------------------------------


def test_csv_quotes_nulls_and_types(spark, tmp_path):
    path = tmp_path / "drivers.csv"
    path.write_text(
        "driver_id,name,vehicle_id,rating,total_rides,available\n"
        '1,"Smith, ""Jo""",7,4.50,3,True\n'
        '2,"",,,,False\n'
        "3,back\\slash,,1.005,,\n"
    )
    rows = raw_files.read_csv(spark, str(path), RAW["drivers"]).collect()
    assert tuple(rows[0]) == ("1", 'Smith, "Jo"', "7", Decimal("4.50"), 3, True)
    assert tuple(rows[1]) == ("2", "", None, None, None, False)
    assert rows[2].name == "back\\slash"


def test_malformed_number_fails(spark, tmp_path):
    path = tmp_path / "vehicles.csv"
    path.write_text("vehicle_id,make,model,year,capacity\n1,a,b,two thousand,4\n")
    with pytest.raises(Exception, match="MALFORMED"):
        raw_files.read_csv(spark, str(path), RAW["vehicles"]).collect()


def test_csv_line_break_inside_quotes(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    path.write_text(
        'rating_id,ride_id,user_id,rating_value,comments,rating_date\n1,r,u,5,"two\nlines",2024-01-01\n'
    )
    row = raw_files.read_csv(spark, str(path), RAW["ratings"], multiline=True).first()
    assert row.comments == "two\nlines" and row.rating_date == dt.date(2024, 1, 1)


@pytest.mark.parametrize("fmt", ["csv", "parquet", "orc"])
def test_raw_folder(spark, tmp_path, fmt):
    raw = _raw(spark)
    for name, df in raw.items():
        path = str(tmp_path / f"{name}.{fmt}")
        raw_files.write_csv(df, path) if fmt == "csv" else df.write.format(fmt).save(path)
    back = raw_files.read_raw(spark, str(tmp_path), fmt)
    for name, df in raw.items():
        assert sorted(back[name].collect(), key=str) == sorted(df.collect(), key=str)


def test_append_and_recreate(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    tables.recreate(df, path)
    tables.append(df, path)
    assert tables.load(spark, path, df.schema).count() == 6
    assert tables.recreate(df, path).count() == 3


# --- expressions ------------------------------------------------------------


def test_salted_fingerprint_differs(spark):
    row = spark.range(1).select(
        fingerprint(F.lit("x")).alias("plain"), fingerprint(F.lit("x"), "s").alias("salted")
    ).first()
    assert len(row.plain) == 32 and len(row.salted) == 64


def test_initial_of_null_and_empty(spark):
    df = spark.createDataFrame([("Ann",), ("",), (None,)], "n string")
    assert [r[0] for r in df.select(initial(F.col("n"))).collect()] == ["A.", ".", None]


def test_minutes_do_not_depend_on_the_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.sql(
        "SELECT timestamp_ntz'2024-03-10 00:30:00' a, timestamp_ntz'2024-03-10 05:30:00' b"
    )
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 300
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_tier_bounds_include_their_end(spark):
    df = spark.createDataFrame([(10,), (11,), (31,)], "n int")
    labels = df.select(tier(F.col("n"), [(10, "a"), (30, "b")], "c")).collect()
    assert [r[0] for r in labels] == ["a", "b", "c"]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=12))
def test_exact_avg_is_the_decimal_mean(spark, cents):
    df = spark.createDataFrame([(Decimal(c) / 100,) for c in cents], "v decimal(10,2)")
    got = df.agg(exact_avg(F.col("v"))).first()[0]
    assert abs(got - Decimal(sum(cents)) / 100 / len(cents)) <= Decimal("1e-16")

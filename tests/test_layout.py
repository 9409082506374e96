"""Large fact builds: rides are shuffled whole once, and what they look up is brought to them."""

from pyspark.sql import functions as F

from fleetmart.operators.joins import bring_near, meet
from fleetmart.operators.scale import Limits, hot_keys, parts_for
from fleetmart.plans import facts, marts
from fleetmart.plans.warehouse import Warehouse

SMALL = Limits(task_rows=50)


def _raw(spark, rides=600, text=True):
    """Rides of 40 drivers and 120 users, some repeated, some without id, user or driver."""
    number = F.col("id")
    key = (lambda c: c.cast("string")) if text else (lambda c: c)
    start = F.timestamp_add("MINUTE", (number * 37 % 5000).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    trips = spark.range(rides).select(
        F.when(number % 41 != 0, key(number - F.when(number % 50 == 7, 1).otherwise(0))).alias("ride_id"),
        F.when(number % 43 != 0, key(number * 7 % 130)).alias("user_id"),
        F.lit(None).cast("string").alias("start_location"),
        F.lit(None).cast("string").alias("end_location"),
        start.alias("ride_start_time"),
        F.timestamp_add("MINUTE", F.lit(9), start).alias("ride_end_time"),
        F.lit("1.50").cast("decimal(10,2)").alias("distance_km"),
        number.cast("decimal(10,2)").alias("fare_amount"),
        F.when(number % 47 != 0, key(number * 11 % 45)).alias("driver_id"),
    )
    trips = trips.unionByName(trips.where("fare_amount < 20"))
    ratings = spark.range(rides // 2).select(
        key(number).alias("rating_id"),
        key(number * 3 % 400).alias("ride_id"),
        key(number).alias("user_id"),
        (1 + number % 5).cast("int").alias("rating_value"),
        F.lit(None).cast("string").alias("comments"),
        F.lit("2024-02-01").cast("date").alias("rating_date"),
    )
    users = spark.range(120).select(key(number).alias("user_id"), (number + 1).alias("user_key"))
    drivers = spark.range(40).select(key(number).alias("driver_id"), (number + 1).alias("driver_key"))
    dates = spark.range(4).select((20240101 + number).cast("int").alias("date_key"))
    return trips, ratings, users, drivers, dates


def _rows(df):
    return sorted(map(str, df.collect()))


def test_laid_out_fact_equals_the_plain_one(spark):
    for text in (True, False):
        raw = _raw(spark, text=text)
        plain = facts.fact_rides(*raw)
        laid_out = facts.fact_rides(*raw, limits=SMALL)
        assert laid_out.columns == plain.columns
        assert _rows(laid_out) == _rows(plain) and plain.count() > 300
        hot = Limits(task_rows=50, hot_rows=13)
        assert hot_keys(raw[0], "driver_id", hot) is not None
        assert _rows(facts.fact_rides(*raw, limits=hot)) == _rows(plain)


def test_rides_are_shuffled_whole_once(spark):
    fact = facts.fact_rides(*_raw(spark), limits=SMALL)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.splitlines() if "RepartitionByExpression" in line and "driver_id" in line]
    assert len(wide) == 2  # the rides, and the drivers' keys
    physical = fact._jdf.queryExecution().executedPlan().toString()
    for key in ("driver_key", "user_id", "ride_id", "driver_id"):
        shuffles = [x for x in physical.splitlines() if f"Exchange hashpartitioning({key}#" in x]
        assert len(shuffles) == {"driver_id": 2}.get(key, 0), key
    by_hash = [x for x in physical.splitlines() if "Exchange hashpartitioning(_hash#" in x]
    assert len(by_hash) == 4  # users and ratings, each with the pairs that ask for them


def test_parts_follow_the_rows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts_for(spark, 50, SMALL) is None
    assert parts_for(spark, 51, SMALL) == least
    assert parts_for(spark, 50 * least * 9 + 1, SMALL) == least * 9 + 1


def test_values_that_repeat_or_miss_change_no_rows(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, None), (3, "z")], "d int, k string")
    right = spark.createDataFrame([("a", 10), ("b", 20)], "k string, v int")
    met = meet(left, right, "k", "d", 8)
    found = bring_near(left, "d", 8, {"k": met})
    assert _rows(found.select("d", "k", "v")) == _rows(left.join(right, "k", "left").select("d", "k", "v"))


def test_namesakes_alone_are_added_up(spark):
    days = spark.createDataFrame(
        [(1, 20240101, "4.00", 2, 2, "9.00"), (2, 20240101, "2.00", 1, 1, "1.00"), (3, 20240101, None, 0, 1, None)],
        "driver_key bigint, start_date_key int, wait string, waits bigint, rides bigint, revenue string",
    ).withColumns({c: F.col(c).cast("decimal(20,2)") for c in ("wait", "revenue")})
    names = spark.createDataFrame([(1, "Joe"), (2, "Joe"), (3, "Eve")], "driver_key bigint, driver_name string")
    wh = Warehouse(None, names, None, None, days)
    found = {r[0]: r for r in marts._daily(wh, "driver_name").collect()}
    assert len(found) == 2
    assert found["Joe"].total_rides_that_day == 3 and found["Joe"].avg_wait_time_minutes == 2
    assert found["Eve"].total_rides_that_day == 1 and found["Eve"].avg_wait_time_minutes is None
    plan = marts._daily(wh, "driver_name")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.startswith("Union")


def test_stored_tables_are_compressed_well(spark, tmp_path):
    import pyarrow.parquet as pq

    from fleetmart.sources import tables

    tables.recreate(spark.range(10).coalesce(1), str(tmp_path / "t"))
    [file] = (tmp_path / "t").glob("*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_large_right_sides_are_not_broadcast(spark, monkeypatch):
    from fleetmart.operators import scale
    from fleetmart.plans import dimensions

    def broadcasts(df):
        return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")

    def few(df):
        return scale.shuffled(df, 5)

    drivers = spark.createDataFrame([("1", "Joe", "7", True)], "driver_id string, name string, vehicle_id string, available boolean")
    vehicles = spark.range(9).select(
        F.col("id").cast("string").alias("vehicle_id"), F.lit("a").alias("make"), F.lit("b").alias("model"),
        F.lit(2001).alias("year"), F.lit(4).alias("capacity"),
    )
    before = dimensions.drivers_with_vehicles(drivers, vehicles)
    monkeypatch.setattr(dimensions, "shuffled", few)
    after = dimensions.drivers_with_vehicles(drivers, vehicles)
    assert (broadcasts(before), broadcasts(after)) == (1, 0) and _rows(before) == _rows(after)
    assert scale.shuffled(vehicles, 9) is vehicles
    met = meet(_raw(spark)[0], _raw(spark)[2], "user_id", "driver_id", 8)
    assert broadcasts(met) == 0

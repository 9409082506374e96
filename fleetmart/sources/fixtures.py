"""Projection of the generic test tables into the raw ride layout.

Two mappings: ``events`` (one ride per event, real times of day) and ``orders``
(one ride per order line, several times the volume, years of dates). Users,
drivers and vehicles are the same in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.functions.scalars import date_key
from fleetmart.operators.scale import parts_for

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(spark: SparkSession, sf_dir: str, name: str) -> Column:
    return read_table(spark, sf_dir, name).agg(F.count(F.lit(1))).scalar()


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    letter = F.substring(F.lit(LETTERS), (key % 26 + 1).cast("int"), F.lit(1))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("user_id"),
        F.concat(letter, "c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-"), F.lpad(key.cast("string"), 10, "0")).alias("phone_number"),
        F.date_add(F.lit("2023-01-01").cast("date"), (key % 365).cast("int")).alias(
            "registration_date"
        ),
        (18 + key % 60).cast("int").alias("age"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("location"),
    )


def raw_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("vehicle_id"),
        F.col("p_brand").alias("make"),
        F.col("p_name").alias("model"),
        (2000 + F.col("p_partkey") % 24).cast("int").alias("year"),
        (2 + F.col("p_size") % 6).cast("int").alias("capacity"),
    )


def raw_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    vehicles = _rows(spark, sf_dir, "part")
    key = F.col("s_suppkey")
    namesake = key - F.when(key % 10 == 9, 1).otherwise(0)
    return read_table(spark, sf_dir, "supplier").select(
        key.alias("driver_id"),
        F.concat(F.lit("Driver#"), namesake.cast("string")).alias("name"),
        F.when(key % 11 == 0, F.lit(-1).cast("bigint"))
        .otherwise(key * 3 % vehicles)
        .alias("vehicle_id"),
        F.lit(None).cast("decimal(3,2)").alias("rating"),
        F.lit(None).cast("int").alias("total_rides"),
        (F.col("s_acctbal") > 0).alias("available"),
    )


def _after(start: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, start)


def _event_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    drivers = _rows(spark, sf_dir, "supplier")
    ride = F.col("event_id")
    return read_table(spark, sf_dir, "events").select(
        ride.alias("ride_id"),
        "user_id",
        F.lit(None).cast("string").alias("start_location"),
        F.lit(None).cast("string").alias("end_location"),
        F.col("ts").cast("timestamp_ntz").alias("ride_start_time"),
        _after(F.col("ts").cast("timestamp_ntz"), 300 + ride * 37 % 5400).alias("ride_end_time"),
        ((100 + ride * 53 % 2900).cast("decimal(10,0)") * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(10,2)")
        .alias("distance_km"),
        F.col("value").cast("decimal(10,2)").alias("fare_amount"),
        ((ride * 7 + F.col("user_id") * 13) % drivers).alias("driver_id"),
    )


def _event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ride = F.col("event_id")
    return (
        read_table(spark, sf_dir, "events")
        .where(ride % 10 < 3)
        .select(
            ride.alias("rating_id"),
            ride.alias("ride_id"),
            "user_id",
            (1 + (ride * 7 + F.col("user_id")) % 5).cast("int").alias("rating_value"),
            F.lit(None).cast("string").alias("comments"),
            F.to_date("ts").alias("rating_date"),
        )
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order's customer: what rides and ratings of orders are made of."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    parts = parts_for(spark, lineitem.count())
    if parts is not None:
        lineitem = lineitem.repartition(parts, "l_orderkey")
        orders = orders.repartition(parts, "o_orderkey")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey",
        F.col("l_shipdate").cast("timestamp_ntz").alias("day"),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
    )


def _identified(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.concat_ws(
            "-",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            date_key(F.to_date("day")).cast("string"),
        ).alias("ride_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("driver_id"),
        *[name for name in lines.columns if name != "o_custkey"],
    )


def _order_rides(lines: DataFrame) -> DataFrame:
    second = (
        F.col("l_orderkey") * 97
        + F.col("l_partkey") * 31
        + F.col("l_linenumber") * 7919
        + F.col("l_suppkey") * 53
    ) % 86400
    length = 300 + (F.col("l_partkey") * 37 + F.col("l_orderkey")) % 5400
    return _identified(lines).select(
        "ride_id",
        "user_id",
        F.lit(None).cast("string").alias("start_location"),
        F.lit(None).cast("string").alias("end_location"),
        _after(F.col("day"), second).alias("ride_start_time"),
        _after(F.col("day"), second + length).alias("ride_end_time"),
        F.col("l_quantity").cast("decimal(10,2)").alias("distance_km"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("fare_amount"),
        "driver_id",
    )


def _order_ratings(lines: DataFrame) -> DataFrame:
    value = 1 + (F.col("l_orderkey") * 7 + F.col("l_linenumber") + F.col("user_id")) % 5
    return (
        _identified(lines)
        .where(F.col("l_orderkey") % 10 < 3)
        .select(
            F.col("ride_id").alias("rating_id"),
            "ride_id",
            "user_id",
            value.cast("int").alias("rating_value"),
            F.lit(None).cast("string").alias("comments"),
            F.to_date("day").alias("rating_date"),
        )
    )


def raw_tables(
    spark: SparkSession, sf_dir: str, rides: str = "events", lines: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The five raw tables; ``rides`` is "events" or "orders".

    ``lines`` are the ``order_lines`` of the folder where these are stored.
    """
    if rides == "events":
        trips, ratings = _event_rides(spark, sf_dir), _event_ratings(spark, sf_dir)
    elif rides == "orders":
        lines = order_lines(spark, sf_dir) if lines is None else lines
        trips, ratings = _order_rides(lines), _order_ratings(lines)
    else:
        raise ValueError(f"unknown ride mapping {rides!r}")
    return {
        "users": raw_users(spark, sf_dir),
        "drivers": raw_drivers(spark, sf_dir),
        "vehicles": raw_vehicles(spark, sf_dir),
        "rides": trips,
        "ratings": ratings,
    }

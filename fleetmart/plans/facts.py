"""The ride fact: one row per ride, with the gap since the driver's previous ride."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.labels import PEAK_HOURS
from fleetmart.functions.scalars import date_key, exact_sum, minutes_between
from fleetmart.operators.joins import bring_near, join_unique, meet
from fleetmart.operators.scale import (
    BROADCAST_KEYS,
    DEFAULT,
    HotKeys,
    Limits,
    hot_keys,
    parts_for,
    together,
)
from fleetmart.operators.sequence import sequence, split_sequence


def rating_per_ride(raw_ratings: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One rating per ride: the latest, then the one with the highest id.

    ``keys`` are the columns to group by where there is another one beside ``ride_id``.
    """
    by = F.struct("rating_date", "rating_id")
    return (
        raw_ratings.where(F.col("ride_id").isNotNull())
        .groupBy(*(keys or ["ride_id"]))
        .agg(F.max_by("rating_value", by).cast("decimal(3,2)").alias("average_driver_rating"))
    )


def keyed_rides(
    raw_rides: DataFrame,
    dim_user: DataFrame,
    dim_driver: DataFrame,
    dim_date: DataFrame,
    *,
    hot_drivers: HotKeys | None = None,
    hot_users: HotKeys | None = None,
    raw_ratings: DataFrame | None = None,
    parts: int | None = None,
    by_driver: bool = True,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Rides with their three dimension keys; rides without a match are dropped.

    With ``parts`` the rides are shuffled whole once, by driver_id into so many parts, and stay
    there. Ratings, and keys of more users than may be broadcast, are brought to them.
    Where nothing needs them by driver (``by_driver`` False, no ratings), they are shuffled to
    such users instead, with the columns that are read later.
    """
    if raw_ratings is not None and not by_driver:
        raise ValueError("ratings are brought to rides that lie by driver")
    rides = raw_rides.drop("start_location", "end_location")
    drivers = dim_driver.select("driver_id", "driver_key")
    users = dim_user.select("user_id", "user_key")
    many_users = parts is not None and users.count() > min(BROADCAST_KEYS, limits.task_rows)
    if parts is not None and by_driver:
        met = {}
        if many_users:
            met["user_id"] = meet(
                raw_rides, users, "user_id", "driver_id", parts, hot=hot_users, limits=limits
            )
        if raw_ratings is not None:
            met["ride_id"] = meet(
                raw_rides, raw_ratings, "ride_id", "driver_id", parts, unique=rating_per_ride
            )
        rides = bring_near(rides.where(F.col("driver_id").isNotNull()), "driver_id", parts, met)
        drivers = drivers.repartition(parts, "driver_id")
    with_driver = join_unique(
        rides.withColumn("date_key", date_key(F.to_date("ride_start_time"))),
        drivers,
        "driver_id",
        spread_by="ride_id",
        hot=hot_drivers,
        limits=limits,
    )
    if many_users and by_driver:
        with_user = with_driver.where(F.col("user_key").isNotNull())
    else:
        with_user = join_unique(
            with_driver,
            users,
            "user_id",
            spread_by="ride_id",
            hot=hot_users,
            parts=parts if many_users else None,
            limits=limits,
        )
    return join_unique(with_user, dim_date.select("date_key"), "date_key")


def rated_rides(
    raw_rides: DataFrame,
    raw_ratings: DataFrame | None,
    dim_user: DataFrame,
    dim_driver: DataFrame,
    dim_date: DataFrame,
    *,
    hot_users: HotKeys | None = None,
    parts: int | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Keyed rides with their rating (``rating_per_ride``), as the fact names them.

    With ``parts`` they stay in their parts by driver_id, see ``keyed_rides``, and keep it.
    ``raw_ratings`` is None where the rides bring ``average_driver_rating``.
    """
    rated = keyed_rides(
        raw_rides,
        dim_user,
        dim_driver,
        dim_date,
        hot_users=hot_users,
        raw_ratings=raw_ratings,
        parts=parts,
        limits=limits,
    )
    if parts is None and raw_ratings is not None:
        ratings = rating_per_ride(raw_ratings)
        rated = join_unique(rated, ratings, "ride_id", "left", spread_by="ride_start_time")
    return rated.select(
        "ride_id",
        "user_key",
        "driver_key",
        F.col("date_key").alias("start_date_key"),
        F.col("ride_start_time").alias("start_time"),
        F.col("ride_end_time").alias("end_time"),
        "distance_km",
        "fare_amount",
        "average_driver_rating",
        *([] if parts is None else ["driver_id"]),
    )


def _with_previous_end(
    raw_rides: DataFrame,
    raw_ratings: DataFrame,
    dim_user: DataFrame,
    dim_driver: DataFrame,
    dim_date: DataFrame,
    limits: Limits,
) -> DataFrame:
    """Keyed and rated rides with the end of the driver's previous ride.

    Hot drivers and users are counted on the raw table, one column each, before any
    join; so every ride passes through the joins once. More rides than a task holds are laid
    out by driver first, and windows and joins work in those parts.
    """
    hot_drivers, hot_users, rows = together(
        lambda: hot_keys(raw_rides, "driver_id", limits),
        lambda: hot_keys(raw_rides, "user_id", limits),
        raw_rides.count,
    )
    parts = parts_for(raw_rides.sparkSession, rows - (hot_drivers.rows if hot_drivers else 0), limits)
    order, lag = ["start_time", "ride_id"], {"previous_end": "end_time"}

    def rated(rides: DataFrame, drivers: DataFrame, parts: int | None = None) -> DataFrame:
        return rated_rides(
            rides, raw_ratings, dim_user, drivers, dim_date, hot_users=hot_users, parts=parts, limits=limits
        )

    def linked(rides: DataFrame) -> DataFrame:
        key = "driver_key" if parts is None else "driver_id"
        return sequence(rated(rides, dim_driver, parts), key, order, lag=lag).drop("driver_id")

    if hot_drivers is None:
        return linked(raw_rides)

    flags = hot_drivers.flags
    few = dim_driver.join(flags, "driver_id", "left_semi")
    many_rides = raw_rides.join(flags, "driver_id", "left_semi")
    other_rides = raw_rides.join(flags, "driver_id", "left_anti")
    other = linked(other_rides)
    many = split_sequence(
        rated(many_rides, few), "driver_key", order, hot_drivers.rows, lag=lag, limits=limits
    )
    return other.unionByName(many)


def with_measures(linked: DataFrame, peak_hours: list[int] | None = None) -> DataFrame:
    """Rated rides with ``previous_end`` as rows of the fact."""
    peak = F.hour("start_time").isin(PEAK_HOURS if peak_hours is None else peak_hours)
    return linked.select(
        "ride_id",
        "user_key",
        "driver_key",
        "start_date_key",
        "start_time",
        "end_time",
        minutes_between(F.col("start_time"), F.col("end_time")).alias("ride_duration_minutes"),
        "distance_km",
        "fare_amount",
        minutes_between(F.col("previous_end"), F.col("start_time")).alias(
            "time_to_next_ride_minutes"
        ),
        F.coalesce(peak, F.lit(False)).alias("is_peak_hour"),
        "average_driver_rating",
    )


def fact_rides(
    raw_rides: DataFrame,
    raw_ratings: DataFrame,
    dim_user: DataFrame,
    dim_driver: DataFrame,
    dim_date: DataFrame,
    *,
    peak_hours: list[int] | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """The fact in its stored layout. Unrated rides and first rides keep NULLs.

    Runs jobs first that count rides, drivers and users, see ``hot_keys``.
    """
    linked = _with_previous_end(raw_rides, raw_ratings, dim_user, dim_driver, dim_date, limits)
    return with_measures(linked, peak_hours)


def daily_rides(fact: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per driver and date: sums that add up further, first rides left out.

    With ``parts`` they are added up in so many partitions.
    """
    rides = fact.where(F.col("time_to_next_ride_minutes").isNotNull())
    rides = rides.select(
        "driver_key",
        "start_date_key",
        "time_to_next_ride_minutes",
        "fare_amount",
        F.when(F.col("ride_id").isNotNull(), True).alias("_has_id"),
    )
    if parts is not None:
        rides = rides.repartition(parts, "driver_key", "start_date_key")
    return rides.groupBy("driver_key", "start_date_key").agg(
        exact_sum(F.col("time_to_next_ride_minutes")).alias("wait"),
        F.count("time_to_next_ride_minutes").alias("waits"),
        F.count("_has_id").alias("rides"),
        exact_sum(F.col("fare_amount")).alias("revenue"),
    )

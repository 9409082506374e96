"""The three dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.scalars import date_key, day_of_week, fingerprint, initial
from fleetmart.operators.joins import join_unique
from fleetmart.operators.keys import insert_if_absent
from fleetmart.operators.scale import DEFAULT, Limits, shuffled
from fleetmart.sources.registers import insert_registered


def masked_users(raw_users: DataFrame, salt: str | None = None) -> DataFrame:
    """Users without personal data: initial, fingerprints, trimmed city."""
    return raw_users.select(
        "user_id",
        initial(F.col("name")).alias("masked_name"),
        fingerprint(F.col("email"), salt).alias("masked_email_hash"),
        fingerprint(F.col("phone_number"), salt).alias("masked_phone_hash"),
        "registration_date",
        "age",
        "gender",
        F.trim("location").alias("location_city"),
        F.lit(None).cast("boolean").alias("is_active_subscriber"),
    )


def drivers_with_vehicles(
    raw_drivers: DataFrame, raw_vehicles: DataFrame
) -> DataFrame:
    vehicles = shuffled(raw_vehicles).select(
        "vehicle_id",
        F.col("make").alias("vehicle_make"),
        F.col("model").alias("vehicle_model"),
        F.col("year").alias("vehicle_year"),
        F.col("capacity").alias("vehicle_capacity"),
    )
    drivers = raw_drivers.select(
        "driver_id",
        F.col("name").alias("driver_name"),
        "vehicle_id",
        F.col("available").alias("is_available_flag"),
    )
    return join_unique(
        drivers, vehicles, "vehicle_id", "left", spread_by="driver_id"
    ).select(
        "driver_id",
        "driver_name",
        "vehicle_make",
        "vehicle_model",
        "vehicle_year",
        "vehicle_capacity",
        "is_available_flag",
    )


def ride_dates(raw_rides: DataFrame) -> DataFrame:
    """Dates on which a ride starts, each once."""
    day = F.to_date("ride_start_time").alias("full_date")
    return raw_rides.select(day).where(F.col("full_date").isNotNull()).distinct()


def new_users(
    raw_users: DataFrame,
    existing: DataFrame | None = None,
    *,
    salt: str | None = None,
    register: str | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Rows to add to dim_user; keys come from the register at that path, if one is given."""
    users = masked_users(raw_users, salt)
    if register:
        return insert_registered(existing, users, "user_key", "user_id", register)
    return insert_if_absent(existing, users, "user_key", "user_id", limits=limits)


def new_drivers(
    raw_drivers: DataFrame,
    raw_vehicles: DataFrame,
    existing: DataFrame | None = None,
    *,
    register: str | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Rows to add to dim_driver; keys come from the register at that path, if one is given."""
    drivers = drivers_with_vehicles(raw_drivers, raw_vehicles)
    if register:
        return insert_registered(existing, drivers, "driver_key", "driver_id", register)
    return insert_if_absent(
        existing, drivers, "driver_key", "driver_id", limits=limits
    )


def new_dates(raw_rides: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Rows to add to dim_date; its key is the date itself, so nothing is allocated."""
    days = ride_dates(raw_rides)
    if existing is not None:
        days = days.join(existing.select("full_date"), "full_date", "left_anti")
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.year(day).alias("year"),
        day_of_week(day).isin(0, 6).alias("is_weekend"),
    )

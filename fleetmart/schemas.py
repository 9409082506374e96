"""Declared layouts: five raw staging tables, three dimensions, one fact.

Schemas are never inferred. ``RULES`` adds what a ``StructType`` cannot say:
primary keys, NOT NULL columns, text lengths and decimal sizes. The quality
operators read it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, INTEGER, KEY = StringType(), IntegerType(), LongType()
DATE, TIME, FLAG = DateType(), TimestampNTZType(), BooleanType()
AMOUNT, RATING, TOTAL = DecimalType(10, 2), DecimalType(3, 2), DecimalType(20, 2)


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


RAW: dict[str, StructType] = {
    "users": _table(
        user_id=TEXT,
        name=TEXT,
        email=TEXT,
        phone_number=TEXT,
        registration_date=DATE,
        age=INTEGER,
        gender=TEXT,
        location=TEXT,
    ),
    "drivers": _table(
        driver_id=TEXT,
        name=TEXT,
        vehicle_id=TEXT,
        rating=RATING,
        total_rides=INTEGER,
        available=FLAG,
    ),
    "vehicles": _table(
        vehicle_id=TEXT,
        make=TEXT,
        model=TEXT,
        year=INTEGER,
        capacity=INTEGER,
    ),
    "rides": _table(
        ride_id=TEXT,
        user_id=TEXT,
        start_location=TEXT,
        end_location=TEXT,
        ride_start_time=TIME,
        ride_end_time=TIME,
        distance_km=AMOUNT,
        fare_amount=AMOUNT,
        driver_id=TEXT,
    ),
    "ratings": _table(
        rating_id=TEXT,
        ride_id=TEXT,
        user_id=TEXT,
        rating_value=INTEGER,
        comments=TEXT,
        rating_date=DATE,
    ),
}

STAR: dict[str, StructType] = {
    "dim_user": _table(
        user_key=KEY,
        user_id=TEXT,
        masked_name=TEXT,
        masked_email_hash=TEXT,
        masked_phone_hash=TEXT,
        registration_date=DATE,
        age=INTEGER,
        gender=TEXT,
        location_city=TEXT,
        is_active_subscriber=FLAG,
    ),
    "dim_driver": _table(
        driver_key=KEY,
        driver_id=TEXT,
        driver_name=TEXT,
        vehicle_make=TEXT,
        vehicle_model=TEXT,
        vehicle_year=INTEGER,
        vehicle_capacity=INTEGER,
        is_available_flag=FLAG,
    ),
    "dim_date": _table(
        date_key=INTEGER,
        full_date=DATE,
        day_of_week=INTEGER,
        day_name=TEXT,
        month_name=TEXT,
        year=INTEGER,
        is_weekend=FLAG,
    ),
    "fact_rides": _table(
        ride_id=TEXT,
        user_key=KEY,
        driver_key=KEY,
        start_date_key=INTEGER,
        start_time=TIME,
        end_time=TIME,
        ride_duration_minutes=AMOUNT,
        distance_km=AMOUNT,
        fare_amount=AMOUNT,
        time_to_next_ride_minutes=AMOUNT,
        is_peak_hour=FLAG,
        average_driver_rating=RATING,
    ),
    # Sums per driver and date, stored with the fact that they come from.
    "daily_rides": _table(
        driver_key=KEY,
        start_date_key=INTEGER,
        wait=TOTAL,
        waits=KEY,
        rides=KEY,
        revenue=TOTAL,
    ),
}


def value_kinds(schema: StructType) -> dict[str, str]:
    """Columns of which a text must parse as a whole number, date, time or flag."""
    return {
        f.name: f.dataType.simpleString()
        for f in schema
        if not isinstance(f.dataType, (StringType, DecimalType))
    }


@dataclass(frozen=True)
class Rules:
    """Integrity rules of one table."""

    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()


RULES: dict[str, Rules] = {
    "users": Rules(
        ("user_id",),
        ("user_id",),
        {
            "user_id": 50,
            "name": 255,
            "email": 255,
            "phone_number": 50,
            "gender": 20,
            "location": 255,
        },
    ),
    "drivers": Rules(
        ("driver_id",),
        ("driver_id",),
        {"driver_id": 50, "name": 255, "vehicle_id": 50},
        {"rating": (3, 2)},
    ),
    "vehicles": Rules(
        ("vehicle_id",),
        ("vehicle_id",),
        {"vehicle_id": 50, "make": 100, "model": 100},
    ),
    "rides": Rules(
        ("ride_id",),
        ("ride_id",),
        {
            "ride_id": 50,
            "user_id": 50,
            "start_location": 255,
            "end_location": 255,
            "driver_id": 50,
        },
        {"distance_km": (10, 2), "fare_amount": (10, 2)},
    ),
    "ratings": Rules(
        ("rating_id",),
        ("rating_id",),
        {"rating_id": 50, "ride_id": 50, "user_id": 50},
    ),
    "dim_user": Rules(
        ("user_key",),
        ("user_key", "user_id"),
        {
            "user_id": 50,
            "masked_name": 255,
            "masked_email_hash": 32,
            "masked_phone_hash": 32,
            "gender": 20,
            "location_city": 100,
        },
        unique=(("user_id",),),
    ),
    "dim_driver": Rules(
        ("driver_key",),
        ("driver_key", "driver_id"),
        {
            "driver_id": 50,
            "driver_name": 255,
            "vehicle_make": 100,
            "vehicle_model": 100,
        },
        unique=(("driver_id",),),
    ),
    "dim_date": Rules(
        ("date_key",),
        ("date_key", "full_date"),
        {"day_name": 10, "month_name": 10},
        unique=(("full_date",),),
    ),
    "fact_rides": Rules(
        ("ride_id",),
        ("ride_id",),
        {"ride_id": 50},
        {
            "ride_duration_minutes": (10, 2),
            "distance_km": (10, 2),
            "fare_amount": (10, 2),
            "time_to_next_ride_minutes": (10, 2),
            "average_driver_rating": (3, 2),
        },
    ),
}

# (child table, child column, parent table, parent column); the last one is a
# soft link: it is joined on but never declared as a reference.
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("rides", "user_id", "users", "user_id"),
    ("rides", "driver_id", "drivers", "driver_id"),
    ("ratings", "ride_id", "rides", "ride_id"),
    ("ratings", "user_id", "users", "user_id"),
    ("fact_rides", "user_key", "dim_user", "user_key"),
    ("fact_rides", "driver_key", "dim_driver", "driver_key"),
    ("fact_rides", "start_date_key", "dim_date", "date_key"),
    ("drivers", "vehicle_id", "vehicles", "vehicle_id"),
)

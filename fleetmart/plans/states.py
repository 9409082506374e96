"""States of drivers and users that merge: what the marts per person need of all rides.

A state is one row: counts, sums in whole hundredths, and for a driver the latest rated ride
and the first ``KEPT`` fares. The state of all rides is the merge of the states of any parts
of them, so a load merges that of its new rides into the stored one, and the marts that read
states read no fact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rides whose fares a driver's state keeps.
KEPT = 100
_DRIVER_SUMS = ["rides", "fare100", "fares", "rated", "stars100"]
_USER_SUMS = ["rides", "fare100", "fares", "km100", "kms"]


def _total(column: str) -> Column:
    return F.coalesce(F.sum((F.col(column) * 100).cast("bigint")), F.lit(0).cast("bigint"))


def _added(names: list[str]) -> list[Column]:
    return [F.sum(name).cast("bigint").alias(name) for name in names]


def amount(total: str, count: str) -> Column:
    """A sum of hundredths as ``exact_sum`` gives it; NULL where nothing was added."""
    value = (F.col(total).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")
    return F.when(F.col(count) > 0, value)


def _ride_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rides"),
        _total("fare_amount").alias("fare100"),
        F.count("fare_amount").alias("fares"),
    ]


def driver_totals() -> list[Column]:
    """The counts and sums of a driver's state."""
    return [
        *_ride_totals(),
        F.count("average_driver_rating").alias("rated"),
        _total("average_driver_rating").alias("stars100"),
    ]


def user_totals() -> list[Column]:
    """The counts and sums of a user's state."""
    return [*_ride_totals(), _total("distance_km").alias("km100"), F.count("distance_km").alias("kms")]


def driver_states(rides: DataFrame) -> DataFrame:
    """One row per driver of rows of the fact.

    ``latest`` is the last rated ride by time and id, NULL without one; ``opening`` holds the
    first ``KEPT`` rides in order, with NULL fares too. Only so many rides of a driver leave
    a map task.
    """
    ride = F.struct("start_time", "ride_id", "average_driver_rating")
    totals = rides.groupBy("driver_key").agg(
        *driver_totals(),
        F.max(F.when(F.col("average_driver_rating").isNotNull(), ride)).alias("latest"),
    )
    in_order = Window.partitionBy("driver_key").orderBy("start_time", "ride_id")
    opening = (
        rides.select("driver_key", "start_time", "ride_id", "fare_amount")
        .withColumn("_n", F.row_number().over(in_order))
        .where(F.col("_n") <= KEPT)
        .groupBy("driver_key")
        .agg(
            F.array_sort(F.collect_list(F.struct("start_time", "ride_id", "fare_amount"))).alias(
                "opening"
            )
        )
    )
    return totals.join(opening, "driver_key")


def merged_drivers(states: DataFrame) -> DataFrame:
    """States of parts, a few a driver, as one state per driver."""
    return states.groupBy("driver_key").agg(
        *_added(_DRIVER_SUMS),
        F.max("latest").alias("latest"),
        F.slice(F.array_sort(F.flatten(F.collect_list("opening"))), 1, KEPT).alias("opening"),
    )


def user_states(rides: DataFrame) -> DataFrame:
    """One row per user of rows of the fact."""
    return rides.groupBy("user_key").agg(*user_totals())


def merged_users(states: DataFrame) -> DataFrame:
    return states.groupBy("user_key").agg(*_added(_USER_SUMS))

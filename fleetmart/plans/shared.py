"""What a run of all reports reads of the fact, in two passes over it.

The first pass adds up by driver, by user, and by date and hour at once (grouping sets), in sums
of fixed width that combine in a hash table. The second keeps the rides that are needed as rows:
the first fares and the latest rated rides of every driver, all rides of the sample drivers.
Reports over the result read stored rows, one per person, date or hour, and never the fact.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.operators.scale import materialize
from fleetmart.plans import states
from fleetmart.plans.warehouse import Warehouse

_SETS = [["driver_key"], ["user_key"], ["start_date_key", "hour_of_day"]]
_DRIVERS, _USERS, _HOURS = 0b0111, 0b1011, 0b1100  # grouping ids: a bit for each column left out
_RIDE = ["driver_key", "ride_id", "start_time", "end_time", "fare_amount", "average_driver_rating"]


def totals(fact: DataFrame) -> DataFrame:
    """Sums and counts by driver, by user, and by date and hour; ``_set`` tells which."""
    rides = fact.withColumn("hour_of_day", F.hour("start_time"))
    keys = [key for keys in _SETS for key in keys]
    return rides.groupingSets([[F.col(k) for k in keys] for keys in _SETS], *keys).agg(
        F.grouping_id().cast("int").alias("_set"), *states.driver_totals(), *states.user_totals()[3:]
    )


def kept_rides(fact: DataFrame, sample_keys: list[int]) -> DataFrame:
    """Rides of the sample drivers, the first ``KEPT`` and the latest rated ones of every driver.

    ``view`` says for which of these a row stands: "sample", "first" or "latest". One window
    ranks all: a sample ride is alone in its partition, latest rides run back in time, and
    those at the same time share a rank. Spark drops higher ranks before the shuffle, so a
    driver sends some ``KEPT`` rows a task.
    """
    views = F.array(
        F.lit("first"),
        F.when(F.col("average_driver_rating").isNotNull(), F.lit("latest")),
        F.when(F.col("driver_key").isin(sample_keys), F.lit("sample")),
    )
    rows = fact.select(*_RIDE, F.explode(F.filter(views, lambda v: v.isNotNull())).alias("view"))
    since = F.col("start_time") - F.lit("1970-01-01").cast("timestamp_ntz")
    late = F.col("view") == "latest"
    ranks = Window.partitionBy(
        "driver_key", "view", F.when(F.col("view") == "sample", F.col("ride_id"))
    ).orderBy(F.when(late, -since).otherwise(since), F.when(~late, F.col("ride_id")))
    ranked = rows.withColumn("_rank", F.rank().over(ranks)).where(F.col("_rank") <= states.KEPT)
    return ranked.where(~late | (F.col("_rank") == 1)).drop("_rank")


def _driver_states(sums: DataFrame, kept: DataFrame) -> DataFrame:
    latest = kept.where("view = 'latest'").groupBy("driver_key").agg(
        F.max(F.struct("start_time", "ride_id", "average_driver_rating")).alias("latest")
    )
    opening = kept.where("view = 'first'").groupBy("driver_key").agg(
        F.array_sort(F.collect_list(F.struct("start_time", "ride_id", "fare_amount"))).alias("opening")
    )
    rows = sums.where(F.col("_set") == _DRIVERS).select(
        "driver_key", "rides", "fare100", "fares", "rated", "stars100"
    )
    return rows.join(latest, "driver_key", "left").join(opening, "driver_key")


def reduced(wh: Warehouse, sample_keys: list[int]) -> Warehouse:
    """``wh`` with stored states of drivers, users and hours, for reports; runs jobs.

    Its fact holds the rides of ``sample_keys`` only, with the columns that q10 and q11 need.
    """
    sums = materialize(totals(wh.fact_rides), "report-totals")
    kept = materialize(kept_rides(wh.fact_rides, sample_keys), "report-rides")
    users = sums.where(F.col("_set") == _USERS)
    hours = sums.where(F.col("_set") == _HOURS)
    return replace(
        wh,
        fact_rides=kept.where("view = 'sample'").drop("view"),
        driver_states=materialize(_driver_states(sums, kept), "report-drivers"),
        user_states=users.select("user_key", "rides", "fare100", "fares", "km100", "kms"),
        hour_states=hours.select("start_date_key", "hour_of_day", "rides", "fare100", "fares"),
    )

"""The daily view and the thirteen marts.

Each mart takes a ``Warehouse`` and returns a DataFrame. Where a report groups by
an attribute of a dimension (a name, an initial, a weekday), the fact is first
reduced to one row per dimension key and only that result meets the dimension, so
no join carries the fact itself and a busy key costs one row. ``by`` switches the
grouping from the attribute to the key behind it. Ranks without a limit run jobs at once,
see ``ranking.ranked``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.functions import labels
from fleetmart.functions.scalars import (
    exact_avg,
    exact_ratio,
    exact_sum,
    first_match,
    hours_between,
    tier,
)
from fleetmart.operators import ranking
from fleetmart.operators.joins import join_unique
from fleetmart.operators.ranking import ranked
from fleetmart.operators.scale import (
    DEFAULT,
    Limits,
    HotKeys,
    parts_for,
    sort_columns,
)
from fleetmart.operators.sequence import sequence
from fleetmart.plans.states import KEPT, amount
from fleetmart.plans.warehouse import Warehouse
from fleetmart.sources.colocated import Colocated

RIDE_ORDER = ["start_time", "ride_id"]
# Rows of daily sums that take the place of a ride in a task.
_NARROW = 4
# Keys that a filter on a scan may list.
MOST_KEYS = 10_000


def _top(df: DataFrame, order: list[tuple[str, str]], limit: int | None) -> DataFrame:
    """First ``limit`` rows; without a limit all rows, unsorted (the reader sorts)."""
    if limit is None:
        return df
    return df.orderBy(*sort_columns(order)).limit(limit)


def _mean(total: str, count: str) -> Column:
    return exact_ratio(exact_sum(F.col(total)).cast("decimal(22,2)"), F.sum(count))


# --- reductions of the fact -------------------------------------------------


def _daily(wh: Warehouse, by: str) -> DataFrame:
    """One row per driver and date key, first ride of each driver left out.

    Reads the stored sums per driver key and date; only their names are joined here. Days of
    drivers who share their name are added up, those of all others stay where they are. A small
    job counts the days, so that the partitions of the sums follow their number.
    """
    days = wh.daily_rides
    if by != "driver_key":
        alike = F.count(F.lit(1)).over(Window.partitionBy("driver_name")) > 1
        names = wh.dim_driver.select("driver_key", "driver_name", alike.alias("_alike"))
        sums = ["wait", "waits", "rides", "revenue"]
        named = join_unique(days, names, "driver_key").select(by, "start_date_key", *sums, "_alike")
        shared = named.where("_alike")
        parts = parts_for(days.sparkSession, -(-days.count() // _NARROW))
        if parts is not None:
            shared = shared.repartition(parts, by, "start_date_key")
        shared = shared.groupBy(by, "start_date_key").agg(
            exact_sum(F.col("wait")).alias("wait"),
            F.sum("waits").alias("waits"),
            F.sum("rides").alias("rides"),
            exact_sum(F.col("revenue")).alias("revenue"),
        )
        days = named.where("not _alike").drop("_alike").unionByName(shared)
    return days.select(
        by,
        "start_date_key",
        exact_ratio(F.col("wait").cast("decimal(22,2)"), F.col("waits")).alias(
            "avg_wait_time_minutes"
        ),
        F.col("rides").alias("total_rides_that_day"),
        F.col("revenue").alias("total_revenue_that_day"),
    )


def driver_daily_utilization(wh: Warehouse, by: str = "driver_name") -> DataFrame:
    """Wait, rides and revenue per driver and day, first ride of each driver left out."""
    days = wh.dim_date.select(F.col("date_key").alias("start_date_key"), "full_date")
    return join_unique(_daily(wh, by), days, "start_date_key").select(
        by,
        "full_date",
        "avg_wait_time_minutes",
        "total_rides_that_day",
        "total_revenue_that_day",
    )


def driver_waits(wh: Warehouse, by: str = "driver_name") -> DataFrame:
    """Unweighted mean of the daily mean waits, and rides, per driver."""
    return (
        _daily(wh, by)
        .where(F.col("total_rides_that_day") > 0)
        .groupBy(by)
        .agg(
            exact_ratio(
                F.sum("avg_wait_time_minutes"), F.count("avg_wait_time_minutes")
            ).alias("avg_wait"),
            F.sum("total_rides_that_day").alias("total_rides"),
        )
    )


def driver_revenue(wh: Warehouse, by: str = "driver_name") -> DataFrame:
    if wh.driver_states is not None:
        per_key = wh.driver_states.select(
            "driver_key", "rides", amount("fare100", "fares").alias("revenue")
        )
    else:
        per_key = wh.fact_rides.groupBy("driver_key").agg(
            F.count("ride_id").alias("rides"), exact_sum(F.col("fare_amount")).alias("revenue")
        )
    return (
        join_unique(per_key, wh.dim_driver.select("driver_key", "driver_name"), "driver_key")
        .groupBy(by)
        .agg(F.sum("rides").alias("total_rides"), exact_sum(F.col("revenue")).alias("total_revenue"))
    )


def customer_spend(wh: Warehouse, by: str = "masked_name") -> DataFrame:
    if wh.user_states is not None:
        per_key = wh.user_states.select(
            "user_key",
            "rides",
            amount("fare100", "fares").alias("fare"),
            amount("km100", "kms").alias("km"),
            "kms",
        )
    else:
        per_key = wh.fact_rides.groupBy("user_key").agg(
            F.count("ride_id").alias("rides"),
            exact_sum(F.col("fare_amount")).alias("fare"),
            exact_sum(F.col("distance_km")).alias("km"),
            F.count("distance_km").alias("kms"),
        )
    return (
        join_unique(per_key, wh.dim_user.select("user_key", "masked_name"), "user_key")
        .groupBy(by)
        .agg(
            F.sum("rides").alias("total_rides"),
            exact_sum(F.col("fare")).alias("total_fare_spent"),
            _mean("km", "kms").alias("avg_km"),
        )
    )


# --- totals and top-k -------------------------------------------------------


def driver_efficiency(
    wh: Warehouse,
    *,
    more_rides_than: int = 100,
    limit: int | None = 10,
    by: str = "driver_name",
) -> DataFrame:
    """q1: drivers with the lowest mean wait."""
    busy = driver_waits(wh, by).where(F.col("total_rides") > more_rides_than)
    order = [("avg_wait", "asc"), ("total_rides", "desc"), (by, "asc")]
    return _top(busy, order, limit).select(
        by, F.col("avg_wait").alias("overall_avg_wait_time_minutes"), "total_rides"
    )


def peak_hours(wh: Warehouse, *, limit: int | None = 20) -> DataFrame:
    """q2: revenue by weekday and hour."""
    if wh.hour_states is not None:
        per_key = wh.hour_states.select(
            "start_date_key", "hour_of_day", "rides", amount("fare100", "fares").alias("revenue")
        )
    else:
        per_key = wh.fact_rides.groupBy(
            "start_date_key", F.hour("start_time").alias("hour_of_day")
        ).agg(F.count("ride_id").alias("rides"), exact_sum(F.col("fare_amount")).alias("revenue"))
    days = wh.dim_date.select(F.col("date_key").alias("start_date_key"), "day_name")
    slots = (
        join_unique(per_key, days, "start_date_key")
        .groupBy("day_name", "hour_of_day")
        .agg(F.sum("rides").alias("total_rides"), exact_sum(F.col("revenue")).alias("total_revenue"))
    )
    order = [("total_revenue", "desc"), ("day_name", "asc"), ("hour_of_day", "asc")]
    return _top(slots, order, limit)


def vip_customers(
    wh: Warehouse, *, limit: int | None = 5, by: str = "masked_name"
) -> DataFrame:
    """q3: customers by total spend."""
    order = [("total_fare_spent", "desc"), ("total_rides", "desc"), (by, "asc")]
    return _top(customer_spend(wh, by), order, limit).select(
        by, "total_rides", "total_fare_spent", F.col("avg_km").alias("avg_ride_distance_km")
    )


# --- global ranks -----------------------------------------------------------


def leaderboard(
    wh: Warehouse,
    *,
    limit: int | None = 15,
    by: str = "driver_name",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """q4: unique positions by mean wait, beside the mean of the whole fleet."""
    # Read twice, for the board and for the fleet, from the stored daily sums.
    waits = driver_waits(wh, by)
    fleet = waits.agg(F.round(exact_ratio(F.sum("avg_wait"), F.count("avg_wait")), 2)).scalar()
    board = ranked(
        waits,
        [("avg_wait", "asc")],
        [(by, "asc")],
        {"efficiency_rank": ranking.row_number()},
        limit=limit,
        limits=limits,
    )
    return board.select(
        "efficiency_rank",
        by,
        F.col("avg_wait").alias("overall_avg_wait_time_minutes"),
        "total_rides",
        fleet.alias("fleet_avg_wait_time"),
    )


def revenue_rank(
    wh: Warehouse,
    *,
    limit: int | None = 30,
    by: str = "driver_name",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """q5: rank by revenue, with gaps after ties, and its tier."""
    board = ranked(
        driver_revenue(wh, by),
        [("total_revenue", "desc")],
        [(by, "asc")],
        {"revenue_rank": ranking.rank()},
        limit=limit,
        limits=limits,
    )
    return board.select(
        "revenue_rank",
        by,
        "total_rides",
        "total_revenue",
        _per_ride("total_revenue").alias("avg_fare_per_ride"),
        tier(F.col("revenue_rank"), labels.REVENUE_TIERS, labels.REVENUE_TIER_REST).alias(
            "performance_tier"
        ),
    )


def _per_ride(total: str) -> Column:
    return exact_ratio(F.col(total).cast("decimal(22,2)"), F.col("total_rides"), 2)


def quality_tiers(
    wh: Warehouse,
    *,
    least_rides: int = 10,
    limit: int | None = 20,
    by: str = "driver_name",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """q6: dense rank by mean rating, and the tier named after the rank."""
    if wh.driver_states is not None:
        per_key = wh.driver_states.where("rated > 0").select(
            "driver_key",
            F.col("rated").alias("rides"),
            amount("stars100", "rated").alias("stars"),
            F.col("rated").alias("ratings"),
        )
    else:
        per_key = (
            wh.fact_rides.where(F.col("average_driver_rating").isNotNull())
            .groupBy("driver_key")
            .agg(
                F.count("ride_id").alias("rides"),
                exact_sum(F.col("average_driver_rating")).alias("stars"),
                F.count("average_driver_rating").alias("ratings"),
            )
        )
    rated = (
        join_unique(per_key, wh.dim_driver.select("driver_key", "driver_name"), "driver_key")
        .groupBy(by)
        .agg(
            F.sum("rides").alias("rides_completed"),
            _mean("stars", "ratings").alias("mean_rating"),
        )
        .where(F.col("rides_completed") >= least_rides)
    )
    board = ranked(
        rated,
        [("mean_rating", "desc")],
        [(by, "asc")],
        {"quality_tier": ranking.dense_rank()},
        limit=limit,
        limits=limits,
    )
    return board.select(
        "quality_tier",
        by,
        "rides_completed",
        F.round("mean_rating", 2).alias("avg_rating"),
        first_match(
            [(F.col("quality_tier") == place, label) for place, label in labels.QUALITY_TIERS],
            labels.QUALITY_TIER_REST,
        ).alias("tier_name"),
    )


def _thousandths(share: Column) -> Column:
    # The tiers compare this rounded decimal, not the share itself.
    return F.round(share.cast("decimal(20,15)"), 3)


def commission(
    wh: Warehouse,
    *,
    limit: int | None = 25,
    by: str = "driver_name",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """q7: percentile of revenue and the commission it earns."""
    board = ranked(
        driver_revenue(wh, by),
        [("total_revenue", "desc")],
        [(by, "asc")],
        {"revenue_percentile": _thousandths(ranking.percent_rank())},
        limit=limit,
        limits=limits,
    )
    return board.select(
        by,
        "total_revenue",
        "total_rides",
        _per_ride("total_revenue").alias("revenue_per_ride"),
        "revenue_percentile",
        tier(
            F.col("revenue_percentile"), labels.COMMISSION_TIERS, labels.COMMISSION_TIER_REST
        ).alias("commission_tier"),
    )


def efficiency_quartiles(
    wh: Warehouse,
    *,
    limit: int | None = 30,
    by: str = "driver_name",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """q8: cumulative share of drivers by mean wait, cut into quartiles."""
    board = ranked(
        driver_waits(wh, by),
        [("avg_wait", "asc")],
        [(by, "asc")],
        {"efficiency_cume_dist": _thousandths(ranking.cume_dist())},
        limit=limit,
        limits=limits,
    )
    return board.select(
        by,
        "total_rides",
        F.col("avg_wait").alias("avg_wait_time"),
        "efficiency_cume_dist",
        tier(
            F.col("efficiency_cume_dist"),
            labels.EFFICIENCY_QUARTILES,
            labels.EFFICIENCY_QUARTILE_REST,
        ).alias("efficiency_quartile"),
    )


def value_segments(
    wh: Warehouse,
    *,
    limit: int | None = 50,
    by: str = "masked_name",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """q9: customers in four equal tiles by spend, each with its offer."""
    board = ranked(
        customer_spend(wh, by),
        [("total_fare_spent", "desc")],
        [(by, "asc")],
        {"customer_value_quartile": ranking.ntile(4)},
        limit=limit,
        limits=limits,
    )
    quartile = F.col("customer_value_quartile")
    return board.select(
        "customer_value_quartile",
        by,
        "total_rides",
        "total_fare_spent",
        F.col("avg_km").alias("avg_distance_km"),
        tier(quartile, labels.VALUE_SEGMENTS, labels.VALUE_SEGMENT_REST).alias("segment_name"),
        tier(quartile, labels.SEGMENT_OFFERS, labels.SEGMENT_OFFER_REST).alias("offer"),
    )


# --- sequences per driver ---------------------------------------------------


def idle_gaps(
    wh: Warehouse,
    *,
    driver_keys: list[int] | None = labels.SAMPLE_DRIVER_KEYS,
    limit: int | None = 30,
    hot: HotKeys | None = None,
    stored: Colocated | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """q10: hours until the driver's next ride and the retention risk they signal.

    ``driver_keys=None`` covers every driver. ``hot`` names drivers to cut into segments
    (``hot_keys(wh.fact_rides, "driver_key")``); with it jobs run at once. ``stored``, the
    fact by driver, is read in place of the fact and spares the shuffle; it knows its own
    hot drivers.
    """
    columns = ["driver_key", "ride_id", "start_time", "end_time", "fare_amount"]
    rides = wh.fact_rides.select(*columns) if stored is None else stored
    if driver_keys is not None:
        rides = rides.where(F.col("driver_key").isin(driver_keys))
    lead = {"next_ride_start": "start_time"}
    if stored is not None:
        followed, hot = rides.sequence(columns, lead=lead), stored.keys
    else:
        followed = sequence(rides, "driver_key", RIDE_ORDER, lead=lead, hot=hot, limits=limits)
    followed = followed.where(F.col("next_ride_start").isNotNull())
    named = join_unique(
        followed,
        wh.dim_driver.select("driver_key", "driver_name"),
        "driver_key",
        spread_by="ride_id",
        hot=hot,
        limits=limits,
    )
    first = _top(
        named, [("driver_name", "asc"), ("start_time", "asc"), ("ride_id", "asc")], limit
    )
    idle = F.col("next_ride_start") - F.col("end_time")
    has_next = F.col("next_ride_start").isNotNull()
    flag = first_match(
        [
            *[
                (has_next & (idle > F.make_dt_interval(hours=F.lit(hours))), label)
                for hours, label in labels.IDLE_FLAGS
            ],
            (has_next, labels.IDLE_NORMAL),
        ],
        labels.IDLE_LAST_RIDE,
    )
    return first.select(
        "driver_name",
        F.to_date("start_time").alias("ride_date"),
        F.hour("start_time").alias("start_hour"),
        F.col("fare_amount").alias("current_fare"),
        "next_ride_start",
        hours_between(F.col("end_time"), F.col("next_ride_start")).alias(
            "idle_hours_until_next_ride"
        ),
        flag.alias("retention_risk_flag"),
    )


def progression(
    wh: Warehouse,
    *,
    driver_names: list[str] | None = labels.SAMPLE_DRIVER_NAMES,
    limit: int | None = 50,
    hot: HotKeys | None = None,
    stored: Colocated | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """q11: each fare against the driver's first fare.

    ``driver_names`` picks whole drivers: a small job looks up their keys, which then filter
    the scan of the fact. Where more than ``MOST_KEYS`` drivers bear the names, the fact is
    joined to them instead. ``driver_names=None`` covers every driver; ``hot`` and ``stored`` as
    in q10.
    """
    drivers = wh.dim_driver.select("driver_key", "driver_name")
    columns = ["driver_key", "ride_id", "start_time", "fare_amount"]
    rides = wh.fact_rides.select(*columns) if stored is None else stored
    if driver_names is not None:
        drivers = drivers.where(F.col("driver_name").isin(driver_names))
        wanted = [row.driver_key for row in drivers.select("driver_key").take(MOST_KEYS + 1)]
        if len(wanted) <= MOST_KEYS:
            rides = rides.where(F.col("driver_key").isin(wanted))
        elif stored is not None:
            rides = rides.of_drivers(drivers.select("driver_key"))
        else:
            rides = rides.join(drivers.select("driver_key"), "driver_key", "left_semi")
    wanted = {"row_number": "ride_number", "first": {"first_ever_fare": "fare_amount"}}
    if stored is not None:
        numbered, hot = rides.sequence(columns, **wanted), stored.keys
    else:
        numbered = sequence(rides, "driver_key", RIDE_ORDER, **wanted, hot=hot, limits=limits)
    named = join_unique(
        numbered, drivers, "driver_key", spread_by="ride_id", hot=hot, limits=limits
    )
    first = _top(
        named, [("driver_name", "asc"), ("ride_number", "asc"), ("driver_key", "asc")], limit
    )
    gain = F.col("fare_amount") - F.col("first_ever_fare")
    share = gain / F.nullif(F.col("first_ever_fare"), F.lit(0)) * 100
    return first.select(
        "driver_name",
        "ride_number",
        F.to_date("start_time").alias("ride_date"),
        F.col("fare_amount").alias("current_fare"),
        "first_ever_fare",
        F.round(gain, 2).alias("fare_improvement"),
        F.round(share, 1).alias("improvement_percent"),
        first_match(
            [(gain >= least, label) for least, label in labels.PROGRESSION_TRENDS],
            labels.PROGRESSION_REST,
        ).alias("performance_trend"),
    )


def quality_trend(wh: Warehouse, *, limit: int | None = 20) -> DataFrame:
    """q12: latest rating against the lifetime mean, steepest fall first.

    One row per driver is wanted, so the latest rating is an aggregate: it combines
    on the map side and a driver with very many rides needs no window.
    """
    if wh.driver_states is not None:
        mean = exact_ratio(
            amount("stars100", "rated").cast("decimal(22,2)"), F.col("rated"), 2
        )
        per_driver = wh.driver_states.where("rated > 0").select(
            "driver_key",
            F.col("rated").alias("total_rides"),
            mean.alias("lifetime_avg_rating"),
            F.round("latest.average_driver_rating", 2).alias("most_recent_rating"),
        )
    else:
        latest = F.max_by("average_driver_rating", F.struct(*RIDE_ORDER))
        per_driver = (
            wh.fact_rides.where(F.col("average_driver_rating").isNotNull())
            .groupBy("driver_key")
            .agg(
                F.count(F.lit(1)).alias("total_rides"),
                exact_avg(F.col("average_driver_rating"), 2).alias("lifetime_avg_rating"),
                F.round(latest, 2).alias("most_recent_rating"),
            )
        )
    trend = F.col("most_recent_rating") - F.col("lifetime_avg_rating")
    named = join_unique(
        per_driver, wh.dim_driver.select("driver_key", "driver_name"), "driver_key"
    ).withColumn("recent_trend", trend)
    order = [("recent_trend", "asc"), ("driver_name", "asc"), ("driver_key", "asc")]
    return _top(named, order, limit).select(
        "driver_name",
        "total_rides",
        "lifetime_avg_rating",
        "most_recent_rating",
        "recent_trend",
        first_match(
            [
                (F.col("recent_trend") < labels.TREND_ALERT_BELOW, labels.TREND_ALERT),
                (F.col("recent_trend") < 0, labels.TREND_WARNING),
                (F.col("recent_trend") >= 0, labels.TREND_POSITIVE),
            ]
        ).alias("quality_trend_flag"),
    )


def milestone_fares(wh: Warehouse, milestones: list[int]) -> DataFrame:
    """Rides per driver and the fare at each milestone ride, NULL when not reached.

    Only the first max(milestones) rides of a driver matter. Catalyst applies the
    row-number filter before the shuffle as well, so a driver sends at most that
    many rows per map task, however many rides there are.
    """
    last = max(milestones)
    if wh.driver_states is not None and last <= KEPT:
        return wh.driver_states.select(
            "driver_key",
            F.col("rides").alias("total_rides_to_date"),
            *[
                F.get("opening", F.lit(place - 1))["fare_amount"].alias(f"ride_{place}_fare")
                for place in milestones
            ],
        )
    window = Window.partitionBy("driver_key").orderBy(*RIDE_ORDER)
    fares = (
        wh.fact_rides.select("driver_key", "fare_amount", *RIDE_ORDER)
        .withColumn("n", F.row_number().over(window))
        .where(F.col("n") <= last)
        .groupBy("driver_key")
        .agg(
            *[
                F.max(F.when(F.col("n") == place, F.col("fare_amount"))).alias(
                    f"ride_{place}_fare"
                )
                for place in milestones
            ]
        )
    )
    totals = wh.fact_rides.groupBy("driver_key").agg(
        F.count(F.lit(1)).alias("total_rides_to_date")
    )
    return totals.join(fares, "driver_key")


def driver_milestones(
    wh: Warehouse,
    *,
    least_rides: int = 10,
    milestones: list[int] = labels.MILESTONES,
    limit: int | None = 30,
) -> DataFrame:
    """q13: fares at milestone rides and the driver's lifecycle stage."""
    per_driver = milestone_fares(wh, sorted({*milestones, 1, 10})).where(
        F.col("total_rides_to_date") >= least_rides
    )
    named = join_unique(
        per_driver, wh.dim_driver.select("driver_key", "driver_name"), "driver_key"
    )
    rides = F.col("total_rides_to_date")
    order = [("total_rides_to_date", "desc"), ("driver_name", "asc"), ("driver_key", "asc")]
    return _top(named, order, limit).select(
        "driver_name",
        "total_rides_to_date",
        first_match(
            [(rides >= least, label) for least, label in labels.LIFECYCLE_STAGES],
            labels.LIFECYCLE_REST,
        ).alias("driver_lifecycle_stage"),
        *[f"ride_{n}_fare" for n in milestones],
        first_match(
            [
                (
                    (rides >= 50) & (F.col("ride_10_fare") > F.col("ride_1_fare")),
                    labels.STRONG_ONBOARDING,
                )
            ],
            labels.MONITOR_ONBOARDING,
        ).alias("onboarding_quality"),
    )

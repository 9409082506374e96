"""Chart-ready tables: second-level aggregates over the marts, and their runner."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.functions import labels
from fleetmart.operators.scale import sort_columns, together
from fleetmart.plans import marts
from fleetmart.plans.shared import reduced
from fleetmart.plans.warehouse import Warehouse


def peak_heatmap(slots: DataFrame) -> DataFrame:
    """Weekday by hour grid of revenue; weekdays without a slot are left out."""
    names = F.array(*[F.lit(day) for day in labels.WEEKDAYS])
    grid = (
        slots.groupBy("day_name").pivot("hour_of_day", list(range(24))).agg(F.sum("total_revenue"))
    )
    return grid.select(
        F.array_position(names, F.col("day_name")).alias("day_order"),
        "day_name",
        *[F.col(f"`{hour}`").alias(f"h{hour:02d}") for hour in range(24)],
    )


def peak_labels(slots: DataFrame, limit: int = 20) -> DataFrame:
    """The best slots with their axis label, in ascending order of revenue."""
    order = [("total_revenue", "desc"), ("day_name", "asc"), ("hour_of_day", "asc")]
    best = slots.orderBy(*sort_columns(order)).limit(limit)
    label = F.concat(F.col("day_name"), F.lit(" "), F.col("hour_of_day").cast("string"), F.lit(":00"))
    return best.select(
        label.alias("hour_label"), "day_name", "hour_of_day", "total_rides", "total_revenue"
    ).orderBy("total_revenue")


def _two_places(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(38,2)").cast("string")


def vip_share(customers: DataFrame) -> DataFrame:
    """Each customer's share of the spend of all listed customers, with a caption."""
    total = customers.agg(F.sum("total_fare_spent")).scalar()
    caption = F.concat(
        F.col("masked_name"),
        F.lit(" spent "),
        _two_places(F.col("total_fare_spent")),
        F.lit(" on "),
        F.col("total_rides").cast("string"),
        F.lit(" trips of "),
        _two_places(F.col("avg_ride_distance_km")),
        F.lit(" km each"),
    )
    share = F.col("total_fare_spent").cast("decimal(22,2)") / F.nullif(
        total.cast("decimal(22,2)"), F.lit(0)
    )
    return customers.select(
        "masked_name", "total_fare_spent", F.round(share, 6).alias("share"), caption.alias("caption")
    )


def tier_counts(tiers: DataFrame) -> DataFrame:
    return tiers.groupBy("tier_name").agg(F.count(F.lit(1)).alias("drivers"))


def tier_averages(tiers: DataFrame) -> DataFrame:
    """Mean of the already rounded driver averages."""
    return tiers.groupBy("tier_name").agg(
        marts.exact_avg(F.col("avg_rating"), 6).alias("avg_rating")
    )


def segment_stats(segments: DataFrame, examples: int = 3) -> DataFrame:
    """Spend statistics per segment, the names of its best customers, and a caption.

    The names come from a row-number filter, so a segment brings at most
    ``examples`` rows together, whatever its size.
    """
    best_first = Window.partitionBy("segment_name").orderBy(
        *sort_columns([("total_fare_spent", "desc"), ("masked_name", "asc")])
    )
    names = (
        segments.select("segment_name", "masked_name", "total_fare_spent")
        .withColumn("place", F.row_number().over(best_first))
        .where(F.col("place") <= examples)
        .groupBy("segment_name")
        .agg(F.array_sort(F.collect_list(F.struct("place", "masked_name"))).alias("best"))
        .select(
            "segment_name",
            F.array_join(F.transform("best", lambda row: row["masked_name"]), ", ").alias(
                "top_customers"
            ),
        )
    )
    stats = segments.groupBy("segment_name").agg(
        F.min("total_fare_spent").alias("min_fare"),
        F.max("total_fare_spent").alias("max_fare"),
        marts.exact_avg(F.col("total_fare_spent"), 6).alias("avg_fare"),
        F.sum("total_fare_spent").alias("total_fare"),
        F.count("masked_name").alias("customer_count"),
    )

    caption = F.concat(
        F.col("customer_count").cast("string"),
        F.lit(" in "),
        F.col("segment_name"),
        F.lit(" with "),
        F.format_number("min_fare", 0),
        F.lit(" to "),
        F.format_number("max_fare", 0),
        F.lit(" each, "),
        F.format_number("total_fare", 0),
        F.lit(" together; first: "),
        F.col("top_customers"),
    )
    return stats.join(names, "segment_name").withColumn("caption", caption)


def milestone_funnel(
    milestones: DataFrame, places: list[int] = labels.MILESTONES
) -> DataFrame:
    """Per milestone: drivers who reached it and their mean fare there."""
    one_row = milestones.agg(
        F.array(
            *[
                F.struct(
                    F.lit(place).alias("ride"),
                    F.lit(f"Ride #{place}").alias("milestone"),
                    F.count(f"ride_{place}_fare").alias("drivers"),
                    marts.exact_avg(F.col(f"ride_{place}_fare"), 6).alias("avg_fare"),
                )
                for place in places
            ]
        ).alias("steps")
    )
    return one_row.select(F.explode("steps").alias("step")).select("step.*")


def _sample_keys(wh: Warehouse, driver_names: list[str] | None) -> list[int]:
    """Keys of the drivers whose rides the reports list."""
    if driver_names is None:
        raise ValueError("a shared run lists the rides of named drivers only")
    named = wh.dim_driver.where(F.col("driver_name").isin(driver_names)).select("driver_key")
    keys = [row.driver_key for row in named.take(marts.MOST_KEYS + 1)]
    if len(keys) > marts.MOST_KEYS:
        raise ValueError(f"more than {marts.MOST_KEYS} drivers bear these names")
    return sorted({*keys, *labels.SAMPLE_DRIVER_KEYS})


def catalog(
    wh: Warehouse,
    *,
    driver_names: list[str] | None = labels.SAMPLE_DRIVER_NAMES,
    shared: bool = False,
) -> dict[str, Callable[[], DataFrame]]:
    """The reports in the order they are produced, each a function of no arguments.

    Fixed values: the names, which must match for the manifest to match. With ``shared`` two
    jobs reduce the fact at once, and the reports read what these stored (see ``shared``); each
    named driver's rides are among that, so all drivers can't be asked for.
    """
    if shared:
        wh = reduced(wh, _sample_keys(wh, driver_names))
    return {
        "01_driver_efficiency": lambda: marts.driver_efficiency(wh),
        "02_peak_hours_heatmap": lambda: peak_heatmap(marts.peak_hours(wh)),
        "03_top_peak_hours": lambda: peak_labels(marts.peak_hours(wh)),
        "04_vip_customers": lambda: marts.vip_customers(wh),
        "05_vip_revenue_distribution": lambda: vip_share(marts.vip_customers(wh)),
        "06_driver_leaderboard": lambda: marts.leaderboard(wh),
        "07_revenue_tier_ranks": lambda: marts.revenue_rank(wh),
        "08_quality_tier_counts": lambda: tier_counts(marts.quality_tiers(wh, limit=None)),
        "08_quality_tier_averages": lambda: tier_averages(marts.quality_tiers(wh, limit=None)),
        "09_commission_percentiles": lambda: marts.commission(wh),
        "10_efficiency_quartiles": lambda: marts.efficiency_quartiles(wh, limit=None),
        "11_customer_value_segments": lambda: segment_stats(marts.value_segments(wh, limit=None)),
        "12_churn_risk_matrix": lambda: marts.idle_gaps(wh, limit=100).drop("next_ride_start"),
        "13_driver_progression": lambda: marts.progression(wh, driver_names=driver_names),
        "14_quality_trend_alerts": lambda: marts.quality_trend(wh),
        "15_driver_milestones": lambda: milestone_funnel(marts.driver_milestones(wh)),
    }


def _manifest_row(name: str, df: DataFrame) -> DataFrame:
    return df.agg(
        F.lit(name).alias("report"),
        F.count(F.lit(1)).alias("n_rows"),
        F.when(F.count(F.lit(1)) > 0, "OK").otherwise("NO DATA").alias("status"),
    )


def manifest(reports: dict[str, DataFrame]) -> DataFrame:
    """One row per report: its size and whether it has data."""
    return reduce(
        DataFrame.unionByName, [_manifest_row(name, df) for name, df in reports.items()]
    )


def write_reports(
    reports: dict[str, Callable[[], DataFrame]], folder: str, fmt: str = "parquet"
) -> DataFrame:
    """Write every report and return the manifest; a failing report is noted and skipped.

    Each run writes to a folder of its own below ``folder``, named ``run-`` and an id, so no
    table of an earlier run stands in for a report that failed.
    """
    run = f"{folder}/run-{uuid.uuid4().hex}"

    def produce(name: str, make: Callable[[], DataFrame]) -> DataFrame | str:
        path = f"{run}/{name}"
        try:
            df = make()
            df.write.mode("overwrite").format(fmt).save(path)
            return df.sparkSession.read.schema(df.schema).format(fmt).load(path)
        except Exception as error:  # the other reports are still wanted
            return f"FAILED: {type(error).__name__}: {error}"

    outcome = dict(
        zip(
            reports,
            together(*[partial(produce, name, make) for name, make in reports.items()]),
            strict=True,
        )
    )
    written = {name: df for name, df in outcome.items() if isinstance(df, DataFrame)}
    failed = [(name, 0, text) for name, text in outcome.items() if isinstance(text, str)]
    if not written:
        raise RuntimeError(f"no report could be written: {failed}")
    result = manifest(written)
    if failed:
        lost = result.sparkSession.createDataFrame(failed, result.schema)
        result = result.unionByName(lost)
    return result

"""Every operator and mart as a function of (spark, sf_dir).

The marts read a warehouse built once per session and data folder, as a user would.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, ShortType

from fleetmart.functions.scalars import elapsed_seconds
from fleetmart.operators import keys, quality, ranking
from fleetmart.operators.joins import join_unique
from fleetmart.operators.scale import HotKeys, hot_keys, materialize, parts_for, scratch_dir
from fleetmart.operators.sequence import (
    last_value,
    latest_per_key,
    sequence,
    with_group_values,
)
from fleetmart.plans import dimensions, facts, increment, marts, reports, warehouse
from fleetmart.plans.warehouse import Warehouse
from fleetmart.schemas import FOREIGN_KEYS, RAW, RULES, STAR, value_kinds
from fleetmart.sources import raw as raw_files
from fleetmart.sources import tables, user_days
from fleetmart.sources.colocated import Colocated, write_colocated
from fleetmart.sources.fixtures import order_lines, raw_tables, read_table

Query = Callable[[SparkSession, str], DataFrame]

# The test drivers have generated names, so the name sample is theirs.
DRIVER_NAMES = [f"Driver#{number}" for number in range(5)]
SALT = "fleet"
DECLARED = RAW | STAR
STAR_NAMES = ("dim_user", "dim_driver", "dim_date", "fact_rides")

# Spark counts 4 MB more for each file, so that small files give splits fewer rows.
LINES_PER_FILE = 125_000

_STAGED: dict[tuple[str, str, str], tuple[dict[str, DataFrame], str]] = {}
_BUILT: dict[tuple[str, str, str], Warehouse] = {}


def staged(spark: SparkSession, sf_dir: str, rides: str) -> tuple[dict[str, DataFrame], str]:
    """The raw tables that a load reads, and the folder of their warehouse."""
    key = (spark.sparkContext.applicationId, sf_dir, rides)
    if key not in _STAGED:
        root, lines = f"{scratch_dir(spark)}/warehouse-{uuid.uuid4().hex}", None
        if rides == "orders":
            # Order lines meet their orders once, for rides and ratings, and are stored before
            # use in fewer bytes than rides. A load reads the other tables once. Lines are so
            # narrow that a split of Spark's default size would hold 5 million of them.
            joined = {"order_lines": order_lines(spark, sf_dir)}
            lines = warehouse.stage(joined, root, LINES_PER_FILE)["order_lines"]
        _STAGED[key] = raw_tables(spark, sf_dir, rides, lines), root
    return _STAGED[key]


def built(spark: SparkSession, sf_dir: str, rides: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir, rides)
    if key not in _BUILT:
        raw, root = staged(spark, sf_dir, rides)
        _BUILT[key] = warehouse.build(raw, root, checks="none")
    return _BUILT[key]


_HOT: dict[tuple[str, str, str], HotKeys | None] = {}


def hot_drivers(spark: SparkSession, sf_dir: str, rides: str) -> HotKeys | None:
    """Drivers with too many rides for one task, counted once per warehouse."""
    key = (spark.sparkContext.applicationId, sf_dir, rides)
    if key not in _HOT:
        _HOT[key] = hot_keys(built(spark, sf_dir, rides).fact_rides, "driver_key")
    return _HOT[key]


def stage_from(raw: dict[str, DataFrame], root: str, rides: str) -> dict[str, DataFrame]:
    # Rides from order lines come out of a join and are read several times, so they are stored
    # before use. A load reads the other tables once.
    return raw | warehouse.stage({"rides": raw["rides"]}, root) if rides == "orders" else raw


def build_from(raw: dict[str, DataFrame], root: str, rides: str) -> Warehouse:
    # The checks of a load have queries of their own.
    return warehouse.build(stage_from(raw, root, rides), root, checks="none")


def portable(df: DataFrame) -> DataFrame:
    """Types every engine has: 64-bit integers, doubles (long averages to 6 places)."""
    columns = []
    for column in df.schema:
        value = F.col(f"`{column.name}`")
        if isinstance(column.dataType, DecimalType):
            if column.dataType.scale > 6:
                value = F.round(value, 6)
            value = value.cast("double")
        elif isinstance(column.dataType, (IntegerType, ShortType)):
            value = value.cast("bigint")
        columns.append(value.alias(column.name))
    return df.select(*columns)


# --- load -------------------------------------------------------------------


def csv_table(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table written as text and read back under its declared schema."""
    path = f"{scratch_dir(spark)}/csv-{uuid.uuid4().hex}/{name}.csv"
    raw_files.write_csv(raw_tables(spark, sf_dir)[name], path)
    return raw_files.read_csv(spark, path, RAW[name])


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings whose comments hold line breaks and quotes, written as text and read in splits."""
    path = f"{scratch_dir(spark)}/breaks-{uuid.uuid4().hex}.csv"
    said = F.concat(F.lit('"'), F.col("rating_id"), F.lit('"\n, "\n'))
    ratings = raw_tables(spark, sf_dir)["ratings"].withColumn("comments", said)
    raw_files.write_csv(ratings, path)
    return raw_files.read_csv(spark, path, ratings.schema, multiline=True)


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(
        read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def _all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    wh = built(spark, sf_dir, "events")
    star = {name: getattr(wh, name) for name in STAR_NAMES}
    return raw_tables(spark, sf_dir) | star


def dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_violations(_all_tables(spark, sf_dir), RULES)


def _third(column: str) -> Column:
    """True for about a third of all values."""
    return F.substring(F.md5(F.col(column).cast("string")), 1, 1) < "5"


def _broken(name: str, df: DataFrame) -> DataFrame:
    """All rows of a table as text, and again for each rule with a value that breaks it."""
    rules = RULES[name]
    text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    bad = [(c, F.lit(None).cast("string")) for c in rules.not_null]
    bad += [(c, F.lit("x" * (size + 1))) for c, size in rules.max_length.items()]
    bad += [(c, F.lit("9" * (p - s + 1))) for c, (p, s) in rules.decimals.items()]
    bad += [(c, F.lit("no value")) for c in value_kinds(DECLARED[name]) if c in df.columns]
    cases = text.withColumn("_case", F.explode(F.sequence(F.lit(0), F.lit(len(bad)))))
    changed = {c: F.col(c) for c in df.columns}
    for case, (column, value) in enumerate(bad, 1):
        changed[column] = F.when(F.col("_case") == case, value).otherwise(changed[column])
    return cases.select([value.alias(c) for c, value in changed.items()])


def dq_broken_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of every table, each broken by as many rows as the table has."""
    tables_ = _all_tables(spark, sf_dir)
    kinds = {name: value_kinds(DECLARED[name]) for name in tables_}
    dirty = {name: _broken(name, df) for name, df in tables_.items()}
    return quality.all_violations(dirty, RULES, kinds)


def dq_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken rides written as text and read back without types."""
    path = f"{scratch_dir(spark)}/text-{uuid.uuid4().hex}/rides.csv"
    raw_files.write_csv(_broken("rides", raw_tables(spark, sf_dir)["rides"]), path)
    text = raw_files.read_text(spark, path, RAW["rides"])
    return quality.violations("rides", text, RULES["rides"], value_kinds(RAW["rides"]))


def dq_declared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared keys over all tables, of which a part of the rows comes twice."""
    doubled = {
        name: df.unionByName(df.where(_third(RULES[name].key[0])))
        for name, df in _all_tables(spark, sf_dir).items()
    }
    return quality.declared_keys(doubled, RULES)


def dq_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reference_report(_all_tables(spark, sf_dir), FOREIGN_KEYS)


def dq_broken_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared reference, with children that point nowhere in a third of all rows."""
    found = []
    for child, column, parent, parent_column in FOREIGN_KEYS:
        tables_ = _all_tables(spark, sf_dir)
        value = F.col(column).cast("string")
        lost = F.when(_third(column), F.concat(F.lit("x"), value)).otherwise(value)
        tables_[child] = tables_[child].withColumn(column, lost)
        tables_[parent] = tables_[parent].withColumn(
            parent_column, F.col(parent_column).cast("string")
        )
        found.append(
            quality.reference_report(tables_, ((child, column, parent, parent_column),))
        )
    return reduce(DataFrame.unionByName, found)


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides of drivers who are not available, per driver."""
    raw = raw_tables(spark, sf_dir)
    available = raw["drivers"].where("available")
    return quality.orphans(raw["rides"], "driver_id", available, "driver_id")


def dq_load_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load would drop that knows only available drivers."""
    raw = raw_tables(spark, sf_dir)
    return quality.load_losses(
        raw["rides"], raw["ratings"], raw["users"], raw["drivers"].where("available")
    )


def dq_broken_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of rides of which some lack their time, user or driver, and of fewer users."""
    raw = raw_tables(spark, sf_dir)
    number = F.col("ride_id").cast("bigint")
    rides = raw["rides"]
    for column, every in (("ride_start_time", 17), ("user_id", 19), ("driver_id", 23)):
        rides = rides.withColumn(column, F.when(number % every != 0, F.col(column)))
    ratings = raw["ratings"].unionByName(raw["ratings"].where(number % 4 == 0))
    users = raw["users"].where(F.col("user_id").cast("bigint") % 5 != 0)
    return quality.load_losses(rides, ratings, users, raw["drivers"].where("available"))


def dq_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ride with the rules it breaks: some lack an id, a parent or a readable fare, some
    come twice."""
    raw = raw_tables(spark, sf_dir)
    number = F.col("ride_id").cast("bigint")
    rides = raw["rides"].unionByName(raw["rides"].where(number % 29 == 0))
    rides = rides.select(
        F.when(number % 31 != 0, F.col("ride_id")).alias("ride_id"),
        number.alias("number"),
        F.when(number % 19 != 0, F.col("user_id")).alias("user_id"),
        "driver_id",
        F.when(number % 37 == 0, "no amount").otherwise(F.col("fare_amount").cast("string")).alias("fare_amount"),
    )
    tables_ = {
        "rides": rides,
        "users": raw["users"].where(F.col("user_id").cast("bigint") % 5 != 0),
        "drivers": raw["drivers"].where("available"),
    }
    rows = quality.with_reasons("rides", tables_, RULES["rides"], FOREIGN_KEYS)
    return rows.select("number", "driver_id", F.array_join("reasons", "; ").alias("reasons"))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.new_dates(raw_tables(spark, sf_dir)["rides"])


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.new_users(raw_tables(spark, sf_dir)["users"])


def dim_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_tables(spark, sf_dir)
    return dimensions.new_drivers(raw["drivers"], raw["vehicles"])


def upsert_ignore_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load that repeats a user once per ride, onto the users of the first half-year."""
    raw = raw_tables(spark, sf_dir)
    early = raw["users"].where(F.col("registration_date") < F.lit("2023-07-01"))
    first = dimensions.new_users(early)
    copies = raw["users"].join(raw["rides"].select("user_id"), "user_id")
    second = keys.insert_if_absent(
        first, dimensions.masked_users(copies), "user_key", "user_id"
    )
    return first.withColumn("batch", F.lit(1)).unionByName(second.withColumn("batch", F.lit(2)))


def durable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of users before and after a rebuild that brings new ids smaller than the known ones."""
    users = raw_tables(spark, sf_dir)["users"]
    path = f"{scratch_dir(spark)}/register-{uuid.uuid4().hex}"
    middle = users.agg(F.expr("(min(user_id) + max(user_id)) div 2")).first()[0]
    early = users.where(F.col("user_id") > middle)
    before = materialize(dimensions.new_users(early, register=path), "before")
    after = materialize(dimensions.new_users(users, register=path), "after")
    n_early = before.count()
    n_keys, last_key = after.agg(F.countDistinct("user_key"), F.max("user_key")).first()
    old = before.select("user_id", F.col("user_key").alias("old_key"))
    return after.join(old, "user_id", "left").select(
        "user_id",
        F.col("old_key").isNotNull().alias("early"),
        F.coalesce(F.col("old_key") == F.col("user_key"), F.col("user_key") > n_early).alias("kept"),
        (F.col("user_key") >= 1).alias("positive"),
        F.lit(n_early).alias("n_early"),
        F.lit(n_keys).alias("n_keys"),
        F.lit(last_key).alias("last_key"),
    )


def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.ride_dates(raw_tables(spark, sf_dir, "orders")["rides"])


def mask_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.masked_users(raw_tables(spark, sf_dir)["users"])


def mask_pii_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.masked_users(raw_tables(spark, sf_dir)["users"], SALT)


def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = built(spark, sf_dir, "events")
    rides = raw_tables(spark, sf_dir)["rides"]
    keyed = facts.keyed_rides(rides, wh.dim_user, wh.dim_driver, wh.dim_date)
    return keyed.select("ride_id", "user_key", "driver_key")


def join_inner_dropping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with dimensions that lack some drivers, users and dates."""
    wh = built(spark, sf_dir, "events")
    keyed = facts.keyed_rides(
        raw_tables(spark, sf_dir)["rides"],
        wh.dim_user.where("user_key % 5 <> 0"),
        wh.dim_driver.where("driver_key % 3 <> 0"),
        wh.dim_date.where("date_key % 7 <> 0"),
    )
    return keyed.select("ride_id", "user_key", "driver_key")


def join_computed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = built(spark, sf_dir, "orders")
    rides = staged(spark, sf_dir, "orders")[0]["rides"]
    parts = parts_for(spark, rides.count())
    keyed = facts.keyed_rides(
        rides,
        wh.dim_user,
        wh.dim_driver,
        wh.dim_date,
        hot_users=None if parts is None else hot_keys(rides, "user_id"),
        parts=parts,
        by_driver=False,
    )
    return keyed.select("ride_id", "date_key")


def join_left_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_tables(spark, sf_dir)
    return join_unique(
        raw["rides"].select("ride_id", "ride_start_time"),
        facts.rating_per_ride(raw["ratings"]),
        "ride_id",
        "left",
        spread_by="ride_start_time",
    ).drop("ride_start_time")


def join_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = built(spark, sf_dir, "events")
    return (
        join_unique(
            join_unique(
                join_unique(wh.fact_rides, wh.dim_driver, "driver_key"),
                wh.dim_date.withColumnRenamed("date_key", "start_date_key"),
                "start_date_key",
            ),
            wh.dim_user,
            "user_key",
        ).select("ride_id", "driver_name", "vehicle_make", "day_name", "masked_name")
    )


def fact_rides(rides: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a load computes it, from the raw rides and dimensions of its own."""
    raw, root = staged(spark, sf_dir, rides)
    dims = warehouse.build_dimensions(raw, f"{root}/fact-{uuid.uuid4().hex}")
    return facts.fact_rides(raw["rides"], raw["ratings"], *dims)


def fact_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact stored in date folders, loaded in two appends split by rating."""
    fact = built(spark, sf_dir, "events").fact_rides
    path = f"{scratch_dir(spark)}/by-date-{uuid.uuid4().hex}"
    rated = F.col("average_driver_rating").isNotNull()
    tables.write_fact(fact.where(rated), path, by_date=True)
    return tables.write_fact(fact.where(~rated), path, by_date=True, mode="append")


_USER_DAYS: dict[tuple[str, str], DataFrame] = {}


def fact_by_user_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact stored for look-ups by user and date."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _USER_DAYS:
        path = f"{scratch_dir(spark)}/user-days-{uuid.uuid4().hex}"
        fact = built(spark, sf_dir, "events").fact_rides
        _USER_DAYS[key] = user_days.write_user_days(fact, path)
    return _USER_DAYS[key]


def _most_rides(stored: DataFrame, by: str) -> int:
    """The value of a column with most rides, the smallest of several."""
    counts = stored.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), by).first()[0]


def lookup_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rides of the user with most of them."""
    stored = fact_by_user_date(spark, sf_dir)
    return user_days.look_up(stored, users=[_most_rides(stored, "user_key")])


def lookup_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rides of the date with most of them."""
    stored = fact_by_user_date(spark, sf_dir)
    busiest = _most_rides(stored, "start_date_key")
    return user_days.look_up(stored, dates=(busiest, busiest))


_BATCHES: dict[tuple[str, str], Warehouse] = {}
_BATCH_ROOTS: dict[tuple[str, str], str] = {}


def in_batches(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All rides in three loads: two by time, of which each tenth ride comes with the last."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BATCHES:
        root = _BATCH_ROOTS[key] = f"{scratch_dir(spark)}/batches-{uuid.uuid4().hex}"
        raw = raw_tables(spark, sf_dir)
        time = F.col("ride_start_time")
        ends = raw["rides"].agg(F.min("ride_start_time"), F.max("ride_start_time")).first()
        half = F.lit(ends[0] + (ends[1] - ends[0]) / 2)
        late = F.col("ride_id").cast("bigint") % 10 == 3
        batch = F.when(late, 3).when(time < half, 1).otherwise(2)
        for number in (1, 2, 3):
            rides = raw["rides"].where(batch == number)
            _BATCHES[key] = increment.load_batch(raw | {"rides": rides}, root, groups=4)
    return _BATCHES[key]


def fact_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after loads of which the last one holds late rides only."""
    return in_batches(spark, sf_dir).fact_rides


def daily_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per driver and date, kept up by the differences that each load made."""
    return in_batches(spark, sf_dir).daily_rides


def utilization_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily view over the tables kept by loads in batches."""
    return marts.driver_daily_utilization(in_batches(spark, sf_dir))


def ride_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uses of the ids of a batch: all rides again, each tenth twice, and as many new ids."""
    in_batches(spark, sf_dir)
    ids = raw_tables(spark, sf_dir)["rides"].select("ride_id")
    number = F.col("ride_id").cast("bigint")
    new = ids.select((-number - 1).cast(ids.schema["ride_id"].dataType).alias("ride_id"))
    batch = ids.unionByName(ids.where(number % 10 == 3)).unionByName(new)
    return increment.ride_uses(batch, _BATCH_ROOTS[spark.sparkContext.applicationId, sf_dir])


_FROM_STATES = {
    "q5": marts.revenue_rank,
    "q6": marts.quality_tiers,
    "q7": marts.commission,
    "q9": marts.value_segments,
    "q12": marts.quality_trend,
    "q13": marts.driver_milestones,
}


def from_states(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart over the states per driver or user that loads in batches have merged."""
    return _FROM_STATES[name](in_batches(spark, sf_dir), limit=None)


# --- windows ----------------------------------------------------------------


def _rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, "events").fact_rides.select(
        "driver_key", "ride_id", "start_time", "end_time", "fare_amount", "average_driver_rating"
    )


def win_lag_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = sequence(
        _rides(spark, sf_dir),
        "driver_key",
        marts.RIDE_ORDER,
        lag={"previous_end": "end_time"},
        lead={"next_start": "start_time"},
        hot=hot_drivers(spark, sf_dir, "events"),
    )
    return linked.select(
        "ride_id",
        "previous_end",
        "next_start",
        elapsed_seconds(F.col("previous_end"), F.col("start_time")).alias("seconds_since"),
        elapsed_seconds(F.col("end_time"), F.col("next_start")).alias("seconds_until"),
    )


def win_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence(
        _rides(spark, sf_dir),
        "driver_key",
        marts.RIDE_ORDER,
        row_number="ride_number",
        first={"first_fare": "fare_amount"},
        hot=hot_drivers(spark, sf_dir, "events"),
    ).select("ride_id", "ride_number", "first_fare")


_COLOCATED: dict[tuple[str, str], Colocated] = {}


def colocated(spark: SparkSession, sf_dir: str) -> Colocated:
    """The fact stored by driver, once per warehouse."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _COLOCATED:
        path = f"{scratch_dir(spark)}/colocated-{uuid.uuid4().hex}"
        _COLOCATED[key] = write_colocated(built(spark, sf_dir, "events").fact_rides, path)
    return _COLOCATED[key]


def win_lag_gap_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``win_lag_gap`` over the fact stored by driver."""
    return colocated(spark, sf_dir).sequence(
        ["ride_id", "start_time", "end_time"],
        lag={"previous_end": "end_time"},
        lead={"next_start": "start_time"},
    ).select(
        "ride_id",
        "previous_end",
        "next_start",
        elapsed_seconds(F.col("previous_end"), F.col("start_time")).alias("seconds_since"),
        elapsed_seconds(F.col("end_time"), F.col("next_start")).alias("seconds_until"),
    )


def win_numbering_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``win_numbering`` over the fact stored by driver."""
    return colocated(spark, sf_dir).sequence(
        ["ride_id"], row_number="ride_number", first={"first_fare": "fare_amount"}
    )


def q10_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, stored = built(spark, sf_dir, "events"), colocated(spark, sf_dir)
    return marts.idle_gaps(wh, driver_keys=None, limit=None, stored=stored)


def q11_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, stored = built(spark, sf_dir, "events"), colocated(spark, sf_dir)
    return marts.progression(wh, driver_names=None, limit=None, stored=stored)


def win_partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_group_values(
        _rides(spark, sf_dir),
        "driver_key",
        {
            "n_rides": F.count(F.lit(1)),
            "mean_rating": marts.exact_avg(F.col("average_driver_rating")),
            "last_fare": last_value("fare_amount", marts.RIDE_ORDER),
            "last_rating": last_value("average_driver_rating", marts.RIDE_ORDER),
        },
    ).select("ride_id", "n_rides", "mean_rating", "last_fare", "last_rating")


def win_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by rating, of which the largest is that of all unrated rides, NULL."""
    return with_group_values(
        _rides(spark, sf_dir),
        "average_driver_rating",
        {"n_rides": F.count(F.lit(1)), "last_fare": last_value("fare_amount", marts.RIDE_ORDER)},
    ).select("ride_id", "average_driver_rating", "n_rides", "last_fare")


def win_nth_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.milestone_fares(built(spark, sf_dir, "events"), [1, 10, 50, 100])


def latest_per_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(_rides(spark, sf_dir), "driver_key", marts.RIDE_ORDER)


def win_fleet_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    waits = marts.driver_waits(built(spark, sf_dir, "events"))
    fleet = waits.agg(marts.exact_ratio(F.sum("avg_wait"), F.count("avg_wait"))).scalar()
    return waits.select("driver_name", "avg_wait", fleet.alias("fleet_avg_wait"))


def _rides_per_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, "events").fact_rides.groupBy("driver_key").agg(
        F.count("ride_id").alias("n_rides")
    )


def win_rank_family(limit: int | None, spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six global rank functions over ride counts, which tie heavily."""
    return ranking.ranked(
        _rides_per_driver(spark, sf_dir),
        [("n_rides", "desc")],
        [("driver_key", "asc")],
        {
            "row_no": ranking.row_number(),
            "rank_no": ranking.rank(),
            "dense_no": ranking.dense_rank(),
            "pct": F.round(ranking.percent_rank(), 9),
            "cume": F.round(ranking.cume_dist(), 9),
            "tile": ranking.ntile(4),
        },
        limit=limit,
    )


# --- marts and reports ------------------------------------------------------


def _mart(rides: str, function: Callable[..., DataFrame], **arguments: object) -> Query:
    return lambda spark, sf_dir: function(built(spark, sf_dir, rides), **arguments)


def _mart_of_all_drivers(function: Callable[..., DataFrame], **arguments: object) -> Query:
    return lambda spark, sf_dir: function(
        built(spark, sf_dir, "events"), hot=hot_drivers(spark, sf_dir, "events"), **arguments
    )


def _marts(rides: str) -> dict[str, Query]:
    mart = partial(_mart, rides)
    return {
        "driver_daily_utilization": mart(marts.driver_daily_utilization),
        "q1_driver_efficiency": mart(marts.driver_efficiency),
        "q2_peak_hours": mart(marts.peak_hours),
        "q3_vip_customers": mart(marts.vip_customers),
        "q4_leaderboard": mart(marts.leaderboard),
        "q5_revenue_rank": mart(marts.revenue_rank),
        "q6_quality_tiers": mart(marts.quality_tiers),
        "q7_commission": mart(marts.commission),
        "q8_efficiency_quartiles": mart(marts.efficiency_quartiles),
        "q9_value_segments": mart(marts.value_segments),
        "q10_idle_gaps": mart(marts.idle_gaps),
        "q11_progression": mart(marts.progression, driver_names=DRIVER_NAMES),
        "q12_quality_trend": mart(marts.quality_trend),
        "q13_milestones": mart(marts.driver_milestones),
    }


def _variants() -> dict[str, Query]:
    mart = partial(_mart, "events")
    return {
        "driver_key_daily_utilization": mart(marts.driver_daily_utilization, by="driver_key"),
        "q1_by_driver_key": mart(marts.driver_efficiency, by="driver_key", more_rides_than=90),
        "q2_all": mart(marts.peak_hours, limit=None),
        "q3_by_user": mart(marts.vip_customers, by="user_key", limit=None),
        "q4_all": mart(marts.leaderboard, limit=None),
        "q5_all": mart(marts.revenue_rank, limit=None),
        "q6_all": mart(marts.quality_tiers, limit=None),
        "q7_all": mart(marts.commission, limit=None),
        "q8_all": mart(marts.efficiency_quartiles, limit=None),
        "q9_all": mart(marts.value_segments, limit=None),
        "q9_by_user": mart(marts.value_segments, by="user_key", limit=None),
        "q10_100": lambda spark, sf_dir: marts.idle_gaps(
            built(spark, sf_dir, "events"), limit=100
        ).drop("next_ride_start"),
        "q10_all_drivers": _mart_of_all_drivers(marts.idle_gaps, driver_keys=None, limit=None),
        "q11_all_drivers": _mart_of_all_drivers(marts.progression, driver_names=None, limit=None),
        "q11_five_names": mart(marts.progression, driver_names=DRIVER_NAMES, limit=None),
        "q12_all": mart(marts.quality_trend, limit=None),
        "q13_all": mart(marts.driver_milestones, limit=None),
    }


def _reports() -> dict[str, Query]:
    def over(report: Callable[[DataFrame], DataFrame], mart: Callable[..., DataFrame], **arguments):
        return lambda spark, sf_dir: report(mart(built(spark, sf_dir, "events"), **arguments))

    def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _manifest(spark, sf_dir, shared=False)

    def shared_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _manifest(spark, sf_dir, shared=True)

    def _manifest(spark: SparkSession, sf_dir: str, shared: bool) -> DataFrame:
        wh = built(spark, sf_dir, "events")
        catalog = reports.catalog(wh, driver_names=DRIVER_NAMES, shared=shared)
        folder = f"{scratch_dir(spark)}/reports-{uuid.uuid4().hex}"
        return reports.write_reports(catalog, folder)

    return {
        "report_peak_heatmap": over(reports.peak_heatmap, marts.peak_hours),
        "report_peak_heatmap_full": over(reports.peak_heatmap, marts.peak_hours, limit=None),
        "report_peak_labels": over(reports.peak_labels, marts.peak_hours),
        "report_vip_share": over(reports.vip_share, marts.vip_customers),
        "report_tier_counts": over(reports.tier_counts, marts.quality_tiers, limit=None),
        "report_tier_avg": over(reports.tier_averages, marts.quality_tiers, limit=None),
        "report_segment_stats": over(reports.segment_stats, marts.value_segments, limit=None),
        "report_milestone_funnel": over(reports.milestone_funnel, marts.driver_milestones),
        "report_milestone_funnel_full": over(
            reports.milestone_funnel, marts.driver_milestones, limit=None
        ),
        "report_manifest": manifest,
        "report_manifest_shared": shared_manifest,
    }


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {f"csv_{name}": partial(csv_table, name) for name in RAW}
    found |= {
        function.__name__: function
        for function in (
            csv_line_breaks,
            dq_duplicate_keys,
            dq_violations,
            dq_broken_rows,
            dq_text_rows,
            dq_declared_keys,
            dq_references,
            dq_broken_references,
            dq_orphans,
            dq_load_losses,
            dq_broken_losses,
            dq_reasons,
            dim_date,
            dim_user,
            dim_driver,
            upsert_ignore_dim,
            durable_keys,
            distinct_dates,
            mask_pii,
            mask_pii_salted,
            join_inner,
            join_inner_dropping,
            join_computed_key,
            join_left_ratings,
            join_star,
            fact_by_date,
            fact_by_user_date,
            lookup_user,
            lookup_date,
            fact_in_batches,
            daily_in_batches,
            utilization_in_batches,
            ride_uses,
            win_lag_gap,
            win_numbering,
            win_lag_gap_colocated,
            win_numbering_colocated,
            q10_colocated,
            q11_colocated,
            win_partition_values,
            win_null_partition,
            win_nth_value,
            latest_per_driver,
            win_fleet_avg,
        )
    }
    found["fact_rides"] = partial(fact_rides, "events")
    found["orders_fact_rides"] = partial(fact_rides, "orders")
    found["win_rank_family"] = partial(win_rank_family, None)
    found["win_rank_family_top"] = partial(win_rank_family, 25)
    found |= {f"{name}_from_states": partial(from_states, name) for name in _FROM_STATES}
    found |= _marts("events")
    found |= {f"orders_{name}": query for name, query in _marts("orders").items()}
    found |= _variants() | _reports()

    def run(query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(query(spark, sf_dir))

    return {name: partial(run, query) for name, query in found.items()}

"""Loads of the fact in batches: new rides meet stored state, not the stored fact.

The fact is stored in parts: by group of drivers, month of the ride and number of the load
that brought it. Beside it lie states. ``driver_months`` holds the first and the last ride
of each driver and month, which is all that a later ride of the driver needs to know of
earlier ones. ``daily_parts`` holds the sums per driver and date, in whole hundredths;
``driver_states`` and ``user_states`` what the marts per person need, see ``states``.

A load links its rides to that state. Rides later than all of their driver's month are added
and read nothing of the fact. A late ride reads the parts of its driver group and month, and
the one ride after it gets a new gap, in its own part; sums by date change by the signed
difference. Parts without such a ride are neither read nor written.

What a load has computed is stored aside before any part is replaced, and replacing parts
can be repeated. So a load that ended halfway is completed by the next one.
"""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetmart.functions.scalars import minutes_between
from fleetmart.operators import bitmaps
from fleetmart.operators.keys import first_per_key
from fleetmart.operators.scale import (
    DEFAULT,
    HotKeys,
    Limits,
    hot_keys,
    materialize,
    remove,
    shuffled,
    together,
)
from fleetmart.operators.sequence import sequence
from fleetmart.plans import facts, states
from fleetmart.plans.warehouse import Warehouse, load_dimensions
from fleetmart.schemas import STAR
from fleetmart.sources import tables

GROUPS = 64
FACT_PARTS = ["driver_group", "start_month", "load"]
DAILY_PARTS = ["driver_group", "start_month"]
MONTH_PARTS = ["driver_group"]
USER_PARTS = ["user_group"]
_TABLES = {
    "fact_parts": FACT_PARTS,
    "daily_parts": DAILY_PARTS,
    "driver_months": MONTH_PARTS,
    "driver_states": MONTH_PARTS,
    "user_states": USER_PARTS,
}
_SUMS = ["wait100", "waits", "rides", "revenue100", "fares"]


def _group(groups: int, key: str = "driver_key", name: str = "driver_group") -> Column:
    return F.pmod(key, F.lit(groups)).cast("int").alias(name)


def _month(time: str) -> Column:
    return (F.year(time) * 100 + F.month(time)).alias("start_month")


def _part(group: str = "driver_group", month: str = "start_month") -> Column:
    """A group and a month as one number; over partition columns it prunes folders."""
    return F.col(group).cast("bigint") * 1_000_000 + F.col(month)


def _placed(df: DataFrame) -> DataFrame:
    """Rides with ``_place``, one number for driver and month."""
    return df.withColumn("_place", F.col("driver_key") * 1_000_000 + F.col("start_month"))


_LOADS = "load int, groups int, " + ", ".join(f"{name} string" for name in _TABLES)


def _last_load(spark: SparkSession, root: str) -> Row | None:
    """Number of the last load, the groups that the first one has fixed, schemas as JSON."""
    path = f"{root}/loads"
    if not tables.exists(spark, path):
        return None
    return spark.read.schema(_LOADS).parquet(path).orderBy(F.col("load").desc()).first()


def _read(spark: SparkSession, root: str, name: str, last: Row | None) -> DataFrame | None:
    """A stored table under the schema of its last load: no file is opened for it."""
    if last is None:
        return None
    if last[name] is None:
        raise ValueError(f"{root} was loaded before {name} was kept: load it anew")
    schema = StructType.fromJson(json.loads(last[name]))
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def _months_after(batch: DataFrame, stored: DataFrame | None) -> DataFrame:
    """First and last rides by driver and month with ``batch``, and what is to be done there.

    ``kind`` is "add" where the batch only has rides later than the stored ones, "late" where
    it also has earlier ones, null where it has none. ``follows`` marks other months than late
    ones whose stored first ride now has another ride before it. ``before`` is the end of the
    ride before the month's first one, ``was_last`` the stored last ride, ``n_new`` the number
    of rides in the batch.
    """
    place = ["driver_group", "driver_key", "start_month"]
    ride = F.struct("start_time", "ride_id")
    new = batch.groupBy(*place).agg(
        F.min(ride).alias("new_first"),
        F.max(F.struct("start_time", "ride_id", "end_time")).alias("new_last"),
        F.count(F.lit(1)).alias("n_new"),
    )
    if stored is None:
        kinds = {f.name: f.dataType for f in new.schema}
        both = new.withColumn("was_first", F.lit(None).cast(kinds["new_first"])).withColumn(
            "was_last", F.lit(None).cast(kinds["new_last"])
        )
    else:
        touched = new.select("driver_key").distinct()
        old = stored.join(touched, "driver_key", "left_semi").select(
            *place, F.col("first").alias("was_first"), F.col("last").alias("was_last")
        )
        both = new.join(old, place, "full")
    last_ride = lambda name: F.struct(f"{name}.start_time", f"{name}.ride_id")
    is_new, is_old = F.col("new_first").isNotNull(), F.col("was_first").isNotNull()
    later = is_new & (~is_old | (last_ride("new_last") > last_ride("was_last")))
    earlier = is_new & (~is_old | (F.col("new_first") < F.col("was_first")))
    merged = both.select(
        *place,
        F.when(earlier, F.col("new_first")).otherwise(F.col("was_first")).alias("first"),
        F.when(later, F.col("new_last")).otherwise(F.col("was_last")).alias("last"),
        "was_first",
        "was_last",
        "n_new",
        later.alias("moved"),
        F.when(is_new & is_old & (F.col("new_first") <= last_ride("was_last")), "late")
        .when(is_new, "add")
        .alias("kind"),
    )
    months = Window.partitionBy("driver_key").orderBy("start_month")
    moved = F.coalesce(F.lag("moved").over(months), F.lit(False))
    stays = F.col("was_first").isNotNull() & ~F.col("kind").eqNullSafe("late")
    return merged.select(
        "*", F.lag("last.end_time").over(months).alias("before"), (stays & moved).alias("follows")
    )


def _hot_places(counts: DataFrame, limits: Limits) -> HotKeys | None:
    """``hot_keys`` of drivers and months by ``_n``, the number of their rides or an upper bound.

    Rides that come out of joins aren't computed once more to be counted.
    """
    hot = _placed(counts).where(F.col("_n") > limits.hot_rows).select("_place", "_n")
    number, rows = hot.agg(F.count(F.lit(1)), F.sum("_n")).first()
    return HotKeys(materialize(hot, "hot-keys"), number, rows) if number else None


def _linked(
    rides: DataFrame, months: DataFrame, before: Column, hot: HotKeys | None, limits: Limits
) -> DataFrame:
    """``rides`` with ``previous_end``: the ride before, or ``before`` of the driver's month."""
    placed = _placed(rides)
    chained = sequence(
        placed,
        "_place",
        ["start_time", "ride_id"],
        row_number="_number",
        lag={"_end": "end_time"},
        hot=hot,
        limits=limits,
    )
    ends = _placed(months).select("_place", before.alias("_before"))
    return (
        chained.join(ends, "_place")
        .withColumn(
            "previous_end",
            F.when(F.col("_number") == 1, F.col("_before")).otherwise(F.col("_end")),
        )
        .select(*rides.columns, "previous_end")
    )


def _daily_sums(rows: DataFrame, gap: str, sign: int) -> DataFrame:
    """What rides add to the sums per driver and date, or take from them."""
    counted = rows.where(F.col(gap).isNotNull())
    cents = lambda name: F.sum((F.col(name) * 100).cast("bigint"))
    sums = {
        "wait100": cents(gap),
        "waits": F.count(gap),
        "rides": F.count("ride_id"),
        "revenue100": F.coalesce(cents("fare_amount"), F.lit(0)),
        "fares": F.count("fare_amount"),
    }
    return counted.groupBy(*DAILY_PARTS, "driver_key", "start_date_key").agg(
        *[(value * F.lit(sign)).cast("bigint").alias(name) for name, value in sums.items()]
    )


def _listed(df: DataFrame) -> list[int]:
    """The groups and months of ``df``: at most as many as there are folders."""
    return sorted(r[0] for r in df.select(_part().alias("_part")).distinct().collect())


def _together_by(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the rows of a folder of table ``name`` in few tasks, and large ones split.

    Adaptive execution cuts by the sizes it has seen; a range would compute ``df`` twice, once to
    sample it.
    """
    return df.hint("rebalance", *_TABLES[name])


def _staged(root: str) -> str:
    return f"{root}/_load"


def _finish(spark: SparkSession, root: str) -> None:
    """Replace the parts that a computed load has staged; nothing without a staged load."""
    staged = _staged(root)
    if not tables.exists(spark, f"{staged}/ready"):
        return
    for name, parts in _TABLES.items():
        tables.replace_parts(spark.read.parquet(f"{staged}/{name}"), f"{root}/{name}", parts)
    done = spark.read.schema(_LOADS).parquet(f"{staged}/ready")
    last = _last_load(spark, root)
    if last is None or last["load"] < done.first()["load"]:
        done.write.mode("append").parquet(f"{root}/loads")
    remove(spark, staged)


def load_batch(
    raw: dict[str, DataFrame],
    root: str,
    *,
    salt: str | None = None,
    peak_hours: list[int] | None = None,
    groups: int = GROUPS,
    limits: Limits = DEFAULT,
) -> Warehouse:
    """Add a batch of raw rides, with their ratings and new dimension rows, to ``root``.

    The first batch creates the tables; loading batches in any order gives the tables that one
    load of all of them gives. Of rides that share an id in the batch one counts, and a ride
    that is stored already for its driver and month adds nothing, so a batch may come twice.
    Ratings are taken with the rides of their own batch. ``groups`` of drivers are fixed by
    the first load. A load that stopped halfway is completed first.
    """
    spark = raw["rides"].sparkSession
    _finish(spark, root)
    remove(spark, _staged(root))
    (dim_user, dim_driver, dim_date), hot_users = together(
        lambda: load_dimensions(raw, root, salt=salt, limits=limits),
        lambda: hot_keys(raw["rides"], "user_id", limits),
    )
    last = _last_load(spark, root)
    load, groups = (last["load"] + 1, last["groups"]) if last else (1, groups)

    # What grows with the rides or users is shuffled: a broadcast would pass the driver. Ratings
    # meet the rides where copies of an id have met, before any other join moves them.
    ratings = facts.rating_per_ride(raw["ratings"]).hint("merge")
    rated = facts.rated_rides(
        first_per_key(raw["rides"], ["ride_id"]).join(ratings, "ride_id", "left"),
        None,
        shuffled(dim_user),
        shuffled(dim_driver),
        dim_date,
        hot_users=hot_users,
        limits=limits,
    )
    batch = materialize(
        rated.select("*", _group(groups), _month("start_time")), "batch"
    )
    touched = [r[0] for r in batch.select("driver_group").distinct().collect()]
    state = _read(spark, root, "driver_months", last)
    if state is not None:
        state = state.where(F.col("driver_group").isin(touched))
    months = materialize(_months_after(batch, state), "months")
    place = ["driver_key", "start_month"]
    of_kind = lambda kind: months.where(F.col("kind") == kind)

    # Rides that come after all others of their driver and month.
    added = batch.join(of_kind("add"), place, "left_semi").select(*batch.columns)
    last_end = F.when(F.col("was_last").isNotNull(), F.col("was_last.end_time"))
    since = last_end.otherwise(F.col("before"))
    hot = _hot_places(of_kind("add").select(*place, F.col("n_new").alias("_n")), limits)
    fresh = _linked(added, of_kind("add"), since, hot, limits)
    changed = None

    fact = _read(spark, root, "fact_parts", last)
    reread = _listed(months.where("kind = 'late' or follows")) if fact is not None else []
    if reread:
        held = fact.where(_part().isin(reread))
        names = [*batch.columns, "time_to_next_ride_minutes", "load"]
        held_late = held.join(of_kind("late"), place, "left_semi").select(*names)
        late = batch.join(of_kind("late"), place, "left_semi").select(*batch.columns)
        # A ride that is stored already isn't new.
        known = held_late.select("ride_id", *place).hint("merge")
        late = late.join(known, ["ride_id", *place], "left_anti").select(*batch.columns)
        gap = held.schema["time_to_next_ride_minutes"].dataType
        both = held_late.unionByName(
            late.withColumn("time_to_next_ride_minutes", F.lit(None).cast(gap)).withColumn(
                "load", F.lit(None).cast("int")
            )
        )
        held_rides = held.groupBy(*place).agg(F.count(F.lit(1)).alias("n_held"))
        counts = of_kind("late").join(held_rides, place, "left")
        at_most = F.col("n_new") + F.coalesce("n_held", F.lit(0))
        hot = _hot_places(counts.select(*place, at_most.alias("_n")), limits)
        linked = _linked(both, of_kind("late"), F.col("before"), hot, limits)
        relinked = materialize(linked, "relinked")
        fresh = fresh.unionByName(relinked.where("load is null").select(*fresh.columns))
        following = months.where("follows").select(
            *place, F.col("was_first.ride_id").alias("ride_id"), F.col("before").alias("previous_end")
        )
        heads = held.join(following, [*place, "ride_id"]).select(*names, "previous_end")
        gap_now = minutes_between(F.col("previous_end"), F.col("start_time"))
        old = relinked.where("load is not null").unionByName(heads).withColumn("gap", gap_now)
        changed = materialize(
            old.where(~F.col("gap").eqNullSafe(F.col("time_to_next_ride_minutes"))), "changed"
        )

    new = materialize(
        facts.with_measures(fresh, peak_hours)
        .select("*", _group(groups), _month("start_time"), F.lit(load).alias("load")),
        "new-rides",
    )
    deltas = _daily_sums(new, "time_to_next_ride_minutes", 1)
    rewritten = None
    if changed is not None:
        deltas = deltas.unionByName(_daily_sums(changed, "time_to_next_ride_minutes", -1))
        deltas = deltas.unionByName(_daily_sums(changed, "gap", 1))
        whole = [tuple(r) for r in changed.select(*FACT_PARTS).distinct().collect()]
        if whole:
            here = held.where(
                F.struct(*FACT_PARTS).isin([F.struct(*(F.lit(v) for v in w)) for w in whole])
            )
            gaps = changed.select("ride_id", *FACT_PARTS, F.lit(True).alias("_new"), "gap")
            rewritten = here.join(gaps.hint("merge"), ["ride_id", *FACT_PARTS], "left").select(
                *[
                    F.when(F.col("_new"), F.col("gap")).otherwise(F.col(name)).alias(name)
                    if name == "time_to_next_ride_minutes"
                    else F.col(name)
                    for name in new.columns
                ]
            )

    daily = _read(spark, root, "daily_parts", last)
    deltas = materialize(deltas, "deltas")
    sums = deltas
    if daily is not None:
        sums = deltas.unionByName(daily.where(_part().isin(_listed(deltas))).select(*deltas.columns))
    keyed = [*DAILY_PARTS, "driver_key", "start_date_key"]
    merged = sums.groupBy(*keyed).agg(*[F.sum(name).cast("bigint").alias(name) for name in _SUMS])

    kept = months.select("driver_group", "driver_key", "start_month", "first", "last")
    if state is not None:
        others = state.join(months.select("driver_key").distinct(), "driver_key", "left_anti")
        kept = kept.unionByName(others.select(*kept.columns))

    # States of the new rides merge into those of their groups.
    user_group = _group(groups, "user_key", "user_group")
    users = [r[0] for r in new.select(user_group).distinct().collect()]
    of_drivers, of_users = states.driver_states(new), states.user_states(new)
    old_drivers, old_users = (_read(spark, root, n, last) for n in ("driver_states", "user_states"))
    if last is not None:
        old_drivers = old_drivers.where(F.col("driver_group").isin(touched))
        of_drivers = of_drivers.unionByName(old_drivers.select(*of_drivers.columns))
        old_users = old_users.where(F.col("user_group").isin(users))
        of_users = of_users.unionByName(old_users.select(*of_users.columns))
    drivers = states.merged_drivers(of_drivers).select("*", _group(groups))
    users_now = states.merged_users(of_users).select("*", user_group)

    staged = _staged(root)
    rows = new if rewritten is None else rewritten.unionByName(new)
    laid = [*FACT_PARTS, *tables.FACT_ORDER]
    rows = _together_by(rows, "fact_parts").sortWithinPartitions(*laid)
    together(
        lambda: rows.write.parquet(f"{staged}/fact_parts"),
        lambda: _together_by(merged, "daily_parts").write.parquet(f"{staged}/daily_parts"),
        lambda: _together_by(kept, "driver_months").write.parquet(f"{staged}/driver_months"),
        lambda: _together_by(drivers, "driver_states").write.parquet(f"{staged}/driver_states"),
        lambda: _together_by(users_now, "user_states").write.parquet(f"{staged}/user_states"),
    )
    layouts = [df.schema.json() for df in (rows, merged, kept, drivers, users_now)]
    spark.createDataFrame([(load, groups, *layouts)], _LOADS).coalesce(1).write.parquet(f"{staged}/ready")
    _finish(spark, root)
    return open_batches(spark, root)


_COVERED = "version int, load int, n bigint, bits int"


def ride_bitmaps(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """Bitmaps of all stored ride ids below ``root`` and their bits, brought up to the last load.

    Only the ids of loads that came since the last call are read, and set in maps of their own.
    When the places are an eighth full, all ids are set anew in 4 times as many or more.
    """
    last = _last_load(spark, root)
    fact, path = _read(spark, root, "fact_parts", last), f"{root}/ride_bitmaps"
    version, upto, rows, bits = 0, 0, 0, 0
    if tables.exists(spark, f"{path}/covered"):
        covered = spark.read.schema(_COVERED).parquet(f"{path}/covered")
        of_version = covered.groupBy("version").agg(F.max("load"), F.sum("n"), F.max("bits"))
        version, upto, rows, bits = of_version.orderBy(F.col("version").desc()).first()
    old = version
    if version == 0 or upto < last["load"]:
        fresh = fact.where(F.col("load") > upto)
        added = fresh.count()
        if version == 0 or (rows + added) * 8 > 1 << bits:
            version, bits = version + 1, bitmaps.bits_for(rows + added)
            fresh, added = fact, rows + added
        maps = bitmaps.bitmaps(fresh, "ride_id", bits)
        tables.recreate(maps, f"{path}/maps/version={version}/upto={last['load']}")
        now = spark.createDataFrame([(version, last["load"], added, bits)], _COVERED)
        tables.append(now.coalesce(1), f"{path}/covered")
        if old not in (0, version):
            remove(spark, f"{path}/maps/version={old}")
    return spark.read.parquet(f"{path}/maps/version={version}"), bits


def ride_uses(raw_rides: DataFrame, root: str) -> DataFrame:
    """(ride_id, n_batch, n_stored): how often each id of a batch occurs in it and below ``root``.

    To be asked before a load: ids of more than one row, or stored with another driver or month,
    break the key. Bitmaps kept beside the fact say of nearly all new ids that they are new.
    """
    spark = raw_rides.sparkSession
    maps, bits = ride_bitmaps(spark, root)
    fact = _read(spark, root, "fact_parts", _last_load(spark, root))
    return bitmaps.key_uses(
        raw_rides.select("ride_id"), fact, "ride_id", maps, bits, lambda df: materialize(df, "ride-ids")
    )


def daily_rides(parts: DataFrame) -> DataFrame:
    """The stored sums as ``daily_rides`` of a warehouse."""

    def amount(name: str) -> Column:
        return (F.col(name).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")

    return parts.where("rides > 0").select(
        "driver_key",
        "start_date_key",
        F.when(F.col("waits") > 0, amount("wait100")).alias("wait"),
        "waits",
        "rides",
        F.when(F.col("fares") > 0, amount("revenue100")).alias("revenue"),
    )


def open_batches(spark: SparkSession, root: str) -> Warehouse:
    """The warehouse that ``load_batch`` keeps; all marts and reports read it like any other."""
    last = _last_load(spark, root)
    if last is None:
        raise ValueError(f"no load below {root}")
    dims = [
        spark.read.parquet(f"{root}/{name}").select(*STAR[name].names)
        for name in ("dim_user", "dim_driver", "dim_date")
    ]
    fact = _read(spark, root, "fact_parts", last).select(*STAR["fact_rides"].names)
    return Warehouse(
        *dims,
        fact,
        daily_rides(_read(spark, root, "daily_parts", last)),
        _read(spark, root, "driver_states", last),
        _read(spark, root, "user_states", last),
    )

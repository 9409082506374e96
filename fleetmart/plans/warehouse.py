"""Build and refresh of the stored star schema."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.operators import quality
from fleetmart.operators.scale import DEFAULT, Limits, materialize, parts_for, together
from fleetmart.plans import dimensions, facts
from fleetmart.schemas import FOREIGN_KEYS, RAW, RULES, STAR, value_kinds
from fleetmart.sources import tables


@dataclass(frozen=True)
class Warehouse:
    """The stored tables; marts read the states of drivers, users and hours where they are kept."""

    dim_user: DataFrame
    dim_driver: DataFrame
    dim_date: DataFrame
    fact_rides: DataFrame
    daily_rides: DataFrame
    driver_states: DataFrame | None = None
    user_states: DataFrame | None = None
    hour_states: DataFrame | None = None

    def register_views(self) -> None:
        """Make the tables and the daily view available to SQL."""
        from fleetmart.plans.marts import driver_daily_utilization

        for name in ("dim_user", "dim_driver", "dim_date", "fact_rides"):
            getattr(self, name).createOrReplaceTempView(name)
        driver_daily_utilization(self).createOrReplaceTempView("v_driver_daily_utilization")


def stage(raw: dict[str, DataFrame], root: str, rows_per_file: int = 0) -> dict[str, DataFrame]:
    """Store the raw tables as columns, so that the build reads only what it needs.

    For raw text and for raw tables that are themselves the result of a join. ``rows_per_file``
    (no limit if 0) keeps tasks that read narrow tables from getting too many rows.
    """
    stored = together(
        *[
            partial(tables.recreate, df, f"{root}/raw_{name}", rows_per_file)
            for name, df in raw.items()
        ]
    )
    return dict(zip(raw, stored, strict=True))


class LoadRefused(ValueError):
    """The raw tables break rules that a load must not accept."""


def load_report(raw: dict[str, DataFrame]) -> DataFrame:
    """``(check, subject, n_rows)``: rows of the raw tables that break declared rules.

    Repeated keys, NULL keys and other column rules, values without a parent, and rows that
    the fact load leaves out.
    """
    names = [name for name in RAW if name in raw]
    tables_ = {name: raw[name] for name in names}
    keys = quality.declared_keys(tables_, RULES).select(
        F.lit("key").alias("check"),
        F.concat_ws(".", "table_name", "key").alias("subject"),
        "n_rows",
    )
    rules = quality.all_violations(tables_, RULES, {n: value_kinds(RAW[n]) for n in names}).select(
        F.when(F.col("rule") == "not_null", "null").otherwise("value").alias("check"),
        F.concat_ws(" ", F.concat_ws(".", "table_name", "column_name"), "rule").alias("subject"),
        "n_rows",
    )
    links = quality.reference_report(tables_, FOREIGN_KEYS).select(
        F.lit("reference").alias("check"),
        F.concat_ws(".", "child_table", "child_column").alias("subject"),
        "n_rows",
    )
    losses = quality.load_losses(raw["rides"], raw["ratings"], raw["users"], raw["drivers"]).select(
        F.lit("loss").alias("check"), F.col("reason").alias("subject"), "n_rows"
    )
    return keys.unionByName(rules).unionByName(links).unionByName(losses)


def accepted(raw: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """The raw rows that break no declared rule, for ``build`` or a load in batches.

    Every row is stored below ``root`` as ``checked_<table>``, those that break a rule with
    their reasons in folders of their own (rejected=true), where they can be read and mended.
    """
    links = tuple(link for link in FOREIGN_KEYS if link[0] in raw and link[2] in raw)
    out = {}
    for name in (name for name in RAW if name in raw):
        rows = quality.with_reasons(name, raw, RULES[name], links, value_kinds(RAW[name]))
        marked = rows.withColumn("rejected", F.size("reasons") > 0)
        path = f"{root}/checked_{name}"
        marked.write.mode("overwrite").partitionBy("rejected").parquet(path)
        stored = raw[name].sparkSession.read.schema(marked.schema).parquet(path)
        out[name] = stored.where(~F.col("rejected")).select(*raw[name].columns)
    return out


def _registers(spark: SparkSession, root: str, durable_keys: bool) -> list[str | None]:
    """Paths of the key registers of users and drivers, where they are kept or asked for."""
    paths = [f"{root}/key_registers/{name}" for name in ("users", "drivers")]
    return [path if durable_keys or tables.exists(spark, f"{path}/keys") else None for path in paths]


def build_dimensions(
    raw: dict[str, DataFrame],
    root: str,
    *,
    salt: str | None = None,
    durable_keys: bool = False,
    limits: Limits = DEFAULT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop and rebuild dim_user, dim_driver and dim_date, in this order, for ``build``."""
    of_users, of_drivers = _registers(raw["users"].sparkSession, root, durable_keys)
    dim_user, dim_driver, dim_date = together(
        lambda: tables.recreate(
            dimensions.new_users(raw["users"], salt=salt, register=of_users, limits=limits),
            f"{root}/dim_user",
        ),
        lambda: tables.recreate(
            dimensions.new_drivers(raw["drivers"], raw["vehicles"], register=of_drivers, limits=limits),
            f"{root}/dim_driver",
        ),
        lambda: tables.recreate(dimensions.new_dates(raw["rides"]), f"{root}/dim_date"),
    )
    return dim_user, dim_driver, dim_date


def build(
    raw: dict[str, DataFrame],
    root: str,
    *,
    checks: str = "report",
    salt: str | None = None,
    peak_hours: list[int] | None = None,
    durable_keys: bool = False,
    limits: Limits = DEFAULT,
) -> Warehouse:
    """Drop and rebuild all tables under ``root``.

    With ``durable_keys`` users and drivers take their keys from registers below ``root``, which
    no build drops: an id keeps its key whatever ids come or go. They are used from then on, by
    later builds and refreshes as well. Without, keys follow the order of the ids.

    ``checks="report"`` stores ``load_report`` beside the tables and loads all the same;
    ``"fail"`` stores it first and raises ``LoadRefused`` where a key is repeated or NULL;
    ``"none"`` runs no check. Dimensions are stored first: their keys are allocated once,
    and the fact then joins tables of known size.
    """
    if checks not in ("report", "fail", "none"):
        raise ValueError(f"checks must be report, fail or none, got {checks!r}")
    report = lambda: tables.recreate(load_report(raw), f"{root}/load_report")
    if checks == "fail":
        broken = report().where("n_rows > 0 and check in ('key', 'null')")
        found = [f"{r.check} {r.subject}: {r.n_rows}" for r in broken.orderBy("subject").take(20)]
        if found:
            raise LoadRefused("; ".join(found))
    made = together(
        lambda: build_dimensions(raw, root, salt=salt, durable_keys=durable_keys, limits=limits),
        *([report] if checks == "report" else []),
    )
    dim_user, dim_driver, dim_date = made[0]
    fact = facts.fact_rides(
        raw["rides"],
        raw["ratings"],
        dim_user,
        dim_driver,
        dim_date,
        peak_hours=peak_hours,
        limits=limits,
    )
    stored = tables.write_fact(fact, f"{root}/fact_rides")
    parts = parts_for(stored.sparkSession, stored.count(), limits)
    daily = tables.recreate(facts.daily_rides(stored, parts), f"{root}/daily_rides")
    return Warehouse(dim_user, dim_driver, dim_date, stored, daily)


_TABLES = ("dim_user", "dim_driver", "dim_date", "fact_rides", "daily_rides")


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    return Warehouse(*[tables.load(spark, f"{root}/{name}", STAR[name]) for name in _TABLES])


def load_dimensions(
    raw: dict[str, DataFrame],
    root: str,
    *,
    salt: str | None = None,
    limits: Limits = DEFAULT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Append to the stored dimensions, if any, what is new in ``raw``; a second run adds nothing.

    Returns dim_user, dim_driver and dim_date. New rows are computed and written aside before
    any table is appended to, so no table is read and written by the same job. ``salt`` must
    be that of the first load.
    """
    spark = raw["users"].sparkSession

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}").select(*STAR[name].names)

    def old(name: str) -> DataFrame | None:
        return stored(name) if tables.exists(spark, f"{root}/{name}") else None

    of_users, of_drivers = _registers(spark, root, durable_keys=False)
    # Keys are allocated by jobs of their own, which run side by side too.
    fresh = {
        "dim_date": lambda: dimensions.new_dates(raw["rides"], old("dim_date")),
        "dim_user": lambda: dimensions.new_users(
            raw["users"], old("dim_user"), salt=salt, register=of_users, limits=limits
        ),
        "dim_driver": lambda: dimensions.new_drivers(
            raw["drivers"], raw["vehicles"], old("dim_driver"), register=of_drivers, limits=limits
        ),
    }
    aside = together(
        *[lambda new=new, name=name: materialize(new(), f"new-{name}") for name, new in fresh.items()]
    )
    for name, df in zip(fresh, aside, strict=True):
        tables.append(df, f"{root}/{name}")
    return stored("dim_user"), stored("dim_driver"), stored("dim_date")


def refresh_dimensions(
    raw: dict[str, DataFrame],
    root: str,
    *,
    salt: str | None = None,
    limits: Limits = DEFAULT,
) -> Warehouse:
    """``load_dimensions`` for a warehouse that ``build`` stored; its fact stays as it is."""
    load_dimensions(raw, root, salt=salt, limits=limits)
    return open_warehouse(raw["users"].sparkSession, root)

"""Surrogate keys and insert-if-absent loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.operators import ranking
from fleetmart.operators.scale import DEFAULT, Limits, shuffled


def first_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the least by ``order``, then by all other columns.

    An aggregate, so copies of one key collapse before the shuffle.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    by = F.struct(*(order or []), *[name for name in others if name not in (order or [])])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*others), by).alias("_row"))
        .select(*[F.col(name) if name in keys else F.col(f"_row.{name}") for name in df.columns])
    )


def with_surrogate_key(
    df: DataFrame,
    key: str,
    natural: str,
    *,
    start: int = 1,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``df`` with ``key`` = start, start+1, … in order of the natural key; runs jobs.

    Text ids that are numbers are ordered as numbers (1, 2, 10); the rest follow
    in binary order.
    """
    if df.schema[natural].dataType.typeName() == "string":
        numbered = df.withColumn("_number", F.col(natural).try_cast("decimal(38,0)"))
        order = [("_number", "asc"), (natural, "asc")]
    else:
        numbered, order = df, [(natural, "asc")]
    keyed = ranking.ranked(
        numbered,
        order,
        [],
        {key: ranking.row_number() + F.lit(start - 1)},
        limits=limits,
    )
    return keyed.select(key, *df.columns)


def insert_if_absent(
    target: DataFrame | None,
    incoming: DataFrame,
    key: str,
    natural: str,
    order: list[str] | None = None,
    *,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Rows to append to ``target``: incoming rows whose natural key is new; runs jobs.

    Known keys are dropped first, so only new rows are compared. Existing rows are never changed. Among incoming copies the first by ``order``
    wins. New keys continue after the largest existing one. NULL natural keys
    cannot be loaded and are left out.
    """
    fresh, start = incoming.where(F.col(natural).isNotNull()), 1
    if target is not None:
        known = shuffled(target).select(natural)
        fresh = fresh.join(known, natural, "left_anti").select(*fresh.columns)
        start = (target.agg(F.max(key)).first()[0] or 0) + 1
    return with_surrogate_key(
        first_per_key(fresh, [natural], order), key, natural, start=start, limits=limits
    )

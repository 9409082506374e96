"""Joins of a large table to a table that is unique on the join key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fleetmart.operators.scale import DEFAULT, HotKeys, Limits

_SALT, _ROWS, _HASH, _KIND = "_salt", "_n", "_hash", "_kind"
# Partitions of a layout whose narrow pairs fill one task.
_NARROW = 4


def join_unique(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    *,
    spread_by: str | None = None,
    hot: HotKeys | None = None,
    parts: int | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``left`` joined to ``right`` (unique on ``key``), inner or left outer.

    Spark decides between broadcast and shuffle by the sizes it knows or measures. Where
    it shuffles, adaptive execution splits uneven partitions. ``hot`` (from ``hot_keys``)
    spreads known hot keys beforehand: each over as many salts as its own number of rows
    needs, taken from ``spread_by`` (a column with many values), and only its one right row
    is repeated that often. NULL keys of an outer join match nothing, so with ``spread_by``
    their salt is a whole hash and they go everywhere. With ``parts`` nothing is broadcast: both
    sides are shuffled into so many partitions, whose sorts fit their tasks. Adaptive execution
    doesn't split those, so hot keys must be known. Nothing runs here.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    if hot is not None and spread_by is None:
        raise ValueError("hot keys need a column to spread them by")

    def joined(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
        if parts is not None:
            left, right = left.repartition(parts, *by), right.repartition(parts, *by).hint("merge")
        return left.join(right, by, how)

    if spread_by is None or (hot is None and how == "inner"):
        return joined(left, right, [key])

    everywhere = F.xxhash64(spread_by)
    # Always 0, but not a literal: Catalyst would take that out of the join keys.
    zero = F.pmod(F.xxhash64(key), F.lit(1).cast("bigint"))
    salt = F.lit(0).cast("bigint")
    dimension = right.withColumn(_SALT, zero)
    if hot is not None:
        copies = F.ceil(F.col(_ROWS) / limits.hot_rows).cast("bigint")
        left = left.join(hot.flags, key, "left")
        salt = F.when(F.col(_ROWS).isNotNull(), F.pmod(everywhere, copies)).otherwise(salt)
        salts = F.sequence(F.lit(0).cast("bigint"), F.coalesce(copies, F.lit(1)) - 1)
        dimension = (
            right.join(hot.flags, key, "left").withColumn(_SALT, F.explode(salts)).drop(_ROWS)
        )
    fact = left.withColumn(_SALT, F.when(F.col(key).isNull(), everywhere).otherwise(salt))
    return joined(fact.drop(_ROWS), dimension, [key, _SALT]).drop(_SALT)


def meet(
    source: DataFrame,
    right: DataFrame,
    key: str,
    near: str,
    parts: int,
    *,
    unique: Callable[[DataFrame, list[str]], DataFrame] | None = None,
    hot: HotKeys | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """(``near``, ``key``, columns of ``right``) for the pairs of ``source``, for ``bring_near``.

    Only the two columns of ``source`` are shuffled, text keys as hashes, so that there may be
    pairs of keys that hash alike as well. Pairs may repeat; those with a NULL are left out.
    ``unique`` makes one row per key (the columns it is given) of a ``right`` that isn't unique,
    in the parts where it is joined, so that it is shuffled once. ``hot`` needs a unique one.
    """
    if hot is not None and unique is not None:
        raise ValueError("hot keys need a right side that is unique")
    asked = source.select(key, near).where(F.col(key).isNotNull() & F.col(near).isNotNull())
    if hot is not None:
        met = join_unique(asked, right, key, spread_by=near, hot=hot, limits=limits)
    else:
        by, few = key, -(-parts // _NARROW)
        if source.schema[key].dataType == right.schema[key].dataType == StringType():
            by = _HASH
            asked = asked.select(F.xxhash64(key).alias(by), near)
            right = right.withColumn(by, F.xxhash64(key))
        right = right.repartition(few, by)
        if unique is not None:
            right = unique(right, list(dict.fromkeys([by, key])))
        met = asked.repartition(few, by).join(right.hint("merge"), by)
    return met.select(near, key, *[name for name in right.columns if name not in (key, _HASH)])


def bring_near(
    left: DataFrame, near: str, parts: int, met: dict[str, DataFrame]
) -> DataFrame:
    """``left`` in ``parts`` by ``near``, with the columns of frames that ``meet`` gave, by key.

    A left join that shuffles wide rows once, however many frames there are: what has met comes
    as rows beside them into the part of ``near``, and a running window hands its values over.
    """
    rows = left.withColumn(_KIND, F.lit(0))
    for kind, found in enumerate(met.values(), 1):
        rows = rows.unionByName(found.withColumn(_KIND, F.lit(-kind)), allowMissingColumns=True)
    rows = rows.repartition(parts, near)
    for kind, (key, found) in enumerate(met.items(), 1):
        window = Window.partitionBy(near, key).orderBy(_KIND)
        so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        given = [name for name in found.columns if name not in (near, key)]
        kept = [name for name in rows.columns if name not in given]
        values = [F.last(name, ignorenulls=True).over(so_far).alias(name) for name in given]
        rows = rows.select(*kept, *values).where(F.col(_KIND) != -kind)
    return rows.drop(_KIND)

"""Ranks over a whole table (no PARTITION BY) without one task sorting it all.

Two forms, chosen by the caller and not by size:

* with a ``limit``, the first rows are found by a distributed top-k and only they
  are ranked; what depends on the rest (row count, ties at the cut) is a scalar.
  Nothing runs before the result is read.
* without one, the frame is written once, range-partitioned by the order, ranked inside
  each part, and shifted by the parts' totals (a row a part, which the driver adds up);
  these jobs run at once. Equal values may span parts, so a value that a third of all rows
  share is split too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from fleetmart.operators.scale import (
    DEFAULT,
    Limits,
    materialize,
    sort_columns,
)

_POSITION, _BELOW, _UPTO, _ORDINAL, _TOTAL = "_position", "_below", "_upto", "_ordinal", "_total"
_PART = "_part"


def row_number() -> Column:
    return F.col(_POSITION)


def rank() -> Column:
    return F.col(_BELOW) + 1


def dense_rank() -> Column:
    return F.col(_ORDINAL)


def percent_rank() -> Column:
    share = F.col(_BELOW).cast("double") / F.nullif(F.col(_TOTAL) - 1, F.lit(0))
    return F.coalesce(share, F.lit(0.0))


def cume_dist() -> Column:
    return F.col(_UPTO).cast("double") / F.col(_TOTAL)


def ntile(buckets: int) -> Column:
    position, total = F.col(_POSITION), F.col(_TOTAL)
    size = F.floor(total / F.lit(buckets))
    larger = total - size * buckets
    in_larger = larger * (size + 1)
    return F.when(
        position <= in_larger, F.floor((position - 1) / (size + 1)) + 1
    ).otherwise(larger + F.floor((position - in_larger - 1) / F.nullif(size, F.lit(0))) + 1)


def ranked(
    df: DataFrame,
    order: list[tuple[str, str]],
    tie: list[tuple[str, str]],
    columns: dict[str, Column],
    *,
    limit: int | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``df`` plus rank ``columns`` (built from the functions of this module).

    ``order`` decides rank and ties; ``order + tie`` must be total and decides
    row numbers, tiles and which rows a ``limit`` keeps. Without a ``limit`` this runs
    jobs and stores the parts.
    """
    if limit is not None:
        placed = _place_top(df, order, tie, limit)
    else:
        placed = _place_parts(df, order, tie, limits)
    return placed.select(*df.columns, *[value.alias(name) for name, value in columns.items()])


def _place_window(
    df: DataFrame, order: list[tuple[str, str]], tie: list[tuple[str, str]]
) -> DataFrame:
    by_value = Window.orderBy(*sort_columns(order))
    by_row = Window.orderBy(*sort_columns(order + tie))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        "*",
        F.row_number().over(by_row).cast("bigint").alias(_POSITION),
        (F.rank().over(by_value).cast("bigint") - 1).alias(_BELOW),
        F.dense_rank().over(by_value).cast("bigint").alias(_ORDINAL),
        F.count(F.lit(1)).over(by_value).alias(_UPTO),
        F.count(F.lit(1)).over(everything).alias(_TOTAL),
    )


def _not_after(order: list[tuple[str, str]]) -> Column:
    """True where a row sorts no later than the row held in ``_cut``."""
    result: Column = F.lit(True)
    for name, direction in reversed(order):
        value, cut = F.col(name), F.col("_cut").getField(name)
        same = value.eqNullSafe(cut)
        if direction == "asc":
            sooner = F.coalesce(value < cut, value.isNotNull() & cut.isNull())
        else:
            sooner = F.coalesce(value > cut, value.isNull() & cut.isNotNull())
        result = sooner | (same & result)
    return result


def _place_top(
    df: DataFrame,
    order: list[tuple[str, str]],
    tie: list[tuple[str, str]],
    limit: int,
) -> DataFrame:
    top = df.orderBy(*sort_columns(order + tie)).limit(limit)
    placed = _place_window(top, order, tie).drop(_TOTAL, _UPTO)
    by_value = Window.orderBy(*sort_columns(order))
    cut = (
        top.select(F.struct(*[name for name, _ in order]).alias("_cut"), *df.columns)
        .withColumn("_place", F.row_number().over(Window.orderBy(*sort_columns(order + tie))))
        .agg(F.max_by("_cut", "_place"))
        .scalar()
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    through = (
        df.select(*[name for name, _ in order])
        .withColumn("_cut", cut)
        .where(_not_after(order))
        .agg(F.count(F.lit(1)))
        .scalar()
    )
    at_cut = F.col(_ORDINAL) == F.max(_ORDINAL).over(
        Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return placed.select(
        "*",
        total.alias(_TOTAL),
        F.when(at_cut, through)
        .otherwise(F.count(F.lit(1)).over(by_value))
        .alias(_UPTO),
    )


def _place_parts(
    df: DataFrame,
    order: list[tuple[str, str]],
    tie: list[tuple[str, str]],
    limits: Limits,
) -> DataFrame:
    """Ranks within the parts of one written range exchange, shifted by the parts' totals."""
    names = [name for name, _ in order]
    full = sort_columns(order + tie)
    number = [] if limits.range_parts is None else [limits.range_parts]
    parted = materialize(
        df.repartitionByRange(*number, *full).withColumn(_PART, F.spark_partition_id()), "parts"
    )
    by_value = Window.partitionBy(_PART).orderBy(*sort_columns(order))
    by_row = Window.partitionBy(_PART).orderBy(*full)
    local = parted.select(
        "*",
        F.row_number().over(by_row).cast("bigint").alias("_row"),
        F.rank().over(by_value).cast("bigint").alias("_rank"),
        F.dense_rank().over(by_value).cast("bigint").alias("_dense"),
        F.count(F.lit(1)).over(by_value).alias("_peers"),
    )
    value = F.struct(*names)
    totals = local.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("_dense").alias("values"),
        F.min_by(value, "_row").alias("low"),
        F.max_by(value, "_row").alias("high"),
        F.min("_peers").alias("low_upto"),
        F.max("_rank").alias("high_rank"),
    )
    found = totals.collect()  # a row for each part
    shifts = df.sparkSession.createDataFrame(_shifts(found), _SHIFTS)
    return local.join(F.broadcast(shifts), _PART).select(
        *df.columns,
        (F.col("_before") + F.col("_row")).alias(_POSITION),
        F.when(F.col("_dense") == 1, F.col("_low_start"))
        .otherwise(F.col("_before") + F.col("_rank") - 1)
        .alias(_BELOW),
        F.when(F.col("_dense") == F.col("_values"), F.col("_high_stop"))
        .otherwise(F.col("_before") + F.col("_peers"))
        .alias(_UPTO),
        (F.col("_ordinals") + F.col("_dense")).alias(_ORDINAL),
        F.lit(sum(part["rows"] for part in found)).cast("bigint").alias(_TOTAL),
    )


_SHIFTS = (
    f"{_PART} int, _before bigint, _ordinals bigint, _values bigint, "
    "_low_start bigint, _high_stop bigint"
)


def _same(left: Row, right: Row) -> bool:
    """Equal in every column; NULLs, and NaNs, are alike."""
    return all(a == b or (a != a and b != b) for a, b in zip(left, right, strict=True))


def _shifts(parts: list[Row]) -> list[tuple[int, ...]]:
    """What to add to the ranks of each part, from the totals of all parts.

    A value may end one part and begin the next, or fill several: its rows count once as a
    value, and its start and end are those of the whole run.
    """
    parts = sorted(parts, key=lambda part: part[_PART])
    before, ordinals, low_start = [], [], []
    position = distinct = 0
    high_start = 0
    for k, part in enumerate(parts):
        again = k > 0 and _same(part["low"], parts[k - 1]["high"])
        before.append(position)
        ordinals.append(distinct - again)
        low_start.append(high_start if again else position)
        high_start = low_start[k] if part["values"] == 1 else position + part["high_rank"] - 1
        position += part["rows"]
        distinct += part["values"] - again
    high_stop = [0] * len(parts)
    low_stop = 0
    for k in reversed(range(len(parts))):
        part = parts[k]
        goes_on = k + 1 < len(parts) and _same(part["high"], parts[k + 1]["low"])
        high_stop[k] = low_stop if goes_on else before[k] + part["rows"]
        low_stop = high_stop[k] if part["values"] == 1 else before[k] + part["low_upto"]
    return [
        (part[_PART], before[k], ordinals[k], part["values"], low_start[k], high_stop[k])
        for k, part in enumerate(parts)
    ]

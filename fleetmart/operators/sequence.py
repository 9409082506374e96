"""Row-to-row values along an ordered sequence: LAG, LEAD, ROW_NUMBER, FIRST_VALUE.

The plain form is one window per key. A key that holds too many rows for one
task is cut into ordered segments instead: its rows are range-partitioned by the
sequence order, each segment computes its own window, and a small table with one
row per (key, segment) carries the values across segment edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fleetmart.operators.scale import DEFAULT, HotKeys, Limits, materialize, tasks_for

_SEGMENT = "_segment"


def window_columns(
    window: WindowSpec,
    row_number: str | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    first: dict[str, str] | None = None,
) -> dict[str, Column]:
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns: dict[str, Column] = {}
    if row_number:
        columns[row_number] = F.row_number().over(window).cast("bigint")
    for name, source in (lag or {}).items():
        columns[name] = F.lag(source).over(window)
    for name, source in (lead or {}).items():
        columns[name] = F.lead(source).over(window)
    for name, source in (first or {}).items():
        # The first value is the same in a running frame, which does not buffer.
        columns[name] = F.first(source).over(so_far)
    return columns


def _append(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select("*", *[value.alias(name) for name, value in columns.items()])


def sequence(
    df: DataFrame,
    key: str,
    order: list[str],
    *,
    row_number: str | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    first: dict[str, str] | None = None,
    hot: HotKeys | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``df`` plus sequence columns over ``key`` ordered by ``order``.

    ``lag``, ``lead`` and ``first`` map output names to source columns. ``order``
    must be total within a key, so end it with a unique column. The keys in ``hot``
    (from ``hot_keys``) are cut into segments, which runs jobs; without it nothing runs.
    """
    wanted = {"row_number": row_number, "lag": lag, "lead": lead, "first": first}
    window = Window.partitionBy(key).orderBy(*order)
    if hot is None:
        return _append(df, window_columns(window, **wanted))

    flags = hot.flags
    rest = df.join(flags, key, "left_anti").select(*df.columns)
    plain = _append(rest, window_columns(window, **wanted))
    large = df.join(flags, key, "left_semi").select(*df.columns)
    split = split_sequence(large, key, order, hot.rows, **wanted, limits=limits)
    return plain.unionByName(split)


def split_sequence(
    df: DataFrame,
    key: str,
    order: list[str],
    rows: int,
    *,
    row_number: str | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    first: dict[str, str] | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``sequence`` for a frame of about ``rows`` rows that all belong to hot keys."""
    lag, lead, first = lag or {}, lead or {}, first or {}
    tasks = tasks_for(rows, limits)
    # Segment ids must not change between the two readers, hence the written table.
    segmented = materialize(
        df.repartitionByRange(tasks, key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn(_SEGMENT, F.spark_partition_id()),
        "segments",
    )

    position = F.struct(*order)
    head = F.struct(*sorted({*lead.values(), *first.values()}), F.lit(0).alias("_"))
    tail = F.struct(*sorted(set(lag.values())), F.lit(0).alias("_"))
    along = Window.partitionBy(key).orderBy(_SEGMENT)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per (key, segment): at most segments + hot keys rows in all.
    edges = (
        segmented.groupBy(key, _SEGMENT)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min_by(head, position).alias("_head"),
            F.max_by(tail, position).alias("_tail"),
        )
        .select(
            key,
            _SEGMENT,
            "_rows",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.lag("_tail").over(along).alias("_prior"),
            F.lead("_head").over(along).alias("_next"),
            F.first("_head").over(so_far).alias("_first"),
        )
    )

    window = Window.partitionBy(key, _SEGMENT).orderBy(*order)
    local = _append(segmented, window_columns(window, "_local", lag, lead))
    joined = local.join(edges, [key, _SEGMENT])
    starts, ends = F.col("_local") == 1, F.col("_local") == F.col("_rows")
    result = {}
    if row_number:
        result[row_number] = F.col("_before") + F.col("_local")
    for name, source in lag.items():
        result[name] = F.when(starts, F.col(f"_prior.{source}")).otherwise(F.col(name))
    for name, source in lead.items():
        result[name] = F.when(ends, F.col(f"_next.{source}")).otherwise(F.col(name))
    for name, source in first.items():
        result[name] = F.col(f"_first.{source}")
    return joined.select(*df.columns, *[value.alias(name) for name, value in result.items()])


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key. Catalyst drops all other rows before the shuffle."""
    window = Window.partitionBy(key).orderBy(*[F.col(name).desc() for name in order])
    return df.withColumn("_n", F.row_number().over(window)).where(F.col("_n") == 1).drop("_n")


def with_group_values(
    df: DataFrame,
    key: str,
    columns: dict[str, Column],
) -> DataFrame:
    """``df`` plus one aggregate value per group on each of its rows.

    Gives what a window over a whole partition gives (COUNT, AVG, LAST_VALUE …), for the
    NULL key too, without holding a partition in one task: the groups are aggregated with
    map-side combine and joined back null-safe. That join has keys of its own, so both its
    sides are shuffled for it and adaptive execution may split a large group.
    """
    groups = df.groupBy(F.col(key).alias("_key")).agg(
        *[value.alias(name) for name, value in columns.items()]
    )
    joined = df.join(groups, F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(*df.columns, *columns)


def last_value(column: str, order: list[str]) -> Column:
    """For ``with_group_values``: the value in the last row of the group."""
    return F.max_by(column, F.struct(*order))

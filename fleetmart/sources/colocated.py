"""The fact stored by driver, so that sequences along a driver read it without a shuffle.

Drivers that fit a task lie in a bucketed catalog table: all rides of one in one bucket, in
time order. Catalyst knows the buckets, and a window per driver needs no exchange above the
scan. Hot drivers are kept apart, cut into segments by time. A segment is the unit of their
table's buckets, and what a neighbouring segment must know of it, its first and last row and
its number of rows, is stored once beside them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from fleetmart.operators.scale import (
    BROADCAST_KEYS,
    DEFAULT,
    HotKeys,
    Limits,
    hot_keys,
    materialize,
    tasks_for,
)
from fleetmart.operators.sequence import window_columns
from fleetmart.sources.tables import FACT_ORDER

# Spark refuses tables of more buckets than this (spark.sql.sources.bucketing.maxBuckets).
MOST_BUCKETS = 100_000
_KEY, _TIME = FACT_ORDER[0], FACT_ORDER[1:]
_SEGMENT = "segment"
# A segment's number is its driver's times this, plus the range that it lies in.
_RANGES = 1 << 24


@dataclass(frozen=True)
class Colocated:
    """Rides by driver: ``rest`` in buckets, ``hot`` and ``edges`` by segment (None: no driver
    is hot), ``keys`` the hot drivers."""

    rest: DataFrame
    hot: DataFrame | None
    edges: DataFrame | None
    keys: HotKeys | None

    def where(self, condition: Column) -> Colocated:
        """Only the drivers that meet a condition on ``driver_key``."""
        return self._each(lambda df: df.where(condition))

    def of_drivers(self, drivers: DataFrame) -> Colocated:
        """Only the drivers in ``drivers`` (driver_key)."""
        return self._each(lambda df: df.join(drivers, _KEY, "left_semi").select(*df.columns))

    def _each(self, change: Callable[[DataFrame], DataFrame]) -> Colocated:
        if self.hot is None:
            return replace(self, rest=change(self.rest))
        return replace(self, rest=change(self.rest), hot=change(self.hot))

    def sequence(
        self,
        columns: list[str],
        *,
        row_number: str | None = None,
        lag: dict[str, str] | None = None,
        lead: dict[str, str] | None = None,
        first: dict[str, str] | None = None,
    ) -> DataFrame:
        """``columns`` of all rides plus what ``operators.sequence`` gives by driver and time.

        Values that cross an edge between segments come from the stored edges, one row a
        segment; they meet the rides by segment, which is how those are stored.
        """
        lag, lead, first = lag or {}, lead or {}, first or {}
        needed = [*dict.fromkeys([*columns, *FACT_ORDER, *lag.values(), *lead.values(), *first.values()])]
        made = [*([row_number] if row_number else []), *lag, *lead, *first]
        along = Window.partitionBy(_KEY).orderBy(*_TIME)
        wanted = window_columns(along, row_number, lag, lead, first)
        plain = self.rest.select(*needed).select(
            *columns, *[value.alias(name) for name, value in wanted.items()]
        )
        if self.hot is None:
            return plain
        within = Window.partitionBy(_SEGMENT).orderBy(*_TIME)
        local = window_columns(within, "_local", lag, lead)
        rides = self.hot.select(*needed, _SEGMENT).select(
            "*", *[value.alias(name) for name, value in local.items()]
        )
        joined = rides.join(self.edges.drop(_KEY), _SEGMENT)
        starts, ends = F.col("_local") == 1, F.col("_local") == F.col("rows")
        result = {name: F.col(name) for name in made if name in local}
        if row_number:
            result[row_number] = F.col("rows_before") + F.col("_local")
        for name, source in lag.items():
            result[name] = F.when(starts, F.col(f"prior.{source}")).otherwise(F.col(name))
        for name, source in lead.items():
            result[name] = F.when(ends, F.col(f"next.{source}")).otherwise(F.col(name))
        for name, source in first.items():
            result[name] = F.col(f"opening.{source}")
        return plain.unionByName(
            joined.select(*columns, *[value.alias(name) for name, value in result.items()])
        )


def _table(path: str, name: str) -> str:
    return f"fleet_{name}_{hashlib.md5(path.encode()).hexdigest()}"


def _write(df: DataFrame, path: str, name: str, by: str, buckets: int, order: list[str]) -> None:
    """One sorted file a bucket: rows are hashed as the buckets are, so a task writes one."""
    spark, table = df.sparkSession, _table(path, name)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        df.repartition(buckets, by)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .bucketBy(buckets, by)
        .sortBy(*order)
        .option("path", f"{path}/{name}")
        .saveAsTable(table)
    )


def _open(spark: SparkSession, path: str, name: str, by: str, buckets: int, schema: StructType) -> DataFrame:
    """The stored table; a catalog that doesn't know it yet is told where it lies."""
    table = _table(path, name)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet "
            f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}/{name}'"
        )
    return spark.table(table)


def write_colocated(
    fact: DataFrame, path: str, *, buckets: int | None = None, limits: Limits = DEFAULT
) -> Colocated:
    """Store ``fact`` below ``path`` by driver; what lies there is replaced.

    ``fact`` must not read from there. ``buckets`` is taken from the number of rows where it
    is None: as many as ``limits.hot_rows`` rows fill, but no more than a table may have.
    """
    spark = fact.sparkSession
    hot = hot_keys(fact, _KEY, limits)
    rest = fact if hot is None else fact.join(hot.flags, _KEY, "left_anti").select(*fact.columns)
    if buckets is None:
        total = fact.count() - (hot.rows if hot else 0)
        buckets = min(MOST_BUCKETS, tasks_for(total, limits))
    _write(rest, path, "rest", _KEY, buckets, FACT_ORDER)
    about = {"schema": fact.schema.json(), "buckets": buckets, "ranges": 0, "number": 0, "rows": 0}
    if hot is not None:
        ranges = min(_RANGES - 1, tasks_for(hot.rows, limits))
        large = fact.join(hot.flags, _KEY, "left_semi").select(*fact.columns)
        # Range numbers must not change between two readers, hence the written table.
        cut = materialize(
            large.repartitionByRange(ranges, *FACT_ORDER).select(
                "*",
                (F.col(_KEY).cast("bigint") * _RANGES + F.spark_partition_id()).alias(_SEGMENT),
            ),
            "ranges",
        )
        about |= {"ranges": ranges, "number": hot.number, "rows": hot.rows}
        _write(cut, path, "hot", _SEGMENT, min(MOST_BUCKETS, ranges), [_SEGMENT, *_TIME])
        _edges(cut).write.mode("overwrite").parquet(f"{path}/edges")
        hot.counts.write.mode("overwrite").parquet(f"{path}/keys")
    spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/about")
    return open_colocated(spark, path)


def _edges(cut: DataFrame) -> DataFrame:
    """One row a segment: its rows and those before it, the row before and after it, and the
    first row of its driver."""
    names = [name for name in cut.columns if name != _SEGMENT]
    row, position = F.struct(*names), F.struct(*_TIME)
    along = Window.partitionBy(_KEY).orderBy(_SEGMENT)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        cut.groupBy(_KEY, _SEGMENT)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min_by(row, position).alias("head"),
            F.max_by(row, position).alias("tail"),
        )
        .select(
            _KEY,
            _SEGMENT,
            "rows",
            (F.sum("rows").over(so_far) - F.col("rows")).alias("rows_before"),
            F.lag("tail").over(along).alias("prior"),
            F.lead("head").over(along).alias("next"),
            F.first("head").over(so_far).alias("opening"),
        )
    )


def open_colocated(spark: SparkSession, path: str) -> Colocated:
    """What ``write_colocated`` has stored below ``path``, also by another session."""
    about = json.loads(spark.read.parquet(f"{path}/about").first()[0])
    schema = StructType.fromJson(json.loads(about["schema"]))
    rest = _open(spark, path, "rest", _KEY, about["buckets"], schema)
    if not about["number"]:
        return Colocated(rest, None, None, None)
    by_segment = StructType([*schema.fields]).add(_SEGMENT, LongType())
    hot = _open(spark, path, "hot", _SEGMENT, min(MOST_BUCKETS, about["ranges"]), by_segment)
    edges = spark.read.parquet(f"{path}/edges")
    # At most a segment for each range and one more for each driver, of three rides each.
    if about["number"] + about["ranges"] <= BROADCAST_KEYS // 16:
        edges = F.broadcast(edges)
    keys = HotKeys(spark.read.parquet(f"{path}/keys"), about["number"], about["rows"])
    return Colocated(rest, hot, edges, keys)

"""Key registers: which number each natural id has, for good.

A register is a folder of (id, key) rows that is only appended to, and beside it the blocks of
numbers that loads have reserved. Ids that are new get the next numbers: every task that writes
some of them holds a range of the reserved block, so nothing is sorted. Tables that take their
keys from it can be dropped and rebuilt from other raw rows, and every id keeps its key.

A block is reserved before rows that use it are written. After a load that stopped halfway the
ids written have their keys, the others get numbers of a later block. One load at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetmart.operators.keys import first_per_key
from fleetmart.operators.scale import materialize
from fleetmart.sources import tables

_BLOCKS = "first bigint, n bigint"
_IN_TASK = 33  # bits that monotonically_increasing_id has for the rows of a task


def in_blocks(df: DataFrame, key: str, start: int) -> tuple[DataFrame, int]:
    """``df`` with ``key`` = start, start+1, … in no order, and its number of rows; runs jobs.

    The rows are written once with their place in the task that wrote them. The next jobs
    read one number of each, and one total a task.
    """
    placed = materialize(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("_at", _IN_TASK)
    sizes = materialize(
        placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n")), "numbered-tasks"
    )
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.select("_task", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + start).alias("_first"))
    rows = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    at = F.col("_at").bitwiseAND(F.lit((1 << _IN_TASK) - 1))
    numbered = placed.withColumn("_task", task).join(F.broadcast(ranges), "_task")
    return numbered.select((F.col("_first") + at).alias(key), *df.columns), rows


def known_keys(spark: SparkSession, path: str) -> DataFrame | None:
    """(id, key) of a register; None before its first load."""
    return spark.read.parquet(f"{path}/keys") if tables.exists(spark, f"{path}/keys") else None


def register(ids: DataFrame, natural: str, path: str) -> DataFrame:
    """(``natural``, key) of every id ever registered at ``path``, those of ``ids`` included.

    NULL ids get no key. Ids of ``ids`` may repeat.
    """
    spark = ids.sparkSession
    fresh = ids.select(F.col(natural).alias("id")).where("id is not null").distinct()
    known = known_keys(spark, path)
    if known is not None:
        fresh = fresh.join(known.select("id"), "id", "left_anti")
    start = 1
    if tables.exists(spark, f"{path}/blocks"):
        blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
        start = blocks.agg(F.max(F.col("first") + F.col("n"))).first()[0] or 1
    numbered, rows = in_blocks(fresh, "key", start)
    if rows:
        tables.append(spark.createDataFrame([(start, rows)], _BLOCKS).coalesce(1), f"{path}/blocks")
    if rows or known is None:
        tables.append(numbered.select("id", "key"), f"{path}/keys")
    return known_keys(spark, path).withColumnRenamed("id", natural)


def insert_registered(
    target: DataFrame | None,
    incoming: DataFrame,
    key: str,
    natural: str,
    path: str,
    order: list[str] | None = None,
) -> DataFrame:
    """``insert_if_absent`` with keys of the register at ``path``; runs jobs."""
    fresh = incoming.where(F.col(natural).isNotNull())
    if target is not None:
        fresh = fresh.join(target.select(natural), natural, "left_anti").select(*fresh.columns)
    fresh = first_per_key(fresh, [natural], order)
    keys = register(fresh, natural, path).withColumnRenamed("key", key)
    return fresh.join(keys, natural).select(key, *fresh.columns)

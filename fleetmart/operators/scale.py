"""Hot keys, stored intermediates and concurrent jobs, shared by the other operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


T = TypeVar("T")

# Codec of all stored tables and intermediates.
CODEC = "zstd"
# Rows of a frame of hot keys that may be broadcast: some 16 MB in memory.
BROADCAST_KEYS = 250_000


@dataclass(frozen=True)
class Limits:
    """``hot_rows``: rows of one key for a single task. ``range_parts``: parts of a ranking.

    Spark chooses the parts by its settings and their size where ``range_parts`` is None.
    ``task_rows``: rows of a wide table that one task sorts in memory, see ``parts_for``.
    """

    hot_rows: int = 5_000_000
    range_parts: int | None = None
    task_rows: int = 500_000


DEFAULT = Limits()


@dataclass(frozen=True)
class HotKeys:
    """Keys too large for one task: a stored frame (key, _n rows), their number and rows."""

    counts: DataFrame
    number: int
    rows: int

    @property
    def flags(self) -> DataFrame:
        """The frame for a join; a broadcast as long as its known number of rows allows."""
        return F.broadcast(self.counts) if self.number <= BROADCAST_KEYS else self.counts


def hot_keys(df: DataFrame, key: str, limits: Limits = DEFAULT) -> HotKeys | None:
    """All keys with more than ``hot_rows`` rows; None if there are none. NULL is never one.

    Runs a job: one column is read and counted with map-side combine, and the keys found,
    at most rows / hot_rows, are stored with their counts. Only two totals reach the driver.
    """
    counts = materialize(
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > limits.hot_rows),
        "hot-keys",
    )
    number, rows = counts.agg(F.count(F.lit(1)), F.sum("_n")).first()
    return HotKeys(counts, number, rows) if number else None


def tasks_for(rows: int, limits: Limits = DEFAULT) -> int:
    return max(1, -(-rows // limits.hot_rows))


def parts_for(spark: SparkSession, rows: int, limits: Limits = DEFAULT) -> int | None:
    """Partitions of at most some ``task_rows`` rows; None where one task can hold them all.

    A number by the rows, so that sorts don't spill where the session has few partitions. Never
    fewer than the session has: Spark would shuffle a join's sides into those again.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // limits.task_rows)) if rows > limits.task_rows else None


def shuffled(df: DataFrame, rows: int = BROADCAST_KEYS) -> DataFrame:
    """``df`` for the right side of a join: not broadcast where it has more than ``rows`` rows.

    Spark judges a stored table by its compressed size, and a broadcast passes all of it through
    the driver. Counts the rows, of stored tables from their footers.
    """
    return df.hint("merge") if df.count() > rows else df


def scratch_dir(spark: SparkSession) -> str:
    """Folder for written intermediates, below the one named in spark.checkpoint.dir.

    Where that is unset, below the warehouse folder. On a cluster that must not be a folder of
    one machine, where executors would write to disks that others don't see.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        alone = context.master.split("[")[0] == "local"
        if not alone and (base.startswith("file:") or ":/" not in base):
            raise ValueError(f"{base} is local to a machine: set spark.checkpoint.dir to a shared folder")
    return f"{base}/fleetmart/{context.applicationId}"


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of intermediates; frames that read them end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_scratch(spark: SparkSession) -> None:
    """Deletes all intermediates of this application."""
    remove(spark, scratch_dir(spark))


def materialize(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, fixes partition ids."""
    spark = df.sparkSession
    path = f"{folder or scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)


def together(*actions: Callable[[], T]) -> list[T]:
    """Results of independent Spark actions, submitted at the same time.

    A small job leaves most of a cluster idle; its neighbours fill it.
    """
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(actions)))) as pool:
        return list(pool.map(lambda action: action(), actions))


def sort_column(name: str, direction: str) -> Column:
    """Ascending puts NULLs last, descending puts them first."""
    if direction == "asc":
        return F.col(name).asc_nulls_last()
    if direction == "desc":
        return F.col(name).desc_nulls_first()
    raise ValueError(f"direction must be asc or desc, got {direction!r}")


def sort_columns(order: list[tuple[str, str]]) -> list[Column]:
    return [sort_column(name, direction) for name, direction in order]

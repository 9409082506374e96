"""Stored warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fleetmart.operators.scale import CODEC

FACT_ORDER = ["driver_key", "start_time", "ride_id"]


def recreate(df: DataFrame, path: str, rows_per_file: int = 0) -> DataFrame:
    """Replace the table at ``path``. ``df`` must not read from ``path``.

    ``rows_per_file`` limits the rows of a file where it isn't 0.
    """
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path, compression=CODEC)


def load(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def replace_parts(df: DataFrame, path: str, parts: list[str]) -> None:
    """Replace the partitions (folders by ``parts``) that ``df`` has rows of, and no others.

    ``df`` must not read from ``path``. Running it again changes nothing.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.partitionBy(*parts).option("maxRecordsPerFile", 20_000_000)
    writer.parquet(path, compression=CODEC)


def fact_layout(df: DataFrame) -> DataFrame:
    """Rows of a driver together and in time order within each file.

    Takes the place of the key indexes: row groups carry narrow driver ranges, so
    a driver filter skips nearly all of them. The fact leaves its window already
    sorted like this, and Catalyst then drops the sort.
    """
    return df.sortWithinPartitions(*FACT_ORDER)


def write_fact(
    df: DataFrame, path: str, *, by_date: bool = False, mode: str = "overwrite"
) -> DataFrame:
    """Store the fact, by driver within files and optionally by date in folders."""
    if by_date:
        # Ranges give each task few dates, so few files per folder; a busy date
        # is split over several tasks.
        order = ["start_date_key", *FACT_ORDER]
        laid_out = df.repartitionByRange(*order).sortWithinPartitions(*order)
        writer = laid_out.write.partitionBy("start_date_key")
    else:
        writer = fact_layout(df).write
    writer = writer.mode(mode).option("maxRecordsPerFile", 20_000_000)
    writer.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)

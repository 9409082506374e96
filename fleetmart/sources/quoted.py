"""Comma-separated text with line breaks inside quotes, read in splits.

A line belongs to the record before it if the number of quotes ahead of it in its file is odd.
The quotes of every split are counted, added up over the splits of a file (one row a split), and
then over the lines of each split. Lines that are a record by themselves stay where they are;
the lines of other records meet, also across splits. Parsing is left to ``from_csv``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetmart.operators.scale import materialize

_SPLIT = ["_file", "_block"]


def _before(value: str):
    """Sum of ``value`` over the earlier splits of the file."""
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record, is_header): the records of the files at ``path``, the first of each marked; runs jobs.

    Records end with a line break outside quotes; blank lines between them are none. Quotes
    stand around fields or are doubled inside them. A quote that nothing closes takes the rest of
    its file into one record. Text is shuffled once, by split, and stored.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),  # rises within a split
        ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("_odd"),
    )
    quotes = lines.groupBy(*_SPLIT).agg(F.sum("_odd").alias("_odds"))
    ahead = quotes.select(*_SPLIT, _before("_odds").alias("_ahead"))
    in_split = Window.partitionBy(*_SPLIT).orderBy("_at")
    until = in_split.rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.col("_ahead") + F.coalesce(F.sum("_odd").over(until), F.lit(0))) % 2 == 1
    begins = ~F.col("_inside") & (F.trim(F.regexp_replace("value", "\r$", "")) != "")
    marked = (
        lines.join(ahead, _SPLIT)
        .withColumn("_inside", inside)
        .withColumn("_begins", begins)
        .where("_inside or _begins")
        .withColumn("_number", F.count_if("_begins").over(in_split))
    )
    marked = materialize(marked.drop("_ahead"), "lines")
    starts = marked.groupBy(*_SPLIT).agg(F.max("_number").alias("_n"))
    offsets = starts.select(*_SPLIT, _before("_n").alias("_earlier"))

    whole = F.col("_begins") & (F.col("_odd") == 0)
    # The first record of a file begins in its first split with lines.
    first = offsets.where("_earlier = 0").groupBy("_file").agg(F.max("_block").alias("_first_block"))
    single = marked.where(whole).join(first, "_file", "left").select(
        F.col("value").alias("record"),
        ((F.col("_block") <= F.col("_first_block")) & (F.col("_number") == 1)).alias("is_header"),
    )
    pieces = marked.where(~whole).join(offsets, _SPLIT)
    pieces = pieces.withColumn("_record", F.col("_earlier") + F.col("_number"))
    joined = pieces.groupBy("_file", "_record").agg(
        F.sort_array(F.collect_list(F.struct("_block", "_at", "value"))).alias("_lines")
    )
    several = joined.select(
        F.array_join(F.col("_lines.value"), "\n").alias("record"),
        (F.col("_record") == 1).alias("is_header"),
    )
    return single.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_quoted(spark: SparkSession, path: str, schema: StructType, options: dict[str, str]) -> DataFrame:
    """Rows of files with a header, under ``schema``; ``options`` are those of ``from_csv``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    row = F.from_csv("record", ddl, options | {"multiLine": "true"})
    return records(spark, path).where("not is_header").select(row.alias("_row")).select("_row.*")

"""Raw staging tables from files, always under a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from fleetmart.schemas import RAW
from fleetmart.sources.quoted import read_quoted


_OPTIONS = {"nullValue": r"\N", "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, schema: StructType, *, multiline: bool = False
) -> DataFrame:
    """Comma-separated text with a header; a malformed row fails the read.

    An unquoted empty field is NULL and a quoted one is the empty text (that is
    what the odd null marker does); a quote inside a quoted field is doubled.
    ``multiline`` allows line breaks inside quotes; it runs jobs and shuffles the text once.
    """
    options = _OPTIONS | {"mode": "FAILFAST"}
    if multiline:
        return read_quoted(spark, path, schema, options)
    return spark.read.schema(schema).options(header=True, **options).csv(path)


def read_text(
    spark: SparkSession, path: str, schema: StructType, *, multiline: bool = False
) -> DataFrame:
    """The same text with every column left as text, for checks before a typed read.

    Nothing fails here: ``quality.violations`` counts what would not parse.
    """
    plain = StructType([StructField(f.name, StringType()) for f in schema])
    if multiline:
        return read_quoted(spark, path, plain, _OPTIONS)
    return spark.read.schema(plain).options(header=True, **_OPTIONS).csv(path)


def read_raw(
    spark: SparkSession, folder: str, fmt: str = "csv", *, multiline: bool = False
) -> dict[str, DataFrame]:
    """The five staging tables of ``folder``, one file or directory each."""
    if fmt == "csv":
        return {
            name: read_csv(spark, f"{folder}/{name}.csv", schema, multiline=multiline)
            for name, schema in RAW.items()
        }
    if fmt in ("parquet", "orc"):
        return {
            name: spark.read.schema(schema).format(fmt).load(f"{folder}/{name}.{fmt}")
            for name, schema in RAW.items()
        }
    raise ValueError(f"unsupported format {fmt!r}")


def write_csv(df: DataFrame, path: str) -> None:
    """Text that ``read_csv`` reads back unchanged, NULL and empty text included."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )

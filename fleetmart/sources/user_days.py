"""The fact stored for look-ups by user, by date and by both.

Users and dates are laid along one curve: the high bits of a ride's user and of its date are
interleaved, and files are ranges of that number. So a file holds few users and few dates, and
the smallest and largest values that Parquet keeps of both columns tell nearly every file
that a look-up doesn't need. A filter on the stored columns is all that a reader writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.sources.tables import FACT_ORDER

# Bits taken in turn from the user's and from the date's number, and how often. A look-up by
# user is the more frequent and selective one, so users get more.
USER_BITS, DATE_BITS, TURNS = 2, 1, 8


def _steps(value: Column, least: int, most: int, bits: int) -> Column:
    """``value`` between ``least`` and ``most`` as one of 2 ** bits equal steps; NULL as 0."""
    step = F.floor((value - F.lit(least)) * F.lit(float(1 << bits)) / F.lit(most - least + 1))
    return F.coalesce(step.cast("bigint"), F.lit(0).cast("bigint"))


def interleaved(values: list[tuple[Column, int]], turns: int) -> Column:
    """One number from non-negative ones (value, bits a turn), highest bits first.

    A value counts with its lowest ``bits * turns`` bits.
    """
    code = F.lit(0).cast("bigint")
    for turn in reversed(range(turns)):
        for value, bits in values:
            part = F.shiftright(value, bits * turn).bitwiseAND(F.lit((1 << bits) - 1))
            code = F.shiftleft(code, bits).bitwiseOR(part.cast("bigint"))
    return code


def _day(column: str) -> Column:
    return F.unix_date(F.to_date(column))


def write_user_days(
    fact: DataFrame,
    path: str,
    *,
    rows_per_file: int = 2_000_000,
    user_bits: int = USER_BITS,
    date_bits: int = DATE_BITS,
) -> DataFrame:
    """Store ``fact`` by user and date; ``fact`` must not read from ``path``.

    Surrogate keys are dense and so are dates, so equal steps of either hold about equally
    many users and dates. A user or date with very many rides is spread over as many files as
    its rides need: inside a cell rows are cut by user, time and id. Runs one job for the
    smallest and largest values.
    """
    ends = fact.agg(
        F.min("user_key"),
        F.max("user_key"),
        F.min(_day("start_time")),
        F.max(_day("start_time")),
        F.count(F.lit(1)),
    ).first()
    first_user, last_user, first_day, last_day = (value or 0 for value in ends[:4])
    cell = interleaved(
        [
            (_steps(F.col("user_key"), first_user, last_user, user_bits * TURNS), user_bits),
            (_steps(_day("start_time"), first_day, last_day, date_bits * TURNS), date_bits),
        ],
        TURNS,
    )
    files = max(1, -(-ends[4] // rows_per_file))
    order = ["_cell", "user_key", *FACT_ORDER[1:]]
    laid = fact.withColumn("_cell", cell).repartitionByRange(files, *order)
    laid.sortWithinPartitions(*order).drop("_cell").write.mode("overwrite").parquet(path)
    return fact.sparkSession.read.schema(fact.schema).parquet(path).select(*fact.columns)


def look_up(
    stored: DataFrame,
    *,
    users: list[int] | None = None,
    dates: tuple[int, int] | None = None,
) -> DataFrame:
    """Rides of some users and of the dates (keys such as 20240131) from one to another.

    None leaves out that filter. Both are compared with the files' statistics.
    """
    if users is not None:
        stored = stored.where(F.col("user_key").isin(users))
    if dates is not None:
        stored = stored.where(F.col("start_date_key").between(*dates))
    return stored

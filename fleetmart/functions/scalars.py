"""Column expressions shared by the load and the marts. All stay in the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def initial(name: Column) -> Column:
    """First letter and a full stop; NULL stays NULL, empty becomes a full stop."""
    return F.concat(F.substring(name, 1, 1), F.lit("."))


def fingerprint(value: Column, salt: str | None = None) -> Column:
    """MD5 in hex, or SHA-256 over salt and value where a salt is given."""
    if salt is None:
        return F.md5(value)
    return F.sha2(F.concat(F.lit(salt), value), 256)


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of_week(day: Column) -> Column:
    """Sunday = 0 … Saturday = 6."""
    return F.dayofweek(day) - 1


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Exact seconds with microseconds; negative when ``end`` is earlier."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes with two places, rounded half up.

    Dividing an interval by a whole number rounds half up on its 64-bit microseconds:
    600,000 of them are a hundredth of a minute, shown as 10,000 to read as minutes.
    """
    hundredths = (end - start) / 600_000
    return (hundredths * 10_000).cast("interval second").cast("decimal(10,2)")


def hours_between(start: Column, end: Column) -> Column:
    """Hours with one place, rounded half up."""
    tenths = (end - start) / 360_000_000
    return (tenths * 100_000).cast("interval second").cast("decimal(10,1)")


def exact_ratio(total: Column, count: Column, scale: int = 16) -> Column:
    """``total / count`` as a decimal; NULL for a zero count.

    Averages are kept as decimals so that they do not depend on the order in
    which tasks add up, and equal averages compare as equal.
    """
    return F.round(total / F.nullif(count.cast("decimal(20,0)"), F.lit(0)), scale)


def exact_sum(value: Column) -> Column:
    """Sum of a two-decimal column within a group.

    Added up as 64-bit hundredths: a decimal sum this wide would leave the fixed-width
    aggregation buffers.
    """
    hundredths = F.sum((value * 100).cast("bigint")).cast("decimal(20,0)")
    return (hundredths * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def exact_avg(value: Column, scale: int = 16) -> Column:
    """Mean of a two-decimal column within a group, NULLs skipped."""
    return exact_ratio(exact_sum(value).cast("decimal(22,2)"), F.count(value), scale)


def first_match(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """Label of the first condition that holds."""
    (condition, label), *rest = rules
    result = F.when(condition, label)
    for condition, label in rest:
        result = result.when(condition, label)
    return result if otherwise is None else result.otherwise(otherwise)


def tier(value: Column, bounds: list[tuple[object, str]], otherwise: str) -> Column:
    """Label of the first upper bound that ``value`` does not exceed."""
    return first_match([(value <= F.lit(bound), label) for bound, label in bounds], otherwise)

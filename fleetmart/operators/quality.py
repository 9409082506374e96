"""Integrity checks: what a database would enforce at load, reported as counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fleetmart.operators.joins import join_unique
from fleetmart.schemas import Rules


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent and how many rows hold each; NULL is allowed.

    Child rows collapse to one per value before the join, so a value that fills a
    third of the table costs one row.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return values.join(known, column, "left_anti").select(column, "n_rows")


def _count_if(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def declared_keys(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """``(table_name, key, n_keys, n_rows)`` for every declared key and unique column set:
    values that occur again, and the rows beyond the first of each.

    Rows collapse to one per value before the shuffle. A value with a NULL part is no key
    value; ``violations`` counts it.
    """
    parts = []
    for name, df in tables.items():
        for columns in (rules[name].key, *rules[name].unique):
            again = duplicate_keys(df.dropna(subset=list(columns)), list(columns))
            parts.append(
                again.agg(
                    F.lit(name).alias("table_name"),
                    F.lit(", ".join(columns)).alias("key"),
                    F.count(F.lit(1)).alias("n_keys"),
                    F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("n_rows"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def _checks(
    df: DataFrame, rules: Rules, kinds: dict[str, str] | None = None
) -> list[tuple[str, str, Column]]:
    """(column, rule, condition of a row that breaks it) for the columns that ``df`` has."""
    present = set(df.columns)
    checks: list[tuple[str, str, Column]] = []
    for name in rules.not_null:
        checks.append((name, "not_null", F.col(name).isNull()))
    for name, size in rules.max_length.items():
        checks.append((name, f"varchar({size})", F.length(F.col(name).cast("string")) > size))
    for name, (precision, scale) in rules.decimals.items():
        kind = f"decimal({precision},{scale})"
        misfit = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
        checks.append((name, kind, misfit))
    texts = {field.name for field in df.schema if isinstance(field.dataType, StringType)}
    for name, kind in (kinds or {}).items():
        if name in texts:
            unread = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
            checks.append((name, kind, unread))
    return [check for check in checks if check[0] in present]


def violations(
    table: str, df: DataFrame, rules: Rules, kinds: dict[str, str] | None = None
) -> DataFrame:
    """``(table_name, column_name, rule, n_rows)`` for every declared rule.

    All rules of a table are counted in one scan. Columns may still be text (as
    ``read_text`` gives them): a value that does not parse or does not fit counts.
    ``kinds`` names the types that text columns must parse as.
    """
    checks = _checks(df, rules, kinds)
    counted = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(name).alias("column_name"),
                    F.lit(rule).alias("rule"),
                    _count_if(condition).alias("n_rows"),
                )
                for name, rule, condition in checks
            ]
        ).alias("found")
    )
    return counted.select(F.explode("found").alias("found")).select("found.*")


def with_reasons(
    table: str,
    tables: dict[str, DataFrame],
    rules: Rules,
    links: tuple[tuple[str, str, str, str], ...] = (),
    kinds: dict[str, str] | None = None,
) -> DataFrame:
    """The rows of a table, each with ``reasons``: an array of the rules it breaks.

    A reason is "column rule": those of ``violations`` in their order, then "column reference"
    for a value without a parent in the given tables, then "columns key" for every row whose
    key another row has too, as none of them is known to be the right one. A row without
    reasons has an empty array, so accepted and rejected rows are filters of one result, and
    together are the input, row for row.

    The table is read once for this, and its key columns once more. Parents collapse to
    distinct values, and keys to those that come again, before they meet the rows; NULL
    values meet nothing and don't move to one task.
    """
    df = tables[table]
    reasons = [F.when(broken, F.lit(f"{name} {rule}")) for name, rule, broken in _checks(df, rules, kinds)]
    for at, (child, column, parent, parent_column) in enumerate(links):
        if child != table or parent not in tables or column not in df.columns:
            continue
        flag = f"_known_{at}"
        known = tables[parent].select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull())
        df = join_unique(
            df, known.distinct().withColumn(flag, F.lit(True)), column, "left", spread_by=rules.key[0]
        )
        lost = F.col(column).isNotNull() & F.col(flag).isNull()
        reasons.append(F.when(lost, F.lit(f"{column} reference")))
    for at, key in enumerate((rules.key, *rules.unique)):
        flag = f"_again_{at}"
        again = duplicate_keys(tables[table].dropna(subset=list(key)), list(key))
        df = df.join(again.select(*key, F.lit(True).alias(flag)), list(key), "left")
        reasons.append(F.when(F.col(flag), F.lit(f"{', '.join(key)} key")))
    return df.select(*tables[table].columns, F.array_compact(F.array(*reasons)).alias("reasons"))


def all_violations(
    tables: dict[str, DataFrame],
    rules: dict[str, Rules],
    kinds: dict[str, dict[str, str]] | None = None,
) -> DataFrame:
    parts = [
        violations(name, df, rules[name], (kinds or {}).get(name)) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reference_report(
    tables: dict[str, DataFrame], links: tuple[tuple[str, str, str, str], ...]
) -> DataFrame:
    """Orphan values and rows per declared reference between the given tables."""
    parts = []
    for child, column, parent, parent_column in links:
        if child in tables and parent in tables:
            lost = orphans(tables[child], column, tables[parent], parent_column)
            parts.append(
                lost.agg(
                    F.lit(child).alias("child_table"),
                    F.lit(column).alias("child_column"),
                    F.lit(parent).alias("parent_table"),
                    F.count(F.lit(1)).alias("n_values"),
                    F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def load_losses(
    rides: DataFrame, ratings: DataFrame, dim_user: DataFrame, dim_driver: DataFrame
) -> DataFrame:
    """Rows the fact load leaves out, by reason. A ride can have several reasons."""
    unset = rides.agg(
        *[
            _count_if(F.col(name).isNull()).alias(name)
            for name in ("ride_start_time", "user_id", "driver_id")
        ]
    ).select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(f"ride without {name}").alias("reason"), F.col(name).alias("n_rows"))
                    for name in ("ride_start_time", "user_id", "driver_id")
                ]
            )
        ).alias("found")
    ).select("found.*")

    def total(name: str, lost: DataFrame, rows: Column) -> DataFrame:
        return lost.agg(
            F.lit(name).alias("reason"), F.coalesce(F.sum(rows), F.lit(0)).alias("n_rows")
        )

    parts = [
        unset,
        total("ride of an unknown user", orphans(rides, "user_id", dim_user, "user_id"), F.col("n_rows")),
        total(
            "ride of an unknown driver",
            orphans(rides, "driver_id", dim_driver, "driver_id"),
            F.col("n_rows"),
        ),
        total(
            "further rating of a ride",
            duplicate_keys(ratings.where(F.col("ride_id").isNotNull()), ["ride_id"]),
            F.col("n_rows") - 1,
        ),
    ]
    return reduce(DataFrame.unionByName, parts)

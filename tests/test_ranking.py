"""Both ways to rank against the built-in windows, with ties and NULLs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetmart.operators import ranking
from fleetmart.operators.scale import Limits

TINY = Limits(hot_rows=7, range_parts=9)


def _columns():
    return {
        "rn": ranking.row_number(),
        "rk": ranking.rank(),
        "dr": ranking.dense_rank(),
        "pr": ranking.percent_rank(),
        "cd": ranking.cume_dist(),
        "nt": ranking.ntile(4),
    }


def _expected(df, direction):
    value = F.col("v").asc_nulls_last() if direction == "asc" else F.col("v").desc_nulls_first()
    by_value, by_row = Window.orderBy(value), Window.orderBy(value, "id")
    return df.select(
        "id",
        "v",
        F.row_number().over(by_row).alias("rn"),
        F.rank().over(by_value).alias("rk"),
        F.dense_rank().over(by_value).alias("dr"),
        F.percent_rank().over(by_value).alias("pr"),
        F.cume_dist().over(by_value).alias("cd"),
        F.ntile(4).over(by_row).alias("nt"),
    )


def _frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, v int")


def _cases():
    rng = random.Random(7)
    spread = [rng.randrange(1000) for _ in range(60)]
    ties = [rng.randrange(5) for _ in range(80)]
    hot = [3] * 40 + [rng.randrange(10) for _ in range(40)]
    nulls = [None] * 25 + [rng.randrange(6) for _ in range(30)]
    return {
        "spread": spread,
        "ties": ties,
        "one value": [1] * 50,
        "hot value": hot,
        "nulls": nulls,
        "single": [4],
        "three": [4, 4, 2],
    }


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("case", _cases())
def test_parts_equal_windows(spark, case, direction):
    df = _frame(spark, _cases()[case])
    got = ranking.ranked(df, [("v", direction)], [("id", "asc")], _columns(), limits=TINY)
    want = _expected(df, direction)
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(
        want.collect(), key=lambda r: r.id
    )


@pytest.mark.parametrize(("direction", "limit"), [("asc", 10), ("desc", 12), ("desc", 200)])
@pytest.mark.parametrize("case", _cases())
def test_top_equals_windows(spark, case, direction, limit):
    df = _frame(spark, _cases()[case])
    got = ranking.ranked(df, [("v", direction)], [("id", "asc")], _columns(), limit=limit, limits=TINY)
    want = _expected(df, direction).where(F.col("rn") <= limit)
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(
        want.collect(), key=lambda r: r.id
    )


def test_two_order_columns(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), rng.choice([None, 1, 2])) for i in range(70)]
    df = spark.createDataFrame(rows, "id bigint, a int, b int")
    order = [("a", "desc"), ("b", "asc")]
    columns = {name: _columns()[name] for name in ("rk", "dr", "cd")}
    small = ranking.ranked(df, order, [("id", "asc")], columns)
    parts = ranking.ranked(df, order, [("id", "asc")], columns, limits=TINY)
    top = ranking.ranked(df, order, [("id", "asc")], columns, limit=70, limits=TINY)
    first = ranking.ranked(df, order, [("id", "asc")], columns, limit=9)
    assert first.count() == 9 and first.exceptAll(small).isEmpty()
    expected = sorted(small.collect())
    assert sorted(parts.collect()) == expected
    assert sorted(top.collect()) == expected


def test_ranks_are_ordered_and_tiles_even(spark):
    df = _frame(spark, _cases()["hot value"])
    rows = ranking.ranked(df, [("v", "asc")], [("id", "asc")], _columns(), limits=TINY).collect()
    assert all(row.dr <= row.rk <= row.rn for row in rows)
    sizes = [sum(row.nt == tile for row in rows) for tile in (1, 2, 3, 4)]
    assert max(sizes) - min(sizes) <= 1

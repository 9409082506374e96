"""join_unique: salted and plain forms give the same rows, and no task gets a hot key whole."""

import random

import pytest
from pyspark.sql import functions as F

from fleetmart.operators.joins import join_unique
from fleetmart.operators.scale import HotKeys, Limits, hot_keys

TINY = Limits(hot_rows=10)


def _frames(spark):
    rng = random.Random(5)
    keys = [1] * 50 + [None] * 20 + [rng.randrange(2, 12) for _ in range(50)]
    left = spark.createDataFrame(list(enumerate(keys)), "id bigint, k int")
    right = spark.createDataFrame([(k, f"name {k}") for k in range(9)], "k int, name string")
    return left, right


def _rows(df):
    return sorted(df.select("id", "k", "name").collect(), key=str)


def _rows_per_task(df):
    """Rows of each task of a shuffled join, for a session that neither broadcasts nor merges."""
    spark = df.sparkSession
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, ("-1", "false", "40"), strict=True):
            spark.conf.set(name, value)
        found = df.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return [row["count"] for row in found]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_equals_plain(spark, how):
    left, right = _frames(spark)
    hot = hot_keys(left, "k", TINY)
    assert hot.number >= 1
    salted = join_unique(left, right, "k", how, spread_by="id", hot=hot, limits=TINY)
    assert _rows(salted) == _rows(left.join(right, "k", how))


def test_every_hot_key_is_found_and_split(spark):
    # More hot keys than any former cap: each holds three times what a task may hold.
    left = spark.range(36_000).select("id", (F.col("id") % 12_000).cast("int").alias("k"))
    one = Limits(hot_rows=1)
    hot = hot_keys(left, "k", one)
    assert (hot.number, hot.rows) == (12_000, 36_000)
    right = spark.range(12_000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"))
    joined = join_unique(left, right, "k", spread_by="id", hot=hot, limits=one)
    assert joined.count() == 36_000


def test_salts_follow_the_size_of_each_key(spark):
    left = spark.range(4_000).select("id", F.when(F.col("id") < 3_000, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    limits = Limits(hot_rows=50)
    plain = _rows_per_task(join_unique(left, right, "k"))
    salted = _rows_per_task(
        join_unique(left, right, "k", spread_by="id", hot=hot_keys(left, "k", limits), limits=limits)
    )
    assert max(plain) >= 3_000 and max(salted) < 400 and sum(salted) == 4_000


def test_null_keys_of_an_outer_join_go_everywhere(spark):
    left = spark.range(3_000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 500).alias("k"))
    right = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    plain = _rows_per_task(join_unique(left, right, "k", "left"))
    spread = _rows_per_task(join_unique(left, right, "k", "left", spread_by="id"))
    assert max(plain) >= 1_000 and max(spread) < 200 and sum(spread) == 3_000


def test_other_joins_are_refused(spark):
    left, right = _frames(spark)
    with pytest.raises(ValueError):
        join_unique(left, right, "k", "full")


def test_known_hot_keys_need_a_spread_column(spark):
    left, right = _frames(spark)
    hot = HotKeys(spark.createDataFrame([(1, 50)], "k int, _n bigint"), 1, 50)
    with pytest.raises(ValueError):
        join_unique(left, right, "k", hot=hot)


def test_nothing_runs_while_a_join_is_built(spark):
    left, right = _frames(spark)
    broken = left.where(F.raise_error(F.lit("read")).isNull())
    join_unique(broken, right, "k", "left", spread_by="id")

"""The join on a computed key: stored rides, shuffled to their users once."""

import pytest
from pyspark.sql import functions as F
from test_layout import SMALL, _raw, _rows

from checks import queries
from fleetmart.operators.joins import join_unique
from fleetmart.operators.scale import Limits, hot_keys
from fleetmart.plans import facts, warehouse


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Order lines of their own: repeated lines, lines without order, date, user or driver."""
    folder, n = tmp_path_factory.mktemp("tables"), F.col("id")
    double = lambda c: c.cast("double")
    day = F.timestamp_add("DAY", (n % 9).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    lines = spark.range(400).select(
        (n % 90).alias("l_orderkey"), (n * 3 % 20).alias("l_partkey"),
        F.when(n % 31 != 0, n % 12).alias("l_suppkey"), (n % 4).cast("int").alias("l_linenumber"),
        double(n % 50).alias("l_quantity"), double(n * 7).alias("l_extendedprice"),
        F.when(n % 29 != 0, day).alias("l_shipdate"),
    )
    made = {
        "lineitem": lines.unionByName(lines.where("l_extendedprice < 70")),
        "orders": spark.range(80).select(n.alias("o_orderkey"), F.when(n % 17 != 0, n % 25).alias("o_custkey")),
        "customer": spark.range(20).select(
            n.alias("c_custkey"), F.concat(F.lit("C"), n).alias("c_name"), (n % 2).alias("c_nationkey")
        ),
        "nation": spark.range(2).select(n.alias("n_nationkey"), n.cast("string").alias("n_name")),
        "supplier": spark.range(10).select(n.alias("s_suppkey"), double(n).alias("s_acctbal")),
        "part": spark.range(20).select(
            n.alias("p_partkey"), F.lit("b").alias("p_brand"), F.lit("m").alias("p_name"), n.alias("p_size")
        ),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


def test_order_lines_are_not_joined_again(spark, tables):
    found = queries.join_computed_key(spark, tables)
    assert not [file for file in found.inputFiles() if "lineitem" in file or "orders" in file.split("/")[-2]]
    wh = queries.built(spark, tables, "orders")
    rides = queries.raw_tables(spark, tables, "orders")["rides"]
    plain = facts.keyed_rides(rides, wh.dim_user, wh.dim_driver, wh.dim_date).select("ride_id", "date_key")
    assert _rows(found) == _rows(plain) and plain.count() > 200


def test_rides_meet_many_users_once_in_parts_of_their_own(spark):
    for text in (True, False):
        rides, _, *dims = _raw(spark, text=text)
        plain = facts.keyed_rides(rides, *dims)
        for hot in (None, hot_keys(rides, "user_id", Limits(hot_rows=4))):
            found = facts.keyed_rides(rides, *dims, hot_users=hot, parts=9, by_driver=False, limits=SMALL)
            assert found.columns == plain.columns
            assert _rows(found) == _rows(plain) and plain.count() > 300
    few = facts.keyed_rides(rides, *dims, parts=9, by_driver=False, limits=SMALL).select("ride_id", "date_key")
    plan = few._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 2 and all("user_id" in line and ", 9)" in line for line in moved)  # rides and users


def test_ratings_need_rides_by_driver(spark):
    rides, ratings, *dims = _raw(spark)
    with pytest.raises(ValueError):
        facts.keyed_rides(rides, *dims, raw_ratings=ratings, parts=9, by_driver=False, limits=SMALL)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_in_parts_equals_plain(spark, how):
    left = spark.range(300).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 11).alias("k"))
    right = spark.range(9).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    hot = hot_keys(left, "k", Limits(hot_rows=20))
    assert hot.number > 1
    plain = _rows(join_unique(left, right, "k", how))
    for known in (None, hot):
        found = join_unique(
            left, right, "k", how, spread_by="id", hot=known, parts=9, limits=Limits(hot_rows=20)
        )
        assert _rows(found) == plain and found.rdd.getNumPartitions() == 9


def test_rides_and_ratings_come_from_stored_lines(spark, tables):
    raw, root = queries.staged(spark, tables, "orders")
    plain = queries.raw_tables(spark, tables, "orders")
    for name in ("rides", "ratings"):
        assert all(f"{root}/raw_order_lines" in file for file in raw[name].inputFiles())
        assert raw[name].dtypes == plain[name].dtypes
        assert _rows(raw[name]) == _rows(plain[name]) and raw[name].count() > 50


def test_files_of_staged_tables_hold_few_rows(spark, tmp_path):
    df = spark.range(100).coalesce(1)
    assert len(warehouse.stage({"t": df}, str(tmp_path / "whole"))["t"].inputFiles()) == 1
    cut = warehouse.stage({"t": df}, str(tmp_path / "cut"), 30)["t"]
    assert len(cut.inputFiles()) == 4 and _rows(cut) == _rows(df)

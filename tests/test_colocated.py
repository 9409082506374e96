"""The fact stored by driver: same sequences, no exchange below the window, any session."""

import pytest
from pyspark.sql import functions as F

from checks import queries
from fleetmart.operators.scale import Limits
from fleetmart.operators.sequence import sequence
from fleetmart.plans import marts
from fleetmart.sources.colocated import open_colocated, write_colocated

SF = "/root/testdata/sf0.001"
WANTED = {
    "row_number": "number",
    "lag": {"before": "end_time"},
    "lead": {"after": "start_time"},
    "first": {"opening_fare": "fare_amount"},
}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def fact(events):
    """The small fact, of which one driver has a third of all rides."""
    spread = F.pmod(F.xxhash64("ride_id"), F.lit(3)) == 0
    return events.fact_rides.withColumn("driver_key", F.when(spread, 1).otherwise(F.col("driver_key")))


@pytest.mark.parametrize("hot_rows", [5_000_000, 120, 7])
def test_sequences_equal_those_over_the_plain_fact(spark, fact, tmp_path, hot_rows):
    stored = write_colocated(fact, str(tmp_path / "f"), buckets=4, limits=Limits(hot_rows=hot_rows))
    assert (stored.hot is None) == (hot_rows == 5_000_000)
    columns = ["driver_key", "ride_id"]
    expected = sequence(fact, "driver_key", marts.RIDE_ORDER, **WANTED).select(
        *columns, "number", "before", "after", "opening_fare"
    )
    assert _rows(stored.sequence(columns, **WANTED)) == _rows(expected)
    few = F.col("driver_key").isin(1, 3)
    assert _rows(stored.where(few).sequence(columns, **WANTED)) == _rows(expected.where(few))
    drivers = spark.createDataFrame([(1,), (4,)], "driver_key int")
    some = expected.join(drivers, "driver_key", "left_semi").select(*expected.columns)
    assert _rows(stored.of_drivers(drivers).sequence(columns, **WANTED)) == _rows(some)


def test_no_exchange_below_the_window(fact, tmp_path):
    path = str(tmp_path / "f")
    stored = write_colocated(fact, path, buckets=4, limits=Limits(hot_rows=120))
    plan = _plan(stored.sequence(["ride_id"], **WANTED))
    assert "Window" in plan and "Exchange hashpartitioning" not in plan and "rangepartition" not in plan
    assert "Exchange" in _plan(sequence(fact, "driver_key", marts.RIDE_ORDER, **WANTED))


def test_a_bucket_is_one_file(fact, tmp_path):
    write_colocated(fact, str(tmp_path / "f"), buckets=4)
    files = [file.name for file in (tmp_path / "f" / "rest").glob("*.parquet")]
    assert 1 < len(files) == len({name.split("_")[-1] for name in files}) <= 4


def test_another_session_reads_it(spark, fact, tmp_path):
    path = str(tmp_path / "f")
    stored = write_colocated(fact, path, buckets=4, limits=Limits(hot_rows=120))
    expected = _rows(stored.sequence(["ride_id"], **WANTED))
    for row in spark.sql("SHOW TABLES").collect():
        if row.tableName.startswith("fleet_"):
            spark.sql(f"DROP TABLE {row.tableName}")
    again = open_colocated(spark, path).sequence(["ride_id"], **WANTED)
    assert "Exchange hashpartitioning" not in _plan(again)
    assert _rows(again) == expected


def test_rewriting_replaces_rows_and_hot_drivers(fact, tmp_path):
    path = str(tmp_path / "f")
    write_colocated(fact, path, buckets=4, limits=Limits(hot_rows=120))
    small = fact.where("driver_key = 2")
    stored = write_colocated(small, path, buckets=2)
    assert stored.hot is None
    assert stored.rest.count() == small.count()


def test_empty_fact(fact, tmp_path):
    stored = write_colocated(fact.limit(0), str(tmp_path / "f"))
    assert stored.sequence(["ride_id"], **WANTED).count() == 0


@pytest.mark.parametrize("name", ["q10", "q11"])
def test_marts_read_it(spark, name):
    plain, stored = (queries.registry()[f"{name}_{form}"](spark, SF) for form in ("all_drivers", "colocated"))
    assert _rows(plain) == _rows(stored)
    assert any("/colocated-" in file for file in stored.inputFiles())

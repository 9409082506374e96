"""Look-ups by user and date: same rows, few row groups, busy users over several files."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.queries import built
from fleetmart.sources.user_days import interleaved, look_up, write_user_days

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fact(spark):
    return built(spark, LARGER, "events").fact_rides


@pytest.fixture(scope="module")
def stored(fact, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("user-days") / "fact")
    return path, write_user_days(fact, path, rows_per_file=50)


def _spans(folder, column):
    """The smallest and largest value of a column in every row group."""
    spans = []
    for name in pq.ParquetDataset(folder).files:
        meta = pq.ParquetFile(name).metadata
        for group in range(meta.num_row_groups):
            part = meta.row_group(group)
            stats = next(
                part.column(i).statistics
                for i in range(part.num_columns)
                if part.column(i).path_in_schema == column
            )
            spans.append((stats.min, stats.max))
    return spans


def _share(spans, value):
    return sum(low <= value <= high for low, high in spans) / len(spans)


def test_interleaved_bits_against_strings(spark):
    rows = [(a, b) for a in (0, 1, 5, 63) for b in (0, 2, 7)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    out = df.select("a", "b", interleaved([(F.col("a"), 2), (F.col("b"), 1)], 3).alias("code"))
    for a, b, code in out.collect():
        users, days = f"{a:06b}", f"{b:03b}"
        assert code == int("".join(users[2 * i : 2 * i + 2] + days[i] for i in range(3)), 2)


def test_nothing_is_lost(fact, stored):
    assert sorted(map(repr, stored[1].collect())) == sorted(map(repr, fact.collect()))


def test_a_user_is_in_under_a_tenth_of_the_row_groups(fact, stored):
    spans = _spans(stored[0], "user_key")
    assert len(spans) > 100
    users = [row[0] for row in fact.select("user_key").distinct().collect()]
    shares = [_share(spans, user) for user in users]
    assert max(shares) < 0.1
    for user in users[:3]:
        found = look_up(stored[1], users=[user])
        assert "PushedFilters: [IsNotNull(user_key)" in found._jdf.queryExecution().toString()
        assert found.count() == fact.where(F.col("user_key") == user).count()


def test_a_date_leaves_out_most_row_groups(fact, stored):
    spans = _spans(stored[0], "start_date_key")
    dates = [row[0] for row in fact.select("start_date_key").distinct().collect()]
    shares = [_share(spans, date) for date in dates]
    assert sum(shares) / len(shares) < 0.4
    assert look_up(stored[1], dates=(dates[0], dates[0])).count() == fact.where(
        F.col("start_date_key") == dates[0]
    ).count()


def test_a_busy_user_is_spread_over_files(fact, tmp_path):
    busy = F.when(F.pmod(F.xxhash64("ride_id"), F.lit(3)) == 0, 7).otherwise(F.col("user_key"))
    path = str(tmp_path / "fact")
    out = write_user_days(fact.withColumn("user_key", busy), path, rows_per_file=100)
    sizes = [pq.ParquetFile(name).metadata.num_rows for name in pq.ParquetDataset(path).files]
    assert max(sizes) < 400 and len(sizes) > 60
    assert out.count() == fact.count()


def test_nulls_and_empty_tables(fact, tmp_path):
    blank = fact.limit(5).withColumn("user_key", F.lit(None).cast("int"))
    assert write_user_days(blank, str(tmp_path / "a")).count() == 5
    assert write_user_days(fact.limit(0), str(tmp_path / "b")).count() == 0

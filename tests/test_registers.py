"""Keys that last, and bitmaps of the keys a table holds."""

import glob

from pyspark.sql import functions as F

from fleetmart.operators import bitmaps
from fleetmart.operators.scale import materialize
from fleetmart.plans import increment, warehouse
from fleetmart.sources import registers
from tests.test_increment import batch_of, frames, raw_rows


def keys_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len({r[1] for r in rows}) == len(rows)
    return dict(rows)


def ids(spark, values):
    return spark.createDataFrame([(v, "x") for v in values], "id string, key string").repartition(7)


def test_registered_ids_keep_their_keys(spark, tmp_path):
    path = str(tmp_path / "r")
    assert keys_of(registers.register(ids(spark, []), "id", path)) == {}
    first = keys_of(registers.register(ids(spark, [f"m{n}" for n in range(500)] * 2 + [None]), "id", path))
    assert sorted(first.values()) == list(range(1, 501))
    # Smaller ids, known ones and copies: known ones keep theirs, the others follow.
    more = [f"a{n}" for n in range(300)] + ["m7"] * 50
    second = keys_of(registers.register(ids(spark, more), "id", path))
    assert {k: second[k] for k in first} == first
    assert sorted(second.values()) == list(range(1, 801))
    files = set(glob.glob(f"{path}/keys/*.parquet"))
    assert keys_of(registers.register(ids(spark, more), "id", path)) == second
    assert set(glob.glob(f"{path}/keys/*.parquet")) == files  # nothing new, nothing written


def test_numbers_reserved_by_a_stopped_load_are_not_used_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    first = keys_of(registers.register(ids(spark, ["a", "b"]), "id", path))
    put = registers.tables.append

    def stop(df, to):
        if to.endswith("keys"):
            raise RuntimeError("lost")
        put(df, to)

    monkeypatch.setattr(registers.tables, "append", stop)
    try:
        registers.register(ids(spark, ["c"]), "id", path)
        raise AssertionError("not stopped")
    except RuntimeError:
        monkeypatch.setattr(registers.tables, "append", put)
    after = keys_of(registers.register(ids(spark, ["c", "d"]), "id", path))
    assert {k: after[k] for k in first} == first and sorted((after["c"], after["d"])) == [4, 5]


def test_numbering_sorts_and_shuffles_nothing(spark):
    rows = spark.range(1000).withColumn("v", F.col("id") % 3)
    numbered, n = registers.in_blocks(rows.repartition(5), "key", 11)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert n == 1000 and sorted(r.key for r in numbered.collect()) == list(range(11, 1011))
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan


def test_rebuilds_and_refreshes_keep_keys(spark, tmp_path):
    rows, root = raw_rows(5, rides=120), str(tmp_path / "wh")
    late = {k: v for k, v in rows.items()}
    late["users"], late["drivers"] = rows["users"][8:], rows["drivers"][3:]
    build = lambda r, **o: warehouse.build(frames(spark, r), root, checks="none", **o)
    key = lambda wh: (
        keys_of(wh.dim_user.select("user_id", "user_key")),
        keys_of(wh.dim_driver.select("driver_id", "driver_key")),
    )
    one = key(build(late, durable_keys=True))
    every = key(warehouse.refresh_dimensions(frames(spark, rows), root))
    assert all(every[k].items() >= one[k].items() for k in (0, 1))
    # Dropped and rebuilt with all ids, then with few: the registers are used without being asked for.
    wh = build(rows)
    assert key(wh) == every
    assert wh.fact_rides.join(wh.dim_user, "user_key").count() == wh.fact_rides.count() > 0
    few = rows | {"users": rows["users"][:2]}
    assert key(build(few))[0] == {u: every[0][u] for u in ("u0", "u1")}


def test_bitmaps_lose_no_key(spark):
    held = spark.range(3000).select((F.col("id") * 7 - 500).alias("_range"))
    asked = spark.range(30_000).select(F.col("id").alias("_range"))
    for bits in (20, 10):  # nearly empty, nearly full
        maps = bitmaps.bitmaps(held, "_range", bits)
        kept = bitmaps.may_be_in(asked.withColumnRenamed("_range", "k"), "k", maps, bits)
        found = {r[0] for r in kept.collect()}
        true = {r[0] for r in asked.join(held, "_range", "left_semi").collect()}
        assert found >= true
        assert bits == 10 or len(found - true) < 300
    assert bitmaps.bits_for(0) == 20 and bitmaps.bits_for(1 << 20) == 25 and bitmaps.bits_for(10**12) == 40


def test_uses_of_keys_in_a_batch(spark):
    stored = spark.createDataFrame([(k,) for k in [*range(500), 3, 3, None]], "k long")
    batch = spark.createDataFrame([(k,) for k in [3, 3, 499, 500, 500, -1, None, None] + [7] * 200], "k long")
    store = lambda df: materialize(df, "t")
    maps = bitmaps.bitmaps(stored, "k", 20)
    got = bitmaps.key_uses(batch, stored, "k", maps, 20, store)
    want = [(-1, 1, 0), (3, 2, 3), (7, 200, 1), (499, 1, 1), (500, 2, 0)]
    assert sorted(map(tuple, got.collect())) == want
    # New keys alone: the stored table, here one that can't be read, isn't read.
    broken = stored.select(F.raise_error(F.lit("read")).cast("long").alias("k"))
    new = bitmaps.key_uses(batch.where("k in (500, -1)"), broken, "k", maps, 20, store)
    assert sorted(map(tuple, new.collect())) == [(-1, 1, 0), (500, 2, 0)]
    assert bitmaps.key_uses(batch.limit(0), stored, "k", maps, 20, store).count() == 0


def test_ride_ids_against_loads(spark, tmp_path, monkeypatch):
    rows, root = raw_rows(8, rides=90), str(tmp_path / "wh")
    trips = [r for r in rows["rides"] if "nobody" not in (r[1], r[8])]
    early = {r[0] for r in trips[:50]}
    increment.load_batch(frames(spark, batch_of(rows, early)), root, groups=2)
    batch = rows | {"rides": trips + trips[60:70]}
    uses = lambda: {r[0]: (r[1], r[2]) for r in increment.ride_uses(frames(spark, batch)["rides"], root).collect()}
    want = lambda known: {r[0]: (1 + (60 <= k < 70), int(r[0] in known)) for k, r in enumerate(trips)}
    assert uses() == want(early)
    # A later load adds maps of its own; where places get scarce, all are set anew.
    middle = {r[0] for r in trips[50:55]}
    increment.load_batch(frames(spark, batch_of(rows, middle)), root)
    assert uses() == want(early | middle)
    assert len(glob.glob(f"{root}/ride_bitmaps/maps/version=1/upto=*")) == 2
    rest = {r[0] for r in trips[55:60]}
    increment.load_batch(frames(spark, batch_of(rows, rest)), root)
    covered = spark.read.parquet(f"{root}/ride_bitmaps/covered")
    small = covered.withColumn("bits", F.lit(8))
    materialized = small.collect()
    spark.createDataFrame(materialized, covered.schema).write.mode("overwrite").parquet(f"{root}/ride_bitmaps/covered")
    assert uses() == want(early | middle | rest)
    assert [p.split("=")[-1] for p in glob.glob(f"{root}/ride_bitmaps/maps/version=*")] == ["2"]

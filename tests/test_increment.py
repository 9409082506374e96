"""Loads in batches against one load of everything."""

import glob
import inspect
import os
import random
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from fleetmart.plans import facts, increment, marts, states
from fleetmart.schemas import RAW
from fleetmart.sources import tables

START = datetime(2024, 1, 1)


def raw_rows(seed=1, rides=300, drivers=6):
    """Rides over three months; a third with one driver; some without end, fare, user or driver."""
    rnd = random.Random(seed)
    users = [(f"u{k}", f"Name{k}", f"n{k}@x.org", "1", START.date(), 30, "F", " Rome ") for k in range(20)]
    cars = [(f"v{k}", "make", "model", 2020, 4) for k in range(drivers)]
    people = [(f"d{k}", f"Driver {k % 7}", f"v{k}", None, None, True) for k in range(drivers)]
    trips, stars = [], []
    for k in range(rides):
        driver = "d0" if rnd.random() < 0.33 else f"d{rnd.randrange(drivers)}"
        begin = START + timedelta(minutes=rnd.randrange(80 * 24 * 6) * 10)  # ties in time
        end = None if rnd.random() < 0.05 else begin + timedelta(seconds=rnd.randrange(60, 9000))
        fare = None if rnd.random() < 0.1 else Decimal(rnd.randrange(100, 9000)).scaleb(-2)
        user = "nobody" if rnd.random() < 0.02 else f"u{rnd.randrange(20)}"
        driver = "nobody" if rnd.random() < 0.02 else driver
        trips.append((f"r{k:04}", user, "a", "b", begin, end, Decimal("1.5"), fare, driver))
        if rnd.random() < 0.3:
            stars += [(f"s{k}-{j}", f"r{k:04}", user, rnd.randint(1, 5), None, (begin + timedelta(days=j)).date()) for j in range(2)]
    return {"users": users, "drivers": people, "vehicles": cars, "rides": trips, "ratings": stars}


def frames(spark, rows):
    return {name: spark.createDataFrame(rows[name], RAW[name]) for name in RAW}


def batch_of(rows, ids):
    return rows | {
        "rides": [r for r in rows["rides"] if r[0] in ids],
        "ratings": [r for r in rows["ratings"] if r[1] in ids],
    }


def same(spark, wh, rows):
    """The stored tables equal one load of ``rows``."""
    raw = frames(spark, rows)
    whole = facts.fact_rides(raw["rides"], raw["ratings"], wh.dim_user, wh.dim_driver, wh.dim_date)
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    names = wh.fact_rides.columns
    assert key(wh.fact_rides) == key(whole.select(names))
    days = facts.daily_rides(whole)
    assert key(wh.daily_rides) == key(days.select(wh.daily_rides.columns))
    for kept, made in ((wh.driver_states, states.driver_states), (wh.user_states, states.user_states)):
        fresh = made(whole)
        assert key(kept.select(fresh.columns)) == key(fresh)


def by_time(rows, cuts, seed):
    """Ids in batches by time, of which some come batches later and some batches earlier."""
    rnd = random.Random(seed)
    trips = sorted(rows["rides"], key=lambda r: r[4])
    out = [set() for _ in range(cuts)]
    for k, trip in enumerate(trips):
        at = k * cuts // len(trips)
        if rnd.random() < 0.15:
            at = rnd.randrange(cuts)
        out[at].add(trip[0])
    return out


def test_batches_equal_one_load_after_each(spark, tmp_path):
    rows, root = raw_rows(), str(tmp_path / "wh")
    seen = set()
    for ids in by_time(rows, 3, 2):
        seen |= ids
        wh = increment.load_batch(frames(spark, batch_of(rows, ids)), root, groups=4)
        same(spark, wh, batch_of(rows, seen))
    # The same batch again adds nothing, and the marts read the tables like any others.
    again = increment.load_batch(frames(spark, batch_of(rows, ids)), root)
    same(spark, again, rows)
    assert marts.driver_efficiency(again, more_rides_than=1).count() > 0


def test_reversed_batches_with_hot_driver_months(spark, tmp_path):
    from fleetmart.operators.scale import Limits

    rows, root = raw_rows(7, rides=150), str(tmp_path / "wh")
    for ids in reversed(by_time(rows, 2, 8)):
        wh = increment.load_batch(
            frames(spark, batch_of(rows, ids)), root, groups=2, limits=Limits(hot_rows=8, range_parts=3)
        )
    same(spark, wh, rows)


def test_untouched_parts_are_not_read(spark, tmp_path):
    """Files of other driver groups, and of months without late rides, may be unreadable."""
    rows, root = raw_rows(3, rides=200), str(tmp_path / "wh")
    trips = sorted(rows["rides"], key=lambda r: r[4])
    known = [r for r in trips if r[8] != "nobody" and r[1] != "nobody"]
    late = [r for r in known if r[8] == "d1"][3]
    last = {r[0] for r in known[-5:]}
    first = {r[0] for r in trips} - last - {late[0]}
    wh = increment.load_batch(frames(spark, batch_of(rows, first)), root, groups=4)
    key = wh.dim_driver.where("driver_id = 'd1'").first()["driver_key"]
    at = [r for r in known if r[8] == "d1" and r[4] > late[4]][0][4]
    needed = {f"driver_group={key % 4}/start_month={t.year * 100 + t.month}" for t in (late[4], at)}
    hidden = {}
    for path in glob.glob(f"{root}/fact_parts/*/*/*/*.parquet"):
        if not any(n in path for n in needed):
            hidden[path] = open(path, "rb").read()
            check = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
            if os.path.exists(check):
                hidden[check] = open(check, "rb").read()
            with open(path, "wb") as file:
                file.write(b"not a table")
    assert len(hidden) > 5
    wh = increment.load_batch(frames(spark, batch_of(rows, last | {late[0]})), root)
    for path, data in hidden.items():
        if os.path.exists(path):
            with open(path, "wb") as file:
                file.write(data)
    same(spark, increment.open_batches(spark, root), rows)


def test_a_stopped_load_is_completed(spark, tmp_path, monkeypatch):
    rows, root = raw_rows(4, rides=120), str(tmp_path / "wh")
    one, two = by_time(rows, 2, 5)
    increment.load_batch(frames(spark, batch_of(rows, one)), root, groups=2)
    put, calls = tables.replace_parts, []

    def stop(df, path, parts):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        put(df, path, parts)

    monkeypatch.setattr(tables, "replace_parts", stop)
    with pytest.raises(RuntimeError):
        increment.load_batch(frames(spark, batch_of(rows, two)), root)
    # Before the same batch comes again, what it had computed is put in place.
    monkeypatch.setattr(tables, "replace_parts", put)
    wh = increment.load_batch(frames(spark, batch_of(rows, two)), root)
    same(spark, wh, rows)
    assert sorted(r["load"] for r in spark.read.parquet(f"{root}/loads").collect()) == [1, 2, 3]


def test_empty_batches(spark, tmp_path):
    rows, root = raw_rows(9, rides=30), str(tmp_path / "wh")
    wh = increment.load_batch(frames(spark, rows), root, groups=2)
    again = increment.load_batch(frames(spark, batch_of(rows, set())), root)
    same(spark, again, rows)
    copies = rows | {"rides": rows["rides"] * 2}
    assert increment.load_batch(frames(spark, copies), root).fact_rides.count() == wh.fact_rides.count()


def test_rejected_rows_are_kept_with_their_reasons(spark, tmp_path):
    from fleetmart.plans import warehouse

    rows, root = raw_rows(12, rides=60), str(tmp_path / "wh")
    rows["rides"] = rows["rides"] + rows["rides"][:3] + [(None, *rows["rides"][5][1:])]
    raw = frames(spark, rows)
    good = warehouse.accepted(raw, root)
    held = spark.read.parquet(f"{root}/checked_rides")
    assert held.count() == len(rows["rides"])
    wrong = {r["ride_id"]: r["reasons"] for r in held.where("rejected = 'true'").collect()}
    assert all(wrong[r[0]][-1] == "ride_id key" for r in rows["rides"][:3])
    assert wrong[None] == ["ride_id not_null"]
    lost = {r[0] for r in rows["rides"] if "nobody" in (r[1], r[8])}
    assert lost and all("reference" in " ".join(wrong[i]) for i in lost if i is not None)
    taken = good["rides"].collect()
    assert len(taken) + held.where("rejected = 'true'").count() == len(rows["rides"])
    assert good["rides"].columns == raw["rides"].columns
    assert not {r["ride_id"] for r in taken} & set(wrong)


def test_marts_from_states_read_no_fact(spark, tmp_path):
    rows = raw_rows()
    early = {r[0] for r in rows["rides"][:200]}
    for ids in (early, {r[0] for r in rows["rides"]} - early):
        wh = increment.load_batch(frames(spark, batch_of(rows, ids)), str(tmp_path / "w"), groups=4)
    plain = replace(wh, driver_states=None, user_states=None)
    marts_ = {
        marts.revenue_rank: {},
        marts.quality_tiers: {"least_rides": 1},
        marts.commission: {"by": "driver_key"},
        marts.value_segments: {"by": "user_key", "least_rides": 1},
        marts.quality_trend: {},
        marts.driver_milestones: {"least_rides": 1},
    }
    for mart, arguments in marts_.items():
        known = inspect.signature(mart).parameters
        arguments = {name: value for name, value in arguments.items() if name in known}
        one, other = (mart(w, limit=20, **arguments) for w in (wh, plain))
        assert one.dtypes == other.dtypes
        assert one.count() > 0 and sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
        assert not any("/fact_parts/" in file for file in one.inputFiles())

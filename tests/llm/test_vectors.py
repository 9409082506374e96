"""Nearest neighbours and whitening against plain computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetmart.llm import hnsw, nearest, spectra, whitening
from fleetmart.llm.queries import op12_nearest, op13_whitening

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, rank string, score string, x string, v string"


def vectors_of(spark, rows):
    full = [(i, v, "a", "b", "c", "d") for i, v in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def awkward_vectors():
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=6).astype(np.float32).tolist()) for k in range(120)]
    rows += [(200 + k, rows[7][1]) for k in range(60)]  # copies of one vector, more than k
    rows += [(300, rows[9][1]), (300, rows[9][1])]  # a row that comes twice
    rows += [(400, [1.0, 2.0]), (401, [0.0] * 6), (402, [-0.0] * 6), (403, None), (404, [])]
    rows += [(405, [NAN, 1.0]), (406, [INF, 1.0]), (500, [None, 1.0]), (None, rows[3][1]), (600, [-1.0] * 6)]
    return rows


def plain_nearest(rows, k=10, every=100):
    used = {}
    for i, v in rows:
        if i is None or v is None or any(c is None or not math.isfinite(c) for c in v) or not any(v):
            continue
        used[i] = np.array([*v, *[0.0] * (6 - len(v))], dtype=np.float64)
    out = []
    for q in used:
        if q % every:
            continue
        near = sorted((float(np.sqrt(((used[i] - used[q]) ** 2).sum())), i) for i in used if i != q)
        out += [(q, rank + 1, i, d) for rank, (d, i) in enumerate(near[:k])]
    return sorted(out)


def test_nearest_on_awkward_rows(spark):
    rows = awkward_vectors()
    got = sorted(tuple(r) for r in nearest.nearest(vectors_of(spark, rows)).collect())
    want = plain_nearest(rows)
    # A small shard is walked whole, so the answer is exact.
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=0)


def test_nearest_over_several_shards_and_chunks(spark, monkeypatch):
    rows = awkward_vectors()
    rows += [(100 * k, [float(k), 1.0, k % 7 + 0.5, 0.0, 2.0, -1.0]) for k in range(10, 60)]
    monkeypatch.setattr(nearest, "shard_count", lambda n, width: 5)
    base = nearest.usable(vectors_of(spark, rows), "vec_id", "embedding")
    index = nearest.build_index(base, k=10)
    assert index.count() == 5
    asked = base.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    found = nearest.search_index(index, asked, k=10, width=128, chunk_rows=7)
    got = sorted((r[0], r[1], r[2]) for r in found.collect())
    assert got == [r[:3] for r in plain_nearest(rows)]


def test_nearest_small_tables(spark):
    assert nearest.nearest(vectors_of(spark, [(0, [1.0])]).limit(0)).count() == 0
    assert nearest.nearest(vectors_of(spark, [(0, [1.0, 2.0])])).count() == 0
    two = nearest.nearest(vectors_of(spark, [(0, [1.0, 2.0]), (5, [4.0, 6.0])])).collect()
    assert [tuple(r) for r in two] == [(0, 1, 5, 5.0)]


def test_shards_are_bounded():
    assert nearest.shard_count(0, 64) == 1 and nearest.shard_count(4096, 64) == 1
    assert nearest.shard_count(51_282, 64) == 13
    assert nearest.shard_count(10**6, 64) == 64
    assert nearest.shard_count(10**9, 64) == 15_259
    assert nearest.shard_count(10**6, 4096) == 123  # 8,192 rows of 4,096 numbers


@pytest.mark.parametrize("spread", ["plain", "clustered", "line", "huge"])
def test_graph_recall(spread):
    rng = np.random.default_rng(1)
    n = 3000
    points = rng.normal(size=(n, 24))
    if spread == "clustered":
        points = points * 0.05 + rng.normal(size=(30, 24))[rng.integers(0, 30, n)]
    if spread == "line":
        points = np.outer(np.arange(n), rng.normal(size=24))
    scale = 1e25 if spread == "huge" else 1.0
    points = nearest._small(points * scale, float(np.abs(points * scale).max()))
    levels = -np.sort(-np.minimum(-np.log(1 - rng.random(n)) / np.log(16), 6).astype(int))
    graph = hnsw.build(points, levels)
    again = hnsw.Graph.from_flat(points, *graph.flat)
    queries = points[::30]
    got = again.search(queries, 128)
    away = ((points[None].astype(float) - queries[:, None]) ** 2).sum(axis=2)
    true = np.argsort(away, axis=1, kind="stable")[:, :10]
    hit = np.mean([len(set(a) & set(b[:10])) / 10 for a, b in zip(true.tolist(), got.tolist(), strict=True)])
    assert hit >= 0.95
    for table in graph.links:
        for row in table:
            held = row[row >= 0]
            assert len(set(held)) == len(held)


def test_query_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    used = {r[0]: np.array(r[1], dtype=np.float64) for r in rows}
    got = op12_nearest(spark, SF).collect()
    assert len(got) == 10 * sum(i % 100 == 0 for i in used)
    hits = 0
    for q in (i for i in used if i % 100 == 0):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        near = sorted((float(np.sqrt(((used[i] - used[q]) ** 2).sum())), i) for i in used if i != q)[:10]
        hits += len({i for _, i in near} & {m[1] for m in mine})
        for _, i, score in mine:
            assert abs(score - np.sqrt(((used[i] - used[q]) ** 2).sum())) < 1e-12
    assert hits >= 0.9 * len(got)


def test_rank_one_updates():
    rng = np.random.default_rng(0)
    for _ in range(300):
        m = int(rng.integers(1, 12))
        d = np.sort(rng.choice([0, 0, 1, 1, 2, 3, rng.random()], m).astype(float))
        u = np.linalg.qr(rng.normal(size=(m, m)))[0]
        v = rng.normal(size=m) * rng.choice([1, 1e-9, 1e4, 0], m)
        rho = rng.random() + 0.1
        whole = (u * d) @ u.T + rho * np.outer(v, v)
        values, vectors = spectra.rank_one(d, u, v, rho)
        size = max(1.0, np.abs(whole).max()) * m
        assert np.abs((vectors * values) @ vectors.T - whole).max() < 1e-13 * size
        assert np.abs(vectors.T @ vectors - np.eye(m)).max() < 1e-13 * m
        assert (np.diff(values) >= -1e-13 * size).all()


def test_spectra_merge_to_the_scatter():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(200, 9)) * 40)
    x[:, 3] = x[:, 4]  # without full rank
    whole = spectra.Spectrum.empty(9)
    for part in (x[:1], x[1:50], x[50:50], x[50:]):
        one = spectra.Spectrum.empty(9)
        for row in part:
            one.add(row)
        whole.merge(one)
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    assert whole.n == 200 and np.allclose(whole.mean, x.mean(axis=0))
    assert np.abs((whole.vectors * whole.values) @ whole.vectors.T - scatter).max() < 1e-11 * np.abs(scatter).max()


def plain_whitening(rows, width, components=4):
    usable = [
        (i, [*(math.floor(256 * c) for c in v), *[0] * (width - len(v))])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = np.array(sorted({tuple(x) for _, x in usable}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    cov = np.zeros((width, width))
    centred = fit.astype(float) - (sums / n).astype(float)
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = {i: int(((n * np.array(x, dtype=object) - sums) ** 2).sum()) for i, x in usable}
    white = {i: ((np.array(x, dtype=float) - (sums / n).astype(float)) @ vectors) / np.sqrt(values) for i, x in usable}
    return n, deviation, white, values / np.trace(cov), len(usable)


def held_to_plain(out, rows, width):
    n, deviation, white, explained, usable = plain_whitening(rows, width)
    got = out.collect()
    assert len(got) == 4 * usable
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        i, c = r["vec_id"], r["component"] - 1
        want = white[i][c]
        sign = signs.setdefault(c, 1.0 if want * r["whitened"] >= 0 else -1.0)
        assert abs(sign * r["whitened"] - want) < 1e-7
        assert (r["n"], r["deviation"]) == (n, deviation[i])
        assert abs(r["explained"] / explained[c] - 1) < 1e-9 and r["identity_error"] < 1e-9


def test_whitening_on_awkward_rows(spark):
    rows = awkward_vectors()
    held_to_plain(whitening.whiten(vectors_of(spark, rows), rows_a_task=20), rows, 6)


def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    held_to_plain(op13_whitening(spark, SF), rows, 64)


def test_whitening_without_variance(spark):
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, []), (2, None)])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, [1.0])]).limit(0)).count() == 0
    line = whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0])])).collect()
    assert [(r["vec_id"], r["component"]) for r in sorted(line)] == [(1, 1), (2, 1), (2, 1)]
    assert all(abs(abs(r["whitened"]) - 1) < 1e-12 and abs(r["explained"] - 1) < 1e-12 for r in line)


def test_whitening_beyond_64_bits(spark):
    rows = [(k, [float(2.0 ** (40 + k)), 1.0]) for k in range(5)]
    out = whitening.whiten(vectors_of(spark, rows)).collect()
    assert out and all(r["deviation"] is None for r in out)

"""Exact top-k search by inner product over blocks of vectors, with block maxima as bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.common import map_batches, stored

_EXACT = float(1 << 53)
_LOWEST = np.int64(-(1 << 63))
_TASKS = 20_000  # at most, at any size
_ASKED = 2048  # queries whose bounds are held at once


def weights(vectors: DataFrame, vec_id: str, embedding: str, scale: int = 1024) -> DataFrame:
    """(vec_id, terms): floor(scale * x) of every component.

    Rows whose id or vector is null, or whose vector holds a null or non-finite component,
    take no part. Components beyond 64 bits saturate, as a Spark cast does.
    """
    x = F.col(embedding)
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return vectors.where(
        F.col(vec_id).isNotNull() & x.isNotNull() & ~F.exists(x, lambda v: F.coalesce(bad(v), F.lit(True)))
    ).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("terms"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up to ``width`` with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _comparable(terms: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where every partial sum of a product fits 53 bits, else as they are."""
    most = float(np.abs(terms).max(initial=0)) * float(np.abs(queries).max(initial=0))
    if most * max(1, terms.shape[1]) < _EXACT:
        return terms.astype(np.float64), queries.astype(np.float64)
    return terms, queries


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= cut)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search_segment(
    ids: np.ndarray,
    terms: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    k: int,
    block: int,
    floors: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score) of each query's k best rows of one segment, as three arrays.

    The segment's rows lie in blocks. A block's bound for a query sums, term by term, the
    query's weight times the block's largest (for negative weights: smallest) value. Each
    query visits blocks by falling bound and scores a block's rows through its forward
    index, until the next bound is below its k-th score. ``floors`` are k-th scores that
    queries bring along: rows below them are left out, blocks below them never visited.
    """
    terms, queries = _comparable(terms, queries)
    cuts = np.arange(0, len(ids), block)
    high = np.maximum.reduceat(terms, cuts, axis=0)
    low = np.minimum.reduceat(terms, cuts, axis=0)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    lowest = np.full(len(query_ids), _LOWEST) if floors is None else floors
    kth = lowest.astype(bounds.dtype)
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    active = np.arange(len(query_ids))
    for step in range(len(cuts)):
        active = active[bounds[active, order[active, step]] >= kth[active]]
        if not len(active):
            break
        at = order[active, step]
        together = np.argsort(at, kind="stable")  # queries at the same block are scored together
        for who in np.split(active[together], np.flatnonzero(np.diff(at[together])) + 1):
            start = cuts[order[who[0], step]]
            rows = slice(start, start + block)
            scores = queries[who] @ terms[rows].T
            hits = (scores >= kth[who][:, None]) & (ids[rows] != query_ids[who][:, None])
            for j in np.flatnonzero(hits.any(axis=1)):
                q, new = who[j], (ids[rows][hits[j]], scores[j][hits[j]])
                i, s = (np.concatenate(x) for x in zip(found[q], new)) if q in found else new
                keep = _best(s, i, k)
                found[q] = i[keep], s[keep]
                if len(keep) == k:
                    kth[q] = max(kth[q], s[keep[-1]])
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    sizes = [len(i) for i, _ in found.values()]
    return (
        np.repeat(query_ids[list(found)], sizes),
        np.concatenate([i for i, _ in found.values()]),
        np.concatenate([s for _, s in found.values()]).astype(np.int64),
    )


def unit_sizes(rows: int, queries: int, width: int, values: int = 1 << 22) -> tuple[int, int, int]:
    """Rows of a segment, chunks of queries, tasks at most.

    64 segments of 1,024 rows or more, until a segment holds ``values`` components; then more
    segments. A chunk holds as many components. Larger halves of a unit mean fewer copies of
    each vector; the copies grow with rows * queries / halves, as the work itself does.
    """
    most = max(64, values // max(1, width))
    segment = min(most, max(1024, -(-rows // 64)))
    chunks = max(1, -(-queries // most))
    return segment, chunks, min(_TASKS, max(1, 2 * -(-rows // segment)) * chunks)


def _placed_sides(counts: list[tuple[int, int]], segment_rows: int) -> tuple[list[tuple[int, int, int]], int]:
    """(side, first segment, segments) of each side, and the number of segments.

    A side larger than a segment has segments of its own; smaller ones share, in order.
    """
    out, number, room = [], 0, 0
    for side, n in sorted(counts):
        if n > segment_rows:
            parts = -(-n // segment_rows)
            out.append((side, number, parts))
            number, room = number + parts, 0
            continue
        if n > room:
            number, room = number + 1, segment_rows
        out.append((side, number - 1, 1))
        room -= n
    return out, max(1, number)


def _scored(units: DataFrame, k: int, block: int, every: int | None) -> DataFrame:
    """(query_id, vec_id, score) of units that lie together, each in the order of its blocks.

    With ``every`` the queries of a unit are its own rows of such ids.
    """

    def answers(parts):
        whole = pa.Table.from_batches(parts).combine_chunks()
        lengths = whole.column("terms").combine_chunks().value_lengths()
        terms = _matrix(whole.column("terms"), max(lengths.to_pylist()))
        ids = whole.column("vec_id").to_numpy()
        if every is None:
            asks = whole.column("is_query").to_numpy()
            data, floors = ~asks, whole.column("floor").to_numpy()[asks]
        else:
            asks, data = ids % every == 0, np.ones(len(ids), dtype=bool)
            floors = np.full(int(asks.sum()), _LOWEST)
        if not asks.any() or not data.any():
            return
        held, rows, who, asked = ids[data], terms[data], ids[asks], terms[asks]
        for a in range(0, len(who), _ASKED):
            part = slice(a, a + _ASKED)
            got = search_segment(held, rows, who[part], asked[part], k, block, floors[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=pa.int64()) for x in got], names=["query_id", "vec_id", "score"]
            )

    def run(batches):
        unit, parts = None, []
        for batch in batches:
            units_of = batch.column("unit").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(units_of)) + 1).tolist(), len(units_of)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b == a:
                    continue
                if parts and units_of[a] != unit:
                    yield from answers(parts)
                    parts = []
                unit = units_of[a]
                parts.append(batch.slice(a, b - a))
        if parts:
            yield from answers(parts)

    return map_batches(units, run, "query_id long, vec_id long, score long", 4096)


def top_k(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    *,
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    values: int = 1 << 22,
    block: int = 64,
) -> DataFrame:
    """Exact top-k: each row whose id is divisible by ``every`` against all other rows.

    Returns (query_id, rank from 1, vec_id, score), ties to the smaller vec_id.

    A row's side is its strongest term with its sign. Segments hold rows of few sides, in
    blocks by side and strength, so that a block holds rows of like direction. First each
    query searches the segment it lies in, which moves every vector once; the k-th scores
    of that go along when it meets the other segments, where blocks below are not scored and
    rows below not returned. Queries are cut into chunks; each (segment, chunk) pair is one
    unit of work, whose halves hold about ``values`` components. Units are dealt evenly to a
    number of tasks with an upper bound. The driver holds the number of rows by side, two
    numbers for each component of a vector.

    Ids are meant to be unique: of rows that repeat both id and vector one takes part, and
    a row never finds a row of its own id. Vectors of other lengths count as filled up with
    zeros. An empty table gives no rows.
    """
    base = weights(vectors, vec_id, embedding, scale).distinct()
    size = F.transform("terms", lambda v: F.abs(v))
    base = base.withColumn("peak", F.coalesce(F.array_max(size), F.lit(0)))
    strongest = F.array_position(size, F.col("peak")).cast("int")
    base = stored(
        base.withColumn(
            "side",
            F.when(F.size("terms") == 0, 0)
            .when(F.element_at("terms", F.greatest(strongest, F.lit(1))) < 0, -strongest)
            .otherwise(strongest),
        ),
        "vectors",
    )
    is_query = F.col("vec_id") % every == 0
    sides = base.groupBy("side").agg(
        F.count("*").alias("n"), F.count_if(is_query).alias("q"), F.max(F.size("terms")).alias("w")
    ).collect()
    n, queries = sum(r["n"] for r in sides), sum(r["q"] for r in sides)
    width = max((r["w"] for r in sides), default=0)
    segment_rows, chunks, tasks = unit_sizes(n, queries, width, values)
    places, segments = _placed_sides([(r["side"], r["n"]) for r in sides], segment_rows)

    spark = vectors.sparkSession
    of_side = spark.createDataFrame(places, "side int, first long, parts long")
    laid = base.join(F.broadcast(of_side), "side").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id", "terms"), F.col("parts"))).alias("segment"),
        "side", "peak", "vec_id", "terms",
    )
    order = ["side", F.col("peak").desc(), "vec_id"]

    def dealt(df: DataFrame, number: int) -> DataFrame:
        return df.repartitionById(number, F.pmod("unit", F.lit(number)).cast("int"))

    own = dealt(laid.withColumnRenamed("segment", "unit"), min(_TASKS, segments))
    first = stored(_scored(own.sortWithinPartitions("unit", *order), k, block, every), "own-segment")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.withColumn("rank", F.row_number().over(best))
    floors = ranked.where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("floor")
    )

    data = laid.select(
        "segment",
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        F.lit(False).alias("is_query"),
        F.lit(int(_LOWEST)).alias("floor"),
        "side", "peak", "vec_id", "terms",
    )
    others = F.sequence(F.lit(0).cast("long"), F.lit(segments - 1).cast("long"))
    asked = (
        laid.where(is_query)
        .join(floors, "vec_id", "left")
        .select(
            F.explode(F.filter(others, lambda s: s != F.col("segment"))).alias("segment"),
            F.pmod(F.xxhash64(F.lit(3), "vec_id", "terms"), F.lit(chunks)).cast("int").alias("chunk"),
            F.lit(True).alias("is_query"),
            F.coalesce("floor", F.lit(int(_LOWEST))).alias("floor"),
            "side", "peak", "vec_id", "terms",
        )
    )
    units = data.unionByName(asked).withColumn("unit", F.col("segment") * chunks + F.col("chunk"))
    units = dealt(units, min(tasks, segments * chunks)).sortWithinPartitions("unit", "is_query", *order)
    found = first.unionByName(_scored(units, k, block, None))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

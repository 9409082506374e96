"""Approximate nearest neighbours: one small-world graph a shard, results merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.common import stored
from fleetmart.llm.hnsw import Graph, build
from fleetmart.llm.whitening import finite_vector

_INDEX = (
    "shard int, vecs array<double>, ids array<long>, copies array<int>, "
    "links array<int>, counts array<int>, columns array<int>"
)
_FOUND = "query_id long, vec_id long, score double"


def shard_count(vectors: int, width: int) -> int:
    """Shards for so many vectors: 64 of 4,096 to 65,536 rows, then more, of 2**25 numbers at most."""
    rows = min(65_536, max(4_096, -(-vectors // 64)), max(256, (1 << 25) // max(1, width)))
    return max(1, -(-vectors // rows))


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): doubles, of one length, without rows that take no part."""
    x = F.transform(embedding, lambda c: c.cast("double") + F.lit(0.0))  # no negative zeros
    kept = vectors.where(
        F.col(vec_id).isNotNull()
        & finite_vector(F.col(embedding))
        & F.exists(embedding, lambda c: c != F.lit(0))
    ).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("v"))
    base = stored(kept.distinct(), "vectors")
    least, most = base.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if least == most:
        return base
    zeros = F.array_repeat(F.lit(0.0), F.lit(most) - F.size("v"))
    return stored(base.withColumn("v", F.concat("v", zeros)).distinct(), "filled")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _small(points: np.ndarray, most: float) -> np.ndarray:
    """Single precision for the walk; scaled, so that squares stay in range."""
    return (points / (most or 1.0)).astype(np.float32)


def build_index(base: DataFrame, *, k: int, links: int = 16, width: int = 64) -> DataFrame:
    """A row for each shard: its vectors, their ids, and its graph as flat neighbour arrays.

    Equal vectors are one node with the k + 1 smallest of their ids: no answer of ``k`` rows
    needs more. Levels and order of insertion come from a hash of the vector.
    """
    spread = F.xxhash64("v")
    smallest = Window.partitionBy("v").orderBy("vec_id")
    nodes = stored(
        base.withColumn("place", F.row_number().over(smallest))
        .where(F.col("place") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("hash", spread),
        "nodes",
    )
    number, size = nodes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    shards = shard_count(number, size or 0)
    slope = float(np.log(links))

    def make(key, table):
        hashes = table.column("hash").to_numpy()
        chance = ((hashes >> 11) & ((1 << 40) - 1)).astype(np.float64)
        levels = np.minimum(-np.log((chance + 1) / (1 << 40)) / slope, 12).astype(np.int64)
        order = np.lexsort((hashes, -levels))
        vectors = _matrix(table.column("v"))[order]
        graph = build(
            _small(vectors, float(np.abs(vectors).max())), levels[order], links=links, width=width
        )
        flat, counts, columns = graph.flat
        ids = table.column("ids").combine_chunks().take(pa.array(order))
        copies = ids.value_lengths().to_numpy()
        arrays = [
            pa.array([key[0].as_py()], pa.int32()),
            *(
                pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
                for x, kind in (
                    (vectors.ravel(), pa.float64()),
                    (ids.flatten().to_numpy(zero_copy_only=False), pa.int64()),
                    (copies, pa.int32()),
                    (flat, pa.int32()),
                    (counts, pa.int32()),
                    (columns, pa.int32()),
                )
            ),
        ]
        return pa.Table.from_arrays(arrays, names=[f.split()[0] for f in _INDEX.split(", ")])

    shard = F.pmod("hash", F.lit(shards)).cast("int").alias("shard")
    return stored(nodes.groupBy(shard).applyInArrow(make, _INDEX), "index")


def _answers(index: pa.Table, asked: pa.Table, k: int, width: int) -> pa.Table:
    """The k best rows of one shard for each query, by exact distance, then id."""
    arrays = ("vecs", "ids", "copies", "links", "counts", "columns")
    row = {name: index.column(name).combine_chunks().flatten() for name in arrays}
    copies = row["copies"].to_numpy()
    points = row["vecs"].to_numpy(zero_copy_only=False).reshape(len(copies), -1)
    ids, first = row["ids"].to_numpy(), np.concatenate([[0], np.cumsum(copies)])
    most = float(np.abs(points).max())
    graph = Graph.from_flat(
        _small(points, most), row["links"].to_numpy(), row["counts"].to_pylist(), row["columns"].to_pylist()
    )
    own, queries = asked.column("query_id").to_numpy(), _matrix(asked.column("q"))
    out = []
    for part in range(0, len(own), 512):
        some = queries[part : part + 512]
        nodes = graph.search(_small(some, most), width)
        query, place = np.nonzero(nodes >= 0)
        node = nodes[query, place]
        away = points[node] - some[query]
        score = np.sqrt((away * away).sum(axis=1))
        many = copies[node]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        found = ids[np.repeat(first[node], many) + at]
        query, score = np.repeat(query, many), np.repeat(score, many)
        other = found != own[part + query]
        query, score, found = query[other], score[other], found[other]
        order = np.lexsort((found, score, query))
        query, score, found = query[order], score[order], found[order]
        begin = np.searchsorted(query, query)
        keep = np.arange(len(query)) - begin < k
        out.append((own[part + query[keep]], found[keep], score[keep]))
    columns = [np.concatenate([x[c] for x in out]) for c in range(3)]
    return pa.table([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])


def search_index(
    index: DataFrame, queries: DataFrame, *, k: int, width: int, chunk_rows: int = 65_536
) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of the ``k`` nearest rows found for each query.

    ``queries`` has (query_id, q) and is a stored frame. Every shard is walked for every query,
    in units of one shard and about ``chunk_rows`` queries; the walks keep ``width`` nodes,
    whose distances are then taken in double precision on the original vectors.
    """
    chunks = max(1, -(-queries.count() // chunk_rows))
    last = index.agg(F.max("shard")).first()[0]
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n)))
    cut = F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int")
    asked = queries.select("query_id", "q", cut.alias("chunk"), number(last or 0).alias("shard"))
    walked = index.select("*", number(chunks - 1).alias("chunk"))

    def answer(key, shard, asks):
        if not shard.num_rows or not asks.num_rows:
            none = [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())]
            return pa.table(none, names=["query_id", "vec_id", "score"])
        return _answers(shard, asks, k, width)

    found = (
        walked.groupBy("shard", "chunk")
        .cogroup(asked.groupBy("shard", "chunk"))
        .applyInArrow(answer, _FOUND)
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    *,
    k: int = 10,
    every: int = 100,
    links: int = 16,
    build_width: int = 64,
    width: int = 128,
) -> DataFrame:
    """The ``k`` nearest rows found for each row whose id is divisible by ``every``.

    Returns (query_id, rank from 1, vec_id, score): Euclidean distance in double precision,
    nearest first, ties to the smaller vec_id. Every row is indexed. Shards grow from 4,096
    to 65,536 vectors, each has a graph of its own, and a walk keeps ``width`` vectors, so the
    answer is approximate within a shard (``width`` of a shard's size or more makes it exact)
    and complete over shards.

    Rows whose id or vector is null, whose vector is zero or holds null or non-finite
    components take no part. Equal vectors are one node, so copies neither crowd a graph nor
    get lost; a row that repeats id and vector takes part once. Ids are meant to be unique; a
    row never finds a row of its own id. Vectors of other lengths count as filled up with
    zeros. An empty table gives no rows, a table of one row none for it.
    """
    base = usable(vectors, vec_id, embedding)
    index = build_index(base, k=k, links=links, width=build_width)
    asked = base.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q")
    )
    return search_index(index, asked, k=k, width=max(width, k + 1))

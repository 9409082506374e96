"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of contraction; ``edges`` (a, b) with a < b, each once.

    Large: every node links its larger neighbours to its smallest one. Small: every node
    links its smaller neighbours, and itself, to the smallest of them.
    """
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    low = stored(near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "lowest")
    met = near.join(low, "a")
    if large:
        out = met.where("b > a").select(F.col("low").alias("a"), "b")
    else:
        out = met.select(F.col("low").alias("a"), "b").unionByName(
            low.select(F.col("low").alias("a"), F.col("a").alias("b"))
        )
    return out.where("a < b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is its component's smallest node.

    Alternates large and small stars until nothing changes; each round is a stored table,
    and one number of it reaches the driver. Nodes may be of any ordered type.
    """
    now = stored(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = None
    for _ in range(rounds):
        after = stored(_star(_star(now, True), False), "edges")
        seen = after.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        now = after
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )

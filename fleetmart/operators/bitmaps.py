"""Bitmaps of keys: most values are known to be absent without reading the table that holds them.

A key's hash sets one of 2**bits places, kept as rows of 4 KB by range of places. A key whose
place isn't set is not among the keys; one whose place is set may be, and must be looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a bitmap that is broadcast: at most 2,048 rows of 4 KB.
SMALL = 26


def bits_for(rows: int, least: int = 20, most: int = 40) -> int:
    """Bits at which ``rows`` keys set at most one place in 32."""
    return min(most, max(least, (32 * max(1, rows) - 1).bit_length()))


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def bitmaps(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(_range, _map) of the values of ``key`` that aren't NULL; copies meet map-side."""
    placed = keys.where(F.col(key).isNotNull()).select(_place(key, bits).alias("_place"))
    return placed.groupBy(F.expr("bitmap_bucket_number(_place)").alias("_range")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(_place))").alias("_map")
    )


def may_be_in(df: DataFrame, key: str, maps: DataFrame, bits: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among the keys of ``maps``, by its range of places.

    ``maps`` may hold several maps of a range; a row comes once for each that has its place.
    """
    placed = df.withColumn("_place", _place(key, bits))
    placed = placed.withColumn("_range", F.expr("bitmap_bucket_number(_place)"))
    placed = placed.withColumn("_bit", F.expr("bitmap_bit_position(_place)"))
    byte = "cast(conv(hex(substring(_map, cast(_bit div 8 + 1 as int), 1)), 16, 10) as int)"
    is_set = F.expr(f"shiftright({byte}, cast(_bit % 8 as int)) & 1 = 1")
    return placed.join(maps.select("_range", "_map"), "_range").where(is_set).select(*df.columns)


def key_uses(batch: DataFrame, stored: DataFrame, key: str, maps: DataFrame, bits: int, store) -> DataFrame:
    """(key, n_batch, n_stored): how often each key of ``batch`` occurs there and in ``stored``.

    ``maps`` are bitmaps of at least all keys of ``stored``. The batch is counted by key, and
    its keys alone meet the maps. Of ``stored`` one column is read, and only if keys may be in
    it; a small bitmap of those, broadcast, drops its other rows in the scan, so that only rows
    with keys of the batch are counted and shuffled. ``store`` writes a frame down.
    """
    counted = store(
        batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_batch"))
    )
    hits = store(may_be_in(counted.select(key), key, maps, bits).distinct())
    if hits.isEmpty():
        return counted.withColumn("n_stored", F.lit(0).cast("bigint"))
    small = F.broadcast(bitmaps(hits, key, SMALL))
    there = may_be_in(stored.select(key), key, small, SMALL)
    found = there.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counted.join(found, key, "left").select(
        key, "n_batch", F.coalesce("_n", F.lit(0)).alias("n_stored")
    )

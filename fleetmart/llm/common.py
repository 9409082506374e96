"""Helpers shared by the operators: stored steps, batches of texts, hashed words."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.operators.scale import materialize, remove, scratch_dir

BATCH_BYTES = 1 << 20
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDERS: ContextVar[tuple[str, ...]] = ContextVar("folders", default=())


@contextmanager
def steps(spark: SparkSession) -> Iterator[None]:
    """What is ``stored`` inside goes at the end; results must be stored with ``keep``."""
    folder = f"{scratch_dir(spark)}/steps-{uuid.uuid4().hex}"
    token = _FOLDERS.set((*_FOLDERS.get(), folder))
    try:
        yield
    finally:
        _FOLDERS.reset(token)
        remove(spark, folder)


def stored(df: DataFrame, label: str, *, keep: bool = False) -> DataFrame:
    """``df`` written once below spark.checkpoint.dir and read back: its lineage is cut.

    Within ``steps`` it goes with them; ``keep`` stores it where these steps leave it.
    """
    folders = _FOLDERS.get()[:-1] if keep else _FOLDERS.get()
    return materialize(df, label, folders[-1] if folders else None)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while f"_{name}" in taken:
            name += "_"
        out.append(f"_{name}")
    return out


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """Each row of ``df`` as one struct ``_row`` beside ``columns``: no name can clash."""
    return df.select(
        F.struct("*").alias("_row"), *(value.alias(name) for name, value in columns.items())
    )


def unpacked(df: DataFrame, like: DataFrame, **changed: Column) -> DataFrame:
    """The rows of ``packed`` again, with ``changed`` columns, in the order of ``like``."""
    return df.select(
        *(
            changed.get(name, F.col("_row").getField(name)).alias(name)
            for name in like.columns
        )
    )


def map_batches(df: DataFrame, function: Callable, schema: str, rows: int = 512) -> DataFrame:
    """``mapInArrow`` in batches of at most ``rows`` rows, so that long texts fit a worker.

    The session's own batch size stands where it is smaller.
    """
    spark = df.sparkSession
    if int(spark.conf.get(ARROW_ROWS)) > rows or int(spark.conf.get(ARROW_ROWS)) <= 0:
        spark.conf.set(ARROW_ROWS, str(rows))
    return df.mapInArrow(function, schema)


def text_slices(
    batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cuts of ``batch`` with about ``limit`` characters of text each; a longer text is one cut."""
    sizes = np.asarray(
        [len(x) if x is not None else 0 for x in batch.column(column).to_pylist()], dtype=np.int64
    )
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from its values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def possible(
    df: DataFrame, column: str, keys: DataFrame, *, bits: int = 26, inverse: bool = False
) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among ``keys`` (a column of that name).

    All keys are set in one bitmap of 2**bits places, broadcast as rows of 4 KB: 8 MB at
    most, however many keys there are. It lets false positives through and loses nothing,
    so an exact join must follow; it spares that join the shuffle of the other rows.
    ``inverse`` gives the rows that are surely not among them.
    """
    slots = F.pmod(F.xxhash64(column), F.lit(1 << bits))
    slot, at, part, bitmap = fresh(df, "slot", "at", "part", "map")
    maps = (
        keys.select(slots.alias(slot))
        .groupBy(F.expr(f"bitmap_bucket_number({slot})").alias(part))
        .agg(F.expr(f"bitmap_construct_agg(bitmap_bit_position({slot}))").alias(bitmap))
    )
    marked = df.withColumn(slot, slots).withColumn(at, F.expr(f"bitmap_bit_position({slot})"))
    bit = F.expr(
        f"shiftright(cast(conv(hex(substring({bitmap}, cast({at} div 8 + 1 as int), 1)), 16, 10)"
        f" as int), cast({at} % 8 as int)) & 1 = 1"
    )
    here = F.expr(f"bitmap_bucket_number({slot})") == F.col(part)
    found = marked.join(F.broadcast(maps), here, "left" if inverse else "inner")
    return found.where(~F.coalesce(bit, F.lit(False)) if inverse else bit).select(
        *(F.col(f"`{name}`") for name in df.columns)
    )


def text_key(text: Column | str = "text") -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(column).alias("h1"), F.xxhash64(F.lit(7), column).alias("h2")


# Hashing of words and word n-grams, over whole batches with numpy.

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS = np.cumprod(np.full(_CHUNK, _BASE, dtype=np.uint64))
_INVERSE = np.cumprod(np.full(_CHUNK, pow(_BASE, -1, 1 << 64), dtype=np.uint64))


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of data[start:end], mixed with the length."""
    out = np.empty(len(starts), dtype=np.uint64)
    k = 0
    while k < len(starts):
        at = starts[k]
        stop = max(int(np.searchsorted(ends, at + _CHUNK, side="right")), k + 1)
        size = int(ends[stop - 1] - at)
        if size > _CHUNK:  # one word longer than a chunk
            value = np.uint64(0)
            for piece in range(0, size, _CHUNK):
                part = data[at + piece : min(at + piece + _CHUNK, ends[k])]
                value = mixed(
                    np.array([value + (_BYTES[part] * _POWERS[: len(part)]).sum()], dtype=np.uint64)
                )[0]
            out[k] = value
        else:
            sums = np.zeros(size + 1, dtype=np.uint64)
            part = data[at : at + size]
            np.cumsum(_BYTES[part] * _POWERS[:size], out=sums[1:])
            s, e = starts[k:stop] - at, ends[k:stop] - at
            out[k:stop] = (sums[e] - sums[s]) * _INVERSE[np.minimum(s, _CHUNK - 1)]
        k = stop
    return mixed(out ^ (ends - starts).astype(np.uint64))


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column (null: none).

    Returns the bytes, the starts and ends of all words in them, the words' hashes, and
    for each row the index of its first word (one entry more than rows).
    """
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    if len(column) == 0:
        offsets = np.zeros(1, dtype=np.int64)
    data = (
        np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        if column.buffers()[2] is not None
        else np.zeros(0, dtype=np.uint8)
    )
    offsets = offsets - offsets[0]
    space = np.concatenate([[True], _SPACE[data], [True]])
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    inside = ~space[1:-1]
    starts = np.flatnonzero(inside & (space[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside & (space[2:] | edge[1:])) + 1
    return data, starts, ends, _hash_words(data, starts, ends), np.searchsorted(starts, offsets)


def ngrams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every row's word n-grams, and the index of each row's first one.

    A row of fewer than n words has one n-gram, of all its words; one without words none.
    """
    counts = np.diff(first)
    grams = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    begins = np.concatenate([[0], np.cumsum(grams)]).astype(np.int64)
    if begins[-1] == 0:
        return np.zeros(0, dtype=np.uint64), begins
    row = np.repeat(np.arange(len(counts)), grams)
    at = np.arange(begins[-1]) - begins[row] + first[row]
    left = first[1:][row] - at
    value = np.zeros(begins[-1], dtype=np.uint64)
    for k in range(n):
        word = hashes[np.minimum(at + k, len(hashes) - 1)]
        value = mixed(value * np.uint64(31) + np.where(k < left, word, np.uint64(k + 1)))
    return value, begins

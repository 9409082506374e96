"""Whitening of integer-scaled embeddings by an incremental eigendecomposition."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.common import map_batches, stored
from fleetmart.llm.spectra import Spectrum

_MOST = (1 << 63) - 1
_FAN_IN = 16
_SPECTRUM = (
    "part int, n long, sums array<decimal(38,0)>, mean array<double>, "
    "vals array<double>, vecs array<double>"
)


def finite_vector(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one width."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(x: np.ndarray) -> list[int]:
    """Exact sums of each column of integers."""
    if len(x) and float(np.abs(x.astype(np.float64)).max(initial=0.0)) * len(x) >= 2.0**62:
        return [int(v) for v in x.astype(object).sum(axis=0)]
    return [int(v) for v in x.sum(axis=0)]


def _spectrum_batch(part: int, spectrum: Spectrum, sums: list[int]) -> pa.RecordBatch:
    decimals = pa.list_(pa.decimal128(38, 0))
    doubles = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([spectrum.n], pa.int64()),
            pa.array([sums], decimals),
            pa.array([spectrum.mean], doubles),
            pa.array([spectrum.values], doubles),
            pa.array([spectrum.vectors.ravel()], doubles),
        ],
        names=["part", "n", "sums", "mean", "vals", "vecs"],
    )


def _spectrum_of(row: dict) -> tuple[Spectrum, list[int]]:
    mean = np.asarray(row["mean"], dtype=np.float64)
    vectors = np.asarray(row["vecs"], dtype=np.float64).reshape(len(mean), len(mean))
    values = np.asarray(row["vals"], dtype=np.float64)
    return Spectrum(row["n"], mean, values, vectors), [int(v) for v in row["sums"]]


def part_spectra(fit: DataFrame, width: int, tasks: int) -> DataFrame:
    """One spectrum a task: its vectors added one by one as centred rank-one updates."""

    def run(batches):
        spectrum, sums = Spectrum.empty(width), [0] * width
        for batch in batches:
            x = _matrix(batch.column("x"))
            sums = [a + b for a, b in zip(sums, _sums(x), strict=True)]
            for row in x.astype(np.float64):
                spectrum.add(row)
        if spectrum.n:
            yield _spectrum_batch(TaskContext.get().partitionId(), spectrum, sums)

    dealt = fit.select("x").repartition(tasks, F.xxhash64("x"))
    return map_batches(dealt, run, _SPECTRUM, 4096)


def merged_spectrum(parts: DataFrame) -> tuple[Spectrum, list[int]] | None:
    """All spectra as one, by a tree of merges of at most 16 each; one row reaches the driver."""

    def combine(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        spectrum, sums = _spectrum_of(rows[0])
        for row in rows[1:]:
            other, more = _spectrum_of(row)
            spectrum.merge(other)
            sums = [a + b for a, b in zip(sums, more, strict=True)]
        return pa.Table.from_batches([_spectrum_batch(key[0].as_py(), spectrum, sums)])

    parts = stored(parts, "spectra")
    last = parts.agg(F.max("part")).first()[0]
    if last is None:
        return None
    while last:
        group = F.expr(f"part div {_FAN_IN}").cast("int").alias("group")
        parts = stored(parts.groupBy(group).applyInArrow(combine, _SPECTRUM), "spectra")
        last //= _FAN_IN
    return _spectrum_of(parts.first().asDict(recursive=True))


def second_moments(fit: DataFrame, basis: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Sum of outer products of (x - mean) @ basis over all vectors, added up on Spark."""
    size = basis.shape[1]

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            y = (_matrix(batch.column("x")) - mean) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size * size), pa.int64()), pa.array(total.ravel())],
            names=["at", "value"],
        )

    cells = map_batches(fit.select("x"), run, "at long, value double", 4096)
    found = cells.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size * size)
    out[found.column("at").to_numpy()] = found.column("value").to_numpy()
    return out.reshape(size, size)


@dataclass(frozen=True)
class Whitener:
    """Fitted on ``n`` vectors with exact ``sums``: columns of ``vectors`` are components.

    ``values`` are their variances, falling; ``total`` is the variance of all dimensions and
    ``identity_error`` the largest entry by which the whitened covariance misses the identity.
    """

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    total: float
    identity_error: float


def fit_whitener(fit: DataFrame, width: int, components: int, *, rows_a_task: int = 4096) -> Whitener | None:
    """Components of the rows ``x`` (integer arrays of ``width``) of ``fit``, a stored frame.

    Tasks add their rows to spectra, whose merge gives an approximate basis; Rayleigh-Ritz
    in that basis, with its second moments taken over all rows, gives the final components.
    Components without variance (at most 1e-12 of the largest) are left out.
    """
    rows = fit.count()
    if not rows or not width:
        return None
    tasks = max(1, min(10_000, -(-rows // rows_a_task)))
    spectrum, sums = merged_spectrum(part_spectra(fit, width, tasks))
    n = spectrum.n
    mean = np.asarray([s / n for s in sums])
    basis = np.linalg.qr(spectrum.vectors)[0]
    # The basis spans all dimensions, so one projection is exact however far the merge was off.
    moments = second_moments(fit, basis, mean) / n
    values, turn = np.linalg.eigh((moments + moments.T) / 2)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    some = int((values[:components] > 1e-12 * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    values, vectors = values[:some], vectors[:, :some]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(some)])
    error = 0.0
    if some:
        white = second_moments(fit, vectors / np.sqrt(values), mean) / n
        error = float(np.abs(white - np.eye(some)).max())
    return Whitener(n, sums, mean, values, vectors, float(np.trace(moments)), error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)**2, exactly; None where it needs over 64 bits."""
    most = n * int(np.abs(x.astype(object)).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if most * most * max(1, x.shape[1]) <= _MOST:
        away = n * x - np.asarray(sums, dtype=np.int64)
        return (away * away).sum(axis=1).tolist()
    away = n * x.astype(object) - np.asarray(sums, dtype=object)
    return [int(v) if v <= _MOST else None for v in (away * away).sum(axis=1)]


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    *,
    scale: int = 256,
    components: int = 4,
    rows_a_task: int = 4096,
) -> DataFrame:
    """Whitened first components of x = floor(scale * vector), one row a vector and component.

    Returns (vec_id, component from 1, n, deviation, whitened, explained, identity_error):
    the mean and the components are those of the distinct x vectors, n of them with sums S;
    deviation is the sum over dimensions of (n * x - S)**2, null beyond 64 bits. Signs put
    the largest entry of a component above 0.

    Rows whose vector is null or holds null or non-finite components take no part; repeated
    rows and null ids come out like others. Vectors of other lengths count as filled up with
    zeros; components beyond 64 bits saturate. Components without variance are left out, so
    a table with one distinct vector, of empty vectors, or an empty one gives no rows.

    The driver holds a few matrices of width x width, whatever the number of rows.
    """
    kept = vectors.where(finite_vector(F.col(embedding))).select(
        F.col(vec_id).alias("vec_id"),
        F.transform(embedding, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("x"),
    )
    base = stored(kept, "scaled")
    least, width = base.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if width is not None and least != width:
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
        base = stored(base.withColumn("x", F.concat("x", zeros)), "filled")
    fit = stored(base.select("x").distinct(), "fit")
    fitted = fit_whitener(fit, width or 0, components, rows_a_task=rows_a_task)
    id_type = base.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {id_type}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    if fitted is None or not len(fitted.values):
        return base.sparkSession.createDataFrame([], schema)
    n, sums, mean, error = fitted.n, fitted.sums, fitted.mean, fitted.identity_error
    onto = fitted.vectors / np.sqrt(fitted.values)
    explained = fitted.values / fitted.total
    some = len(explained)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x"))
            rows = len(x)
            each = np.repeat(np.arange(rows), some)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, some + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * some, n)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                    pa.array(((x - mean) @ onto).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * some, error)),
                ],
                names=[f.split()[0] for f in schema.split(", ")],
            )

    return map_batches(base, run, schema, 4096)

"""Embedding whitening by incremental eigendecomposition.

The fit list holds each distinct quantised vector once. Its partitions each keep a spectrum up to date by centred rank-one
updates (eigen.py); the spectra are combined a few at a time, each again by successive rank-one updates; the last one's
eigenvectors are refined by a Rayleigh-Ritz step on the exact data: the fit list, centred by exact integers and projected, gives a
small matrix, summed over the partitions, whose eigenvectors turn the basis into that of the covariance to double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, ship, slots, table
from .eigen import EPS, Spectrum

#: Components returned; spectra combined by one task at once.
COMPONENTS, FAN_IN = 16, 8
#: Fixed values of the quantisation x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
_SAFE, _LONG = 1 << 61, (1 << 63) - 1
SPECTRUM = "part int, n bigint, mean array<double>, eigenvalues array<double>, vectors array<double>"


def quantised(vector: Column) -> Column:
    """x of a vector's entries; null for a vector that is null or holds null or non-finite entries."""
    c = vector.cast("array<double>")
    fine = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(fine, F.transform(c, lambda v: F.floor(v * SCALE).cast("long") + F.lit(OFFSET).cast("long")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, (pa.ListArray, pa.LargeListArray)) else column
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dims)


def exact_off(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums as exact integers: 64-bit ones where they fit, else Python's."""
    most = max(map(abs, sums))
    if n * max(abs(int(x.max())), abs(int(x.min()))) + most < _SAFE:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(off: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exactly; None beyond the range of a long."""
    if off.size and off.dtype != object:
        most = int(np.abs(off).max())
        if most * most * off.shape[1] < _SAFE:
            return (off * off).sum(1).tolist()
    return [s if s <= _LONG else None for s in (sum(v * v for v in map(int, row)) for row in off)]


class Centre:
    """The fit list's size and sums, exact."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def off(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean, in double precision from exact integers."""
        return (exact_off(x, self.n, self.sums) / self.n).astype(np.float64)


def summed(fit: DataFrame, dims: int, size: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``of(matrix of a batch)``, a vector of ``size`` numbers: one row per partition, added up by place."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += of(_matrix(b.column(0), dims))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["v"])

    parts = fit.select("x").mapInArrow(partial, "v array<double>").select(F.posexplode("v").alias("at", "v"))
    rows = parts.groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    out[[r["at"] for r in rows]] = [r["v"] for r in rows]
    return out


def centre_of(fit: DataFrame, dims: int) -> Centre:
    """Exact size and sums of the fit list (sums per partition, then by dimension)."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dims
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0), dims)
                if max(abs(int(x.max())), abs(int(x.min()))) * len(x) >= _SAFE:
                    x = x.astype(object)
                n += len(x)
                sums = [s + int(v) for s, v in zip(sums, x.sum(0))]
        row = [Decimal(v) for v in (n, *sums)]
        yield pa.RecordBatch.from_arrays([pa.array([row], pa.list_(pa.decimal128(38, 0)))], ["v"])

    parts = fit.select("x").mapInArrow(partial, "v array<decimal(38,0)>").select(F.posexplode("v").alias("at", "v"))
    found = {r["at"]: int(r["v"]) for r in parts.groupBy("at").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()}
    return Centre(found.get(0, 0), [found.get(k + 1, 0) for k in range(dims)])


def _row(part: int, s: Spectrum) -> dict:
    return {"part": part, "n": s.n, "mean": s.mean.tolist(), "eigenvalues": s.values.tolist(), "vectors": s.vectors.ravel().tolist()}


def _spectrum(row) -> Spectrum:
    s = Spectrum(len(row["mean"]))
    s.n, s.mean, s.values = int(row["n"]), np.array(row["mean"], np.float64), np.array(row["eigenvalues"], np.float64)
    s.vectors = np.array(row["vectors"], np.float64).reshape(len(s.mean), len(s.values))
    return s


def _batch(rows: list[dict]) -> pa.RecordBatch:
    doubles = pa.list_(pa.float64())
    kinds = [("part", pa.int32()), ("n", pa.int64()), ("mean", doubles), ("eigenvalues", doubles), ("vectors", doubles)]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds], [k for k, _ in kinds])


def spectrum_of(fit: DataFrame, dims: int, centre: Centre) -> Spectrum:
    """Spectrum of the whole fit list: one per partition, then FAN_IN at a time; only the last one reaches the driver."""
    parts = slots(fit.sparkSession)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum(dims)
        for b in batches:
            for v in (centre.off(_matrix(b.column(0), dims)) if b.num_rows else ()):
                s.add(v)
        if s.n:
            yield _batch([_row(TaskContext.get().partitionId(), s)])

    def combined(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        whole = _spectrum(rows[0])
        for r in rows[1:]:
            whole.merge(_spectrum(r))
        return pa.Table.from_batches([_batch([_row(rows[0]["part"] // FAN_IN, whole)])])

    # a row costs far more in its update than in this exchange
    spectra = settle(fit.select("x").repartition(parts).mapInArrow(own, SPECTRUM), "spectra")
    while parts > 1:
        spectra = spectra.groupBy((F.col("part") / FAN_IN).cast("int").alias("g")).applyInArrow(combined, SPECTRUM)
        parts = -(-parts // FAN_IN)
    rows = spectra.collect()                                # one row
    return _spectrum(rows[0]) if rows else Spectrum(dims)


class Whitening:
    """What a fit gives: centre, eigenvalues (falling), eigenvectors (columns), share of the variance, largest error."""

    def __init__(self, centre: Centre, values: np.ndarray, vectors: np.ndarray, trace: float):
        self.centre, self.values, self.vectors, self.trace, self.error = centre, values, vectors, trace, 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.centre.off(x) @ self.vectors) / np.sqrt(self.values)


def fit_whitening(fit: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the rows ``x`` (distinct vectors of ``dims`` longs); None without rows."""
    centre = centre_of(fit, dims)
    if not centre.n:
        return None
    basis = spectrum_of(fit, dims, centre).vectors
    k = basis.shape[1]

    def projected(x: np.ndarray) -> np.ndarray:
        off = centre.off(x)
        y = off @ basis
        return np.append((y.T @ y).ravel(), (off * off).sum())

    sums = summed(fit, dims, k * k + 1, projected) / centre.n
    h = sums[:-1].reshape(k, k)
    values, turn = np.linalg.eigh((h + h.T) / 2)
    most = min(components, int((values > (values[-1] if k else 0.0) * 16 * dims * EPS).sum())) if k else 0
    order = np.arange(k)[::-1][:most]
    out = Whitening(centre, values[order], basis @ turn[:, order], float(sums[-1]))
    if most:
        def products(x: np.ndarray) -> np.ndarray:
            z = out.project(x)
            return (z.T @ z).ravel()

        second = summed(fit, dims, most * most, products).reshape(most, most) / centre.n
        out.error = float(np.abs(second - np.eye(most)).max())
    return out


RESULT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null, empty, or hold null or non-finite entries are left out; if lengths differ, only those of the most frequent
    length remain (of equally frequent ones the longest). Repeated vectors are fitted once and returned for every row, null ids
    included. Components are numbered by falling eigenvalue; eigenvalues that are zero to working precision give no component, so a
    table without rows, or with one distinct vector, gives no rows. Entries beyond the range of a long are clamped to it by the
    quantisation; a deviation beyond it is null. Other columns of the table are not read. A task holds a batch of rows and a
    matrix of dims x dims; one such matrix reaches the driver.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), quantised(F.col(vector_col)).alias("x")).filter(F.size("x") > 0)
    sizes = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    schema = f"`{id_col}` {kind}, {RESULT}"
    if not first:
        return spark.createDataFrame([], schema)
    dims = first[0]["dims"]
    rows = rows.filter(F.size("x") == dims)
    fitted = fit_whitening(settle(rows.select("x").distinct(), "whitening-fit"), dims, components)
    if fitted is None or not len(fitted.values):
        return spark.createDataFrame([], schema)
    k, shares = len(fitted.values), fitted.values / fitted.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1), dims)
            each = np.repeat(np.arange(len(x)), k)
            off = deviations(exact_off(x, fitted.centre.n, fitted.centre.sums))
            m = len(each)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(m, fitted.centre.n, np.int64)), pa.array(off, pa.int64()).take(pa.array(each)),
                 pa.array(fitted.project(x).ravel()), pa.array(np.tile(shares, len(x))), pa.array(np.full(m, fitted.error))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)


def op12_whitening(spark, sf_dir):
    """Registered query: every vector of ``embeddings`` projected on the first 16 components."""
    return whiten(table(spark, sf_dir, "embeddings"))

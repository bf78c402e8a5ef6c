"""Whitening against numpy's eigendecomposition of the plainly computed covariance; rank-one updates against the same."""

import math

import numpy as np
import pytest

from keyrelay.llm import whitening
from keyrelay.llm.eigen import Spectrum

SF = "/root/testdata/sf0.001"


def plain(vectors):
    """(fit list, covariance, eigenvalues falling, eigenvectors) by the contract."""
    x = np.array(sorted({tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)
                         for v in (vectors.values() if isinstance(vectors, dict) else vectors)}), np.int64)
    off = (len(x) * x - x.sum(0)) / len(x)
    cov = off.T @ off / len(x)
    values, vecs = np.linalg.eigh(cov)
    return x, cov, values[::-1], vecs[:, ::-1]


def compare(rows, vectors, components):
    x, cov, values, vecs = plain(vectors)
    n, sums = len(x), x.sum(0)
    own = {}
    for r in rows:
        own.setdefault(r.component, []).append(r)
    assert sorted(own) == list(range(1, components + 1))
    for k, rs in own.items():
        assert {r.n for r in rs} == {n}
        assert all(abs(r.explained / (values[k - 1] / np.trace(cov)) - 1) < 1e-10 for r in rs)
        assert all(r.identity_error < 1e-9 for r in rs)
        q = {r.vec_id: np.array([math.floor(64 * float(c)) + 1_000_000 for c in vectors[r.vec_id]]) for r in rs}
        want = np.array([((n * q[r.vec_id] - sums) / n) @ vecs[:, k - 1] / np.sqrt(values[k - 1]) for r in rs])
        got = np.array([r.whitened for r in rs])
        assert np.abs(got - want * np.sign(got @ want)).max() < 1e-7
        assert all(r.deviation == int(((n * q[r.vec_id].astype(object) - sums.astype(object)) ** 2).sum()) for r in rs)


def test_embeddings(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = whitening.op12_whitening(spark, SF).collect()
    vectors = [np.array(r.embedding, np.float32) for r in table.orderBy("vec_id").collect()]
    assert len(rows) == 16 * len(vectors)
    compare(rows, vectors, 16)


def frame(spark, vectors):
    return spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")


def test_repeated_rows_and_dropped_rows(spark):
    rng = np.random.default_rng(5)
    base = [[float(np.float32(c)) for c in rng.normal(size=5)] for _ in range(60)]
    odd = [None, [None] * 5, [1.0, 2.0, float("nan"), 0.0, 0.0], [float("inf")] * 5, [], [1.0, 2.0]]
    vectors = base + [base[0]] * 40 + odd
    df = frame(spark, vectors).selectExpr("*", "'x' AS x", "1 AS n", "2 AS component")
    rows = whitening.whiten(df.repartition(7)).collect()
    assert {r.vec_id for r in rows} == set(range(100)) and len(rows) == 500
    compare(rows, {k: v for k, v in enumerate(vectors[:100])}, 5)


def test_ranks_below_the_dimensions(spark):
    line = frame(spark, [[float(k), 2.0 * k, 0.0] for k in range(20)])
    rows = whitening.whiten(line).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 20 and abs(rows[0].explained - 1) < 1e-12
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)).collect() == []         # one distinct vector: no variance
    empty = whitening.whiten(frame(spark, [[1.0]]).filter("1 = 0"))
    assert empty.collect() == [] and empty.columns == ["vec_id", *[c.split()[0] for c in whitening.RESULT.split(", ")]]


def test_large_entries_stay_exact(spark):
    vectors = [[1e12 * k, -3.0] for k in range(4)] + [[1e12, 5.0]]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], object)
    want = ((len(x) * x - x.sum(0)) ** 2).sum(1)
    assert {(r.vec_id, r.deviation) for r in rows} == {(k, int(v) if v < 1 << 63 else None) for k, v in enumerate(want)}


@pytest.mark.parametrize("make", [
    lambda g: g.normal(size=(300, 24)), lambda g: g.integers(0, 2, size=(200, 9)).astype(float),
    lambda g: np.vstack([np.eye(8), -np.eye(8)]) * 5, lambda g: np.repeat(g.normal(size=(4, 12)), 9, 0),
    lambda g: g.normal(size=(150, 16)) * np.logspace(0, -8, 16), lambda g: np.zeros((5, 3)), lambda g: np.eye(6) * 3,
    lambda g: np.outer(np.arange(40.0), np.ones(5))])
def test_spectra(make):
    """Single rows and combined parts: scatter, orthogonality and mean, equal eigenvalues and low ranks included."""
    x = make(np.random.default_rng(11))
    scatter = (x - x.mean(0)).T @ (x - x.mean(0))
    for parts in (1, 4):
        whole = Spectrum(x.shape[1])
        for part in np.array_split(x, parts):
            own = Spectrum(x.shape[1])
            for v in part:
                own.add(v)
            whole.merge(own)
        k = len(whole.values)
        assert whole.n == len(x) and np.abs(whole.mean - x.mean(0)).max() < 1e-12
        assert k == 0 or np.abs(whole.vectors.T @ whole.vectors - np.eye(k)).max() < 1e-11
        assert np.abs((whole.vectors * whole.values) @ whole.vectors.T - scatter).max() <= 1e-11 * max(1.0, np.abs(scatter).max())

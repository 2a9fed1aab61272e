"""Whitening against a dense eigensolver, and the solver against operators with hard spectra."""

import math

import numpy as np
import pytest

from readweave.llm.whitening import jacobi_davidson, learn_whitening, minres, whiten, whitened_rows


def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize(
    "values",
    [np.arange(1.0, 65), 1 + 0.001 * np.arange(64), np.array([5.0] * 4 + [1.0] * 60), 0.9 ** np.arange(300), np.linspace(1, 2, 400), np.array([1e6, 1e3] + [1.0] * 8 + [0.0] * 40), np.array([3.0, 2.0]), np.array([7.0]), 1 / (1 + np.arange(200.0)) ** 3],
)
def test_eigenpairs(values):
    a = spectrum(values)
    calls = []

    def product(w):
        calls.append(w.shape[1])
        return a @ w

    e, u = jacobi_davidson(product, len(values), 8)
    want = np.sort(values)[::-1][:8]
    assert np.allclose(e, want, rtol=0, atol=1e-12 * want[0])
    assert np.abs(u.T @ u - np.eye(len(want))).max() < 1e-12
    assert np.abs(a @ u - u * e).max() < 1e-13 * want[0] * max(1, len(values) ** 0.5 / 8) * 4
    assert len(calls) < 600


def test_minres_solves_indefinite_columns():
    a = spectrum(np.array([-3.0, -1, 0.5, 2, 4, 9]))
    b = np.random.default_rng(1).standard_normal((6, 3))
    b[:, 1] = 0
    x = minres(lambda v, live: a @ v[:, live], b, 12, 1e-13)
    assert np.allclose(a @ x, b, atol=1e-10)


def check(rows, got, components=8):
    """Against whole numbers of any size and a dense eigensolver."""
    good = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, total = len(good), [sum(c) for c in zip(*(x for _, x in good), strict=True)]
    whole = [[n * c - s for c, s in zip(x, total, strict=True)] for _, x in good]
    y = np.array([[c / n for c in w] for w in whole])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-12 * e.sum()).sum()))
    assert len(got) == n * k and {r.component for r in got} == set(range(1, k + 1))
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    want = sorted((str(i), sum(c * c for c in w)) for (i, _), w in zip(good, whole, strict=True))
    for c in range(k):
        mine = [r for r in got if r.component == c + 1]
        assert sorted((str(r.vec_id), r.deviation) for r in mine) == want
        assert abs(mine[0].explained - e[c] / e.sum()) < 1e-9
        z = y @ u[:, c] / math.sqrt(e[c])
        own = sorted(abs(r.whitened) for r in mine)
        assert np.allclose(own, sorted(np.abs(z)), atol=1e-6)


def test_whitening(spark):
    r = np.random.default_rng(5)
    x = (r.standard_normal((500, 20)) * np.geomspace(3, 0.1, 20)).tolist()
    rows = list(enumerate(x)) + [(None, x[0]), (3, x[3]), (3, x[4]), (600, [0.0] * 20), (601, None), (602, [math.nan] + [0.0] * 19), (603, [None] + [0.0] * 19), (604, [math.inf] + [0.0] * 19)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    check(rows, whitened_rows(df).collect())
    assert whitened_rows(df.limit(0)).count() == 0
    two = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])], "vec_id long, embedding array<double>")
    assert whitened_rows(two).count() == 0
    small = [(1, [1.0, 2.0, 0.5]), (2, [3.0, -2.0, 0.5]), (3, [0.25, 8.0, 0.5])]
    check(small, whitened_rows(spark.createDataFrame(small, "vec_id long, embedding array<float>")).collect())


def test_large_entries_and_other_columns(spark):
    big = float(1 << 41)
    rows = [(k, [big * (k % 3), float(k), -big]) for k in range(1100)]
    df = spark.createDataFrame([(i, v, "v", k) for k, (i, v) in enumerate([*rows, (2000, [1.0, 2.0]), (2001, [big * 8, 0.0, 0.0])])], "vec_id long, embedding array<double>, deviation string, `row` int")
    fit = learn_whitening(df)
    out = whiten(df, fit).collect()
    assert sorted(r.row.row for r in out) == list(range(1100)) and {r.row.deviation for r in out} == {"v"}
    n = 1100
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    total = [sum(c) for c in zip(*x, strict=True)]
    assert fit.wide and fit.total == total and fit.n == n
    for r in out:
        exact = sum((n * c - s) ** 2 for c, s in zip(x[r.row.row], total, strict=True))
        assert r.out.deviation == (exact if exact < 1 << 63 else None)


def test_the_supplied_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    check([(r.vec_id, r.embedding) for r in df.collect()], whitened_rows(df).collect())

"""Whitening against a dense eigensolver and exact integers."""

import math

import numpy as np
import pytest

from ipscope.llm import catalog, whitening
from ipscope.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(rows):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in good]
    n = len(x)
    sums = [sum(col) for col in zip(*x)]
    off = [[n * a - s for a, s in zip(row, sums)] for row in x]
    z = np.array([[t / n for t in row] for row in off])
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    return [i for i, _ in good], n, [sum(t * t for t in row) for row in off], e, u, z, np.trace(v)


def check(got, rows):
    ids, n, deviation, e, u, z, trace = brute(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == 8 * len(ids) and set(by) == set(ids)
    want = z @ (u / np.sqrt(e))
    have = np.array([[by[i][k].whitened for k in range(1, 9)] for i in ids])
    sign = np.sign((want * have).sum(axis=0))
    assert np.abs(want * sign - have).max() < 1e-8
    for i, d in zip(ids, deviation):
        for k, r in by[i].items():
            assert (r.n, r.deviation) == (n, d) and abs(r.explained - e[k - 1] / trace) < 1e-12
            assert r.identity_error < 1e-10 and r.residual < 5e-14
    assert len({r.identity_error for r in got}) == 1


def test_query_equals_dense_solver(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    check(catalog.queries()["op11_whitening"](spark, SF).collect(), rows)


def data(n=300, size=12, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)) @ np.diag(np.linspace(3, 0.2, size))
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, whitened string, component int").repartition(3)


def run(df):
    model = whitening.fit(df)
    return whitening.components(whitening.whiten(df, model), model).collect(), model


def test_odd_rows(spark):
    rows = data()
    nan, inf = float("nan"), float("inf")
    odd = [(1000, None), (1001, []), (1002, [None] * 12), (1003, [nan] + [0.0] * 11), (1004, [-inf] + [0.0] * 11), (1005, [0.0] * 12),
           (1006, rows[3][1]), (1007, rows[3][1])]
    check(run(frame(spark, rows + odd))[0], rows + odd)
    # vectors of another length are left out, null ids stay, repeated ids give a row each
    got, model = run(frame(spark, rows + [(2000, [1.0, 2.0]), (None, [1.0] * 12), (1, [2.0] * 12)]))
    assert model.n == 302 and len(got) == 8 * 302 and sum(r.vec_id is None for r in got) == 8 and sum(r.vec_id == 1 for r in got) == 16


def test_few_dimensions_rank_and_no_rows(spark):
    got, model = run(frame(spark, [(i, [float(i), float(i * i % 7)]) for i in range(30)]))
    assert len(got) == 60 and model.identity_error < 1e-10
    line = [(i, [i / 8, 3 * i / 8, 0.0, 1.0]) for i in range(20)]  # one direction only
    got, model = run(frame(spark, line))
    assert len(model.values) == 1 and len(got) == 20 and abs(got[0].explained - 1) < 1e-12
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert run(frame(spark, rows))[0] == []


def test_large_entries(spark):
    rows = data(60, 3) + [(100, [1e200, 1.0, 2.0]), (101, [-1e15, 1e300, 0.0])]
    got, model = run(frame(spark, rows))
    assert len({r.vec_id for r in got}) == 62 and all(math.isfinite(r.whitened) for r in got)
    assert all(r.deviation is None for r in got)  # does not fit in a long
    x = np.array([[2 ** 40, 3], [5, 7]])
    t = [[2 * a - s for a, s in zip(row, (2 ** 40 + 5, 10))] for row in x.tolist()]
    assert whitening.deviations(x, 2, [2 ** 40 + 5, 10]) == [v if (v := sum(c * c for c in row)) < 2 ** 63 else None for row in t]


@pytest.mark.parametrize("spectrum", [
    np.linspace(1, 2, 200), 10.0 ** np.linspace(0, -9, 200), np.r_[[5.0] * 3, [4.0] * 12, np.ones(185)], np.r_[3.0, np.zeros(199)],
    np.r_[2.0 + 1e-7 * np.arange(8), np.linspace(0, 1, 192)]])
def test_solver_on_hard_spectra(spectrum):
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(200, 200)))[0]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors, residual = whitening.jacobi_davidson(lambda w: a @ w, 200, 8)
    assert np.allclose(values, np.sort(spectrum)[::-1][:8], rtol=0, atol=1e-12 * spectrum.max())
    assert residual < 1e-12 and np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-13


def test_minres_solves_each_column():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(40, 40))
    a, b = a + a.T, rng.normal(size=(40, 5))
    b[:, 2] = 0.0
    x = whitening.minres(lambda t: a @ t, b, 200, 1e-13)
    assert np.abs(a @ x - b).max() < 1e-8 and not x[:, 2].any()

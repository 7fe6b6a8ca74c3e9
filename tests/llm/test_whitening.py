"""Whitening by shifted CholeskyQR against a plain SVD, and its defined cases."""

import math

import numpy as np
import pytest

from staylens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x int, whitened string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in vectors], SCHEMA)


def run(df):
    rows = whitening.quantise(df)
    fit = rows.select("x").distinct()
    model = whitening.fit_whitening(fit)
    return rows, fit, model


def plain(vectors, k=16):
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    a = (n * u - s) / n
    _, sv, vt = np.linalg.svd(a, full_matrices=False)
    sv = sv[sv > 1e-12 * sv[0]][:k]
    return x, n, s, vt[:len(sv)].T, sv ** 2 / n, sv ** 2 / (a ** 2).sum()


@pytest.mark.parametrize("kind", ["plain", "dependent", "steep"])
def test_against_svd(spark, kind):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(300, 10)) * (10.0 ** -np.linspace(0, 3, 10) if kind == "steep" else 1) * (1000 if kind == "steep" else 1)
    if kind == "dependent":
        v[:, 3] = 0.25                                   # no variance
        v[:, 4] = np.round(v[:, 5] * 64) / 64
        v[:, 5] = v[:, 4]                                # the same dimension twice
    v = v.astype(np.float32)
    v = np.concatenate([v, np.repeat(v[:1], 150, axis=0)])   # a third of the rows are one vector
    rows, fit, model = run(table(spark, [(i, r.tolist()) for i, r in enumerate(v)]))
    x, n, s, comp, var, share = plain(v)
    assert model["n"] == n and [int(t) for t in model["sums"]] == s.tolist()
    assert len(model["variance"]) == len(var) == (8 if kind == "dependent" else 10)
    np.testing.assert_allclose(model["variance"], var, rtol=1e-9)
    np.testing.assert_allclose(model["explained"], share, rtol=1e-9)
    np.testing.assert_allclose(np.abs((comp * model["components"]).sum(axis=0)), 1, atol=1e-9)
    assert whitening.identity_error(fit, model) < 1e-8
    got = {r.vec_id: r for r in whitening.whiten(rows, model).collect()}
    assert len(got) == len(v)
    want = (x - s / n) @ model["components"] / np.sqrt(var)
    for i in (0, 5, 299, 449):
        np.testing.assert_allclose(got[i].whitened, want[i], atol=1e-6)
        assert got[i].deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))


def test_far_smaller_component_keeps_its_digits():
    """A direction 1e-7 times the first: a covariance would lose it."""
    rng = np.random.default_rng(3)
    a = rng.integers(-10 ** 9, 10 ** 9, (500, 1)) * np.array([[1, 1, 1]]) + rng.integers(-90, 90, (500, 3))

    r = None
    held = []
    for _ in range(6):
        q = a - a.mean(axis=0)
        for f in held:
            q = whitening.solve_right(q, f)
        g = q.T @ q
        values = np.linalg.eigvalsh(g)
        if held and values[0] > 0.5 and values[-1] < 2:
            r = whitening.pivoted_cholesky(g, 1e-9)
            break
        if not held or values[0] < 1e-13 * values[-1]:
            g = g + 11 * (500 * 3 + 12) * whitening.UNIT * values[-1] * np.eye(3)
        held.append(np.linalg.cholesky(g).T)
    for f in reversed(held):
        r = r @ f
    want = np.linalg.svd(a - a.mean(axis=0), compute_uv=False)
    np.testing.assert_allclose(np.linalg.svd(r, compute_uv=False), want, rtol=1e-6)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, 2.0, 3.0])]
    good = [(7, [0.5, -0.25]), (7, [0.5, -0.25]), (None, [1.0, 3.0]), (9, [-3e38, 1.0])]
    rows, _, model = run(table(spark, bad + good))
    got = whitening.whiten(rows, model).collect()
    assert sorted(str(r.vec_id) for r in got) == ["7", "7", "9", "None"] and model["n"] == 3
    by = {str(r.vec_id): r for r in got}
    assert by["9"].deviation is None and by["7"].deviation is None and len(by["9"].whitened) == 1   # beyond a long; the other direction is 1e-15 of it
    one, fit, model = run(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    assert model["n"] == 1 and len(model["variance"]) == 0 and whitening.identity_error(fit, model) == 0
    assert [r.whitened for r in whitening.whiten(one, model).collect()] == [[], []]
    none, _, model = run(table(spark, bad[:5]))
    assert none.count() == 0 and model["n"] == 0 and whitening.whiten(none, model).count() == 0


def test_query(spark, tmp_path):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(120, 20)).astype(np.float32)
    table(spark, [(i, r.tolist()) for i, r in enumerate(v)]).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = whitening.op11_whitening(spark, str(tmp_path)).collect()
    x, n, s, comp, var, share = plain(v)
    assert len(out) == 120 * 16 and {r.component for r in out} == set(range(1, 17)) and {r.n for r in out} == {n}
    y = np.zeros((120, 16))
    for r in out:
        y[r.vec_id, r.component - 1] = r.whitened
        assert math.isclose(r.explained, share[r.component - 1], rel_tol=1e-9) and r.identity_error < 1e-8
    want = (x - s / n) @ comp / np.sqrt(var)
    np.testing.assert_allclose(np.abs(y), np.abs(want), atol=1e-7)
    table(spark, []).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert whitening.op11_whitening(spark, f"{tmp_path}/none").count() == 0
    assert sorted(out[0].asDict()) == ["component", "deviation", "explained", "identity_error", "n", "vec_id", "whitened"]

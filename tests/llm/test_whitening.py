"""Whitening against a dense eigendecomposition."""

from __future__ import annotations

import math

import numpy as np

from sitemill.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, size int, component string, n string"


def rows_of(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 1, "c", "n") for i, v in vectors], SCHEMA)


def dense(vectors, k=4):
    """x vectors by id, sums, count, eigenvalues and components, from the whole matrix."""
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in vectors if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    dim = max(len(v) for _, v in good)
    good = [(i, np.r_[v, np.zeros(dim - len(v), int)]) for i, v in good]
    fit = np.unique([v for _, v in good], axis=0)
    v = fit - fit.mean(0)
    e, c = np.linalg.eigh(v.T @ v / len(fit))
    return good, fit, e[::-1][:k], c[:, ::-1][:, :k], e.sum()


def odd_vectors(dim, n, seed=1, scale=None):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * (np.linspace(2, 1, dim) if scale is None else scale)
    out = [(i, [float(e) for e in v]) for i, v in enumerate(x)]
    out += [(n, None), (n + 1, out[0][1][:-1] + [None]), (n + 2, [float("nan")] + out[1][1][1:]), (n + 3, [float("inf")] + out[1][1][1:])]
    out += [(None, out[3][1]), (5, out[5][1]), (n + 4, [0.0] * dim), (n + 5, out[2][1][: dim // 2]), (n + 6, [])]
    return out


def check(spark, vectors, k=4):
    df = rows_of(spark, vectors)
    model = whitening.fit_whitening(df, k=k)
    got = whitening.whiten(df, model).collect()
    good, fit, e, c, trace = dense(vectors, k)
    n, s = len(fit), fit.sum(0)
    assert len(got) == len(good) * min(k, fit.shape[1])
    want = {(i, tuple(x)): ((x - s / n) @ c / np.sqrt(e), sum(int(d) ** 2 for d in n * x.astype(object) - s)) for i, x in good}
    by_id = {}
    for i, x in good:
        by_id.setdefault(i, []).append(want[(i, tuple(x))])
    signs = np.sign((model.components * c).sum(0))
    for r in got:
        j = r["component"] - 1
        assert any(abs(r["whitened"] - signs[j] * w[j]) < 1e-7 and int(r["deviation"]) == d for w, d in by_id[r["vec_id"]])
        assert r["n"] == n and abs(r["explained"] / (e[j] / trace) - 1) < 1e-9 and r["identity_error"] < 1e-9
    return model


def test_clear_and_close_eigenvalues(spark):
    clear = check(spark, odd_vectors(24, 300, scale=np.r_[9, 7, 5, 4, np.full(20, 0.5)]))
    assert clear.residual <= whitening.TOLERANCE and clear.passes > 1
    close = check(spark, odd_vectors(40, 400, scale=np.ones(40)))
    assert close.residual <= 1e-12  # blocks were doubled up to the dimension


def test_fewer_dimensions_than_components(spark):
    assert check(spark, odd_vectors(3, 50)).components.shape == (3, 3)


def test_no_variance_and_empty_tables(spark):
    for vectors in ([], [(1, None)], [(1, [float("nan")])]):
        df = rows_of(spark, vectors)
        assert whitening.fit_whitening(df) is None
        out = whitening.whiten(df, None)
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0
    same = rows_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    got = whitening.whiten(same, whitening.fit_whitening(same)).collect()
    assert len(got) == 4 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 and r["identity_error"] is None for r in got)
    line = rows_of(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(6)])
    got = whitening.whiten(line, whitening.fit_whitening(line)).collect()
    assert [r["component"] for r in got if r["whitened"] is not None] == [1] * 6 and all(r["identity_error"] < 1e-9 for r in got)


def test_distances_beyond_64_bits(spark):
    far = rows_of(spark, [(1, [3e6, 0.0]), (2, [-3e6, 1.0]), (3, [0.0, 5.0])])
    got = whitening.whiten(far, whitening.fit_whitening(far)).where("component = 1").collect()
    x = {1: (768000000, 0), 2: (-768000000, 256), 3: (0, 1280)}
    s = [sum(v[i] for v in x.values()) for i in (0, 1)]
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == {i: sum((3 * v[d] - s[d]) ** 2 for d in (0, 1)) for i, v in x.items()}

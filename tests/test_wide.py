"""Components of wide rows against a singular value decomposition in memory."""

import numpy as np
import pytest

from tickloom.operators.wide import fit_wide, wide_pca

KIND = "id int, features array<double>"


def exact(x):
    scale = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(scale > 0, scale, 1.0)
    _, s, v = np.linalg.svd(z, full_matrices=False)
    return z, s**2 / len(x), v.T


def test_thousand_columns(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (400, 8)) * np.arange(9, 1, -1) @ rng.normal(0, 1, (8, 1000)) + rng.normal(0, 1, (400, 1000)) + 1e4
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], KIND).repartition(6)
    model = fit_wide(df, 5)
    z, variances, loadings = exact(x)
    cosines = np.linalg.svd(model.loadings.T @ loadings[:, :5])[1]
    assert cosines.min() > 1 - 1e-6
    assert model.variances == pytest.approx(variances[:5], rel=1e-6)
    assert np.abs(model.loadings).max(axis=0) == pytest.approx(model.loadings.max(axis=0))
    out = wide_pca(df, model).toPandas().sort_values("id")
    assert np.allclose(np.stack(out["components"]), z @ model.loadings, atol=1e-6)


def test_missing_short_constant_and_empty(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (40, 4)) * [1, 2, 3, 0] + [0, 0, 1e6, 7]
    rows = [(i, r.tolist()) for i, r in enumerate(x)]
    odd = [(90, None), (91, [1.0]), (92, [1.0, None, 2.0, 3.0]), (93, [float("nan")] * 4), (94, [])]
    df = spark.createDataFrame(rows + odd, KIND)
    model = fit_wide(df, 9)
    z, variances, _ = exact(x)
    assert model.variances == pytest.approx(variances, abs=1e-9) and model.loadings.shape == (4, 4)
    out = {r["id"]: r["components"] for r in wide_pca(df, model).collect()}
    assert len(out) == 45 and all(out[i] is None for i, _ in odd)
    assert sum(v * v for v in out[3]) == pytest.approx((z[3] ** 2).sum())
    one = fit_wide(df.where("id = 0"), 2)
    assert one.variances == pytest.approx([0.0])
    for empty in (df.limit(0), df.where("id >= 90 AND id != 91"), df.where("id = 94")):
        with pytest.raises(ValueError):
            fit_wide(empty, 2)

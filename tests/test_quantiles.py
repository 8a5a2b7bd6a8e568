"""Quantile regression against an exhaustive search and the definition of a quantile."""

from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from tickloom.functions.scalar import middle
from tickloom.operators.quantiles import fit_quantiles, predict_quantiles, quantile_scores


def pinball(e, q):
    return np.maximum(q * e, (q - 1) * e).mean()


def least(x, y, q):
    """The best line passes through two of the points."""
    best = np.inf
    for i, j in combinations(range(len(x)), 2):
        if x[i] != x[j]:
            w = (y[j] - y[i]) / (x[j] - x[i])
            best = min(best, pinball(y - (y[i] + w * (x - x[i])), q))
    return best


def test_loss_is_that_of_the_best_line(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1000, 5, 90)
    y = 7 - 2 * x + (1 + rng.uniform(0, 1, 90)) * rng.standard_t(3, 90)
    levels = (0.1, 0.5, 0.9)
    model = fit_quantiles(spark.createDataFrame(pd.DataFrame({"x": x, "y": y})), "y", ["x"], levels)
    for q, b, (w,) in zip(levels, model.intercepts, model.weights, strict=True):
        assert pinball(y - (b + w * x), q) <= 1.01 * least(x, y, q)


def test_shares_are_right_and_lines_do_not_cross(spark):
    rng = np.random.default_rng(4)
    n = 6000
    pdf = pd.DataFrame({"a": rng.normal(0, 1, n), "b": rng.uniform(0, 3, n), "flat": 5.0})
    pdf["twin"] = pdf["a"]
    pdf["y"] = 1e6 + 3 * pdf["a"] + (0.2 + pdf["b"]) * rng.normal(0, 1, n)
    df = spark.createDataFrame(pdf).repartition(5)
    columns = ["a", "b", "flat", "twin"]
    model = fit_quantiles(df, "y", columns)
    out = predict_quantiles(model, df)
    rows = quantile_scores(out, "y", "quantiles", model.quantiles).collect()
    assert [r["quantile"] for r in rows] == list(model.quantiles) and {r["n"] for r in rows} == {n}
    for r in rows:
        assert abs(r["below"] - r["quantile"]) < 0.01
    far = predict_quantiles(model, spark.createDataFrame([(9.0, -40.0, 5.0, 9.0)], "a double, b double, flat double, twin double"))
    values = far.first()["quantiles"]
    assert values == sorted(values)
    got = out.toPandas()
    assert np.allclose(got["quantiles"].map(lambda v: v[3]), 1e6 + 3 * got["a"], atol=0.3)
    assert out.where(middle("quantiles") != out["quantiles"][3]).count() == 0
    for i, q in enumerate(model.quantiles):
        e = got["y"] - got["quantiles"].map(lambda v, i=i: v[i])
        assert rows[i]["pinball"] == pytest.approx(pinball(e.to_numpy(), q), rel=1e-9)


def test_missing_rows_no_columns_and_bad_calls(spark):
    kind = "x double, y double"
    df = spark.createDataFrame([(None, 1.0), (1.0, None), *[(float(i % 7), float(i)) for i in range(101)]], kind)
    model = fit_quantiles(df, "y", [], (0.25, 0.5))
    assert model.weights == ((), ()) and model.intercepts == pytest.approx((25.0, 50.0), abs=1.0)
    model = fit_quantiles(df, "y", ["x"], (0.5,))
    out = predict_quantiles(model, df)
    assert out.where("x IS NULL AND quantiles IS NULL").count() == 1
    assert quantile_scores(out, "y", "quantiles", (0.5,)).first()["n"] == 101
    flat = fit_quantiles(spark.createDataFrame([(1.0, 5.0)] * 3, kind), "y", ["x"], (0.1, 0.9))
    assert predict_quantiles(flat, spark.createDataFrame([(1.0, 0.0)], kind)).first()["quantiles"] == pytest.approx([5.0, 5.0])
    with pytest.raises(ValueError):
        fit_quantiles(df.limit(0), "y", ["x"])
    for bad in ((), (0.5, 0.1), (0.0, 0.5), (0.5, 0.5)):
        with pytest.raises(ValueError):
            fit_quantiles(df, "y", ["x"], bad)

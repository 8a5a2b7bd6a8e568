"""Moving-average models against a plain fit, whole and cut; forecasts fed back to a model."""

import numpy as np
import pytest

from tests.frames import by_series, close_to, make_bars, to_spark
from tickloom import Series
from tickloom.operators.arma import arma_forecast, arma_residuals, feedback_forecast, invertible, scan

SIZES = {"A": 400, "B": 1, "C": 37, "D": 150}


def plain_lags(x, n):
    return np.array([[x[t - i] if t >= i else np.nan for i in range(1, n + 1)] for t in range(len(x))]).reshape(len(x), n)


def plain_fit(y, p, d, q):
    """Both stages with whole design matrices; the shocks row by row."""
    z = np.array(y, dtype=float)
    for _ in range(d):
        z = np.concatenate([[np.nan], np.diff(z)])

    def solve(x):
        good = np.isfinite(x).all(axis=1) & np.isfinite(z)
        if good.sum() <= x.shape[1]:
            return None
        beta = np.linalg.lstsq(x[good], z[good], rcond=None)[0]
        return beta, ((z[good] - x[good] @ beta) ** 2).sum() / (good.sum() - x.shape[1])

    m, one = 2 * max(p, q), np.ones((len(z), 1))
    first = np.hstack([one, plain_lags(z, m)])
    found = solve(first)
    if found is None:
        return None
    found = solve(np.hstack([one, plain_lags(z, p), plain_lags(z - first @ found[0], q)]))
    if found is None:
        return None
    beta, variance = found
    theta, share = invertible(beta[1 + p:])
    u, e = z - np.hstack([one, plain_lags(z, p)]) @ beta[: 1 + p], np.zeros(len(z))
    for t in range(len(z)):
        if np.isfinite(u[t]):
            e[t] = u[t] - sum(theta[j] * e[t - 1 - j] for j in range(q) if t > j)
    return beta[0], beta[1 : 1 + p], theta, variance * share, z, e, np.isfinite(u)


def test_scan_equals_the_plain_recurrence():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 7, 50, 401):
        for q in (0, 1, 3):
            u, known = rng.normal(size=n), rng.uniform(size=n) > 0.2
            theta, entering = rng.uniform(-0.4, 0.4, q), rng.normal(size=q)
            e, matrix, state = scan(u, known, theta, entering)
            past, want = entering.copy(), []
            for t in range(n):
                x = u[t] - theta @ past if known[t] else 0.0
                want.append(x)
                past = np.concatenate([[x], past])[:q]
            assert close_to(e, want) and close_to(state, past)
            zero = scan(u, known, theta, np.zeros(q))[2]
            assert close_to(matrix @ entering + zero, past)


def test_roots_are_reflected():
    theta, share = invertible(np.array([-2.5, 1.0]))  # roots 2 and 1/2
    assert close_to(theta, [-1.0, 0.25]) and share == pytest.approx(4.0)
    assert invertible(np.array([0.5]))[1] == 1.0 and len(invertible(np.zeros(0))[0]) == 0


@pytest.mark.parametrize("gaps", [0.0, 0.05], ids=["dense", "gappy"])
@pytest.mark.parametrize(("p", "d", "q"), [(1, 1, 1), (2, 0, 2), (0, 1, 2), (3, 2, 0)])
def test_residuals_whole_and_cut(spark, p, d, q, gaps):
    pdf = make_bars(SIZES, gaps=gaps)
    df = to_spark(spark, pdf)
    whole = by_series(arma_residuals(df, p=p, d=d, q=q))
    cut = by_series(arma_residuals(df, p=p, d=d, q=q, series=Series(chunk_rows=29, bucket=50)))
    assert (whole["symbol"] == cut["symbol"]).all() and close_to(whole["residual"], cut["residual"], 1e-6)
    seen = 0
    for symbol, part in whole.groupby("symbol"):
        y = pdf[pdf["symbol"] == symbol].sort_values("date")["close"].to_numpy()
        found = plain_fit(y, p, d, q)
        assert found is not None
        want = np.where(found[6], found[5], np.nan)
        assert close_to(part["residual"], want, 1e-5)
        seen += np.isfinite(want).sum()
    assert seen > 300 and set(whole["symbol"]) == {"A", "C", "D"}


def test_long_forecast_equals_a_plain_fit(spark):
    pdf = make_bars({"A": 700, "B": 40})
    got = by_series(arma_forecast(to_spark(spark, pdf), p=6, d=2, q=4, h=20), "step")
    assert set(got["symbol"]) == {"A", "B"}
    for symbol, part in got.groupby("symbol"):
        y = pdf[pdf["symbol"] == symbol].sort_values("date")["close"].to_numpy()
        c, phi, theta, variance, z, e, _ = plain_fit(y, 6, 2, 4)
        z, e, levels = list(z), list(e), [y[-1], y[-1] - y[-2]]
        want, psi = [], []
        full = np.convolve(np.convolve(np.concatenate([[1.0], -phi]), [1, -1]), [1, -1])
        for k in range(20):
            z.append(c + sum(phi[i] * z[-1 - i] for i in range(6)) + sum(theta[j] * e[-1 - j] for j in range(4)))
            e.append(0.0)
            levels[1] += z[-1]
            levels[0] += levels[1]
            want.append(levels[0])
            moving = 1.0 if k == 0 else theta[k - 1] if k <= 4 else 0.0
            psi.append(moving - sum(full[i] * psi[k - i] for i in range(1, min(k, len(full) - 1) + 1)))
        half = 1.959963984540054 * np.sqrt(variance * np.cumsum(np.square(psi)))
        assert close_to(part["forecast"], want, 1e-4)
        assert close_to(part["upper"] - part["lower"], 2 * half, 1e-4)


def test_odd_series(spark):
    df = to_spark(spark, make_bars({"A": 60, "B": 3}))
    assert {r["symbol"] for r in arma_forecast(df, h=2).collect()} == {"A"}
    assert arma_forecast(df.limit(0), h=2).collect() == [] and arma_residuals(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        arma_forecast(df, p=0, q=0)


def test_feedback(spark):
    pdf = make_bars({"A": 50, "B": 3, "C": 40})
    pdf.loc[pdf[pdf["symbol"] == "C"].index[-2], "close"] = np.nan

    def load():
        return lambda seen: seen.mean(axis=1)

    df = to_spark(spark, pdf)
    for series in (Series(), Series(chunk_rows=7, bucket=20)):
        got = by_series(feedback_forecast(df, load, window=4, h=30, series=series), "step")
        assert set(got["symbol"]) == {"A"}
        last = list(pdf[pdf["symbol"] == "A"].sort_values("date")["close"][-4:])
        for _ in range(30):
            last.append(float(np.mean(last[-4:])))
        assert close_to(got["forecast"], last[4:])

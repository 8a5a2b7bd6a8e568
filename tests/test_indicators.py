import numpy as np
import pandas as pd
import pytest

from tests.frames import by_series, close_to, make_bars, to_spark
from tickloom import DAILY, Series, with_features
from tickloom.functions import indicators as ind
from tickloom.operators import features, psar

CUT = Series(chunk_rows=64, bucket=40)


def test_three_rsi_start_at_different_rows(spark):
    df = to_spark(spark, make_bars({"A": 40}))
    out = by_series(with_features(
        df, ind.rsi_sma(), ind.rsi_sma(first_delta_zero=True), ind.rsi_wilder(), ind.rsi_signed()
    ))
    first = {c: int(out[c].first_valid_index()) for c in ("rsi_sma", "rsi_sma0", "rsi_wilder", "rsi_signed")}
    assert first == {"rsi_sma": 14, "rsi_sma0": 13, "rsi_wilder": 13, "rsi_signed": 14}


def test_same_indicator_with_other_parameters(spark):
    pdf = make_bars({"A": 60})
    df = to_spark(spark, pdf)
    with pytest.raises(ValueError, match="rsi_sma"):
        with_features(df, ind.rsi_sma(n=14), ind.rsi_sma(n=7))
    both = by_series(with_features(
        df, ind.macd(), ind.macd(fast=5, slow=10).named("quick"), *ind.ichimoku(), ind.rsi_sma(n=7)
    ))
    c = pdf["close"]
    want = c.ewm(span=5, adjust=False).mean() - c.ewm(span=10, adjust=False).mean()
    assert close_to(both["quick"], want) and not close_to(both["quick"], both["macd"])
    assert both["rsi_sma"].first_valid_index() == 7


def test_rsi_edges(spark):
    up = make_bars({"UP": 30, "FLAT": 30})
    up["close"] = np.where(up.symbol == "UP", np.arange(60.0), 5.0)
    out = by_series(with_features(to_spark(spark, up), ind.rsi_sma(), ind.rsi_wilder()))
    rising, flat = out[out.symbol == "UP"], out[out.symbol == "FLAT"]
    assert rising["rsi_sma"].iloc[-1] == 100 and rising["rsi_wilder"].iloc[-1] == 100
    assert flat["rsi_sma"].isna().all() and flat["rsi_wilder"].iloc[-1] == 100


def test_atr_variants(spark):
    pdf = make_bars({"A": 60})
    out = by_series(with_features(to_spark(spark, pdf), ind.atr_sma(), ind.atr_unsigned(), ind.atr_wilder()))
    prev = pdf["close"].shift()
    parts = pd.concat([pdf.high - pdf.low, (pdf.high - prev), (pdf.low - prev)], axis=1)
    assert close_to(out["atr_sma"], parts.abs().max(axis=1).rolling(14).mean())
    assert close_to(out["atr_unsigned"], parts.max(axis=1).rolling(14).mean())
    assert out["atr_wilder"].first_valid_index() == 13
    assert out["atr_wilder"][13] == pytest.approx(out["atr_sma"][13])


def test_zero_range_is_missing(spark):
    pdf = make_bars({"A": 30})
    for c in ("high", "low", "close"):
        pdf[c] = 7.0
    out = by_series(with_features(to_spark(spark, pdf), *ind.stochastic(), ind.band_position(), ind.cci(), *ind.adx()))
    for c in ("stochastic_k", "band_position", "cci", "adx"):
        assert out[c].isna().all(), c


def test_macd_signals_differ(spark):
    pdf = make_bars({"A": 80})
    out = by_series(with_features(to_spark(spark, pdf), ind.macd(), ind.macd_signal(), *ind.macd_ta()))
    assert out["macd_line"].first_valid_index() == 25
    assert out["macd_line_signal"].first_valid_index() == 33
    line = out["macd_line"]
    assert close_to(out["macd_line_signal"], line.ewm(span=9, adjust=False, min_periods=9).mean())
    assert close_to(out["macd_signal"], out["macd"].ewm(span=9, adjust=False).mean())


@pytest.mark.parametrize("bundle", ["hand", "ta", "trader", "tft"])
def test_bundles_do_not_depend_on_cutting(spark, bundle):
    df = to_spark(spark, make_bars({"HOT": 400, "B": 90, "C": 1})).cache()
    whole, cut = (by_series(features.feature_set(df, bundle, s)) for s in (DAILY, CUT))
    assert list(whole.columns) == list(cut.columns)
    for c in whole.columns:
        if whole[c].dtype.kind == "f":
            assert close_to(whole[c], cut[c], 1e-9), c


def test_bundle_widths(spark):
    df = to_spark(spark, make_bars({"A": 5}))
    added = {b: len(features.feature_set(df, b).columns) - len(df.columns) for b in features.BUNDLES}
    assert added == {"hand": 10, "ta": 23, "trader": 7, "tft": 3}


def test_psar_relay_equals_one_pass(spark, monkeypatch):
    """Also with a warm start too short to meet the right state at once."""
    pdf = make_bars({"A": 700, "B": 3})
    df = to_spark(spark, pdf)
    want = by_series(psar.psar(df))["psar"]
    for warm in (1, 200):
        monkeypatch.setattr(psar, "WARM_ROWS", warm)
        assert by_series(psar.psar(df, series=CUT))["psar"].equals(want)


def test_expanding_features_equal_prefix_recomputation(spark):
    pdf = make_bars({"A": 64})
    got = by_series(features.expanding_features(to_spark(spark, pdf)))
    assert len(got) == 64 - 50
    for i in (50, 63):
        prefix = by_series(features.screen(to_spark(spark, pdf[:i]))).iloc[-1]
        assert close_to(got.iloc[i - 50][features.SCREEN], prefix[features.SCREEN])


def test_psar_starts_at_the_first_complete_bar():
    import numpy as np

    from tickloom.operators.psar import run

    rng = np.random.default_rng(3)
    close = 50 + np.cumsum(rng.normal(0, 1, 40))
    high, low = close + 1, close - 1
    whole, _, _ = run(high[1:], low[1:], close[1:])
    broken = high.copy()
    broken[0] = np.nan
    levels, _, _ = run(broken, low, close)
    assert np.isnan(levels[0]) and np.allclose(levels[1:], whole)

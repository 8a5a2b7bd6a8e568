"""Named feature bundles and the per-stock feature vector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import indicators as ind
from tickloom.functions.window import pct_change
from tickloom.operators.aggregate import latest_snapshot
from tickloom.operators.asof import RETURN_STATS, series_stats
from tickloom.operators.psar import psar
from tickloom.operators.rows import slice_rows
from tickloom.plans import DAILY, Series, with_features

VECTOR = [
    "mean_return", "volatility", "rsi", "macd", "macd_signal", "moving_average_50",
    "moving_average_200", "bollinger_upper", "bollinger_lower", "atr", "avg_volume",
]
SCREEN = ["macd", "rsi", "band_position"]


def _with_return_stats(rows: DataFrame, series: Series) -> DataFrame:
    change = pct_change("close").name
    return series_stats(rows, change, series).drop(change)


def hand(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """Ten features by hand-written formulas."""
    k, d = ind.stochastic()
    rows = with_features(
        df,
        ind.rsi_signed().named("rsi"), ind.macd_signal(), ind.avg_volume(),
        ind.bollinger()[0], k, d, ind.smoothed("close", 12), ind.momentum(), pct_change("close"),
        series=series,
    )
    return _with_return_stats(rows, series)


def technical(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """Twenty-three features in the usual technical-analysis definitions."""
    line, signal, _ = ind.macd_ta()
    mid, high, low = ind.bollinger(ddof=0)
    k, d = ind.stochastic()
    rows = with_features(
        df,
        ind.rsi_wilder().named("rsi"), line.named("macd"), signal.named("macd_signal"),
        ind.avg_volume(), mid.named("bb_middle"), high.named("bb_high"), low.named("bb_low"),
        k, d, ind.smoothed("close", 12), ind.roc().named("momentum"),
        *ind.ichimoku(), *ind.adx(), ind.cci(), ind.atr_wilder().named("atr"), pct_change("close"),
        series=series,
    )
    return psar(_with_return_stats(rows, series), series=series)


def trader(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """Seven features of the short feature list, missing values as 0."""
    rows = with_features(
        df,
        ind.rsi_signed().named("rsi"), ind.macd(), ind.macd_signal(),
        ind.atr_unsigned().named("atr"), ind.avg_volume(), pct_change("close"),
        series=series,
    )
    names = [*RETURN_STATS, "rsi", "macd", "macd_signal", "atr", "avg_volume"]
    return _with_return_stats(rows, series).na.fill(0.0, subset=names)


def forecasting(
    df: DataFrame, price: str = "close", volume: str = "volume", series: Series = DAILY
) -> DataFrame:
    """EMA, RSI and VWAP as forecast inputs."""
    return with_features(
        df, ind.smoothed(price, 12), ind.rsi_sma(price, first_delta_zero=True).named("rsi"),
        ind.vwap(price, volume), series=series,
    )


BUNDLES = {"hand": hand, "ta": technical, "trader": trader, "tft": forecasting}


def feature_set(df: DataFrame, bundle: str, series: Series = DAILY) -> DataFrame:
    """Append one of the named bundles."""
    return BUNDLES[bundle](df, series=series)


def stock_features(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """One row of eleven features per stock: return statistics and the latest indicators."""
    change = pct_change("close")
    _, upper, lower = ind.bollinger()
    rows = with_features(
        df, change,
        ind.rsi_sma().named("rsi"), ind.macd(), ind.macd_signal(),
        ind.moving_average(n=50), ind.moving_average(n=200),
        upper.named("bollinger_upper"), lower.named("bollinger_lower"),
        ind.atr_sma().named("atr"), ind.avg_volume(),
        series=series,
    )
    # One buffer of fixed width per column: a struct of them would be aggregated by sorting.
    return rows.groupBy(*series.keys).agg(
        F.avg(change.name).alias("mean_return"),
        F.stddev_samp(change.name).alias("volatility"),
        *[F.max_by(c, series.order).alias(c) for c in VECTOR[2:]],
    )


def screen(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """MACD line, RSI and band position of every row."""
    line, _, _ = ind.macd_ta()
    return with_features(
        df, line.named("macd"), ind.rsi_wilder().named("rsi"), ind.band_position(), series=series
    )


def expanding_features(df: DataFrame, warmup: int = 50, series: Series = DAILY) -> DataFrame:
    """Screen features as known at the end of each prefix of ``warmup`` to length-1 rows.

    Every indicator looks back only, so one pass gives all prefixes; rows warmup-1 to length-2 stay.
    """
    return slice_rows(screen(df, series), warmup - 1, -1, series)


def screen_latest(df: DataFrame, rows: int = 50, series: Series = DAILY) -> DataFrame:
    """Screen features of the last row, computed from the last ``rows`` rows only."""
    return latest_snapshot(screen(slice_rows(df, -rows, None, series), series), SCREEN, series)

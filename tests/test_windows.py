"""Window primitives and recurrences against pandas, whole and cut."""

import numpy as np
import pytest

from tests.frames import by_series, close_to, make_bars, to_spark
from tickloom import DAILY, Running, Series, with_features, with_running
from tickloom.functions import window as win
from tickloom.functions.recurrence import ema, wilder
from pyspark.sql import functions as F

CUT = Series(chunk_rows=37, bucket=50)
SIZES = {"A": 300, "B": 1, "C": 37, "D": 38, "E": 130}


@pytest.fixture(scope="module", params=[0.0, 0.3], ids=["dense", "gappy"])
def prices(request, spark):
    pdf = make_bars(SIZES, gaps=request.param)
    return to_spark(spark, pdf).cache(), pdf


@pytest.mark.parametrize("series", [DAILY, CUT], ids=["whole", "cut"])
def test_primitives_match_pandas(prices, series):
    df, pdf = prices
    out = by_series(with_features(
        df, win.diff("close"), win.pct_change("close"), win.shift("close", 3), win.shift("close", -2),
        win.rolling_mean("close", 5), win.rolling_mean("close", 40), win.rolling_std("close", 6),
        win.rolling_std("close", 6, 0), win.rolling_max("high", 7), win.cum_sum("close"),
        series=series,
    ))
    g = pdf.groupby("symbol")["close"]
    want = {
        "diff_close": g.diff(), "shift3_close": g.shift(3), "shift-2_close": g.shift(-2),
        "pct_close": g.transform(lambda s: s.ffill() / s.ffill().shift() - 1),
        "mean5_close": g.transform(lambda s: s.rolling(5).mean()),
        "mean40_close": g.transform(lambda s: s.rolling(40).mean()),
        "std6_close": g.transform(lambda s: s.rolling(6).std()),
        "pstd6_close": g.transform(lambda s: s.rolling(6).std(ddof=0)),
        "max7_high": pdf.groupby("symbol")["high"].transform(lambda s: s.rolling(7).max()),
        "cumsum_close": g.cumsum(),
    }
    for name, values in want.items():
        assert close_to(out[name], values), name


@pytest.mark.parametrize("series", [DAILY, CUT], ids=["whole", "cut"])
@pytest.mark.parametrize("span", [2, 12, 26])
def test_ema_is_pandas_ewm(prices, series, span):
    df, pdf = prices
    out = by_series(with_features(
        df, ema("close", span).named("plain"), ema("close", span, span).named("warm"), series=series
    ))
    g = pdf.groupby("symbol")["close"]
    assert close_to(out["plain"], g.transform(lambda s: s.ewm(span=span, adjust=False).mean()))
    assert close_to(
        out["warm"], g.transform(lambda s: s.ewm(span=span, adjust=False, min_periods=span).mean())
    )


def test_ema_over_many_blocks(spark):
    """More rows than one block holds, and a value far from zero."""
    pdf = make_bars({"A": 6000})
    pdf["close"] += 1e6
    out = by_series(with_features(to_spark(spark, pdf), ema("close", 9).named("y")))
    assert close_to(out["y"], pdf["close"].ewm(span=9, adjust=False).mean(), 1e-12)


@pytest.mark.parametrize("series", [DAILY, CUT], ids=["whole", "cut"])
def test_seeded_wilder(spark, series):
    pdf = make_bars({"A": 90, "B": 13})
    out = by_series(with_features(to_spark(spark, pdf), wilder("close", 14, True).named("y"), series=series))
    x = pdf[pdf.symbol == "A"]["close"].to_numpy()
    want = np.full(len(pdf), np.nan)
    want[13] = x[:14].mean()
    for i in range(14, 90):
        want[i] = want[i - 1] + (x[i] - want[i - 1]) / 14
    assert close_to(out["y"], want)


@pytest.mark.parametrize("series", [DAILY, CUT], ids=["whole", "cut"])
def test_averages_survive_long_gaps(spark, series, monkeypatch):
    """Runs of missing values longer than chunks, and one in which the old average dies out."""
    monkeypatch.setattr("tickloom.plans.running.FAN", 3)
    pdf = make_bars({"A": 700, "B": 400, "C": 1500})
    pdf["close"] = pdf["close"].where(~((pdf.symbol == "A") & pdf.index.isin(range(60, 640))))
    pdf["close"] = pdf["close"].where(~((pdf.symbol == "B") & (pdf.groupby("symbol").cumcount() % 90 > 0)))
    pdf["close"] = pdf["close"].where(~((pdf.symbol == "C") & pdf.groupby("symbol").cumcount().between(3, 1480)))
    out = by_series(with_features(
        to_spark(spark, pdf), ema("close", 2).named("fast"), ema("close", 12, 4).named("warm"),
        wilder("close", 5).named("wilder"), wilder("close", 5, True).named("seeded"),
        ema(ema("close", 12), 9).named("twice"), win.shift(ema("close", 12), 3).named("late"),
        series=series,
    ))
    g = pdf.groupby("symbol")["close"]
    assert close_to(out["fast"], g.transform(lambda s: s.ewm(span=2, adjust=False).mean()))
    assert close_to(out["warm"], g.transform(lambda s: s.ewm(span=12, adjust=False, min_periods=4).mean()))
    assert close_to(out["wilder"], g.transform(lambda s: s.ewm(alpha=0.2, adjust=False, min_periods=5).mean()))
    once = g.transform(lambda s: s.ewm(span=12, adjust=False).mean())
    assert close_to(out["twice"], once.groupby(pdf.symbol).transform(lambda s: s.ewm(span=9, adjust=False).mean()))
    assert close_to(out["late"], once.groupby(pdf.symbol).shift(3))
    # Fifth values stand in row 4 of A, row 360 of B and row 1482 of C.
    assert out["seeded"].notna().groupby(pdf.symbol).sum().to_dict() == {"A": 696, "B": 40, "C": 18}
    assert (out["seeded"].notna() == out["wilder"].notna()).all()


def test_cut_seed_is_the_whole_seed(spark):
    """The first n values of a seed lie in several chunks."""
    pdf = make_bars({"A": 900, "B": 300})
    pdf["close"] = pdf["close"].where(pdf.groupby("symbol").cumcount() % 30 == 7)
    df = to_spark(spark, pdf)
    whole, cut = (by_series(with_features(df, wilder("close", 4, True).named("y"), series=s)) for s in (DAILY, CUT))
    assert whole["y"].notna().sum() > 900 and close_to(whole["y"], cut["y"])


@pytest.mark.parametrize("kind", ["sum", "product", "last", "first"])
def test_running_values_carry_over_buckets(spark, kind):
    df = to_spark(spark, make_bars({"A": 200, "B": 3}, gaps=0.5))
    item = Running("r", kind, F.col("close") / 100)
    whole = by_series(with_running(df, [item], DAILY))
    for bucket in (50, (7, 70), (3, 30, 120)):
        cut = by_series(with_running(df, [item], Series(chunk_rows=37, bucket=bucket)))
        assert close_to(whole["r"], cut["r"], 1e-8), bucket


def test_full_buckets_are_divided(spark):
    """One key with a third of all rows in one day: narrow buckets lie inside wide ones."""
    rows = [("HOT", i, 1.0) for i in range(300)] + [(f"K{i % 50}", 10 * i, 1.0) for i in range(600)]
    df = spark.createDataFrame(rows, "symbol string, i bigint, x double").withColumn(
        "ts", F.timestamp_seconds(1_700_000_000 + F.col("i"))
    )
    series = Series("symbol", "ts")
    assert series.widths(df) == [1, 1 << 16]
    out = with_running(df, [Running("n", "sum", F.col("x"))], series)
    assert sorted(r.n for r in out.filter("symbol = 'HOT'").collect()) == [float(i) for i in range(1, 301)]


def test_growth_and_sequences(spark):
    pdf = make_bars({"A": 30})
    df = with_features(to_spark(spark, pdf), win.pct_change("close").named("r"))
    out = by_series(with_features(df, win.cum_growth("r").named("g"), win.lag_sequence("close", 10).named("s")))
    assert close_to(out["g"], pdf["close"] / pdf["close"][0])
    assert out["s"][:10].isna().all()
    assert list(out["s"][12]) == list(pdf["close"][2:12])


def test_empty_input(spark):
    df = to_spark(spark, make_bars({"A": 3})).filter("close < 0")
    for series in (DAILY, CUT):
        assert with_features(df, ema("close", 12), win.rolling_mean("close", 3), series=series).count() == 0


def test_partition_count_does_not_matter(spark):
    df = to_spark(spark, make_bars(SIZES))
    results = []
    for n in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(by_series(with_features(df, ema("close", 12).named("y"), win.pct_change("close"), series=CUT)))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0].equals(results[1])

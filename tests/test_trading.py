import numpy as np
import pytest

from tests.frames import by_series, close_to, make_bars, to_spark
from tickloom import DAILY, Series
from tickloom.operators import backtest as book

CUT = Series(chunk_rows=16, bucket=20)


def step_loop(close, action):
    was, entry, rewards = 0, None, []
    for c, a in zip(close, action):
        reward = 0.0
        if a != was:
            if a == 0:
                reward = c - entry
            entry = c
        was = a
        rewards.append(reward)
    return rewards


@pytest.mark.parametrize("series", [DAILY, CUT], ids=["whole", "cut"])
def test_book_equals_step_loop(spark, series):
    pdf = make_bars({"A": 150, "B": 1, "C": 40})
    pdf["action"] = np.random.default_rng(1).integers(0, 2, len(pdf))
    df = to_spark(spark, pdf)
    out = book.backtest(df, series=series)
    got = by_series(book.equity_curve(out, series=series))
    want = np.concatenate([step_loop(g["close"], g["action"]) for _, g in pdf.groupby("symbol")])
    assert close_to(got["reward"], want)
    first = pdf.groupby("symbol")["close"].transform("first")
    total = got.groupby("symbol")["reward"].cumsum()
    assert close_to(got["equity"], first + total)


def test_constant_action_earns_nothing(spark):
    pdf = make_bars({"A": 30})
    for a in (0, 1):
        pdf["action"] = a
        assert book.total_reward(book.backtest(to_spark(spark, pdf))).first().total_reward == 0


@pytest.mark.parametrize("series", [DAILY, CUT], ids=["whole", "cut"])
def test_buy_and_hold(spark, series):
    pdf = make_bars({"A": 60, "B": 20})
    pdf["stake"] = 10.0
    df = to_spark(spark, pdf)
    assert close_to(by_series(book.buy_and_hold(df, series=series))["buy_and_hold"], pdf["close"])
    own = by_series(book.buy_and_hold(df, initial="stake", series=series))["buy_and_hold"]
    growth = pdf.groupby("symbol")["close"].transform(lambda s: (1 + s.pct_change().fillna(0)).cumprod())
    assert close_to(own, 10 * growth)

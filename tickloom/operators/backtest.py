"""Long/flat trading book, equity curve and the buy-and-hold comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.window import filled
from tickloom.plans import DAILY, Feature, Running, Series, with_features, with_running
from tickloom.plans.scratch import stored


def backtest(
    df: DataFrame, action: str = "action", price: str = "close", series: Series = DAILY
) -> DataFrame:
    """Step reward of following the actions (1 long, 0 flat), starting flat.

    When the position flips out of long, the reward is the price minus the price at the
    flip into long, which is the last flip before it.
    """
    was = Feature("_was", lambda w: F.lag(action, 1, 0).over(w), back=1)
    flip = Feature("_flip", lambda w: F.col(action) != F.col("_was"), (was,))
    rows = with_features(df, flip, series=series)
    if series.cut_rows(df) is not None:
        rows = stored(rows)  # a cut scan reads its input twice
    entry = Running("_entry", "last", F.when(F.col("_flip"), F.col(price)), before=True)
    out = with_running(rows, [entry], series)
    closed = F.col("_flip") & (F.col(action) == 0)
    reward = F.when(closed, F.col(price) - F.col("_entry")).otherwise(0.0)
    return out.withColumn("reward", reward).select(*df.columns, "reward")


def total_reward(df: DataFrame, series: Series = DAILY) -> DataFrame:
    return df.groupBy(*series.keys).agg(F.sum("reward").alias("total_reward"))


def equity_curve(
    df: DataFrame, price: str = "close", series: Series = DAILY
) -> DataFrame:
    """First price of the series plus the rewards earned so far."""
    start = Running("_initial", "first", F.col(price))
    won = Running("_won", "sum", F.col("reward"))
    rows = with_running(df, [start, won], series)
    return rows.withColumn("equity", F.col("_initial") + F.col("_won")).select(*df.columns, "equity")


def buy_and_hold(
    df: DataFrame, price: str = "close", initial: str | None = None, series: Series = DAILY
) -> DataFrame:
    """Initial price times the growth so far; ``initial`` names a column to start from instead.

    The product of all returns is the price now over the first price, so no product is needed.
    """
    start, now = Running("_first", "first", F.col(price)), filled(price)
    rows = with_running(df, [start, now], series)
    growth = F.try_divide(F.col(now.name), F.col("_first"))
    stake = F.col(initial or "_first")
    return rows.withColumn("buy_and_hold", stake * growth).select(*df.columns, "buy_and_hold")


def compare_strategies(
    actual: DataFrame, portfolio: DataFrame, on: Sequence[str] = ("symbol", "idx")
) -> DataFrame:
    """Close, buy-and-hold and portfolio value side by side, over the steps both sides have."""
    return actual.join(portfolio, list(on))

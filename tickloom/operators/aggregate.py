"""Aggregates of series: return statistics, snapshots, resampling, votes and error measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import month_start
from tickloom.functions.window import pct_change
from tickloom.plans import DAILY, Series, with_features


def return_stats(df: DataFrame, price: str = "close", series: Series = DAILY) -> DataFrame:
    """Mean and sample deviation of the daily returns, one row per series."""
    change = pct_change(price)
    return (
        with_features(df, change, series=series)
        .groupBy(*series.keys)
        .agg(F.avg(change.name).alias("mean_return"), F.stddev_samp(change.name).alias("volatility"))
    )


def latest_snapshot(df: DataFrame, cols: Sequence[str], series: Series = DAILY) -> DataFrame:
    """The listed columns of the last row of each series, without a sort where they have fixed width."""
    return df.groupBy(*series.keys).agg(*[F.max_by(c, series.order).alias(c) for c in cols])


def resample_first(
    df: DataFrame, value: str, series: Series = DAILY, month: str = "month"
) -> DataFrame:
    """First non-missing value per calendar month; months without one are kept as NULL."""
    day = F.col(series.order)
    rows = df.withColumn(month, month_start(day))
    firsts = rows.groupBy(*series.keys, month).agg(
        F.min_by(value, F.when(F.col(value).isNotNull(), day)).alias(value)
    )
    # At most 12 rows per series and year from here on.
    spans = firsts.groupBy(*series.keys).agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
    months = spans.select(
        *series.keys, F.explode(F.expr("sequence(_a, _b, interval 1 month)")).alias(month)
    )
    return months.join(firsts, [*series.keys, month], "left")


def majority_vote(
    df: DataFrame, cells: Sequence[str], action: str = "action", model_order: str = "model_ord"
) -> DataFrame:
    """Most frequent action per cell; among equals the one met first in model order."""
    counted = df.groupBy(*cells, action).agg(
        F.count(F.lit(1)).alias("_n"), F.min(model_order).alias("_first")
    )
    best = F.max_by(action, F.struct(F.col("_n"), -F.col("_first"))).alias(action)
    return counted.groupBy(*cells).agg(best)


def mse(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    e = F.col(actual) - F.col(predicted)
    return df.groupBy(*by).agg(F.avg(e * e).alias("mse"))


def mae(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mae"))


def pinball_loss(
    df: DataFrame, actual: str, predicted: str, quantiles: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantile loss of each quantile in one pass, then one row per quantile."""
    e = F.col(actual) - F.col(predicted)
    losses = df.groupBy(*by).agg(
        *[F.avg(F.greatest(q * e, (q - 1) * e)).alias(f"_q{i}") for i, q in enumerate(quantiles)]
    )
    pairs = F.array(*[
        F.struct(F.lit(q).alias("quantile"), F.col(f"_q{i}").alias("pinball"))
        for i, q in enumerate(quantiles)
    ])
    return losses.select(*by, F.inline(pairs))


def accuracy(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    hit = (F.col(label) == F.col(predicted)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))

"""Scaling (fit / transform / inverse) and splits.

Fitted statistics are one-row tables; transforms read them as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.rows import beside, slice_rows
from tickloom.plans import DAILY, Series


def fit_standard(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each column."""
    return df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in cols],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in cols],
    )


def _width(std: Column) -> Column:
    return F.when(std == 0, 1.0).otherwise(std)


def standardize(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / deviation; a constant column becomes 0."""
    fit = F.col("_fit")
    return beside(df, stats, "_fit").withColumns(
        {c: (F.col(c) - fit[f"mean_{c}"]) / _width(fit[f"std_{c}"]) for c in cols}
    ).drop("_fit")


def unstandardize(df: DataFrame, stats: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Back to the original scale; maps each column to the fitted column whose scale it has."""
    fit = F.col("_fit")
    return beside(df, stats, "_fit").withColumns(
        {c: F.col(c) * _width(fit[f"std_{s}"]) + fit[f"mean_{s}"] for c, s in cols.items()}
    ).drop("_fit")


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(
        *[F.min(c).alias(f"min_{c}") for c in cols], *[F.max(c).alias(f"max_{c}") for c in cols]
    )


def minmax_scale(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min); a constant column becomes 0."""
    fit = F.col("_fit")
    return beside(df, stats, "_fit").withColumns(
        {c: (F.col(c) - fit[f"min_{c}"]) / _width(fit[f"max_{c}"] - fit[f"min_{c}"]) for c in cols}
    ).drop("_fit")


def minmax_unscale(df: DataFrame, stats: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    fit = F.col("_fit")
    return beside(df, stats, "_fit").withColumns({
        c: F.col(c) * _width(fit[f"max_{s}"] - fit[f"min_{s}"]) + fit[f"min_{s}"]
        for c, s in cols.items()
    }).drop("_fit")


def inverse_softplus(y: Column) -> Column:
    """ln(eʸ - 1) without overflow; defined for y > 0."""
    return F.when(y > 0, y + F.log(-F.expm1(-y)))


def softplus(z: Column) -> Column:
    """ln(1 + eᶻ) without overflow."""
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def fit_group(df: DataFrame, y: str, group: Sequence[str]) -> DataFrame:
    """Centre and scale of the softplus-inverse of y, one row per group."""
    z = inverse_softplus(F.col(y))
    return df.groupBy(*group).agg(F.avg(z).alias("center"), F.stddev_samp(z).alias("scale"))


def group_normalize(df: DataFrame, stats: DataFrame, y: str, group: Sequence[str]) -> DataFrame:
    z = (inverse_softplus(F.col(y)) - F.col("center")) / F.col("scale")
    return df.join(stats, list(group), "left").withColumn(y, z).select(*df.columns)


def group_denormalize(df: DataFrame, stats: DataFrame, z: str, group: Sequence[str]) -> DataFrame:
    y = softplus(F.col(z) * F.col("scale") + F.col("center"))
    return df.join(stats, list(group), "left").withColumn(z, y).select(*df.columns)


def split_temporal(
    df: DataFrame,
    parts: Mapping[str, tuple[int | None, int | None]],
    series: Series = DAILY,
) -> dict[str, DataFrame]:
    """Named positional slices per series; they may overlap."""
    return {name: slice_rows(df, a, b, series) for name, (a, b) in parts.items()}


def split_random(
    df: DataFrame, share: float, ids: Sequence[str], seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and holdout rows by a hash of ``ids``, the same on every run and partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids])
    ticket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)
    return df.filter(ticket >= share), df.filter(ticket < share)

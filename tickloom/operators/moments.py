"""Fitted scales that are kept and updated: mergeable moments of each group, a rule for groups that were never seen.

A fit is a long table, a row for each group and column: n, mean, m2 (squared distances from the mean), lowest, highest.
It can be written, read again and merged with the fit of new days: the merged fit is the fit of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.rows import beside

FIT = ("n", "mean", "m2", "lowest", "highest")


def fit_moments(df: DataFrame, cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """group, column and the moments of each; missing values are left out, columns without a value have n = 0."""
    def moments(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.count(x).alias("n"), F.avg(x).alias("mean"),
            (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("lowest"), F.max(x).alias("highest"))

    fitted = df.groupBy(*group).agg(F.array(*[moments(c) for c in cols]).alias("_fit"))
    return fitted.select(*group, F.inline("_fit"))


def merge_moments(fits: Sequence[DataFrame], group: Sequence[str] = ()) -> DataFrame:
    """The moments of the rows of all fits together."""
    rows = reduce(DataFrame.unionByName, [f.select(*group, "column", *FIT) for f in fits])
    # distances from one of the means: no digits are lost when the level lies far from zero
    here = F.min("mean").over(Window.partitionBy(*group, "column"))
    gap, n = F.col("mean") - F.col("_here"), F.col("n")
    sums = rows.withColumn("_here", here).groupBy(*group, "column").agg(
        F.sum(n).alias("n"), F.sum(n * gap).alias("_gap"), F.sum(n * gap * gap).alias("_square"), F.sum("m2").alias("_m2"),
        F.max("_here").alias("_here"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))
    mean = F.try_divide("_gap", "n")
    return sums.select(
        *group, "column", "n", (F.col("_here") + mean).alias("mean"),
        F.greatest(F.col("_m2") + F.col("_square") - F.col("_gap") * mean, F.lit(0.0)).alias("m2"), "lowest", "highest")


def scale_by(
    df: DataFrame, fit: DataFrame, cols: Sequence[str], group: Sequence[str] = (), kind: str = "standard", unseen: str = "overall"
) -> DataFrame:
    """The columns on the scale of their group's fit: (x - mean) / deviation, or (x - lowest) / (highest - lowest).

    A constant column becomes 0. Rows of a group that the fit has not seen are scaled by all groups together
    (``unseen="overall"``) or become NULL (``"null"``). The fit may be one kept from earlier days.
    """
    if kind not in ("standard", "minmax") or unseen not in ("overall", "null"):
        raise ValueError("kind is standard or minmax, unseen overall or null")
    entry = F.struct(*FIT)

    def wide(f: DataFrame, *keys: str) -> DataFrame:
        named = [F.max(F.when(F.col("column") == c, entry)).alias(f"_fit_{c}") for c in cols]
        return f.groupBy(*keys).agg(F.struct(*named).alias("_own" if keys else "_all"))

    rows = df
    if group:
        rows = rows.join(wide(fit, *group), list(group), "left")
    overall = merge_moments([fit.select("column", *FIT)])
    rows = beside(rows, wide(overall).select("_all.*"), "_all")

    def scaled(c: str) -> Column:
        f = F.col("_all")[f"_fit_{c}"]
        if group:
            own = F.col("_own")[f"_fit_{c}"]
            f = F.coalesce(own, f) if unseen == "overall" else own
        low, width = (f["mean"], F.sqrt(f["m2"] / f["n"])) if kind == "standard" else (f["lowest"], f["highest"] - f["lowest"])
        return (F.col(c) - low) / F.when(width == 0, 1.0).otherwise(width)

    return rows.withColumns({c: scaled(c) for c in cols}).select(*df.columns)

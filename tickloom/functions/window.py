"""Window primitives over a series (differences, rolling and running values).

A rolling value appears only where its frame is full and has no NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.plans import Feature, Running

Source = str | Feature
LONG_FRAME = 40


def source(x: Source) -> tuple[str, tuple[Feature, ...]]:
    """Column name of an input and the features that must exist first."""
    return (x, ()) if isinstance(x, str) else (x.name, (x,))


def derived(name: str, expr: Column, *needs: Feature | Running) -> Feature:
    """A plain expression over already computed columns."""
    return Feature(name, lambda w: expr, needs)


def so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def diff(x: Source) -> Feature:
    """x minus the previous x; NULL in the first row."""
    c, needs = source(x)
    return Feature(f"diff_{c}", lambda w: F.col(c) - F.lag(c).over(w), needs, back=1)


def shift(x: Source, k: int = 1) -> Feature:
    """The value k rows back (ahead when k is negative)."""
    c, needs = source(x)
    return Feature(
        f"shift{k}_{c}", lambda w: F.lag(c, k).over(w), needs, back=max(k, 0), ahead=max(-k, 0)
    )


def filled(x: str) -> Running:
    """The last non-NULL value up to and including this row."""
    return Running(f"filled_{x}", "last", F.col(x))


def pct_change(x: str) -> Feature:
    """x over the previous x, minus 1, after carrying the last value over gaps."""
    f = filled(x)
    return Feature(
        f"pct_{x}",
        lambda w: F.try_divide(F.col(f.name), F.lag(f.name).over(w)) - 1,
        (f,),
        back=1,
    )


def rolling(name: str, agg: Callable[[str], Column], x: Source, n: int) -> Feature:
    """``agg`` over the last n rows, where all n hold a value."""
    c, needs = source(x)

    def expr(w: WindowSpec) -> Column:
        frame = w.rowsBetween(1 - n, 0)
        return F.when(F.count(c).over(frame) == n, agg(c).over(frame))

    return Feature(f"{name}{n}_{c}", expr, needs, back=n - 1)


def rolling_mean(x: Source, n: int) -> Feature:
    """Mean of the last n rows, where all n hold a value.

    Spark adds up a moving frame anew for every row, so a long one is the sum of m-row sums
    m rows apart: m + n/m steps instead of n.
    """
    m = max(d for d in range(1, math.isqrt(n) + 1) if n % d == 0)
    if n < LONG_FRAME or m == 1:
        return rolling("mean", F.avg, x, n)
    c, _ = source(x)
    part = rolling("sum", F.sum, x, m)

    def expr(w: WindowSpec) -> Column:
        total = F.col(part.name)
        for back in range(m, n, m):
            total = total + F.lag(part.name, back).over(w)
        return total / n

    return Feature(f"mean{n}_{c}", expr, (part,), back=n - m)


def rolling_std(x: Source, n: int, ddof: int = 1) -> Feature:
    return rolling("std", F.stddev_samp, x, n) if ddof else rolling("pstd", F.stddev_pop, x, n)


def rolling_max(x: Source, n: int) -> Feature:
    return rolling("max", F.max, x, n)


def rolling_min(x: Source, n: int) -> Feature:
    return rolling("min", F.min, x, n)


def cum_sum(x: str) -> Feature:
    """Running total of the non-NULL values; NULL where x is NULL."""
    r = Running(f"_total_{x}", "sum", F.col(x))
    return derived(f"cumsum_{x}", F.when(F.col(x).isNotNull(), F.col(r.name)), r)


def cum_growth(r: str) -> Feature:
    """Running product of 1 + r, a missing r counting as 0."""
    p = Running(f"_growth_{r}", "product", F.lit(1.0) + F.coalesce(F.col(r), F.lit(0.0)))
    return derived(f"growth_{r}", F.col(p.name), p)


def lag_sequence(x: str, n: int) -> Feature:
    """The n values before this row, oldest first; NULL until n exist."""

    def expr(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-n, -1)
        return F.when(F.count(x).over(frame) == n, F.collect_list(x).over(frame))

    return Feature(f"seq{n}_{x}", expr, back=n)

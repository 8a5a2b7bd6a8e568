"""Scalar, date, string and array helpers used by the analyses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound x below and above; NULL stays NULL."""
    out = x if low is None else F.greatest(x, F.lit(low))
    out = out if high is None else F.least(out, F.lit(high))
    return F.when(x.isNotNull(), out)


def keep_where(x: Column, condition: Column, other: float = 0.0) -> Column:
    """x where the condition holds, else ``other`` (also where it is unknown)."""
    return F.when(condition, x).otherwise(F.lit(other))


def rowwise_max(*cols: Column) -> Column:
    """Largest of the columns, ignoring NULLs."""
    return F.greatest(*cols)


def from_epoch_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month").cast("date")


def days_between(first: Column, last: Column) -> Column:
    """Every day from first to last, as an array."""
    return F.sequence(first, last)


def wave(index: Column, n: int, start: float, stop: float) -> tuple[Column, Column]:
    """The index-th of n evenly spaced points from start to stop, and its sine."""
    x = F.lit(float(start)) + index * F.lit((stop - start) / (n - 1))
    return x, F.sin(x)


def fit_length(values: Column, n: int, pad: float | int | str | None = 0) -> Column:
    """The first n elements, padded at the end to exactly n."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(pad), n)), 1, n)


def middle(values: Column) -> Column:
    """The middle element of an array of quantiles."""
    return F.try_element_at(values, (F.floor(F.size(values) / 2) + 1).cast("int"))


def news_prompt(text: Column, sentiment: Column) -> Column:
    # Fixed value: the prompt wording.
    return F.format_string(
        "News: %s The news has sentiment: %s. "
        "Relevant stock advice based on news and sentiment:",
        text, sentiment,
    )


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def token_window(text: Column, n: int = 128) -> tuple[Column, Column]:
    """The first n word tokens padded with '' to n, and the 1/0 mask of real tokens."""
    tokens = fit_length(words(text), n, "")
    return tokens, F.transform(tokens, lambda t: F.when(t != "", 1).otherwise(0))

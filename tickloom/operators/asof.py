"""Backward as-of joins, panel alignment and per-series statistics.

Two exact plans, chosen from the schema:

* calendar: an un-keyed right side dated by day is expanded to one row per day (so it is at
  most 366 rows a year) and broadcast; the left side is not shuffled.
* points: otherwise the distinct left (key, time) points and the right rows are scanned
  together and the last right row is carried forward, in time buckets where a series is long.
  The answers are joined back by equality, so many left rows at one time cost one lookup.

In both plans right rows of equal key and time are first reduced to the largest, compared column by
column in the right side's order (NULL is least), so ties have one answer and a key has one row a day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.window import pct_change
from tickloom.plans import DAILY, Running, Series, with_features, with_running
from tickloom.plans.scratch import stored


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str = "date",
    by: Sequence[str] = (),
    bucket: int | None = None,
) -> DataFrame:
    """Each left row with the latest right row at or before it; unmatched rows keep NULLs."""
    if not by and _is_date(left, on) and _is_date(right, on):
        return enrich_asof(left, [right], on)
    return _asof_points(left, right, on, list(by), bucket)


def enrich_asof(
    left: DataFrame, rights: Sequence[DataFrame], on: str = "date", suffixes: Sequence[str] | None = None
) -> DataFrame:
    """Chain of as-of joins against daily or slower series: one broadcast calendar.

    ``suffixes``, one for each right side, are put behind its columns whose names the left side or an earlier
    right side has; without them names must not clash. A left row without a day matches nothing. Days after the last right row use its values. The calendar, a
    few hundred rows a year, is written once so that its sources are read once.
    """
    if suffixes is not None:
        rights = _renamed(left, rights, on, suffixes)
    calendar = stored(daily_calendar(rights, on))
    values = [c for c in calendar.columns if c != on]
    end = calendar.agg(F.max(on)).scalar()
    looked_up = calendar.withColumnRenamed(on, "_day")
    return (
        left.withColumn("_day", F.when(F.col(on).isNotNull(), F.least(F.col(on), end)))
        .join(F.broadcast(looked_up), "_day", "left")
        .select(*left.columns, *values)
    )


def _renamed(left: DataFrame, rights: Sequence[DataFrame], on: str, suffixes: Sequence[str]) -> list[DataFrame]:
    taken, out = set(left.columns), []
    for right, suffix in zip(rights, suffixes, strict=True):
        names = {c: c + suffix if c in taken else c for c in right.columns if c != on}
        if len(set(names.values()) | taken) < len(names) + len(taken):
            raise ValueError(f"suffix {suffix!r} leaves clashing names: {sorted(names.values())}")
        taken |= set(names.values())
        out.append(right.withColumnsRenamed(names))
    return out


def daily_calendar(rights: Sequence[DataFrame], on: str = "date") -> DataFrame:
    """One row per day from the first to the last right row, holding the values then known."""
    stacked, names = None, []
    for i, right in enumerate(rights):
        part = right.select(on, F.struct(*[c for c in right.columns if c != on]).alias(f"_s{i}"))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
        names.append(f"_s{i}")
    # One row per day: what follows is bounded by the calendar, also in its one-group window.
    days = stacked.groupBy(on).agg(*[F.max(s).alias(s) for s in names])
    w = Window.partitionBy(F.lit(0)).orderBy(on)
    known = days.select(
        F.col(on).alias("_from"),
        F.lead(on).over(w).alias("_next"),
        *[F.last(s, True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(s) for s in names],
    )
    until = F.coalesce(F.date_sub("_next", 1), F.col("_from"))
    return known.select(
        F.explode(F.sequence("_from", until)).alias(on), *[F.col(f"{s}.*") for s in names]
    )


def _asof_points(
    left: DataFrame, right: DataFrame, on: str, by: list[str], bucket: int | None
) -> DataFrame:
    payload = [c for c in right.columns if c not in {on, *by}]
    renamed = {c: f"_k{i}" for i, c in enumerate([*by, on])}
    # One name for the key columns and the time, so that both sides stack.
    keys, at = [renamed[b] for b in by], renamed[on]
    ids = [F.col(c).alias(n) for c, n in renamed.items()]
    asked = left.select(*ids).distinct().withColumn("_match", F.lit(None))
    given = right.select(*ids, F.struct(*payload).alias("_match")).groupBy(*keys, at).agg(
        F.max("_match").alias("_match")
    )
    both = given.select(*keys, at, "_match", F.lit(0).alias("_ask")).unionByName(
        asked.select(*keys, at, F.col("_match").cast(given.schema["_match"].dataType), F.lit(1).alias("_ask"))
    )
    if not keys:
        both = both.withColumn("_all", F.lit(0))
    # A right row at the same time counts, so it sorts before the question.
    series = Series(tuple(keys) or ("_all",), at, bucket=bucket, ties=("_ask",))
    seen = Running("_seen", "last", F.col("_match"))
    answers = with_running(both, [seen], series).filter(F.col("_ask") == 1)
    answers = answers.select(*keys, at, "_seen")
    same = [F.col(c) == F.col(n) for c, n in renamed.items()]
    return left.join(answers, same, "left").select(
        *left.columns, *[F.col("_seen")[c].alias(c) for c in payload]
    )


def align_panel(
    df: DataFrame, symbols: Sequence[str], value: str, index: str = "month", key: str = "symbol"
) -> DataFrame:
    """Series side by side on a common index: one column per listed symbol."""
    return df.groupBy(index).pivot(key, list(symbols)).agg(F.first(value, ignorenulls=True))


def broadcast_stat(
    df: DataFrame, price: str = "close", series: Series = DAILY
) -> DataFrame:
    """Mean and sample deviation of the returns of the whole series, on every row."""
    change = pct_change(price)
    rows = with_features(df, change, series=series)
    return series_stats(rows, change.name, series).select(*df.columns, *RETURN_STATS)


RETURN_STATS = ["mean_return", "volatility"]


def series_stats(df: DataFrame, change: str, series: Series = DAILY) -> DataFrame:
    """Mean and sample deviation of a column over the whole series, on every row.

    A calendar-bounded series needs no further exchange after its windows; statistics of a long
    one are aggregated (map-side first) and joined.
    """
    stats = dict(zip(RETURN_STATS, (F.avg(change), F.stddev_samp(change))))
    if series.cut_rows(df) is None:
        whole = Window.partitionBy(*series.keys)
        return df.withColumns({n: s.over(whole) for n, s in stats.items()})
    per = df.groupBy(*series.keys).agg(*[s.alias(n) for n, s in stats.items()])
    return df.join(per, series.keys, "left").select(*df.columns, *stats)


def _is_date(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.DateType)

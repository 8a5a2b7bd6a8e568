"""Row-level operators on series tables: projections, filters, positions, slices, stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.window import shift
from tickloom.plans import DAILY, Running, Series, with_features, with_running
from tickloom.plans.running import position

# Steps of a gap that one array opens, in forward_fill.
STRETCH = 4096


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def derive(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns computed from the row (rescaled values, constants, calendar parts)."""
    return df.withColumns(columns)


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any missing value in ``cols`` (all columns by default)."""
    return df.na.drop("any", subset=list(cols) if cols else None)


def fill_const(df: DataFrame, value: float, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(value, subset=list(cols) if cols else None)


def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values take the column's mean over all rows."""
    out = beside(df, df.agg(*[F.avg(c).alias(c) for c in cols]), "_mean")
    return out.withColumns({c: F.coalesce(c, f"_mean.{c}") for c in cols}).drop("_mean")


def beside(df: DataFrame, stats: DataFrame, name: str) -> DataFrame:
    """A one-row table on every row, as one struct column (a single scalar subquery)."""
    return df.withColumn(name, stats.select(F.struct("*").alias("_row")).scalar())


def row_index(df: DataFrame, name: str = "time_idx", series: Series = DAILY) -> DataFrame:
    """Dense 0-based position per series."""
    return with_running(df, [position(name)], series).withColumn(name, F.col(name) - 1)


def with_length(df: DataFrame, name: str, series: Series = DAILY) -> DataFrame:
    """Row count of the series on every row."""
    if series.cut_rows(df) is None:
        return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*series.keys)))
    sizes = df.groupBy(*series.keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(sizes, series.keys, "left").select(*df.columns, name)


def slice_rows(
    df: DataFrame, start: int | None = None, stop: int | None = None, series: Series = DAILY
) -> DataFrame:
    """Positional slice per series with Python rules; negative counts from the end."""
    out = row_index(df, "_at", series)
    if any(b is not None and b < 0 for b in (start, stop)):
        out = with_length(out, "_len", series)

    def bound(b: int) -> Column:
        return F.lit(b) if b >= 0 else F.col("_len") + b

    if start is not None:
        out = out.filter(F.col("_at") >= bound(start))
    if stop is not None:
        out = out.filter(F.col("_at") < bound(stop))
    return out.select(*df.columns)


def min_history(df: DataFrame, n: int, series: Series = DAILY) -> DataFrame:
    """Keep the series with at least n rows."""
    return with_length(df, "_len", series).filter(F.col("_len") >= n).select(*df.columns)


def head(df: DataFrame, n: int, series: Series = DAILY) -> DataFrame:
    return slice_rows(df, 0, n, series)


def rule_label(
    df: DataFrame,
    name: str = "label",
    macd: str = "macd",
    rsi: str = "rsi",
    position: str = "band_position",
) -> DataFrame:
    """1 for a rising, not overheated price near the lower band, else 0."""
    # RSI between 30 and 70, band position below 0.2.
    buy = (
        (F.col(macd) > 0) & (F.col(rsi) > 30) & (F.col(rsi) < 70) & (F.col(position) < 0.2)
    )
    return df.withColumn(name, F.when(buy, 1).otherwise(0))


def remap(df: DataFrame, col: str, mapping: Mapping[int, int], name: str | None = None) -> DataFrame:
    """Replace listed values; others stay."""
    value = F.col(col)
    out = value
    for old, new in mapping.items():
        out = F.when(value == old, F.lit(new)).otherwise(out)
    return df.withColumn(name or col, out)


def order_series(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """Rows in ascending order within each output partition, long series split by range."""
    by = [*series.keys, series.order]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def best_by_score(df: DataFrame, score: str, *ties: str) -> DataFrame:
    """The row with the highest score; among equals the first by ``ties``."""
    return df.orderBy(F.col(score).desc_nulls_last(), *[F.col(t).asc() for t in ties]).limit(1)


def stack(first: DataFrame, second: DataFrame, index: str, series: Series = DAILY) -> DataFrame:
    """Rows of ``first`` followed by rows of ``second`` per series, renumbered in ``index``.

    Rows keep their own order inside each part, also where the parts overlap in time. Series bounded by
    the calendar are numbered in one exchange; long ones part by part.
    """
    if series.cut_rows(first) is None and series.cut_rows(second) is None:
        cols = list(first.columns)
        both = first.withColumn("_part", F.lit(0)).unionByName(second.select(*cols).withColumn("_part", F.lit(1)))
        w = Window.partitionBy(*series.keys).orderBy("_part", series.order)
        return both.withColumn(index, F.row_number().over(w).cast("bigint") - 1).select(*cols, index)
    a, b = (
        row_index(part.withColumn("_part", F.lit(i)), "_at", series)
        for i, part in enumerate((first, second))
    )
    sizes = a.groupBy(*series.keys).agg(F.count(F.lit(1)).alias("_first_len"))
    shifted = b.join(sizes, series.keys, "left").withColumn(
        index, F.col("_at") + F.coalesce("_first_len", F.lit(0))
    )
    cols = list(first.columns)
    return (
        a.withColumn(index, F.col("_at")).select(*cols, index)
        .unionByName(shifted.select(*cols, index))
    )


def tile(df: DataFrame, n: int, index: str, series: Series = DAILY) -> DataFrame:
    """Each series n times in a row, renumbered in ``index``."""
    numbered = with_length(row_index(df, "_at", series), "_len", series)
    return (
        numbered.withColumn("_rep", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .withColumn(index, F.col("_rep") * F.col("_len") + F.col("_at"))
        .select(*df.columns, index)
    )


def recent_sample(
    df: DataFrame, cap: int = 5000, n: int = 64, order: str = "date", ids: Sequence[str] = ()
) -> DataFrame:
    """n rows drawn without replacement from the latest ``cap`` rows; none if fewer than n.

    The draw takes the smallest hashes of ``ids``, so it does not depend on partitioning.
    """
    ids = list(ids) or [order]
    latest = df.orderBy(F.col(order).desc(), *[F.col(i).asc() for i in ids]).limit(cap)
    ticket = F.md5(F.concat_ws("|", *[F.col(i).cast("string") for i in ids]))
    enough = latest.agg((F.count(F.lit(1)) >= n).alias("ok"))
    return (
        latest.filter(enough.scalar()).withColumn("_ticket", ticket).orderBy("_ticket").limit(n)
        .select(*df.columns)
    )


def recent_samples(
    df: DataFrame, cap: int = 5000, n: int = 64, ids: Sequence[str] = (), series: Series = DAILY,
) -> DataFrame:
    """The same draw for each series: n of its latest ``cap`` rows, none if it has fewer than n.

    Rows behind the latest ``cap`` of a series are left out before the shuffle, so a long series brings at most
    ``cap`` rows of each task to the one that draws. The draw takes the smallest hashes of ``ids``, else of the order.
    """
    latest = Window.partitionBy(*series.keys).orderBy(F.col(series.order).desc(), *[F.col(i).asc() for i in ids])
    ticket = F.md5(F.concat_ws("|", *[F.col(i).cast("string") for i in [*series.keys, *(ids or [series.order])]]))
    drawn = Window.partitionBy(*series.keys).orderBy("_ticket")
    everyone = Window.partitionBy(*series.keys)
    return (
        df.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= cap)
        .withColumn("_ticket", ticket)
        .withColumns({"_drawn": F.row_number().over(drawn), "_held": F.count(F.lit(1)).over(everyone)})
        .where((F.col("_drawn") <= n) & (F.col("_held") >= n)).select(*df.columns)
    )


def forward_fill(
    df: DataFrame, cols: Sequence[str], series: Series = DAILY, step: int = 1
) -> DataFrame:
    """Insert the missing time steps of each series and carry the last values over them.

    ``step`` is in days of a date, seconds of a timestamp, units of a number. Gaps are opened in stretches of
    ``STRETCH`` steps, so no array grows with a gap alone. The steps a row opens
    (itself up to the next row's) come from the row alone, so no calendar is joined and values need no lookup.
    """
    filled = with_running(
        df, [Running(f"_f_{c}", "last", F.col(c)) for c in cols], series
    )
    nxt = shift(series.order, -1)
    spans = with_features(filled, nxt, series=series)
    here, until = F.col(series.order), F.col(nxt.name)
    dates = series.cut_rows(df) is None or dict(df.dtypes)[series.order] == "date"
    if dates:
        last = F.coalesce(F.date_sub(until, 1), here)
        by = lambda n: F.expr(f"interval {n} day")
    elif dict(df.dtypes)[series.order].startswith("timestamp"):
        last = F.coalesce(until - F.expr("interval 1 microsecond"), here)
        by = lambda n: F.expr(f"interval {n} second")
    else:
        last = F.coalesce(until - 1, here)
        by = lambda n: F.lit(n).cast(df.schema[series.order].dataType)
    last = F.greatest(last, here)
    rest = [c for c in df.columns if c not in {*cols, *series.keys, series.order}]
    stretches = spans.withColumn("_last", last).withColumn(
        "_from", F.explode(F.sequence(here, F.col("_last"), by(step * STRETCH)))
    )
    until_ = F.least(F.col("_last"), F.col("_from") + by(step * (STRETCH - 1)))
    out = stretches.withColumn("_step", F.explode(F.sequence("_from", until_, by(step))))
    original = F.col("_step") == here
    return out.select(
        *series.keys,
        F.col("_step").alias(series.order),
        *[F.col(f"_f_{c}").alias(c) for c in cols],
        *[F.when(original, F.col(c)).alias(c) for c in rest],
    ).select(*df.columns)

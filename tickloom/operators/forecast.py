"""Forecast inputs (encoder/decoder samples, future rows) and autoregressive forecasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.window import diff, shift
from tickloom.operators.rows import row_index, slice_rows
from tickloom.plans import DAILY, Feature, Series, with_features
from tickloom.plans.frames import neighbourhood, spread_rows

# Fixed value: two-sided 95% point of the normal distribution.
Z95 = 1.959963984540054


def sample_blocks(
    df: DataFrame,
    known: Sequence[str],
    unknown: Sequence[str],
    encoder: int = 365,
    decoder: int = 65,
    min_encoder: int | None = None,
    min_decoder: int = 1,
    series: Series = DAILY,
) -> DataFrame:
    """key, block, rows, samples: the encoder/decoder samples of all time steps, every row stored at most twice.

    A series is cut in blocks of encoder + decoder rows, which also hold the rows their samples reach back and ahead:
    fewer than a block's own. A sample is (at, encoder_length, decoder_length): the place in ``rows`` of its last encoder
    row, and how many rows up to it and after it belong to it. Samples shorter than the minimum lengths are left out.
    ``rows`` holds the row's number in its series (``_pos``), the order, the known and the unknown columns; ``read_samples`` reads samples.
    """
    min_encoder = encoder // 2 if min_encoder is None else min_encoder
    own = encoder + decoder
    columns = list(dict.fromkeys([series.order, *known, *unknown]))
    rows = df.select(*dict.fromkeys([*series.keys, *columns]))
    if series.cut_rows(df) is None:
        rows = rows.withColumn("_pos", F.row_number().over(series.window()).cast("bigint"))
        rows, _ = spread_rows(rows, encoder - 1, decoder, own)
    else:
        rows, _ = neighbourhood(rows, [], encoder - 1, decoder, replace(series, chunk_rows=own))
    # bounded: one block's rows and their neighbours
    block = rows.groupBy(*series.keys, F.col("_chunk").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("_pos", *columns))).alias("rows"))
    first = F.col("block") * own
    every = F.transform("rows", lambda r, i: F.struct(
        i.alias("at"), F.least(F.lit(encoder), i + 1).alias("encoder_length"),
        F.least(F.lit(decoder), F.size("rows") - 1 - i).alias("decoder_length"),
        ((r["_pos"] > first) & (r["_pos"] <= first + own)).alias("own")))
    long = F.filter(every, lambda s: s["own"] & (s["encoder_length"] >= min_encoder) & (s["decoder_length"] >= min_decoder))
    return block.select(
        *series.keys, "block", "rows",
        F.transform(long, lambda s: F.struct(s["at"], s["encoder_length"], s["decoder_length"])).alias("samples"))


def read_samples(
    blocks: DataFrame,
    load: Callable[[], Callable[[np.ndarray, np.ndarray], tuple]],
    encoder_columns: Sequence[str],
    decoder_columns: Sequence[str],
    out: str = "score double",
    series: Series = DAILY,
) -> DataFrame:
    """key, order and the columns ``out``: what an injected function makes of every sample, opened inside the batch that reads it.

    The function gets two matrices, rows by columns, which are views of the block: no sample is copied. ``load`` runs
    once for each task. Missing values are NaN; the function's are NULL.
    """
    row = blocks.schema["rows"].dataType.elementType
    made = T._parse_datatype_string(out).fields
    schema = T.StructType([*[f for f in blocks.schema.fields if f.name in series.keys], row[series.order], *made])
    names = list(dict.fromkeys([*encoder_columns, *decoder_columns]))
    left, right = ([names.index(c) for c in part] for part in (encoder_columns, decoder_columns))

    def column(name: str, kind: str | None = None) -> Column:
        return F.transform("rows", lambda r: r[name].cast(kind) if kind else r[name])

    columns = blocks.where(F.size("samples") > 0).select(
        *series.keys, column(series.order).alias("_at"), "samples.at", "samples.encoder_length", "samples.decoder_length",
        *[column(c, "double").alias(f"_c{i}") for i, c in enumerate(names)])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        do = load()
        for batch in batches:
            for r in batch.to_dict("records"):
                values = np.column_stack([np.array(r[f"_c{i}"], dtype=float) for i in range(len(names))])
                back, ahead = values[:, left], values[:, right]
                found = [do(back[at + 1 - n : at + 1], ahead[at + 1 : at + 1 + m])
                         for at, n, m in zip(r["at"], r["encoder_length"], r["decoder_length"], strict=True)]
                part = pd.DataFrame(found, columns=[f.name for f in made])
                part[series.order] = np.asarray(r["_at"])[np.asarray(r["at"])]
                yield part.assign(**{k: r[k] for k in series.keys})[schema.names]

    read_ = columns.mapInPandas(read, schema)
    floats = [f.name for f in made if isinstance(f.dataType, T.DoubleType)]
    return read_.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in floats})


def forecast_samples(
    df: DataFrame,
    known: Sequence[str],
    unknown: Sequence[str],
    encoder: int = 365,
    decoder: int = 65,
    min_encoder: int | None = None,
    min_decoder: int = 1,
    series: Series = DAILY,
) -> DataFrame:
    """One sample per time step: the rows up to it and the rows after it, as arrays of structs.

    Encoder rows hold known and unknown columns, decoder rows the known ones and the target
    (first of ``unknown``). Samples shorter than the minimum lengths are left out. Every row is copied into up to
    encoder + decoder samples: ``sample_blocks`` keeps them twice at most.
    """
    min_encoder = encoder // 2 if min_encoder is None else min_encoder
    seen, ahead = F.struct(*known, *unknown), F.struct(*known, unknown[0])
    past = Feature(
        "encoder", lambda w: F.collect_list(seen).over(w.rowsBetween(1 - encoder, 0)),
        back=encoder - 1,
    )
    future = Feature(
        "decoder", lambda w: F.collect_list(ahead).over(w.rowsBetween(1, decoder)), ahead=decoder
    )
    rows = with_features(df, past, future, series=series)
    return (
        rows.select(
            *series.keys, series.order, "encoder", "decoder",
            F.size("encoder").alias("encoder_length"),
        )
        .filter((F.col("encoder_length") >= min_encoder) & (F.size("decoder") >= min_decoder))
    )


def future_frame(
    df: DataFrame, h: int = 65, index: str = "time_idx", month: str | None = "month",
    series: Series = DAILY,
) -> DataFrame:
    """The rows followed by a copy of the last h, numbered and placed onwards in steps of the order.

    Dates go on day by day and numbers by one; timestamps by the time between the series' last two rows, a day if
    there is one row, so the time of day is kept. ``month`` is taken anew from dates and timestamps.
    """
    if series.cut_rows(df) is None:
        return _future_in_place(df, h, index, month, series)
    tail = row_index(slice_rows(df, -h, None, series), "_step", series)
    ends = df.groupBy(*series.keys).agg(
        F.max(index).alias("_last_index"), F.max(series.order).alias("_last")
    )
    if not isinstance(df.schema[series.order].dataType, T.DateType):
        two = slice_rows(df.select(*series.keys, series.order), -2, None, series)
        ends = ends.join(two.groupBy(*series.keys).agg(F.min(series.order).alias("_before")), series.keys)
    scaffold = tail.join(ends, series.keys)
    scaffold = scaffold.withColumns({
        index: (F.col("_last_index") + 1 + F.col("_step")).cast(df.schema[index].dataType),
        series.order: _onwards(df, F.col("_step") + 1, series),
    })
    if month in df.columns and _dated(df, series):
        scaffold = scaffold.withColumn(month, F.month(series.order).cast(df.schema[month].dataType))
    return df.unionByName(scaffold.select(*df.columns))


def _dated(df: DataFrame, series: Series) -> bool:
    return isinstance(df.schema[series.order].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _onwards(df: DataFrame, steps: Column, series: Series) -> Column:
    """The order ``steps`` steps after ``_last``; ``_before`` is that of the row before the last."""
    kind = df.schema[series.order].dataType
    if isinstance(kind, T.DateType):
        return F.date_add("_last", steps.cast("int"))
    if not _dated(df, series):
        return (F.col("_last") + steps).cast(kind)
    gap = F.col("_last") - F.col("_before")
    day = F.expr("interval '1' day")
    return F.col("_last") + F.when(F.col("_last") > F.col("_before"), gap).otherwise(day) * steps.cast("int")


def _future_in_place(df: DataFrame, h: int, index: str, month: str | None, series: Series) -> DataFrame:
    """The same for series that are one window group: one exchange, then the last h rows are doubled."""
    whole = Window.partitionBy(*series.keys)
    seen = df.withColumns({
        "_at": F.row_number().over(whole.orderBy(series.order)),
        "_len": F.count(F.lit(1)).over(whole),
        "_last_index": F.max(index).over(whole),
        "_last": F.max(series.order).over(whole),
    })
    if not isinstance(df.schema[series.order].dataType, T.DateType):
        seen = seen.withColumn("_before", F.max(F.when(
            F.col("_at") == F.greatest(F.col("_len") - 1, F.lit(1)), F.col(series.order))).over(whole))
    # The place of a row's copy among the new rows, from 1; none for rows before the last h.
    step = F.col("_at") - F.greatest(F.col("_len") - h, F.lit(0))
    copies = F.when(step > 0, F.array(F.lit(0), step.cast("int"))).otherwise(F.array(F.lit(0)))
    doubled = seen.withColumn("_copy", F.explode(copies))
    new = F.col("_copy") > 0
    at = F.when(new, _onwards(df, F.col("_copy"), series)).otherwise(F.col(series.order))
    number = F.when(new, F.col("_last_index") + F.col("_copy")).otherwise(F.col(index))
    changed = {series.order: at, index: number.cast(df.schema[index].dataType)}
    if month in df.columns and _dated(df, series):
        changed[month] = F.when(new, F.month(at)).otherwise(F.col(month)).cast(df.schema[month].dataType)
    return doubled.withColumns(changed).select(*df.columns)


def ar_forecast(
    df: DataFrame, value: str = "close", p: int = 1, d: int = 1, h: int = 10,
    series: Series = DAILY,
) -> DataFrame:
    """h-step forecasts with 95% bounds per series from an AR(p) on d-th differences.

    The least-squares fit needs only sums of products of lags, so it is one partial-and-final
    aggregation whatever the length of a series. Values are taken from the series' mean, so that a
    distant level does not swallow the digits of the sums. The small systems (one row per series) are
    then solved in Arrow batches.
    """
    z: str | Feature = value
    levels: list[str | Feature] = [value]
    for _ in range(d):
        z = diff(z)
        levels.append(z)
    lags = [shift(z, i) for i in range(1, p + 1)]
    made = [x for x in levels if isinstance(x, Feature)]
    rows = with_features(df, *made, *lags, series=series)
    names = [x if isinstance(x, str) else x.name for x in levels]
    target = names[-1]

    if series.cut_rows(df) is None:
        rows = rows.withColumn("_mean", F.avg(target).over(Window.partitionBy(*series.keys)))
    else:
        means = rows.groupBy(*series.keys).agg(F.avg(target).alias("_mean"))
        rows = rows.join(means, series.keys, "left")
    mean = F.col("_mean")
    terms: list[Column] = [F.lit(1.0), *[F.col(x.name) - mean for x in lags], F.col(target) - mean]
    whole = F.col(lags[-1].name).isNotNull() & F.col(target).isNotNull()
    products = [
        F.sum(F.when(whole, terms[i] * terms[j])).alias(f"m{i}_{j}")
        for i in range(p + 2) for j in range(i, p + 2)
    ]
    recent = F.array(F.col(target) - mean, *[F.col(x.name) - mean for x in lags[:-1]])
    fitted = rows.groupBy(*series.keys).agg(
        *products,
        F.max("_mean").alias("_mean"),
        F.max_by(recent, F.col(series.order)).alias("_recent"),
        F.max_by(F.array(*names[:-1]), F.col(series.order)).alias("_levels")
        if d else F.first(F.array().cast("array<double>")).alias("_levels"),
    )
    keys = [f for f in df.schema.fields if f.name in series.keys]
    schema = T.StructType([
        *keys, T.StructField("step", T.IntegerType()),
        *[T.StructField(c, T.DoubleType()) for c in ("forecast", "lower", "upper")],
    ])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for row in batch.to_dict("records"):
                path = _forecast_row(row, p, d, h)
                if path is not None:
                    parts.append(pd.DataFrame({
                        **{k.name: row[k.name] for k in keys},
                        "step": np.arange(1, h + 1, dtype="int32"),
                        "forecast": path[0], "lower": path[0] - path[1], "upper": path[0] + path[1],
                    }))
            yield pd.concat(parts) if parts else pd.DataFrame(columns=schema.names)

    return fitted.mapInPandas(solve, schema)


def _forecast_row(row: dict, p: int, d: int, h: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Path and half-width of one series; None when it is too short to fit."""
    moments = np.zeros((p + 2, p + 2))
    for i in range(p + 2):
        for j in range(i, p + 2):
            x = row[f"m{i}_{j}"]
            moments[i, j] = moments[j, i] = np.nan if x is None else x
    n = moments[0, 0]
    if not n > p + 1:
        return None
    gram, cross = moments[:-1, :-1], moments[:-1, -1]
    beta = np.linalg.lstsq(gram, cross, rcond=None)[0]
    variance = max(moments[-1, -1] - beta @ cross, 0.0) / (n - p - 1)

    past = [float(x) for x in row["_recent"]]
    steps = np.empty(h)
    for k in range(h):
        steps[k] = beta[0] + float(np.dot(beta[1:], past))
        past = [steps[k], *past[:-1]]
    steps = steps + float(row["_mean"])
    for level in reversed([float(x) for x in row["_levels"]]):
        steps = level + np.cumsum(steps)

    full = np.concatenate([[1.0], -beta[1:]])
    for _ in range(d):
        full = np.convolve(full, [1.0, -1.0])
    psi = np.zeros(h)
    psi[0] = 1.0
    for k in range(1, h):
        m = min(k, len(full) - 1)
        psi[k] = -float(np.dot(full[1 : m + 1], psi[k - m : k][::-1]))
    return steps, Z95 * np.sqrt(variance * np.cumsum(psi**2))

"""Parabolic stop-and-reverse: a non-linear state machine along a series.

A calendar-bounded series runs in one group. A long series is cut in chunks that all run at
once from a warm start a few hundred rows earlier. Two runs that flip at the same row continue
identically, so nearly always the state entering a chunk equals the one leaving the chunk
before. That equality is checked for every chunk; chunks that fail it run again from the right
state until none fails, so the result is the sequential one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.plans import DAILY, Series
from tickloom.plans.frames import neighbourhood
from tickloom.plans.scratch import shared_folder

WARM_ROWS = 512
# First and added acceleration, largest acceleration.
STEP, CAP = 0.02, 0.2

State = list[float]


def psar(
    df: DataFrame,
    high: str = "high",
    low: str = "low",
    close: str = "close",
    series: Series = DAILY,
    name: str = "psar",
) -> DataFrame:
    """Append the stop level. The first two rows hold the close."""
    if series.cut_rows(df) is None:
        schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(series.order)
            levels, _, _ = run(*(pdf[c].to_numpy() for c in (high, low, close)))
            return pdf.assign(**{name: levels})

        return df.groupBy(*series.keys).applyInPandas(whole, schema)
    return _relay(df, (high, low, close), series, name)


def run(
    high: np.ndarray, low: np.ndarray, close: np.ndarray,
    state: State | None = None, mark: int = 0,
) -> tuple[np.ndarray, State, State]:
    """Levels of consecutive rows, the state before row ``mark`` and the state at the end.

    State: rows seen (up to 2), rising, level, extreme, acceleration, last two highs and lows.
    """
    seen, rising, sar, ep, af, h1, h2, l1, l2 = state or [0.0] * 9
    out = np.empty(len(high))
    marked = [seen, rising, sar, ep, af, h1, h2, l1, l2]
    for i, (h, l, c) in enumerate(zip(high.tolist(), low.tolist(), close.tolist())):
        if i == mark:
            marked = [seen, rising, sar, ep, af, h1, h2, l1, l2]
        if not (h == h and l == l and c == c):
            out[i] = np.nan
            continue
        if seen < 2:
            sar = c
            if seen == 0:
                rising, ep, af = 1.0, h, STEP
            seen += 1.0
        else:
            sar += af * (ep - sar)
            sar = min(sar, l1, l2) if rising else max(sar, h1, h2)
            if (l < sar) if rising else (h > sar):
                sar, ep, af, rising = ep, (l if rising else h), STEP, 1.0 - rising
            elif (h > ep) if rising else (l < ep):
                ep, af = (h if rising else l), min(af + STEP, CAP)
        h1, h2, l1, l2 = h, h1, l, l1
        out[i] = sar
    return out, marked, [seen, rising, sar, ep, af, h1, h2, l1, l2]


def _relay(df: DataFrame, prices: tuple[str, str, str], series: Series, name: str) -> DataFrame:
    spark = df.sparkSession
    shared_folder(spark)  # makes sure that checkpoint() has a folder
    spread, home = neighbourhood(df, [], WARM_ROWS, 0, series)
    cells = spread.withColumn("_home", home).checkpoint()
    cell = [*series.keys, "_chunk"]
    states = T.ArrayType(T.DoubleType())
    schema = T.StructType([
        *df.schema.fields,
        T.StructField("_chunk", T.LongType()),
        T.StructField(name, T.DoubleType()),
        T.StructField("_enter", states),
        T.StructField("_leave", states),
    ])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        start = pdf["_start"].iloc[0]
        if start is not None:
            pdf = pdf[pdf["_home"]]
        if not pdf["_home"].any():
            return pd.DataFrame(columns=schema.names)
        first = int(np.argmax(pdf["_home"].to_numpy()))
        levels, enter, leave = run(
            *(pdf[c].to_numpy() for c in prices),
            state=None if start is None else list(start), mark=first,
        )
        kept = pdf.assign(**{name: levels}).iloc[first:].copy()
        # The states ride on the last row of the chunk only.
        kept["_enter"] = [None] * (len(kept) - 1) + [enter]
        kept["_leave"] = [None] * (len(kept) - 1) + [leave]
        return kept[schema.names]

    unknown = F.lit(None).cast(states)
    first = cells.withColumn("_start", unknown).groupBy(*cell).applyInPandas(one, schema).checkpoint()
    done, mended = first, None
    while True:
        across = Window.partitionBy(*series.keys).orderBy("_chunk")
        links = done.filter("_leave IS NOT NULL").select(
            *cell, "_enter", F.lag("_leave").over(across).alias("_start")
        )
        broken = links.filter(F.col("_enter") != F.col("_start")).select(*cell, "_start").checkpoint()
        if broken.isEmpty():
            return done.select(*df.columns, name)
        again = cells.join(broken, cell).groupBy(*cell).applyInPandas(one, schema)
        if mended is not None:
            again = mended.join(broken, cell, "left_anti").unionByName(again)
        # Only the chunks that ever failed are written again.
        mended = again.checkpoint()
        done = first.join(mended.select(*cell).distinct(), cell, "left_anti").unionByName(mended)

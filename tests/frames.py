"""Frames of bars, and how results are compared."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd


def make_bars(sizes: dict[str, int], seed: int = 7, gaps: float = 0.0) -> pd.DataFrame:
    """Random bars with irregular days; ``gaps`` is the share of missing closes."""
    rng = np.random.default_rng(seed)
    parts = []
    for symbol, n in sizes.items():
        days = np.cumsum(rng.integers(1, 4, n))
        close = 100 + np.cumsum(rng.normal(0, 1, n))
        high = close + rng.uniform(0, 2, n)
        low = close - rng.uniform(0, 2, n)
        parts.append(pd.DataFrame({
            "symbol": symbol, "date": [date(2000, 1, 1) + timedelta(days=int(d)) for d in days],
            "open": low + (high - low) * rng.uniform(0, 1, n), "high": high, "low": low,
            "close": np.where(rng.uniform(0, 1, n) < gaps, np.nan, close),
            "volume": rng.integers(1, 100, n).astype(float),
        }))
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, pdf: pd.DataFrame):
    """NaN becomes NULL."""
    schema = ", ".join(
        f"{c} " + {"symbol": "string", "date": "date"}.get(c, "bigint" if pdf[c].dtype.kind == "i" else "double")
        for c in pdf.columns
    )
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r)
            for r in pdf.itertuples(index=False, name=None)]
    return spark.createDataFrame(rows, schema)


def by_series(df, *extra: str) -> pd.DataFrame:
    return df.toPandas().sort_values(["symbol", *(extra or ("date",))]).reset_index(drop=True)


def close_to(a, b, tol=1e-9) -> bool:
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    return bool((np.isnan(a) == np.isnan(b)).all()) and np.allclose(a, b, rtol=tol, atol=tol, equal_nan=True)

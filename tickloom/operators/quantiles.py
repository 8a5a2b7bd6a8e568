"""Linear quantile regression: all quantiles fitted together, every step one sum over the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.plans.scratch import forget, stored

# Fixed value: the quantiles of the usual interval forecasts.
QUANTILES = (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)


@dataclass(frozen=True)
class QuantileModel:
    """One line for each quantile: an intercept and a weight for each column."""

    columns: tuple[str, ...]
    quantiles: tuple[float, ...]
    intercepts: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]
    passes: int


def fit_quantiles(
    df: DataFrame,
    target: str,
    columns: Sequence[str],
    quantiles: Sequence[float] = QUANTILES,
    passes: int = 40,
    smooth: float = 1e-3,
    tolerance: float = 1e-3,
    accuracy: int = 100_000,
) -> QuantileModel:
    """Lines that minimise the pinball loss of ``target``, one for each quantile.

    The loss is bounded from above by a parabola that touches it at the lines of the pass before (weights
    1 / (distance + width)), and the parabola is minimised; the loss then never rises. The width shrinks to ``smooth``, in
    deviations of the target. A pass is one sum of products over the rows: each task sends
    quantiles * (k + 1) * (k + 3) numbers for k columns, whatever its rows, and only their sums come to the driver. Passes
    end when no coefficient moves by more than ``tolerance`` deviations. Last, each line is shifted by the quantile
    of its residuals, so the share of rows below it is right up to 1 / ``accuracy`` where the target has no ties.

    Rows with a missing value are left out; without a whole row there is nothing to fit: ValueError.
    """
    levels = tuple(float(q) for q in quantiles)
    if not levels or not all(0 < q < 1 for q in levels) or list(levels) != sorted(set(levels)):
        raise ValueError("quantiles must rise strictly between 0 and 1")
    columns, k = tuple(columns), len(columns)
    names = [*columns, target]
    whole = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)]).na.drop("any")
    sizes = whole.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(f"_{i}").alias(f"{c}{i}") for i in range(k + 1) for c, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).first()
    if not sizes["n"]:
        raise ValueError("no row without missing values")
    mean = np.array([sizes[f"m{i}"] for i in range(k + 1)])
    scale = np.array([sizes[f"s{i}"] for i in range(k + 1)])
    scale[~(scale > 1e-12 * np.maximum(np.abs(mean), 1e-300))] = 1.0  # constant columns

    # Read once a pass: standardized columns, a one, and the standardized target.
    one = [F.lit(1.0)] + [(F.col(f"_{i}") - float(mean[i])) / float(scale[i]) for i in range(k + 1)]
    rows = stored(whole.select(F.array(*one).alias("row")))
    try:
        # Without columns the last shift is the whole fit.
        lines, done = _descend(rows, np.array(levels), k + 1, passes, smooth, tolerance) if k else (np.zeros((len(levels), 1)), 0)
        shifts = rows.agg(*[
            F.percentile_approx(F.element_at("row", -1) - _line(lines[i], lambda j: F.col("row")[j]), q, accuracy).alias(f"q{i}")
            for i, q in enumerate(levels)]).first()
    finally:
        forget(rows)
    lines[:, 0] += [shifts[f"q{i}"] for i in range(len(levels))]
    weights = lines[:, 1:] * scale[k] / scale[:k]
    intercepts = mean[k] + scale[k] * lines[:, 0] - weights @ mean[:k]
    return QuantileModel(
        columns, levels, tuple(map(float, intercepts)), tuple(tuple(map(float, w)) for w in weights), done)


def _line(line: np.ndarray, value) -> Column:
    """Intercept and weights applied to ``value(0)``, ``value(1)``, …"""
    out = F.lit(0.0)
    for j, w in enumerate(line):
        out = out + F.lit(float(w)) * value(j)
    return out


def _descend(
    rows: DataFrame, levels: np.ndarray, m: int, passes: int, smooth: float, tolerance: float
) -> tuple[np.ndarray, int]:
    lines, width = np.zeros((len(levels), m)), 1.0
    for done in range(1, passes + 1):
        sums = _sums(rows, lines, width)
        gram, cross, total = sums[..., :-2], sums[..., -2], sums[..., -1]
        sides = cross + (2 * levels - 1)[:, None] * total
        # Equal columns share their weight: the least of all solutions.
        moved = np.stack([np.linalg.lstsq(g, s, rcond=1e-10)[0] for g, s in zip(gram, sides, strict=True)])
        step, lines = np.abs(moved - lines).max(), moved
        if width == smooth and step <= tolerance:
            return lines, done
        width = max(width * 0.5, smooth)
    return lines, passes


def _sums(rows: DataFrame, lines: np.ndarray, width: float) -> np.ndarray:
    """Of each quantile an m by m + 2 table: weighted products of the columns, those with the target, and plain sums."""
    shape = (len(lines), lines.shape[1], lines.shape[1] + 2)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            x, y = table[:, :-1], table[:, -1]
            plain = x.sum(axis=0)
            for i, line in enumerate(lines):
                heavy = x / (width + np.abs(y - x @ line))[:, None]
                out[i, :, :-2] += heavy.T @ x
                out[i, :, -2] += heavy.T @ y
                out[i, :, -1] += plain
        cells = out.ravel()
        yield pa.record_batch([pa.array(np.arange(len(cells), dtype="int32")), pa.array(cells)], names=["cell", "value"])

    found = rows.mapInArrow(add, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    sums = np.zeros(int(np.prod(shape)))  # bounded: quantiles and columns
    for r in found:
        sums[r["cell"]] = r["value"]
    return sums.reshape(shape)


def predict_quantiles(model: QuantileModel, df: DataFrame, out: str = "quantiles") -> DataFrame:
    """An array with one value for each quantile, rising.

    Lines fitted apart may cross far from the data; sorting a row's values never takes them further from the true
    quantiles. Rows with a missing value get NULL.
    """
    values = [F.lit(b) + _line(np.array(w), lambda j: F.col(model.columns[j]).cast("double"))
              for b, w in zip(model.intercepts, model.weights, strict=True)]
    known = F.lit(True)
    for c in model.columns:
        known = known & F.col(c).isNotNull()
    return df.withColumn(out, F.when(known, F.array_sort(F.array(*values))))


def quantile_scores(
    df: DataFrame, actual: str, predicted: str, quantiles: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """quantile, n, pinball, below: mean loss of each element of an array of quantiles, and the share of rows at or below it.

    Rows without a value or without a prediction are left out. One aggregation for all quantiles.
    """
    made = []
    for i, q in enumerate(quantiles):
        e = F.col(actual) - F.col(predicted)[i]
        made += [F.count(e).alias(f"_n{i}"), F.avg(F.greatest(q * e, (q - 1) * e)).alias(f"_l{i}"),
                 F.avg((e <= 0).cast("double")).alias(f"_b{i}")]
    rows = F.array(*[
        F.struct(F.lit(float(q)).alias("quantile"), F.col(f"_n{i}").alias("n"), F.col(f"_l{i}").alias("pinball"), F.col(f"_b{i}").alias("below"))
        for i, q in enumerate(quantiles)])
    return df.groupBy(*by).agg(*made).select(*by, F.inline(rows))

"""Autoregressive moving-average models of series of any length: two least-squares fits, and a scan of residuals.

The fit has two stages. A long autoregression stands in for the unknown shocks; then values are
regressed on their own lags and on the lags of its residuals. Both stages need only sums of products of
lags, so each is one pass over the chunks of all series and one sum.

Shocks under the fitted model follow a recurrence of order q. Its state, the last q shocks, goes from row to row
by an affine step with a companion matrix. The steps of a chunk compose to one matrix and one vector;
those of all chunks are composed in two levels, and each chunk is entered with the state that the chunks before it leave.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.forecast import Z95
from tickloom.plans import DAILY, Series
from tickloom.plans.frames import neighbourhood
from tickloom.plans.scratch import stored

#: Chunks whose steps are composed in one group.
FAN = 1024
MODEL = "c double, phi array<double>, theta array<double>, variance double"


def arma_forecast(
    df: DataFrame, value: str = "close", p: int = 1, d: int = 1, q: int = 1, h: int = 10,
    series: Series = DAILY, long: int | None = None,
) -> DataFrame:
    """h-step forecasts with 95% bounds per series: key, step, forecast, lower, upper.

    ``long``: lags of the first stage, 2·max(p, q) by default. Series too short for a fit, or whose last
    p differences are not all known, have no rows. A missing value makes the shocks unknown that read it; they
    count as zero. Moving-average roots inside the unit circle are reflected, as they give the same
    correlations and shocks that can be computed. No rows give no rows; other columns are not read.
    """
    rows, chunks = _fitted(df, value, p, d, q, series, long)
    ends = stored(_ends(rows, chunks, p, d, q, series))
    last = _states(ends, series).groupBy(*series.keys).agg(F.max_by("left", "_chunk").alias("state"))
    newest = ends.groupBy(*series.keys).agg(
        *[F.max_by(c, "_chunk").alias(c) for c in ("c", "phi", "theta", "variance", "recent", "levels", "_level")])
    keys = [f for f in df.schema.fields if f.name in series.keys]
    schema = T.StructType([
        *keys, T.StructField("step", T.IntegerType()),
        *[T.StructField(c, T.DoubleType()) for c in ("forecast", "lower", "upper")]])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [pd.DataFrame(columns=schema.names)]
            for row in batch.to_dict("records"):
                found = path(row, d, h)
                if found is not None:
                    parts.append(pd.DataFrame({
                        **{k.name: row[k.name] for k in keys}, "step": np.arange(1, h + 1, dtype="int32"),
                        "forecast": found[0], "lower": found[0] - found[1], "upper": found[0] + found[1]}))
            yield pd.concat(parts[1:] or parts)

    return newest.join(last, series.keys).mapInPandas(solve, schema)


def arma_residuals(
    df: DataFrame, value: str = "close", p: int = 1, d: int = 1, q: int = 1,
    series: Series = DAILY, long: int | None = None,
) -> DataFrame:
    """key, order, residual: the shock of every row under its series' model; NULL where a value it reads is missing."""
    rows, chunks = _fitted(df, value, p, d, q, series, long)
    ends = stored(_ends(rows, chunks, p, d, q, series))
    entered = chunks.join(_states(ends, series).select(*series.keys, "_chunk", "entered"), [*series.keys, "_chunk"])
    out = T.StructType([f for f in df.schema.fields if f.name in (*series.keys, series.order)]
                       + [T.StructField("residual", T.DoubleType())])

    def shocks(_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, model = left.sort_values("_pos"), _model(right)
        if model is None:
            return pd.DataFrame(columns=out.names)
        home = left["_home"].to_numpy(bool)
        u, known = _steps(left, model, d)
        e, _, _ = scan(u[home], known[home], model["theta"], np.array(right["entered"].iloc[0], dtype=float))
        kept = left.loc[home, [*series.keys, series.order]]
        return kept.assign(residual=np.where(known[home], e, np.nan))[out.names]

    found = _with_model(rows, entered, series, shocks, out)
    return found.withColumn("residual", F.nanvl("residual", F.lit(None).cast("double")))


def scan(u: np.ndarray, known: np.ndarray, theta: np.ndarray, entering: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """e_t = u_t - sum of theta_j·e_(t-j), zero where unknown; the matrix and the state that lead on from the last row.

    Stretches of √n rows are run side by side, each for every unit state it may be entered with and for u;
    their matrices then pass the true state from one stretch to the next.
    """
    n, q = len(u), len(theta)
    if not q:
        return np.where(known, u, 0.0), np.zeros((0, 0)), np.zeros(0)
    width = max(1, int(np.sqrt(n)))
    full = n // width if n else 0
    by_stretch = (full, width)
    u_, known_ = u[: full * width].reshape(by_stretch), known[: full * width].reshape(by_stretch)
    state = np.zeros((full, q, q + 1))
    state[:, np.arange(q), np.arange(q)] = 1.0
    answers = np.empty((full, width, q + 1))
    for k in range(width if full else 0):
        new = -np.einsum("j,fjc->fc", theta, state)
        new[:, q] += u_[:, k]
        new[~known_[:, k]] = 0.0
        answers[:, k] = new
        state = np.concatenate([new[:, None], state[:, :-1]], axis=1)
    e, s, matrix = np.empty(n), entering.copy(), np.eye(q)
    for f in range(full):
        e[f * width : (f + 1) * width] = answers[f, :, :q] @ s + answers[f, :, q]
        s, matrix = state[f, :, :q] @ s + state[f, :, q], state[f, :, :q] @ matrix
    step = np.eye(q, k=-1)
    for t in range(full * width, n):
        step[0] = -theta if known[t] else 0.0
        e[t] = u[t] + step[0] @ s if known[t] else 0.0
        s, matrix = np.concatenate([[e[t]], s[:-1]]), step @ matrix
    return e, matrix, s


def path(row: dict, d: int, h: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Forecasts and half-widths of one series; None where something it starts from is unknown."""
    phi, theta = np.array(row["phi"], dtype=float), np.array(row["theta"], dtype=float)
    z, e = np.array(row["recent"], dtype=float), np.array(row["state"], dtype=float)
    levels = np.array(row["levels"], dtype=float)
    if not (np.isfinite(z).all() and np.isfinite(levels).all()):
        return None
    steps = np.empty(h)
    for k in range(h):
        steps[k] = row["c"] + phi @ z + theta @ e
        z, e = np.concatenate([steps[k : k + 1], z])[: len(phi)], np.concatenate([[0.0], e])[: len(theta)]
    for level in levels[::-1]:
        steps = level + np.cumsum(steps)
    full = np.concatenate([[1.0], -phi])
    for _ in range(d):
        full = np.convolve(full, [1.0, -1.0])
    moving = np.zeros(h)
    moving[: min(h, len(theta) + 1)] = np.concatenate([[1.0], theta])[:h]
    psi = np.zeros(h)
    for k in range(h):
        m = min(k, len(full) - 1)
        psi[k] = moving[k] - float(full[1 : m + 1] @ psi[k - m : k][::-1])
    return steps + float(row["_level"]), Z95 * np.sqrt(float(row["variance"]) * np.cumsum(psi**2))


def invertible(theta: np.ndarray) -> tuple[np.ndarray, float]:
    """The moving average with the same correlations whose roots lie outside the unit circle, and its shocks' share of the variance."""
    if not len(theta) or not np.isfinite(theta).all():
        return theta, 1.0
    poles = np.roots(np.concatenate([[1.0], theta]))  # inverse roots
    far = np.abs(poles) > 1
    share = float(np.prod(np.abs(poles[far]) ** 2))
    poles[far] = 1 / np.conj(poles[far])
    return np.real(np.poly(poles))[1:], share


def _fitted(
    df: DataFrame, value: str, p: int, d: int, q: int, series: Series, long: int | None
) -> tuple[DataFrame, DataFrame]:
    """The rows in chunks, and for every chunk the model of its series."""
    if min(p, d, q) < 0 or p + q == 0:
        raise ValueError("p, d and q must not be negative, and p + q not 0")
    m = 2 * max(p, q) if long is None else long
    if m < 1:
        raise ValueError("long must be 1 or more")
    rows = stored(_chunked(df, value, d + m + max(p, q), d, series))
    keys = [*series.keys, "_chunk"]
    names = [f for f in rows.schema.fields if f.name in keys]
    sums = T.StructType([*names, T.StructField("sums", T.ArrayType(T.DoubleType()))])

    def products(x: np.ndarray, home: np.ndarray) -> list[float]:
        x = x[home & np.isfinite(x).all(axis=1)]
        return (x.T @ x).ravel().tolist()

    def first(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_pos")
        z = _differences(part, d)[-1]
        x = np.column_stack([np.ones(len(z)), _lags(z, m), z])
        return pd.DataFrame([(*key, products(x, part["_home"].to_numpy(bool)))], columns=sums.names)

    def second(key: tuple, part: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(model) or not len(part):
            return pd.DataFrame(columns=sums.names)
        part, beta = part.sort_values("_pos"), np.array(model["beta"].iloc[0], dtype=float)
        z = _differences(part, d)[-1]
        e = z - beta[0] - _lags(z, m) @ beta[1:]
        x = np.column_stack([np.ones(len(z)), _lags(z, p), _lags(e, q), z])
        return pd.DataFrame([(*key, products(x, part["_home"].to_numpy(bool)))], columns=sums.names)

    made = stored(rows.groupBy(*keys).applyInPandas(first, sums))
    start = _solved(made, series, "beta array<double>", lambda beta, _: (beta.tolist(),))
    chunks = made.select(*keys).join(start, series.keys)

    def model(beta: np.ndarray, variance: float) -> tuple:
        theta, share = invertible(beta[1 + p :])
        return float(beta[0]), beta[1 : 1 + p].tolist(), theta.tolist(), variance * share

    again = stored(_with_model(rows, chunks, series, second, sums))
    return rows, stored(made.select(*keys).join(_solved(again, series, MODEL, model), series.keys))


def _chunked(df: DataFrame, value: str, back: int, d: int, series: Series) -> DataFrame:
    """Rows by (key, _chunk), numbered by _pos, with the ``back`` rows before each chunk; _home marks a chunk's own rows.

    Undifferenced values are taken from their series' mean, so that a distant level does not swallow the digits of the sums.
    """
    rows = df.select(*series.keys, series.order, F.col(value).cast("double").alias("_y"))
    if series.cut_rows(df) is None:
        level = F.lit(0.0) if d else F.avg("_y").over(Window.partitionBy(*series.keys))
        return rows.withColumns({
            "_pos": F.row_number().over(series.window()).cast("bigint"), "_chunk": F.lit(0).cast("bigint"),
            "_home": F.lit(True), "_level": level})
    spread, home = neighbourhood(rows, [], back, 0, series)
    spread = spread.withColumn("_home", home)
    if d:
        return spread.withColumn("_level", F.lit(0.0))
    return spread.join(rows.groupBy(*series.keys).agg(F.avg("_y").alias("_level")), series.keys)


def _differences(part: pd.DataFrame, d: int) -> list[np.ndarray]:
    """The values and their differences, up to the d-th; those that read a missing value are NaN."""
    found = [part["_y"].to_numpy(float) - part["_level"].to_numpy(float)]
    for _ in range(d):
        found.append(np.concatenate([[np.nan], np.diff(found[-1])]))
    return found


def _lags(x: np.ndarray, n: int) -> np.ndarray:
    """Columns of the values one to ``n`` rows before; NaN before the first."""
    out = np.full((len(x), n), np.nan)
    for i in range(1, n + 1):
        out[i:, i - 1] = x[:-i]
    return out


def _solved(sums: DataFrame, series: Series, columns: str, out: Callable[[np.ndarray, float], tuple]) -> DataFrame:
    """One row per series: what ``out`` makes of the least-squares solution of the products summed over its chunks."""
    each = sums.select(*series.keys, F.posexplode("sums").alias("_i", "_x"))
    entries = each.groupBy(*series.keys, "_i").agg(F.sum("_x").alias("_x"))
    one = entries.groupBy(*series.keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_s"))
    one = one.select(*series.keys, F.transform("_s", lambda e: e["_x"]).alias("_s"))
    keys = [f for f in sums.schema.fields if f.name in series.keys]
    schema = T.StructType([*keys, *T._parse_datatype_string(columns).fields])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for row in batch.to_dict("records"):
                size = int(round(np.sqrt(len(row["_s"]))))
                s = np.array(row["_s"], dtype=float).reshape(size, size)
                if not s[0, 0] > size - 1:
                    continue
                beta = np.linalg.lstsq(s[:-1, :-1], s[:-1, -1], rcond=None)[0]
                variance = max(s[-1, -1] - beta @ s[:-1, -1], 0.0) / (s[0, 0] - (size - 1))
                made.append((*[row[k.name] for k in keys], *out(beta, variance)))
            yield pd.DataFrame(made, columns=schema.names)

    return one.mapInPandas(solve, schema)


def _with_model(rows: DataFrame, models: DataFrame, series: Series, do: Callable, schema: T.StructType) -> DataFrame:
    """Chunks beside their series' model: the model is one row for each chunk, not a column of every row."""
    keys = [*series.keys, "_chunk"]
    return rows.groupBy(*keys).cogroup(models.groupBy(*keys)).applyInPandas(do, schema)


def _model(row: pd.DataFrame) -> dict | None:
    if not len(row):
        return None
    first = row.iloc[0]
    return {"c": float(first["c"]), "phi": np.array(first["phi"], dtype=float), "theta": np.array(first["theta"], dtype=float)}


def _steps(part: pd.DataFrame, model: dict, d: int) -> tuple[np.ndarray, np.ndarray]:
    """What each value has beyond the model's mean and autoregression, and where that is known."""
    z = _differences(part, d)[-1]
    u = z - model["c"] - _lags(z, len(model["phi"])) @ model["phi"]
    known = np.isfinite(u)
    return np.where(known, u, 0.0), known


def _ends(rows: DataFrame, chunks: DataFrame, p: int, d: int, q: int, series: Series) -> DataFrame:
    """Per chunk: its step (matrix, vector), its model, and the values that a forecast from its last row starts with."""
    arrays = ("matrix", "vector", "recent", "levels", "phi", "theta")
    schema = T.StructType([
        *[f for f in rows.schema.fields if f.name in (*series.keys, "_chunk")],
        *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in arrays],
        *[T.StructField(c, T.DoubleType()) for c in ("c", "variance", "_level")]])

    def end(key: tuple, part: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        model = _model(right)
        if model is None or not len(part):
            return pd.DataFrame(columns=schema.names)
        part = part.sort_values("_pos")
        home = part["_home"].to_numpy(bool)
        u, known = _steps(part, model, d)
        _, matrix, vector = scan(u[home], known[home], model["theta"], np.zeros(q))
        *levels, z = _differences(part, d)
        recent = np.concatenate([z[::-1], np.full(p, np.nan)])[:p]
        return pd.DataFrame([(
            *key, matrix.ravel().tolist(), vector.tolist(), recent.tolist(), [float(x[-1]) for x in levels],
            model["phi"].tolist(), model["theta"].tolist(), model["c"], float(right["variance"].iloc[0]),
            float(part["_level"].iloc[0]))], columns=schema.names)

    return _with_model(rows, chunks, series, end, schema)


def _states(ends: DataFrame, series: Series) -> DataFrame:
    """key, _chunk, entered, left: the state before each chunk's first row and after its last, from zero at the start.

    FAN neighbouring chunks are composed in one group, the groups' totals, one row for FAN chunks, in another.
    """
    keys = series.keys
    steps = ends.select(*keys, "_chunk", "matrix", "vector", F.floor(F.col("_chunk") / FAN).cast("bigint").alias("_wide"))
    inner = stored(_walked(steps, keys, "_wide"))
    totals = inner.groupBy(*keys, F.col("_wide").alias("_chunk")).agg(
        F.max_by("matrix_after", "_chunk").alias("matrix"), F.max_by("vector_after", "_chunk").alias("vector"))
    outer = _walked(totals.withColumn("_wide", F.lit(0).cast("bigint")), keys, "_wide")
    start = outer.select(*keys, F.col("_chunk").alias("_wide"), F.col("vector_before").alias("_start"))

    def moved(matrix: str, vector: str):
        n = F.size(vector)
        row = lambda i: F.slice(matrix, i * n + 1, n)
        dot = lambda i: F.aggregate(F.zip_with(row(i), "_start", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        return F.transform(vector, lambda x, i: x + dot(i))

    return inner.join(start, [*keys, "_wide"]).select(
        *keys, "_chunk", moved("matrix_before", "vector_before").alias("entered"),
        moved("matrix_after", "vector_after").alias("left"))


def _walked(steps: DataFrame, keys: list[str], group: str) -> DataFrame:
    """Each step with the composition of the steps before it in its group, and with it added."""
    names = ("matrix_before", "vector_before", "matrix_after", "vector_after")
    fields = [f for f in steps.schema.fields if f.name in (*keys, "_chunk", group)]
    schema = T.StructType([*fields, *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in names]])

    def walk(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_chunk")
        q = len(part["vector"].iloc[0])
        matrix, vector, found = np.eye(q), np.zeros(q), []
        for m, s in zip(part["matrix"], part["vector"], strict=True):
            m = np.array(m, dtype=float).reshape(q, q)
            before = (matrix.ravel().tolist(), vector.tolist())
            matrix, vector = m @ matrix, m @ vector + np.array(s, dtype=float)
            found.append((*before, matrix.ravel().tolist(), vector.tolist()))
        more = pd.DataFrame(found, columns=list(names), index=part.index)
        return pd.concat([part[[f.name for f in fields]], more], axis=1)[schema.names]

    return steps.groupBy(*keys, group).applyInPandas(walk, schema)


def feedback_forecast(
    df: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], value: str = "close", window: int = 10,
    h: int = 100, series: Series = DAILY,
) -> DataFrame:
    """h steps ahead per series by a model fed with its own forecasts: key, step, forecast.

    ``load`` runs once for each task and gives a function of a matrix, a row of ``window`` values (oldest first) for each series,
    to the next value of each. All series of an Arrow batch go ahead together, so the model is called h times for a
    batch, not for a series. Series with fewer than ``window`` rows, or a missing value among the last of them, have no rows.
    """
    from tickloom.operators.rows import slice_rows

    rows = df.select(*series.keys, series.order, F.col(value).cast("double").alias("_y"))
    last = slice_rows(rows, -window, None, series).groupBy(*series.keys).agg(
        F.array_sort(F.collect_list(F.struct(series.order, "_y"))).alias("_last"))
    ready = last.select(*series.keys, F.transform("_last", lambda e: e["_y"]).alias("_last")).where(
        (F.size("_last") == window) & F.forall("_last", lambda y: y.isNotNull() & ~F.isnan(y)))
    keys = [f for f in df.schema.fields if f.name in series.keys]
    schema = T.StructType([*keys, T.StructField("step", T.IntegerType()), T.StructField("forecast", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            if not len(batch):
                continue
            seen = np.stack(batch["_last"].to_numpy()).astype(float)
            ahead = np.empty((len(batch), h))
            for k in range(h):
                ahead[:, k] = model(seen)
                seen = np.concatenate([seen[:, 1:], ahead[:, k : k + 1]], axis=1)
            at = np.repeat(np.arange(len(batch)), h)
            yield pd.DataFrame({
                **{k.name: batch[k.name].to_numpy()[at] for k in keys},
                "step": np.tile(np.arange(1, h + 1, dtype="int32"), len(batch)), "forecast": ahead.ravel()})

    return ready.mapInPandas(run, schema)

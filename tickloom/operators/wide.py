"""Principal components of tables with many columns, without a matrix of columns by columns."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.plans.scratch import forget, stored

SEED = 42
# Triangles of that many groups of tasks are merged on the driver.
GROUPS = 64


@dataclass(frozen=True)
class WideComponents:
    """Mean and deviation of the d columns, d by k loadings and the k variances."""

    mean: np.ndarray
    deviation: np.ndarray
    loadings: np.ndarray
    variances: np.ndarray


def whole_row(features: str, width: int) -> Column:
    """Whether an array has ``width`` numbers, none missing."""
    fine = F.forall(features, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")))
    return F.coalesce((F.size(features) == width) & fine, F.lit(False))


def fit_wide(
    df: DataFrame, k: int = 10, features: str = "features", extra: int = 10, rounds: int = 4
) -> WideComponents:
    """The k leading components of the standardized entries of an array column.

    A random basis of k + ``extra`` directions is multiplied by the table and back ``rounds`` times and made orthonormal each
    time, so it turns towards the leading components (exact where k + ``extra`` reaches the rank). What a task sends is
    d * (k + ``extra``) numbers, d the entries of a row; their sum comes to the driver, never d * d numbers. Last, every task makes a triangle of its projected
    rows (QR), triangles are merged by groups of tasks and then once more, and the singular vectors of the last one order the
    basis. Products of the rows are not squared there, so small variances keep their digits.

    The longest row gives d. Rows of another length or with a missing entry are left out; without a whole row: ValueError.
    """
    width = df.agg(F.max(F.size(features))).first()[0]
    if not width or width < 1:
        raise ValueError("no row without missing values")
    rows = stored(df.where(whole_row(features, width)).select(F.col(features).cast("array<double>").alias("x")))
    try:
        vector = array_to_vector("x")
        n = rows.count()  # from the written footers
        if not n:
            raise ValueError("no row without missing values")
        sizes = rows.agg(
            vector_to_array(Summarizer.mean(vector)).alias("m"), vector_to_array(Summarizer.std(vector)).alias("s")).first()
        mean, deviation = np.array(sizes["m"]), np.array(sizes["s"]) * np.sqrt((n - 1) / n)
        deviation[~(deviation > 1e-12 * np.maximum(np.abs(mean), 1e-300))] = 1.0  # constant columns
        k = min(k, width, n)
        size = min(k + extra, width)
        basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, size)))[0]
        for _ in range(rounds):
            basis = np.linalg.qr(_there_and_back(rows, mean, deviation, basis))[0]
        turn = np.linalg.svd(_triangle(rows, mean, deviation, basis))
    finally:
        forget(rows)
    loadings = (basis @ turn.Vh.T)[:, :k]
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    return WideComponents(mean, deviation, loadings * np.where(signs == 0, 1.0, signs), turn.S[:k] ** 2 / n)


def _scaled(batch: pa.RecordBatch, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    return (batch.column(0).flatten().to_numpy().reshape(batch.num_rows, len(mean)) - mean) / deviation


def _there_and_back(rows: DataFrame, mean: np.ndarray, deviation: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The table's transpose times the table times the basis."""
    names = [f"v{i}" for i in range(basis.shape[1])]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, any_row = np.zeros(basis.shape), False
        for batch in batches:
            if batch.num_rows:
                any_row = True
                x = _scaled(batch, mean, deviation)
                out += x.T @ (x @ basis)
        if any_row:
            at = pa.array(np.arange(len(out), dtype="int32"))
            yield pa.record_batch([at, *[pa.array(np.ascontiguousarray(c)) for c in out.T]], names=["at", *names])

    sent = rows.mapInArrow(add, ", ".join(["at int", *[f"{c} double" for c in names]]))
    found = sent.groupBy("at").agg(*[F.sum(c).alias(c) for c in names]).toPandas()
    return found.sort_values("at")[names].to_numpy()


def _triangle(rows: DataFrame, mean: np.ndarray, deviation: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The triangle of a QR factorisation of the table times the basis."""
    size = basis.shape[1]

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        r = np.linalg.qr(np.concatenate([np.zeros((size, size)), *parts]), mode="r")
        return r * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                r = merged([r, _scaled(batch, mean, deviation) @ basis])
        yield pa.record_batch([pa.array(list(r), pa.list_(pa.float64()))], names=["r"])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"r": list(merged([np.stack(part["r"].to_list())]))})

    kind = "r array<double>"
    # bounded: size rows for each task of a group
    grouped = rows.mapInArrow(make, kind).withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    found = grouped.groupBy("_g").applyInPandas(lambda part: merge(part), kind).collect()
    return merged([np.array([r["r"] for r in found])])


def wide_pca(df: DataFrame, model: WideComponents, features: str = "features", out: str = "components") -> DataFrame:
    """The other columns and each row's components; NULL for rows that are not whole."""
    schema = T.StructType([
        *[f for f in df.schema.fields if f.name not in (features, out)], T.StructField(out, T.ArrayType(T.DoubleType()))])
    width, (mean, deviation, loadings) = len(model.mean), (model.mean, model.deviation, model.loadings)
    kept = [f.name for f in schema.fields[:-1]]
    ready = df.select(F.when(whole_row(features, width), F.col(features).cast("array<double>")).alias("_x"), *kept)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0)
            there = x.is_valid().to_numpy(zero_copy_only=False)
            table = (x.drop_null().flatten().to_numpy().reshape(-1, width) - mean) / deviation @ loadings
            made: list = [None] * len(there)
            for at, row in zip(np.flatnonzero(there), table, strict=True):
                made[at] = row
            yield pa.record_batch([*batch.columns[1:], pa.array(made, pa.list_(pa.float64()))], names=schema.names)

    return ready.mapInArrow(project, schema)

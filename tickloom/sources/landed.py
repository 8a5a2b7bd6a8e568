"""Landed vendor data: JSON bar envelopes and dated histories."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import from_epoch_millis
from tickloom.plans.scratch import stored

# The envelope's field names.
ENVELOPE = "results array<struct<t:bigint,o:double,h:double,l:double,c:double,v:double>>"
FIELDS = {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}


def parse_bar_envelope(df: DataFrame, body: str = "body", on_missing: str = "error") -> DataFrame:
    """One row per bar of each JSON envelope.

    An envelope without ``results`` stops the query, or is left out with ``on_missing="skip"``.
    """
    results = F.from_json(body, ENVELOPE)["results"]
    parsed = df.withColumn("_results", results)
    if on_missing == "error":
        problem = F.raise_error(F.lit("bar envelope without results"))
        parsed = parsed.withColumn(
            "_results", F.when(F.col("_results").isNull(), problem).otherwise(F.col("_results"))
        )
    rest = [c for c in df.columns if c != body]
    # The outer form keeps the check out of any filter, which Spark could run on rows the
    # caller has already left out.
    bars = parsed.select(*rest, F.explode_outer("_results").alias("_bar")).filter("_bar IS NOT NULL")
    return bars.select(
        *rest, from_epoch_millis(F.col("_bar.t")).alias("ts"),
        *[F.col(f"_bar.{short}").alias(name) for short, name in FIELDS.items()],
    )


def within(
    df: DataFrame, symbols: Sequence[str], start: date, end: date, key: str = "symbol", order: str = "date",
) -> DataFrame:
    """The listed symbols' rows within a date range, by filters that reach the scan."""
    return df.filter(F.col(key).isin(list(symbols)) & F.col(order).between(start, end))


def price_history(
    df: DataFrame, symbols: Sequence[str], start: date, end: date,
    key: str = "symbol", order: str = "date",
) -> DataFrame:
    """History of the listed symbols within a date range; one NULL row for a symbol without any.

    The big table is filtered at the scan, read once and never shuffled: what is found is written below the shared
    folder, where the symbols without any are looked up.
    """
    inside = stored(within(df, symbols, start, end, key, order))
    listed = df.sparkSession.createDataFrame([(s,) for s in symbols], f"{key} string")
    absent = listed.join(inside.select(key).distinct(), key, "left_anti")
    return inside.unionByName(absent, allowMissingColumns=True)

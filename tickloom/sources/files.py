"""CSV scans. The header decides the columns, in either letter case and any order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BAR_TYPES = {
    "date": "date", "open": "double", "high": "double", "low": "double",
    "close": "double", "volume": "double",
}

#: A line that names columns has one called date.
HEADER = r'(^|,)[\s"\x{FEFF}]*date[\s"]*(,|$)'


def _path() -> Column:
    """The scan's path, which is percent-encoded, decoded."""
    return F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))


def read_bars_csv(
    spark: SparkSession, path: str | Sequence[str], symbol: str | None = None
) -> DataFrame:
    """Bars of one instrument, typed; columns the files lack are left out.

    Of several paths each file is read under its own header, so columns may stand in any order.
    """
    if isinstance(path, str):
        rows = _typed(spark.read.option("header", True).csv(path))
    else:
        rows = _under_headers(spark, spark.read.text(list(path)))
        if rows is None:
            raise ValueError("no file has a header with a column called date")
    return rows if symbol is None else rows.select(F.lit(symbol).alias("symbol"), *rows.columns)


def read_bars_dir(
    spark: SparkSession, folder: str, symbol_pattern: str = r"([^/]+)\.csv$"
) -> DataFrame:
    """Every ``*.csv`` below a folder as one long table; the path names the symbol.

    ``symbol_pattern``: its first group is taken from the decoded file path. Files are grouped by header, one
    small row for each file, and each group is scanned under its own names, so columns may stand in any order.
    A cell that is not a number or a date becomes NULL.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).text(folder)
    rows = _under_headers(spark, lines, F.regexp_extract(_path(), symbol_pattern, 1).alias("symbol"))
    if rows is None:
        return spark.createDataFrame([], ", ".join(["symbol string", *(f"{c} {t}" for c, t in BAR_TYPES.items())]))
    return rows


def _under_headers(spark: SparkSession, lines: DataFrame, *extra: Column) -> DataFrame | None:
    """The files whose ``lines`` hold a header, each scanned under its own names; None if none does."""
    named = lines.select(_path().alias("path"), "value").where(F.lower("value").rlike(HEADER))
    headers = named.groupBy(F.regexp_replace("value", r'[\r"\x{FEFF}]', "").alias("header")).agg(
        F.collect_set("path").alias("paths")).collect()
    out = None
    for r in sorted(headers):
        schema = ", ".join(f"`{c.strip()}` string" for c in r["header"].split(","))
        part = _typed(spark.read.schema(schema).option("header", True).csv(sorted(r["paths"])), *extra)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_series_csv(
    spark: SparkSession, path: str, name: str, date: str = "date"
) -> DataFrame:
    """A dated series (date, value) as ``date`` and ``name``; blank lines are skipped."""
    raw = spark.read.option("header", True).csv(path)
    found = {c.lower(): c for c in raw.columns}
    day = found[date.lower()]
    value = found.get(name.lower()) or next(c for c in raw.columns if c != day)
    return raw.select(
        F.col(f"`{day}`").try_cast("date").alias("date"), F.col(f"`{value}`").try_cast("double").alias(name)
    ).na.drop("any")


def _typed(raw: DataFrame, *extra: Column) -> DataFrame:
    found = {c.lower().strip(): c for c in raw.columns}
    return raw.select(
        *extra,
        *[F.col(f"`{found[c]}`").try_cast(t).alias(c) for c, t in BAR_TYPES.items() if c in found],
    )

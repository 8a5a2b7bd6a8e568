"""Folders of landed vendor envelopes, one folder ``symbol=…`` for each instrument."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalar import from_epoch_millis
from tickloom.plans.scratch import stored
from tickloom.sources.landed import ENVELOPE, FIELDS

MALFORMED, WITHOUT, UNREADABLE, NONE = "malformed", "without results", "unreadable", "no bars"


def read_vendor_folder(
    spark: SparkSession, folder: str, symbols: Sequence[str] | None = None,
    start: date | None = None, end: date | None = None, lines: bool = False,
) -> DataFrame:
    """Bars of landed JSON envelopes: ``symbol``, ``ts``, open … volume and ``error``; bad files do not stop the job.

    Other symbols' folders are not opened, and bars outside the days ``start`` … ``end`` are left out before the
    arrays are unfolded. A file is one envelope, or one on each line with ``lines``. Contents are read once; what
    is found is written below the shared folder. Besides the bars there is one row with NULL prices, whose
    ``error`` says why, for each envelope that does not parse ("malformed": none of its bars is taken) or has no
    results ("without results"), for each file that Spark cannot decode ("unreadable"; with ``lines`` it stops the
    job, as the lines before the fault would hide the loss of the rest), and for each listed symbol with neither a bar nor such a row ("no bars"). Bars
    without a time are left out; an empty results array is no error.
    """
    wanted = F.lit(True) if symbols is None else F.col("symbol").isin(list(symbols))
    t = lambda bar: from_epoch_millis(bar["t"]).cast("date")
    inside = lambda bar: (
        bar["t"].isNotNull()
        & (F.lit(True) if start is None else t(bar) >= F.lit(start))
        & (F.lit(True) if end is None else t(bar) <= F.lit(end))
    )
    raw = (
        spark.read.schema(f"{ENVELOPE}, _broken string, symbol string")
        .option("multiLine", not lines).option("columnNameOfCorruptRecord", "_broken")
        .option("ignoreCorruptFiles", not lines).json(folder).where(wanted)
    )
    error = F.when(F.col("_broken").isNotNull(), MALFORMED).when(F.col("results").isNull(), WITHOUT)
    envelopes = raw.select("symbol", F.col("_metadata.file_path").alias("_path"), error.alias("error"), "results")
    taken = F.when(F.col("error").isNull(), F.filter("results", inside))
    # The outer form keeps a row for each file that was read, also of one without a bar.
    found = stored(envelopes.select("symbol", "_path", "error", F.explode_outer(taken).alias("_bar")))
    prices = [F.col(f"_bar.{short}").alias(name) for short, name in FIELDS.items()]
    rows = found.where("_bar IS NOT NULL OR error IS NOT NULL").select(
        "symbol", from_epoch_millis(F.col("_bar.t")).alias("ts"), *prices, "error")

    # A listing: the contents are not among the columns taken, so files are not opened.
    listing = (
        spark.read.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary, symbol string")
        .load(folder).where(wanted)
        .select("symbol", F.col("_metadata.file_path").alias("_path"), "length")
    )
    lost = listing.where("length > 0").join(found.select("_path").distinct(), "_path", "left_anti").select(
        "symbol", F.lit(UNREADABLE).alias("error"))
    out = rows.unionByName(lost, allowMissingColumns=True)
    if symbols is None:
        return out
    listed = spark.createDataFrame([(s,) for s in dict.fromkeys(symbols)], "symbol string")
    seen = rows.select("symbol").unionByName(lost.select("symbol")).distinct()
    absent = listed.join(seen, "symbol", "left_anti").withColumn("error", F.lit(NONE))
    return out.unionByName(absent, allowMissingColumns=True)

"""Checks of fitted scales that are kept and updated."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.registry import check, cut, rounded
from checks.views import BARS, bars
from tickloom.operators import moments
from tickloom.plans.scratch import stored

COLS = ["close", "volume"]
NEW = date(2000, 1, 1)


def kept(spark, folder):
    """A written fit of the earlier days, merged with one of the later days."""
    rows = bars(spark, folder)
    old = stored(moments.fit_moments(rows.where(F.col("date") < F.lit(NEW)), COLS, ["symbol"]))
    return moments.merge_moments([old, moments.fit_moments(rows.where(F.col("date") >= F.lit(NEW)), COLS, ["symbol"])], ["symbol"])


@check("merge_moments", BARS, sql=f"""
SELECT symbol, c AS column, count(*) AS n, {cut("avg(x)")} AS mean, {cut("stddev_pop(x)")} AS deviation,
       min(x) AS lowest, max(x) AS highest
FROM (SELECT symbol, 'close' AS c, close AS x FROM bars UNION ALL SELECT symbol, 'volume', volume FROM bars) GROUP BY symbol, c""")
def q_merge(spark, folder):
    """The fit of two parts merged is the fit of the whole."""
    out = kept(spark, folder).withColumn("deviation", F.sqrt(F.col("m2") / F.col("n"))).drop("m2")
    return rounded(out, "mean", "deviation")


@check("scale_by", BARS, """
f AS (SELECT symbol, avg(close) AS m, stddev_pop(close) AS s FROM bars WHERE symbol < 'Brand#4' GROUP BY symbol)""", """
g AS (SELECT avg(close) AS m, stddev_pop(close) AS s FROM bars WHERE symbol < 'Brand#4')""", sql=f"""
SELECT symbol, date, {cut("(close - coalesce(f.m, g.m)) / coalesce(f.s, g.s)")} AS close
FROM bars LEFT JOIN f USING (symbol), g""")
def q_scale(spark, folder):
    """Symbols that the kept fit has not seen are scaled by all others together."""
    seen = stored(kept(spark, folder).where("symbol < 'Brand#4' AND column = 'close'"))
    out = moments.scale_by(bars(spark, folder).select("symbol", "date", "close"), seen, ["close"], ["symbol"])
    return rounded(out, "close")

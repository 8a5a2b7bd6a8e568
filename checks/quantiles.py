"""Checks of quantile regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, cut, rounded
from checks.views import BARS, bars
from tickloom.functions.scalar import middle
from tickloom.functions.window import pct_change, rolling_std, shift
from tickloom.operators import quantiles
from tickloom.plans import with_features
from tickloom.plans.scratch import stored

LEVELS = (0.1, 0.5, 0.9)
SEEN = ["pct_close", "spread", "level"]


def moves(spark, folder):
    """Tomorrow's return and what is known today."""
    move = pct_change("close")
    spread, ahead = rolling_std(move, 10), shift(move, -1)
    out = with_features(bars(spark, folder), move, spread, ahead)
    return out.select("symbol", "date", move.name, F.col(spread.name).alias("spread"),
                      F.log1p("close").alias("level"), F.col(ahead.name).alias("next_move"))


@check("quantile_regression")
def q_regression(spark, folder):
    """A row's interval forecast of the next return."""
    rows = stored(moves(spark, folder))
    model = quantiles.fit_quantiles(rows, "next_move", SEEN, LEVELS)
    out = quantiles.predict_quantiles(model, rows).where("quantiles IS NOT NULL")
    return out.select("symbol", "date", "quantiles", middle("quantiles").alias("forecast"))


@check("quantile_coverage", BARS, """
m AS (SELECT symbol, date, close / lag(close) OVER w - 1 AS r FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date))""", """
s AS (SELECT r, lead(r) OVER w AS nxt, count(r) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS k
      FROM m WINDOW w AS (PARTITION BY symbol ORDER BY date))""", """
known AS (SELECT nxt FROM s WHERE k = 10 AND nxt IS NOT NULL)""", """
best AS (SELECT unnest([0.1, 0.5, 0.9])::DOUBLE AS q, unnest(cs) AS c, n
         FROM (SELECT quantile_disc(nxt, [0.1, 0.5, 0.9]) AS cs, count(*) AS n FROM known))""", sql=f"""
SELECT q AS quantile, n, {cut("avg(greatest(q * (nxt - c), (q - 1) * (nxt - c)))")} AS flat, true AS better, true AS near
FROM known, best GROUP BY q, n""")
def q_coverage(spark, folder):
    """Of each quantile: its rows, the loss of the best constant, whether the lines lose no more, and whether the share below is right."""
    rows = stored(moves(spark, folder))
    model = quantiles.fit_quantiles(rows, "next_move", SEEN, LEVELS)
    lines = quantiles.quantile_scores(quantiles.predict_quantiles(model, rows), "next_move", "quantiles", LEVELS)
    known = rows.na.drop("any")
    constant = quantiles.fit_quantiles(known, "next_move", [], LEVELS)
    flat = quantiles.quantile_scores(quantiles.predict_quantiles(constant, known), "next_move", "quantiles", LEVELS)
    both = lines.join(flat.select("quantile", F.col("pinball").alias("flat")), "quantile")
    return rounded(both.select(
        "quantile", "n", "flat", (F.col("pinball") <= F.col("flat") * 1.0001).alias("better"),
        (F.abs(F.col("below") - F.col("quantile")) <= 0.01).alias("near")), "flat")

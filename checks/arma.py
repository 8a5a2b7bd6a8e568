"""Checks of moving-average models and of forecasts fed back to a model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks import sqltext as t
from checks.registry import check, cut, rounded
from checks.views import bars
from tickloom.operators import arma
from tickloom.plans import Series


def two_lags(name: str, source: str, x: str, y: str) -> str:
    """SQL: regression of z on two columns with a mean, by Cramer's rule: c, a, b and the sum of squares left."""
    return f"""
{name}_sums AS (
  SELECT symbol, count(*) AS n, avg(z) AS m, avg({x}) AS m1, avg({y}) AS m2, var_pop(z) AS v, var_pop({x}) AS v11,
         var_pop({y}) AS v22, covar_pop({x}, {y}) AS v12, covar_pop(z, {x}) AS c1, covar_pop(z, {y}) AS c2
  FROM {source} WHERE z IS NOT NULL AND {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY symbol),
{name} AS (
  SELECT symbol, n, a, b, m - a * m1 - b * m2 AS c, n * (v - a * c1 - b * c2) / (n - 3) AS variance
  FROM (SELECT *, (c1 * v22 - c2 * v12) / (v11 * v22 - v12 * v12) AS a,
               (c2 * v11 - c1 * v12) / (v11 * v22 - v12 * v12) AS b FROM {name}_sums))"""


MODEL = (
    *t.STEPS, """
z AS (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY t) AS z FROM numbered)""", """
lagged AS (SELECT *, lag(z) OVER (PARTITION BY symbol ORDER BY t) AS z1,
                  lag(z, 2) OVER (PARTITION BY symbol ORDER BY t) AS z2 FROM z)""",
    two_lags("ar", "lagged", "z1", "z2"), """
shocked AS (SELECT *, lag(e) OVER (PARTITION BY symbol ORDER BY t) AS e1
            FROM (SELECT lagged.*, z - c - a * z1 - b * z2 AS e FROM lagged JOIN ar USING (symbol)))""",
    two_lags("ma", "shocked", "z1", "e1"), """
model AS MATERIALIZED (
  SELECT symbol, c, a AS phi, CASE WHEN abs(b) > 1 THEN 1 / b ELSE b END AS theta,
         variance * greatest(1, b * b) AS variance FROM ma)""", """
shock(symbol, t, date, e) AS (
  SELECT symbol, t, date, 0.0::DOUBLE FROM numbered WHERE t = 0
  UNION ALL
  SELECT l.symbol, l.t, l.date, CASE WHEN z1 IS NULL THEN 0 ELSE z - c - phi * z1 - theta * e END
  FROM shock s JOIN lagged l ON l.symbol = s.symbol AND l.t = s.t + 1 JOIN model m ON m.symbol = s.symbol)""")

FORECAST = f"""
SELECT symbol, step, {cut("y / 1000")} AS forecast, {cut("(y - 1.959963984540054 * sqrt(variance * total)) / 1000")} AS lower,
       {cut("(y + 1.959963984540054 * sqrt(variance * total)) / 1000")} AS upper FROM path"""

PATH = """
ends AS (SELECT symbol, arg_max(z, t) AS z, arg_max(close, t) AS y FROM lagged GROUP BY symbol)""", """
last_shock AS (SELECT symbol, arg_max(e, t) AS e FROM shock GROUP BY symbol)""", """
path AS (
  SELECT symbol, 1 AS step, c + phi * z + theta * e AS z, y + c + phi * z + theta * e AS y, 1.0::DOUBLE AS p,
         0.0::DOUBLE AS p1, 1.0::DOUBLE AS total, c, phi, theta, variance
  FROM model JOIN ends USING (symbol) JOIN last_shock USING (symbol)
  UNION ALL
  SELECT symbol, step + 1, c + phi * z, y + c + phi * z, q, p, total + q * q, c, phi, theta, variance
  FROM (SELECT *, (1 + phi) * p - phi * p1 + CASE WHEN step = 1 THEN theta ELSE 0 END AS q FROM path WHERE step < 10))"""


def forecast(spark, folder, series):
    out = arma.arma_forecast(bars(spark, folder), p=1, d=1, q=1, h=10, series=series)
    return rounded(out.withColumns({c: F.col(c) / 1000 for c in ("forecast", "lower", "upper")}), "forecast", "lower", "upper")


@check("arma_forecast", *MODEL, *PATH, recursive=True, sql=FORECAST)
def q_arma(spark, folder):
    """One lag and one shock on differences, in thousands: the SQL solves both stages by Cramer's rule."""
    return forecast(spark, folder, Series())


@check("arma_forecast_cut", *MODEL, *PATH, recursive=True, sql=FORECAST)
def q_arma_cut(spark, folder):
    """The same over series cut in chunks of 200 rows."""
    return forecast(spark, folder, Series(chunk_rows=200))


@check("arma_residuals", *MODEL, recursive=True, sql=f"""
SELECT s.symbol, s.date, CASE WHEN z1 IS NOT NULL THEN {cut("e / 100000")} END AS residual
FROM shock s JOIN lagged l ON l.symbol = s.symbol AND l.t = s.t""")
def q_arma_residuals(spark, folder):
    """In hundred thousands: so few of 38,372 values lie near a rounding step that nine digits are enough."""
    out = arma.arma_residuals(bars(spark, folder), p=1, d=1, q=1, series=Series(chunk_rows=500))
    return rounded(out.withColumn("residual", F.col("residual") / 100_000), "residual")


@check("arma_forecast_long")
def q_arma_long(spark, folder):
    """Thirty-four lags and eighteen shocks of fourth differences, 120 steps; tested against a plain fit."""
    return arma.arma_forecast(bars(spark, folder), p=34, d=4, q=18, h=120)


# Weights of the injected linear model, oldest value first.
WEIGHTS = [0.05, 0.15, 0.1, 0.3, 0.38]


def load_weighted():
    weights = np.array(WEIGHTS)
    return lambda seen: seen @ weights + 1.5


def fed_back(value: str, key: str, order: str, source: str) -> str:
    return f"""
WITH RECURSIVE source AS ({source}),
seen AS (SELECT {key}, list({value} ORDER BY {order}) AS w FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order} DESC) AS k FROM source) WHERE k <= 5 GROUP BY {key}),
path AS (SELECT {key}, 0 AS step, w, 0.0::DOUBLE AS y FROM seen WHERE len(w) = 5
  UNION ALL SELECT {key}, step + 1, list_append(w[2:], y), y
  FROM (SELECT {key}, step, w, list_dot_product(w, {WEIGHTS}::DOUBLE[]) + 1.5 AS y FROM path WHERE step < 100))
SELECT {key}, step, {cut("y")} AS forecast FROM path WHERE step > 0"""


@check("feedback_forecast", sql=fed_back("close", "symbol", "date", f"WITH {t.BARS} SELECT * FROM bars"))
def q_feedback(spark, folder):
    return rounded(arma.feedback_forecast(bars(spark, folder), load_weighted, window=5, h=100), "forecast")


@check("feedback_forecast_ticks", sql=fed_back("value", "user_id", "ts", "SELECT user_id, ts, value FROM events"))
def q_feedback_ticks(spark, folder):
    from checks.views import ticks

    out = arma.feedback_forecast(ticks(spark, folder), load_weighted, "value", 5, 100, Series("user_id", "ts"))
    return rounded(out, "forecast")

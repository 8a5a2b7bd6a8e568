"""Checks of as-of joins, panels and aggregates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import sqltext as t
from checks.registry import check, cut, rounded
from checks.views import (
    BARS, INDEX_DAILY, MACRO_MONTH, MACRO_QUARTER, bars, index_daily, macro, table,
)
from tickloom.functions import indicators as ind
from tickloom.functions import window as win
from tickloom.operators import aggregate as agg
from tickloom.operators import asof, features, rows
from tickloom.plans import with_features
from tickloom.plans.scratch import stored

ID = ("symbol", "date")
NAIVE = """
naive AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS guess FROM numbered)"""


@check("asof_join", BARS, MACRO_QUARTER, sql="""
SELECT b.symbol, b.date, b.close, m.gdp
FROM bars b ASOF LEFT JOIN macro_quarter m
  ON b.date >= m.date""")
def q_asof(spark, folder):
    gdp = macro(spark, folder, "quarter", "gdp")
    return asof.asof_join(bars(spark, folder).select(*ID, "close"), gdp)


@check("asof_join_keyed", sql="""
SELECT l.event_id, l.user_id, l.ts, r.value AS last_view, r.event_id AS view_id
FROM (SELECT * FROM events WHERE event_type <> 'view') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') r
  ON l.user_id = r.user_id AND l.ts >= r.ts""")
def q_asof_keyed(spark, folder):
    events = table(spark, folder, "events")
    left = events.filter("event_type <> 'view'").select("event_id", "user_id", "ts")
    right = events.filter("event_type = 'view'").select(
        "user_id", "ts", F.col("value").alias("last_view"), F.col("event_id").alias("view_id")
    )
    return asof.asof_join(left, right, on="ts", by=["user_id"])


# A user has many views a day: of a day's views the largest value counts.
@check("asof_join_ties", """
views AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS top_view FROM events
          WHERE event_type = 'view' GROUP BY ALL)""", sql="""
SELECT l.event_id, l.user_id, l.day, r.top_view
FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type <> 'view') l
ASOF LEFT JOIN views r ON l.user_id = r.user_id AND l.day >= r.day""")
def q_asof_ties(spark, folder):
    events = table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    left = events.filter("event_type <> 'view'").select("event_id", "user_id", "day")
    right = events.filter("event_type = 'view'").select("user_id", "day", F.col("value").alias("top_view"))
    return asof.asof_join(left, right, on="day", by=["user_id"])


@check("asof_join_unkeyed", sql="""
SELECT l.event_id, l.ts, r.value AS last_signup
FROM events l ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') r ON l.ts >= r.ts""")
def q_asof_unkeyed(spark, folder):
    events = table(spark, folder, "events")
    right = events.filter("event_type = 'signup'").select("ts", F.col("value").alias("last_signup"))
    return asof.asof_join(events.select("event_id", "ts"), right, on="ts")


# The five order priorities serve as daily indexes.
INDEXES = {
    "qqq": "1-URGENT", "dia": "2-HIGH", "spy": "3-MEDIUM", "vix": "4-NOT SPECIFIED", "ixic": "5-LOW",
}
CHAIN = " ".join(
    f"ASOF LEFT JOIN (SELECT date, close AS {c} FROM index_daily WHERE series = '{s}') {c}_t "
    f"ON b.date >= {c}_t.date" for c, s in INDEXES.items()
)


@check("enrich_asof", BARS, MACRO_QUARTER, MACRO_MONTH, INDEX_DAILY, sql=f"""
SELECT b.symbol, b.date, b.close, g.gdp / 50 AS gdp, c.cpi, {", ".join(INDEXES)}
FROM bars b ASOF LEFT JOIN macro_quarter g ON b.date >= g.date
ASOF LEFT JOIN macro_month c ON b.date >= c.date {CHAIN}""")
def q_enrich(spark, folder):
    gdp = macro(spark, folder, "quarter", "gdp").withColumn("gdp", F.col("gdp") / 50)
    daily = stored(index_daily(spark, folder))
    sides = [gdp, macro(spark, folder, "month", "cpi")] + [
        daily.filter(F.col("series") == s).select("date", F.col("close").alias(c))
        for c, s in INDEXES.items()
    ]
    return asof.enrich_asof(bars(spark, folder).select(*ID, "close"), sides)


@check("enrich_asof_clash", BARS, INDEX_DAILY, sql="""
SELECT b.symbol, b.date, b.close, q.close AS close_qqq, d.close AS close_dia
FROM bars b ASOF LEFT JOIN (SELECT * FROM index_daily WHERE series = '1-URGENT') q ON b.date >= q.date
ASOF LEFT JOIN (SELECT * FROM index_daily WHERE series = '2-HIGH') d ON b.date >= d.date""")
def q_enrich_clash(spark, folder):
    """Sides whose columns share the names of the bars."""
    daily = stored(index_daily(spark, folder))
    sides = [daily.filter(F.col("series") == INDEXES[c]).select("date", "close") for c in ("qqq", "dia")]
    return asof.enrich_asof(bars(spark, folder).select(*ID, "close"), sides, suffixes=["_qqq", "_dia"])


MONTHLY = """
monthly AS (
  SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS month,
         arg_min(CASE WHEN volume >= 30 THEN close END,
                 CASE WHEN volume >= 30 THEN date END) AS close
  FROM bars GROUP BY ALL
)"""


def busy_days(spark, folder):
    """Closes of thin days count as missing."""
    value = F.when(F.col("volume") >= 30, F.col("close"))
    return bars(spark, folder).select(*ID, value.alias("close"))


@check("resample_first", BARS, MONTHLY, sql="""
SELECT c.symbol, c.month, m.close
FROM (SELECT symbol, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE)
             AS month
      FROM monthly GROUP BY symbol) c LEFT JOIN monthly m USING (symbol, month)""")
def q_resample(spark, folder):
    return agg.resample_first(busy_days(spark, folder), "close")


SYMBOLS = [f"Brand{i}" for i in range(1, 26)]


@check("align_panel", BARS, MONTHLY, sql="SELECT month, " + ", ".join(
    f"max(CASE WHEN symbol = '{s.replace('Brand', 'Brand#')}' THEN close END) AS {s}" for s in SYMBOLS
) + " FROM monthly GROUP BY month")
def q_panel(spark, folder):
    monthly = agg.resample_first(busy_days(spark, folder), "close")
    return asof.align_panel(
        monthly.withColumn("symbol", F.translate("symbol", "#", "")), SYMBOLS, "close"
    )


@check("broadcast_stat", *t.STEPS, t.CHANGES, t.STATS, sql=f"""
SELECT symbol, date, {cut("mean_return")} AS mean_return, {cut("volatility")} AS volatility
FROM bars JOIN stats USING (symbol)""")
def q_broadcast_stat(spark, folder):
    out = asof.broadcast_stat(bars(spark, folder)).select(*ID, "mean_return", "volatility")
    return rounded(out, "mean_return", "volatility")


@check("return_stats", *t.STEPS, t.CHANGES, t.STATS, sql=f"""
SELECT symbol, {cut("mean_return")} AS mean_return, {cut("volatility")} AS volatility FROM stats""")
def q_return_stats(spark, folder):
    return rounded(agg.return_stats(bars(spark, folder)), "mean_return", "volatility")


@check("latest_snapshot", *t.ROLLED, sql=f"""
SELECT symbol, close, volume, {cut("mean20")} AS mean20 FROM roll WHERE t = len - 1""")
def q_latest(spark, folder):
    out = with_features(bars(spark, folder), win.rolling_mean("close", 20).named("mean20"))
    return rounded(agg.latest_snapshot(out, ["close", "volume", "mean20"]), "mean20")


VECTOR = {
    "mean_return": "mean_return", "volatility": "volatility", "rsi": t.rsi("up14", "down14"),
    "macd": "e12 - e26", "macd_signal": "sig", "moving_average_50": "mean50",
    "moving_average_200": "mean200", "bollinger_upper": "mean20 + 2 * std20",
    "bollinger_lower": "mean20 - 2 * std20", "atr": "tr14", "avg_volume": "volume50",
}


@check("stock_features", *t.RECURRED, t.CHANGES, t.STATS, recursive=True, sql=f"""
SELECT symbol, {", ".join(f"{cut(e)} AS {c}" for c, e in VECTOR.items())}
FROM roll JOIN rec USING (symbol, t) JOIN stats USING (symbol) WHERE t = len - 1""")
def q_stock_features(spark, folder):
    return rounded(features.stock_features(bars(spark, folder)), *features.VECTOR)


@check("latest_levels", *t.ROLLED, sql=f"""
SELECT symbol, date, close, {cut(t.rsi("up14", "down14"))} AS rsi, {cut("mean20")} AS bb_middle,
       {cut("mean20 + 2 * std20")} AS bb_upper, {cut("mean20 - 2 * std20")} AS bb_lower
FROM roll WHERE t = len - 1""")
def latest_levels(spark, folder):
    """Latest RSI and Bollinger levels per symbol."""
    levels = ["bb_middle", "bb_upper", "bb_lower"]
    out = with_features(bars(spark, folder), ind.rsi_sma().named("rsi"), *ind.bollinger())
    last = agg.latest_snapshot(out, ["date", "close", "rsi", *levels])
    return rounded(last, "rsi", *levels)


def naive(spark, folder):
    return with_features(bars(spark, folder), win.shift("close", 1).named("guess"))


@check("mse", *t.STEPS, NAIVE, sql=f"""
SELECT symbol, {cut("avg((close - guess) * (close - guess))")} AS mse FROM naive GROUP BY symbol""")
def q_mse(spark, folder):
    return rounded(agg.mse(naive(spark, folder), "close", "guess", ["symbol"]), "mse")


@check("mae", *t.STEPS, NAIVE, sql=f"""
SELECT symbol, {cut("avg(abs(close - guess))")} AS mae FROM naive GROUP BY symbol""")
def q_mae(spark, folder):
    return rounded(agg.mae(naive(spark, folder), "close", "guess", ["symbol"]), "mae")


# The seven forecast quantiles.
QUANTILES = [0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98]


@check("pinball_loss", *t.STEPS, NAIVE, sql=f"""
SELECT symbol, quantile,
       {cut("avg(greatest(quantile * (close - guess), (quantile - 1) * (close - guess)))")} AS pinball
FROM naive, (SELECT unnest({QUANTILES})::DOUBLE AS quantile) GROUP BY symbol, quantile""")
def q_pinball(spark, folder):
    out = agg.pinball_loss(naive(spark, folder), "close", "guess", QUANTILES, ["symbol"])
    return rounded(out, "pinball")


@check("accuracy", *t.STEPS, NAIVE, sql=f"""
SELECT symbol, {cut("avg(CASE WHEN (close > open) = (close > guess) THEN 1.0 ELSE 0.0 END)")} AS accuracy
FROM naive WHERE guess IS NOT NULL GROUP BY symbol""")
def q_accuracy(spark, folder):
    rows_ = rows.drop_incomplete(naive(spark, folder), ["guess"]).select(
        "symbol", (F.col("close") > F.col("open")).cast("int").alias("predicted"),
        (F.col("close") > F.col("guess")).cast("int").alias("label"),
    )
    return rounded(agg.accuracy(rows_, "label", "predicted", ["symbol"]), "accuracy")

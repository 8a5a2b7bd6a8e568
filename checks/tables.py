"""Checks of sources, row operators, sorts, set operations and scalar functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import sqltext as t
from checks.registry import check, cut, rounded
from checks.views import (
    BARS, MACRO_MONTH, TICKS, bars, envelopes, macro, table, ticks, vectors,
)
from tickloom.functions import indicators as ind
from tickloom.functions import scalar as sc
from tickloom.functions import window as win
from tickloom.operators import features, rows
from tickloom.plans import Series, with_features
from tickloom.plans.scratch import shared_folder
from tickloom.sources import (
    parse_bar_envelope, price_history, read_bars_csv, read_bars_dir, read_series_csv, read_vendor_folder,
)

TICK = Series("user_id", "ts")
ALL = "symbol, date, open, high, low, close, volume"
OHLCV = ["date", "open", "high", "low", "close", "volume"]


@check("read_bars_csv", BARS, sql="SELECT date, open, high, low, close, volume FROM bars")
def q_read_bars_csv(spark, folder):
    path = shared_folder(spark)
    named = bars(spark, folder).select(*[F.col(c).alias(c.capitalize()) for c in OHLCV])
    named.write.option("header", True).csv(path)
    return read_bars_csv(spark, path)


@check("read_series_csv", MACRO_MONTH, sql="SELECT date, cpi FROM macro_month")
def q_read_series_csv(spark, folder):
    path = shared_folder(spark)
    series = macro(spark, folder, "month", "cpi")
    series.select(F.col("date").alias("DATE"), F.col("cpi").alias("CPI")).write.option(
        "header", True).csv(path)
    return read_series_csv(spark, path, "cpi")


@check("read_bars_dir", BARS, sql=f"SELECT {ALL} FROM bars")
def q_read_bars_dir(spark, folder):
    path = shared_folder(spark)
    bars(spark, folder).write.partitionBy("symbol").option("header", True).csv(path)
    # Written folders are escaped once more than plain file names.
    out = read_bars_dir(spark, path, r"symbol=([^/]+)/")
    return out.withColumn("symbol", F.url_decode("symbol"))


@check("parse_bar_envelope", BARS, sql=f"SELECT {ALL} FROM bars")
def q_envelope(spark, folder):
    out = parse_bar_envelope(envelopes(spark, folder))
    return out.withColumn("date", F.col("ts").cast("date")).drop("ts")


BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@check("price_history", BARS, sql=f"""
SELECT {ALL} FROM bars WHERE date BETWEEN DATE '1995-01-01' AND DATE '1996-06-30'
UNION ALL SELECT 'Unlisted', NULL, NULL, NULL, NULL, NULL, NULL""")
def q_price_history(spark, folder):
    return price_history(
        bars(spark, folder), [*BRANDS, "Unlisted"], date(1995, 1, 1), date(1996, 6, 30)
    )


# Envelopes of every third year are cut short for symbols that end in 3: none of their bars, one error each.
@check("vendor_history", BARS, """
landed AS (SELECT *, symbol LIKE '%3' AND year(date) % 3 = 0 AS bad FROM bars)""", sql=f"""
SELECT {ALL}, NULL AS error FROM landed WHERE NOT bad AND date BETWEEN DATE '1995-01-01' AND DATE '1996-06-30'
UNION ALL SELECT symbol, CAST(NULL AS DATE), NULL, NULL, NULL, NULL, NULL, 'malformed'
FROM (SELECT symbol, year(date) FROM landed WHERE bad GROUP BY ALL)
UNION ALL SELECT 'Unlisted', NULL, NULL, NULL, NULL, NULL, NULL, 'no bars'""")
def q_vendor_history(spark, folder):
    path = shared_folder(spark)
    year = F.year(F.timestamp_millis(F.get_json_object("body", "$.results[0].t").cast("long")))
    short = F.col("symbol").endswith("3") & (year % 3 == 0)
    body = F.when(short, F.expr("left(body, length(body) div 2)")).otherwise(F.col("body"))
    envelopes(spark, folder).select("symbol", body.alias("body")).write.partitionBy("symbol").text(path)
    out = read_vendor_folder(
        spark, path, [*BRANDS, "Unlisted"], date(1995, 1, 1), date(1996, 6, 30), lines=True)
    return out.withColumn("date", F.col("ts").cast("date")).drop("ts")


@check("rename", BARS, sql="SELECT symbol, date, open, high, low, close AS value, volume AS traded FROM bars")
def q_rename(spark, folder):
    return rows.rename(bars(spark, folder), {"close": "value", "volume": "traded"})


@check("project", BARS, sql="SELECT symbol, date, close FROM bars")
def q_project(spark, folder):
    return rows.project(bars(spark, folder), ["symbol", "date", "close"])


@check("derive", BARS, sql="""
SELECT symbol, date, close / 50 AS scaled, '0' AS grp, month(date) AS month FROM bars""")
def q_derive(spark, folder):
    out = rows.derive(bars(spark, folder), scaled=F.col("close") / 50, grp=F.lit("0"),
                      month=F.month("date"))
    return out.select("symbol", "date", "scaled", "grp", "month")


@check("drop_incomplete", *t.STEPS, sql=f"""
SELECT symbol, date, close, {cut(t.over(20, "avg(close)"))} AS mean20 FROM numbered WHERE t >= 19
""".replace("WHERE t >= 19", "QUALIFY t >= 19"))
def q_drop_incomplete(spark, folder):
    out = with_features(bars(spark, folder), win.rolling_mean("close", 20).named("mean20"))
    return rounded(rows.drop_incomplete(out), "mean20").select("symbol", "date", "close", "mean20")


@check("fill_const", *t.STEPS, sql="""
SELECT symbol, date, coalesce(close - lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) AS change
FROM numbered""")
def q_fill_const(spark, folder):
    out = with_features(bars(spark, folder), win.diff("close").named("change"))
    return rows.fill_const(out, 0.0, ["change"]).select("symbol", "date", "change")


@check("fill_mean", *t.ROLLED, sql=f"""
SELECT symbol, date, {cut("coalesce(close - close10, avg(close - close10) OVER ())")} AS momentum
FROM roll""")
def q_fill_mean(spark, folder):
    out = with_features(bars(spark, folder), ind.momentum())
    return rounded(rows.fill_mean(out, ["momentum"]), "momentum").select("symbol", "date", "momentum")


@check("slice_rows", *t.STEPS, sql="SELECT symbol, date, close FROM numbered WHERE t BETWEEN len - 430 AND len - 66")
def q_slice(spark, folder):
    return rows.slice_rows(bars(spark, folder), -430, -65).select("symbol", "date", "close")


@check("tick_slice", TICKS, sql="""
SELECT user_id, ts, value FROM ticks
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts) > 5
    AND row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) > 10""")
def q_tick_slice(spark, folder):
    return rows.slice_rows(ticks(spark, folder), 5, -10, TICK).select("user_id", "ts", "value")


@check("min_history", TICKS, sql="""
SELECT user_id, ts, value, k FROM ticks QUALIFY count(*) OVER (PARTITION BY user_id) >= 65""")
def q_min_history(spark, folder):
    return rows.min_history(ticks(spark, folder), 65, TICK)


@check("rule_label", *t.SCREENED, recursive=True, sql="""
SELECT symbol, date,
       CASE WHEN macd > 0 AND rsi > 30 AND rsi < 70 AND band_position < 0.2 THEN 1 ELSE 0 END AS label
FROM screen""")
def q_rule_label(spark, folder):
    return rows.rule_label(features.screen(bars(spark, folder))).select("symbol", "date", "label")


@check("remap", sql="SELECT doc_id, toxic, CASE quality WHEN 0 THEN -1 ELSE quality END AS quality FROM labels")
def q_remap(spark, folder):
    return rows.remap(table(spark, folder, "labels"), "quality", {0: -1, 1: 1})


@check("row_index", *t.STEPS, sql="SELECT symbol, date, t AS time_idx FROM numbered")
def q_row_index(spark, folder):
    return rows.row_index(bars(spark, folder)).select("symbol", "date", "time_idx")


@check("order_series", BARS, sql=f"SELECT {ALL} FROM bars ORDER BY symbol, date")
def q_order(spark, folder):
    return rows.order_series(bars(spark, folder))


@check("best_by_score", *t.STEPS, t.CHANGES, sql="""
SELECT symbol, date, change FROM changes ORDER BY change DESC NULLS LAST, symbol, date LIMIT 1""")
def q_best(spark, folder):
    out = with_features(bars(spark, folder), win.pct_change("close").named("change"))
    return rows.best_by_score(out, "change", "symbol", "date").select("symbol", "date", "change")


@check("head", *t.STEPS, sql="SELECT symbol, date, close FROM numbered WHERE t < 5")
def q_head(spark, folder):
    return rows.head(bars(spark, folder), 5).select("symbol", "date", "close")


@check("stack", *t.STEPS, sql="""
SELECT symbol, date, close, t AS time_idx FROM numbered
UNION ALL SELECT symbol, date, close, len + t - (len - 65) FROM numbered WHERE t >= len - 65""")
def q_stack(spark, folder):
    all_rows = bars(spark, folder).select("symbol", "date", "close")
    return rows.stack(all_rows, rows.slice_rows(all_rows, -65), "time_idx")


@check("tile", *t.STEPS, sql="""
SELECT symbol, date, close, rep * len + t AS time_idx
FROM numbered, (SELECT unnest(range(12)) AS rep)""")
def q_tile(spark, folder):
    return rows.tile(bars(spark, folder).select("symbol", "date", "close"), 12, "time_idx")


@check("recent_sample", BARS, sql="""
SELECT symbol, date, close
FROM (SELECT * FROM bars ORDER BY date DESC, symbol LIMIT 5000)
ORDER BY md5(concat_ws('|', symbol, CAST(date AS VARCHAR))) LIMIT 64""")
def q_recent_sample(spark, folder):
    out = rows.recent_sample(bars(spark, folder), 5000, 64, "date", ["symbol", "date"])
    return out.select("symbol", "date", "close")


@check("recent_samples", """
back AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS back FROM events)""", """
drawn AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('|', CAST(user_id AS VARCHAR),
                   CAST(event_id AS VARCHAR)))) AS place,
                 count(*) OVER (PARTITION BY user_id) AS held FROM back WHERE back <= 40)""", sql="""
SELECT user_id, event_id, value FROM drawn WHERE place <= 8 AND held >= 8""")
def q_recent_samples(spark, folder):
    """Eight of each user's latest forty events."""
    out = rows.recent_samples(table(spark, folder, "events"), 40, 8, ["event_id"], TICK)
    return out.select("user_id", "event_id", "value")


@check("clip", *t.ROLLED, sql="""
SELECT symbol, date, greatest(d, 0) + 0 * d AS gain, least(d, 0) + 0 * d AS loss,
       greatest(least(d, 100), -100) + 0 * d AS bounded FROM moves""")
def q_clip(spark, folder):
    out = with_features(bars(spark, folder), win.diff("close").named("d"))
    d = F.col("d")
    return out.select("symbol", "date", sc.clip(d, 0.0).alias("gain"),
                      sc.clip(d, None, 0.0).alias("loss"), sc.clip(d, -100.0, 100.0).alias("bounded"))


@check("keep_where", *t.ROLLED, sql="SELECT symbol, date, up0 AS gain FROM moves")
def q_where(spark, folder):
    out = with_features(bars(spark, folder), win.diff("close").named("d"))
    return out.select("symbol", "date", sc.keep_where(F.col("d"), F.col("d") > 0).alias("gain"))


@check("rowwise_max", *t.ROLLED, sql="SELECT symbol, date, tr AS true_range FROM moves")
def q_rowwise(spark, folder):
    out = with_features(bars(spark, folder), win.shift("close", 1).named("prev"))
    h, l, c = F.col("high"), F.col("low"), F.col("prev")
    return out.select("symbol", "date",
                      sc.rowwise_max(h - l, F.abs(h - c), F.abs(l - c)).alias("true_range"))


@check("date_parts", BARS, sql="""
SELECT symbol, date, month(date) AS month, CAST(date_trunc('month', date) AS DATE) AS first_day,
       CAST(date - 420 AS DATE) AS earlier, date AS parsed, day(date) AS days
FROM bars""")
def q_dates(spark, folder):
    day = F.col("date")
    millis = F.unix_millis(day.cast("timestamp"))
    return bars(spark, folder).select(
        "symbol", "date", F.month(day).alias("month"), sc.month_start(day).alias("first_day"),
        F.date_sub(day, 420).alias("earlier"), sc.from_epoch_millis(millis).cast("date").alias("parsed"),
        F.size(sc.days_between(sc.month_start(day), day)).alias("days"),
    )


@check("wave", *t.STEPS, sql=f"""
SELECT symbol, date, {cut("0.0 + t * (50.0 / 499)")} AS x, {cut("sin(t * (50.0 / 499))")} AS y
FROM numbered""")
def q_wave(spark, folder):
    x, y = sc.wave(F.col("time_idx"), 500, 0, 50)
    out = rows.row_index(bars(spark, folder)).select("symbol", "date", x.alias("x"), y.alias("y"))
    return rounded(out, "x", "y")


@check("wave_fit", *t.STEPS, sql=f"""
SELECT symbol, count(*) AS n, {cut("regr_slope(close, sin(t * (50.0 / 499))) / 1000")} AS swing,
       {cut("corr(close, sin(t * (50.0 / 499)))")} AS fit FROM numbered GROUP BY symbol""")
def q_wave_fit(spark, folder):
    """How far each series swings with the wave."""
    _, y = sc.wave(F.col("time_idx"), 500, 0, 50)
    out = rows.row_index(bars(spark, folder)).withColumn("y", y).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), (F.regr_slope("close", "y") / 1000).alias("swing"), F.corr("close", "y").alias("fit"))
    return rounded(out, "swing", "fit")


@check("fit_length", sql=f"""
SELECT vec_id, 70 AS padded, 40 AS cut_to, {cut("list_sum(CAST(embedding AS DOUBLE[]))")} AS total,
       {cut("list_sum(CAST(embedding[1:40] AS DOUBLE[]))")} AS first_total
FROM embeddings""")
def q_fit_length(spark, folder):
    long, short = sc.fit_length(F.col("v"), 70, 0.0), sc.fit_length(F.col("v"), 40, 0.0)

    def add(a):
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    return rounded(vectors(spark, folder).select(
        "vec_id", F.size(long).alias("padded"), F.size(short).alias("cut_to"),
        add(long).alias("total"), add(short).alias("first_total"),
    ), "total", "first_total")


@check("middle", sql="SELECT vec_id, CAST(embedding[33] AS DOUBLE) AS middle FROM embeddings")
def q_middle(spark, folder):
    return vectors(spark, folder).select("vec_id", sc.middle(F.col("v")).alias("middle"))


@check("news_prompt", """
usual AS (SELECT lang, avg(quality) >= 0.5 AS good FROM documents JOIN labels USING (doc_id) GROUP BY lang)""", sql="""
SELECT doc_id, 'News: ' || text || ' The news has sentiment: '
       || CASE WHEN coalesce(quality = 1, good, true) THEN 'positive' ELSE 'negative' END
       || '. Relevant stock advice based on news and sentiment:' AS prompt
FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN usual USING (lang)""")
def q_prompt(spark, folder):
    """Every document: by its label, else by the commoner label of its language."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    known = docs.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left")
    usual = known.where("quality IS NOT NULL").groupBy("lang").agg((F.avg("quality") >= 0.5).alias("good"))
    positive = F.coalesce(F.col("quality") == 1, F.col("good"), F.lit(True))
    word = F.when(positive, "positive").otherwise("negative")
    return known.join(usual, "lang", "left").select("doc_id", sc.news_prompt(F.col("text"), word).alias("prompt"))


@check("token_window", sql=r"""
SELECT doc_id, 128 AS width, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens
FROM (SELECT doc_id, list_slice(regexp_extract_all(text, '[\p{L}\p{N}]+'), 1, 128) AS tokens
      FROM documents)""")
def q_token_window(spark, folder):
    tokens, mask = sc.token_window(F.col("text"))
    out = table(spark, folder, "documents").select("doc_id", tokens.alias("t"), mask.alias("m"))
    real = F.filter("t", lambda x: x != "")
    return out.select(
        "doc_id", F.size("t").alias("width"),
        F.aggregate("m", F.lit(0), lambda s, x: s + x).alias("n_tokens"),
        F.concat_ws(" ", real).alias("tokens"),
    )

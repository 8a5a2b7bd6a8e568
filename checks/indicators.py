"""Checks of the window primitives and the technical indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as t
from checks.registry import check, cut, rounded
from checks.views import BARS, NUMBERED, TICKS, bars, ticks
from tickloom.functions import indicators as ind
from tickloom.functions import recurrence as rec
from tickloom.functions import window as win
from tickloom.operators import features, rows
from tickloom.operators.psar import psar
from tickloom.plans import Series, with_features

TICK = Series("user_id", "ts")
ID = ("symbol", "date")


def simple(name, parts, columns, feats, exact=(), recursive=False, source="roll"):
    """One check: ``columns`` maps result name → SQL; names not in ``exact`` are rounded."""
    pick = ", ".join(
        f"{e} AS {c}" if c in exact else f"{cut(e)} AS {c}" for c, e in columns.items()
    )

    @check(name, *parts, sql=f"SELECT symbol, date, {pick} FROM {source}", recursive=recursive)
    def query(spark, folder):
        made = feats()
        named = [f.named(c) for f, c in zip(made, columns)]
        out = with_features(bars(spark, folder), *named).select(*ID, *columns)
        return rounded(out, *[c for c in columns if c not in exact])


def lagged(e: str) -> str:
    return f"{e} OVER (PARTITION BY symbol ORDER BY date)"


simple("diff", t.STEPS, {"change": f"close - {lagged('lag(close)')}"},
       lambda: [win.diff("close")], exact=("change",), source="numbered")
simple("pct_change", t.STEPS, {"change": f"close / {lagged('lag(close)')} - 1"},
       lambda: [win.pct_change("close")], exact=("change",), source="numbered")
simple("shift", t.STEPS, {"back": lagged("lag(close, 10)"), "ahead": lagged("lead(close, 1)")},
       lambda: [win.shift("close", 10), win.shift("close", -1)],
       exact=("back", "ahead"), source="numbered")
simple("rolling_mean", t.STEPS, {f"mean{n}": t.over(n, "avg(close)") for n in (3, 14, 20, 50, 200)},
       lambda: [win.rolling_mean("close", n) for n in (3, 14, 20, 50, 200)], source="numbered")
simple("rolling_std", t.STEPS,
       {"sample": t.over(20, "stddev_samp(close)"), "population": t.over(20, "stddev_pop(close)")},
       lambda: [win.rolling_std("close", 20, 1), win.rolling_std("close", 20, 0)], source="numbered")
simple("rolling_extremes", t.STEPS,
       {"highest": t.over(14, "max(high)"), "lowest": t.over(14, "min(low)")},
       lambda: [win.rolling_max("high", 14), win.rolling_min("low", 14)],
       exact=("highest", "lowest"), source="numbered")
simple("ema", (*t.RECURRED, t.BOTH),
       {"fast": "e12", "slow": "e26", "warm": "CASE WHEN t >= 25 THEN e26 END"},
       lambda: [rec.ema("close", 12), rec.ema("close", 26), rec.ema("close", 26, 26)],
       recursive=True, source="both_sides")
simple("wilder", (*t.RECURRED, t.BOTH),
       {"plain": "CASE WHEN t >= 13 THEN wt END", "seeded": "atr"},
       lambda: [rec.wilder(ind.true_range(), 14), rec.wilder(ind.true_range(), 14, seeded=True)],
       recursive=True, source="both_sides")
simple("cum_sum", t.STEPS, {"total": lagged("sum(volume)")},
       lambda: [win.cum_sum("volume")], source="numbered")
simple("rsi_sma", t.ROLLED, {"rsi": t.rsi("up14", "down14")}, lambda: [ind.rsi_sma()])
simple("rsi_sma_first_zero", t.ROLLED, {"rsi": t.rsi("up014", "down014")},
       lambda: [ind.rsi_sma(first_delta_zero=True)])
simple("rsi_signed", t.ROLLED, {"rsi": t.rsi("up14", "(-down14)")}, lambda: [ind.rsi_signed()])
simple("rsi_wilder", (*t.RECURRED, t.BOTH), {"rsi": t.RSI_WILDER}, lambda: [ind.rsi_wilder()],
       recursive=True, source="both_sides")
simple("macd", (*t.RECURRED, t.BOTH), {"macd": "e12 - e26"}, lambda: [ind.macd()],
       recursive=True, source="both_sides")
simple("macd_signal", (*t.RECURRED, t.BOTH), {"signal": "sig"}, lambda: [ind.macd_signal()],
       recursive=True, source="both_sides")
simple("macd_ta", (*t.RECURRED, t.BOTH), {
    "line": "CASE WHEN t >= 25 THEN e12 - e26 END", "signal": "CASE WHEN t >= 33 THEN lsig END",
    "hist": "CASE WHEN t >= 33 THEN e12 - e26 - lsig END",
}, lambda: ind.macd_ta(), recursive=True, source="both_sides")
simple("bollinger", t.ROLLED,
       {"middle": "mean20", "upper": "mean20 + 2 * std20", "lower": "mean20 - 2 * std20"},
       lambda: ind.bollinger())
simple("bollinger_ta", t.ROLLED,
       {"middle": "mean20", "high": "mean20 + 2 * pstd20", "low": "mean20 - 2 * pstd20"},
       lambda: ind.bollinger(ddof=0))
simple("band_position", t.ROLLED, {"band_position": t.BAND_POSITION}, lambda: [ind.band_position()])
simple("bb_middle", t.ROLLED, {"bb_middle": "mean20"}, lambda: [ind.bollinger()[0]])
simple("stochastic", (*t.ROLLED, f"""
stoch AS (SELECT *, {t.STOCHASTIC_K} AS k FROM roll)"""),
       {"k": "k", "d": f"CASE WHEN t >= 15 THEN {t.over(3, 'avg(k)')} END"},
       lambda: ind.stochastic(), source="stoch")
simple("moving_average", t.ROLLED, {"ma50": "mean50", "ma200": "mean200"},
       lambda: [ind.moving_average(n=50), ind.moving_average(n=200)])
simple("ema_12", (*t.RECURRED, t.BOTH), {"ema_12": "e12"}, lambda: [ind.smoothed("close", 12)],
       recursive=True, source="both_sides")
simple("momentum", t.ROLLED, {"momentum": "close - close10"}, lambda: [ind.momentum()],
       exact=("momentum",))
simple("roc", t.ROLLED, {"roc": "100 * (close / close10 - 1)"}, lambda: [ind.roc()],
       exact=("roc",))
simple("atr_sma", t.ROLLED, {"atr": "tr14"}, lambda: [ind.atr_sma()])
simple("atr_unsigned", t.ROLLED, {"atr": "trs14"}, lambda: [ind.atr_unsigned()])
simple("atr_wilder", (*t.RECURRED, t.BOTH), {"atr": "atr"}, lambda: [ind.atr_wilder()],
       recursive=True, source="both_sides")
simple("avg_volume", t.ROLLED, {"avg_volume": "volume50"}, lambda: [ind.avg_volume()])
simple("vwap", t.STEPS, {"vwap": f"{lagged('sum(close * volume)')} / {lagged('sum(volume)')}"},
       lambda: [ind.vwap()], source="numbered")
simple("ichimoku", t.ROLLED,
       {"a": "(mid9 + mid26) / 2", "b": "mid52", "base": "mid26", "conversion": "mid9"},
       lambda: ind.ichimoku(), exact=("a", "b", "base", "conversion"))
simple("adx", (*t.DIRECTED, """
directed AS (SELECT n.symbol, n.date, a.adx, a.pos, a.neg
             FROM numbered n LEFT JOIN adx a USING (symbol, t))"""),
       {"adx": "adx", "adx_pos": "pos", "adx_neg": "neg"}, lambda: ind.adx(),
       recursive=True, source="directed")
simple("cci", t.ROLLED, {"cci": t.CCI}, lambda: [ind.cci()])


@check("cum_growth", *t.STEPS, sql=f"""
SELECT symbol, date,
       {cut("close / first_value(close) OVER (PARTITION BY symbol ORDER BY date)")} AS growth
FROM numbered""")
def cum_growth(spark, folder):
    change = win.pct_change("close").named("change")
    out = with_features(with_features(bars(spark, folder), change), win.cum_growth("change").named("growth"))
    return rounded(out.select(*ID, "growth"), "growth")


@check("lag_sequences", *t.STEPS, sql=f"""
SELECT symbol, date, len(seq) AS n, seq[1] AS oldest, seq[10] AS newest,
       {cut("list_sum(seq)")} AS total, close AS label
FROM (SELECT *, list(close) OVER (PARTITION BY symbol ORDER BY date
                                  ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS seq FROM numbered)
WHERE t >= 10""")
def lag_sequences(spark, folder):
    rows_ = with_features(bars(spark, folder), win.lag_sequence("close", 10).named("seq"))
    pairs = rows.drop_incomplete(rows_, ["seq", "close"])
    total = F.aggregate("seq", F.lit(0.0), lambda a, x: a + x)
    return rounded(pairs.select(
        *ID, F.size("seq").cast("bigint").alias("n"), F.col("seq")[0].alias("oldest"),
        F.col("seq")[9].alias("newest"), total.alias("total"), F.col("close").alias("label"),
    ), "total")


@check("expanding_features", *t.SCREENED, recursive=True, sql=f"""
SELECT symbol, date, {cut("macd")} AS macd, {cut("rsi")} AS rsi,
       {cut("band_position")} AS band_position
FROM screen WHERE t BETWEEN 49 AND len - 2""")
def expanding_features(spark, folder):
    out = features.expanding_features(bars(spark, folder)).select(*ID, *features.SCREEN)
    return rounded(out, *features.SCREEN)


@check("forward_fill", BARS, sql="""
SELECT c.symbol, CAST(day AS DATE) AS date, b.close, b.volume
FROM (SELECT symbol, unnest(generate_series(first, last, INTERVAL 1 DAY)) AS day
      FROM (SELECT symbol, min(date) AS first, max(date) AS last FROM bars GROUP BY symbol)) c
ASOF JOIN bars b ON c.symbol = b.symbol AND c.day >= b.date""")
def forward_fill(spark, folder):
    out = rows.forward_fill(bars(spark, folder), ["close", "volume"])
    return out.select(*ID, "close", "volume")


@check("psar", BARS, NUMBERED, t.PSAR, recursive=True, sql=f"""
SELECT n.symbol, n.date, {cut("p.sar")} AS psar FROM numbered n JOIN psar p USING (symbol, t)""")
def parabolic(spark, folder):
    return rounded(psar(bars(spark, folder)).select(*ID, "psar"), "psar")


# By position every series is cut, so chunks start warm and hand over to each other.
@check("psar_by_position", BARS, NUMBERED, t.PSAR, recursive=True, sql=f"""
SELECT n.symbol, n.t, {cut("p.sar")} AS psar FROM numbered n JOIN psar p USING (symbol, t)""")
def parabolic_by_position(spark, folder):
    numbered = rows.row_index(bars(spark, folder), "t")
    out = psar(numbered, series=Series("symbol", "t", chunk_rows=100))
    return rounded(out.select("symbol", "t", "psar"), "psar")


HAND = {
    "rsi": t.rsi("up14", "(-down14)"), "macd_signal": "sig", "avg_volume": "volume50",
    "bb_middle": "mean20", "stochastic_k": "k",
    "stochastic_d": f"CASE WHEN t >= 15 THEN {t.over(3, 'avg(k)')} END",
    "ema_12": "e12", "momentum": "close - close10",
}
TA = {
    "rsi": t.RSI_WILDER, "macd": "CASE WHEN t >= 25 THEN e12 - e26 END",
    "macd_signal": "CASE WHEN t >= 33 THEN lsig END", "avg_volume": "volume50",
    "bb_middle": "mean20", "bb_high": "mean20 + 2 * pstd20", "bb_low": "mean20 - 2 * pstd20",
    "stochastic_k": "k", "stochastic_d": HAND["stochastic_d"], "ema_12": "e12",
    "momentum": "100 * (close / close10 - 1)", "ichimoku_a": "(mid9 + mid26) / 2",
    "ichimoku_b": "mid52", "ichimoku_base": "mid26", "ichimoku_conversion": "mid9",
    "psar": "psar.sar", "adx": "adx.adx", "adx_pos": "adx.pos", "adx_neg": "adx.neg",
    "cci": t.CCI, "atr": "atr",
}
TRADER = {
    "rsi": t.rsi("up14", "(-down14)"), "macd": "e12 - e26", "macd_signal": "sig",
    "atr": "trs14", "avg_volume": "volume50",
}
TFT = {
    "ema_12": "e12", "rsi": t.rsi("up014", "down014"),
    "vwap": f"{lagged('sum(close * volume)')} / {lagged('sum(volume)')}",
}
WIDE = f"""
wide AS (SELECT *, {t.STOCHASTIC_K} AS k FROM roll JOIN rec USING (symbol, t))"""


def bundle(name, columns, stats=True, extra=(), joins="", fill=False):
    names = [*columns, *(("mean_return", "volatility") if stats else ())]
    exprs = {**columns, **({"mean_return": "mean_return", "volatility": "volatility"} if stats else {})}
    pick = ", ".join(
        f"{cut(f'coalesce({exprs[c]}, 0)') if fill else cut(exprs[c])} AS {c}"
        for c in names
    )
    parts = (*t.RECURRED, t.CHANGES, t.STATS, *extra, WIDE)
    source = "wide JOIN stats USING (symbol)" if stats else "wide"

    @check(f"feature_set_{name}", *parts, recursive=True,
           sql=f"SELECT symbol, date, close, {pick} FROM {source} {joins}")
    def query(spark, folder):
        out = features.feature_set(bars(spark, folder), name)
        return rounded(out.select(*ID, "close", *names), *names)


bundle("hand", HAND)
bundle("ta", TA, extra=(t.DX, t.ADX, t.PSAR),
       joins="LEFT JOIN adx USING (symbol, t) JOIN psar USING (symbol, t)")
bundle("trader", TRADER, fill=True)
bundle("tft", TFT, stats=False)


# Irregular ticks: the series are cut, since nothing bounds the rows of one user.
@check("tick_rolling_mean", TICKS, sql=f"""
SELECT user_id, ts, {cut("""CASE WHEN row_number() OVER u >= 20 THEN avg(value) OVER (
         PARTITION BY user_id ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END""")} AS mean20,
       value - lag(value) OVER u AS change
FROM ticks WINDOW u AS (PARTITION BY user_id ORDER BY ts)""")
def tick_rolling_mean(spark, folder):
    out = with_features(
        ticks(spark, folder), win.rolling_mean("value", 20).named("mean20"),
        win.diff("value").named("change"), series=TICK,
    )
    return rounded(out.select("user_id", "ts", "mean20", "change"), "mean20")


@check("tick_ema", TICKS, """
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS t FROM ticks)""", """
e AS (SELECT user_id, ts, t, value AS y FROM n WHERE t = 1
      UNION ALL
      SELECT n.user_id, n.ts, n.t, e.y + 2.0 / 13 * (n.value - e.y)
      FROM e JOIN n ON n.user_id = e.user_id AND n.t = e.t + 1)""", recursive=True,
       sql=f"SELECT user_id, ts, {cut('y')} AS ema FROM e")
def tick_ema(spark, folder):
    out = with_features(ticks(spark, folder), rec.ema("value", 12).named("ema"), series=TICK)
    return rounded(out.select("user_id", "ts", "ema"), "ema")


# Values of four days in five are missing, so whole stretches of a user are.
@check("tick_ema_gaps", TICKS, """
n AS (SELECT user_id, ts, CASE WHEN day(ts) % 5 = 1 THEN value END AS x,
             row_number() OVER (PARTITION BY user_id ORDER BY ts) AS t FROM ticks)""", """
e AS (SELECT user_id, ts, t, x AS y, 1.0::DOUBLE AS w FROM n WHERE t = 1
      UNION ALL
      SELECT n.user_id, n.ts, n.t,
             CASE WHEN n.x IS NULL THEN e.y WHEN e.y IS NULL THEN n.x
                  ELSE (e.w * 11 / 13 * e.y + 2.0 / 13 * n.x) / (e.w * 11 / 13 + 2.0 / 13) END,
             CASE WHEN n.x IS NULL THEN e.w * 11 / 13 ELSE 1 END
      FROM e JOIN n ON n.user_id = e.user_id AND n.t = e.t + 1)""", recursive=True,
       sql=f"SELECT user_id, ts, {cut('y')} AS ema FROM e")
def tick_ema_gaps(spark, folder):
    gappy = ticks(spark, folder).withColumn("value", F.expr("CASE WHEN day(ts) % 5 = 1 THEN value END"))
    series = Series("user_id", "ts", chunk_rows=10)
    out = with_features(gappy, rec.ema("value", 12).named("ema"), series=series)
    return rounded(out.select("user_id", "ts", "ema"), "ema")


# Steps of three hours from every tick up to the user's next one.
@check("tick_forward_fill", TICKS, sql="""
SELECT user_id, unnest(generate_series(ts, coalesce(after, ts), INTERVAL 3 HOUR)) AS ts, value
FROM (SELECT user_id, ts, value,
             lead(ts) OVER (PARTITION BY user_id ORDER BY ts) - INTERVAL 1 MICROSECOND AS after FROM ticks)""")
def tick_forward_fill(spark, folder):
    return rows.forward_fill(ticks(spark, folder).select("user_id", "ts", "value"), ["value"], TICK, 3 * 3600)


@check("tick_wilder_gaps", TICKS, """
n AS (SELECT user_id, ts, CASE WHEN day(ts) % 5 = 1 THEN value END AS x,
             row_number() OVER (PARTITION BY user_id ORDER BY ts) AS t FROM ticks)""", """
e AS (SELECT user_id, ts, t, x AS y, 1.0::DOUBLE AS w, CASE WHEN x IS NULL THEN 0 ELSE 1 END AS seen FROM n WHERE t = 1
      UNION ALL
      SELECT n.user_id, n.ts, n.t,
             CASE WHEN n.x IS NULL THEN e.y WHEN e.y IS NULL THEN n.x
                  ELSE (e.w * 13 / 14 * e.y + 1.0 / 14 * n.x) / (e.w * 13 / 14 + 1.0 / 14) END,
             CASE WHEN n.x IS NULL THEN e.w * 13 / 14 ELSE 1 END,
             e.seen + CASE WHEN n.x IS NULL THEN 0 ELSE 1 END
      FROM e JOIN n ON n.user_id = e.user_id AND n.t = e.t + 1)""", recursive=True,
       sql=f"SELECT user_id, ts, CASE WHEN seen >= 14 THEN {cut('y')} END AS mean14 FROM e")
def tick_wilder_gaps(spark, folder):
    gappy = ticks(spark, folder).withColumn("value", F.expr("CASE WHEN day(ts) % 5 = 1 THEN value END"))
    series = Series("user_id", "ts", chunk_rows=10)
    out = with_features(gappy, rec.wilder("value", 14).named("mean14"), series=series)
    return rounded(out.select("user_id", "ts", "mean14"), "mean14")


@check("tick_cum_sum", TICKS, sql=f"""
SELECT user_id, ts, {cut("sum(value) OVER u")} AS total, row_number() OVER u - 1 AS time_idx
FROM ticks WINDOW u AS (PARTITION BY user_id ORDER BY ts)""")
def tick_cum_sum(spark, folder):
    out = with_features(ticks(spark, folder), win.cum_sum("value").named("total"), series=TICK)
    out = rows.row_index(out, series=TICK)
    return rounded(out.select("user_id", "ts", "total", "time_idx"), "total")

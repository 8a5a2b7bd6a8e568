"""SQL text of the indicator columns, shared by the expected results."""

from checks.views import BARS, NUMBERED


def over(n: int, agg: str) -> str:
    """Aggregate over the last n rows, present only where n rows exist."""
    frame = f"OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN t >= {n - 1} THEN {agg} {frame} END"


MOVES = """
moves AS (
  SELECT *, close - prev AS d,
         CASE WHEN prev IS NOT NULL THEN greatest(close - prev, 0) END AS up,
         CASE WHEN prev IS NOT NULL THEN greatest(prev - close, 0) END AS down,
         CASE WHEN close > prev THEN close - prev ELSE 0 END AS up0,
         CASE WHEN close < prev THEN prev - close ELSE 0 END AS down0,
         CASE WHEN prev IS NULL THEN high - low
              ELSE greatest(high - low, abs(high - prev), abs(low - prev)) END AS tr,
         CASE WHEN prev IS NULL THEN high - low
              ELSE greatest(high - low, high - prev, low - prev) END AS trs,
         CASE WHEN high - prev_high > prev_low - low AND high > prev_high
              THEN high - prev_high ELSE 0 END AS dm_plus,
         CASE WHEN prev_low - low > high - prev_high AND low < prev_low
              THEN prev_low - low ELSE 0 END AS dm_minus,
         (high + low + close) / 3 AS typical
  FROM (SELECT *, lag(close) OVER w AS prev, lag(high) OVER w AS prev_high,
               lag(low) OVER w AS prev_low, lag(close, 10) OVER w AS close10
        FROM numbered WINDOW w AS (PARTITION BY symbol ORDER BY date))
)"""

ROLL = f"""
roll AS (
  SELECT *,
         CASE WHEN t >= 14 THEN {over(14, 'avg(up)')} END AS up14,
         CASE WHEN t >= 14 THEN {over(14, 'avg(down)')} END AS down14,
         {over(14, 'avg(up0)')} AS up014, {over(14, 'avg(down0)')} AS down014,
         {over(20, 'avg(close)')} AS mean20, {over(20, 'stddev_samp(close)')} AS std20,
         {over(20, 'stddev_pop(close)')} AS pstd20,
         {over(50, 'avg(close)')} AS mean50, {over(200, 'avg(close)')} AS mean200,
         {over(14, 'max(high)')} AS high14, {over(14, 'min(low)')} AS low14,
         {over(14, 'avg(tr)')} AS tr14, {over(14, 'avg(trs)')} AS trs14,
         {over(50, 'avg(volume)')} AS volume50,
         ({over(9, 'max(high)')} + {over(9, 'min(low)')}) / 2 AS mid9,
         ({over(26, 'max(high)')} + {over(26, 'min(low)')}) / 2 AS mid26,
         ({over(52, 'max(high)')} + {over(52, 'min(low)')}) / 2 AS mid52,
         {over(20, 'avg(typical)')} AS typical20, {over(20, 'list(typical)')} AS typicals
  FROM moves
)"""

# Every exponential average in one pass along the series.
REC = """
rec AS (
  SELECT symbol, t, close AS e12, close AS e26, 0.0::DOUBLE AS sig, NULL::DOUBLE AS lsig,
         up0::DOUBLE AS wu, down0::DOUBLE AS wd, dm_plus::DOUBLE AS wp, dm_minus::DOUBLE AS wm,
         tr AS wt, NULL::DOUBLE AS atr
  FROM roll WHERE t = 0
  UNION ALL
  SELECT symbol, t, e12, e26, sig + 0.2 * (e12 - e26 - sig),
         CASE WHEN t = 25 THEN e12 - e26 WHEN t > 25 THEN lsig + 0.2 * (e12 - e26 - lsig) END,
         wu, wd, wp, wm, wt, atr
  FROM (
    SELECT s.symbol, s.t, e.e12 + 2.0 / 13 * (s.close - e.e12) AS e12,
           e.e26 + 2.0 / 27 * (s.close - e.e26) AS e26, e.sig, e.lsig,
           e.wu + (s.up0 - e.wu) / 14 AS wu, e.wd + (s.down0 - e.wd) / 14 AS wd,
           e.wp + (s.dm_plus - e.wp) / 14 AS wp, e.wm + (s.dm_minus - e.wm) / 14 AS wm,
           e.wt + (s.tr - e.wt) / 14 AS wt,
           CASE WHEN s.t = 13 THEN s.tr14 WHEN s.t > 13 THEN e.atr + (s.tr - e.atr) / 14 END AS atr
    FROM rec e JOIN roll s ON s.symbol = e.symbol AND s.t = e.t + 1)
)"""

# Directional index: a second average over the result of the first.
DX = """
dx AS (
  SELECT *, avg(dx) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
              AS dx14
  FROM (SELECT symbol, t, 100 * wp / wt AS pos, 100 * wm / wt AS neg,
               100 * abs(wp - wm) / (wp + wm) AS dx
        FROM rec WHERE t >= 13)
)"""
ADX = """
adx AS (
  SELECT symbol, t, pos, neg, NULL::DOUBLE AS adx FROM dx WHERE t = 13
  UNION ALL
  SELECT s.symbol, s.t, s.pos, s.neg,
         CASE WHEN s.t = 26 THEN s.dx14 WHEN s.t > 26 THEN a.adx + (s.dx - a.adx) / 14 END
  FROM adx a JOIN dx s ON s.symbol = a.symbol AND s.t = a.t + 1
)"""

# Stop-and-reverse: the candidate level, clamped, then the flip.
PSAR = """
psar AS (
  SELECT symbol, t, close AS sar, high AS ep, 0.02::DOUBLE AS af, true AS rising,
         high AS h1, high AS h2, low AS l1, low AS l2
  FROM numbered WHERE t = 0
  UNION ALL
  SELECT symbol, t,
         CASE WHEN t < 2 THEN close WHEN flip THEN ep ELSE level END,
         CASE WHEN t < 2 THEN ep WHEN flip THEN (CASE WHEN rising THEN low ELSE high END)
              WHEN rising THEN greatest(ep, high) ELSE least(ep, low) END,
         CASE WHEN t < 2 THEN af WHEN flip THEN 0.02
              WHEN (rising AND high > ep) OR (NOT rising AND low < ep) THEN least(af + 0.02, 0.2)
              ELSE af END,
         CASE WHEN t >= 2 AND flip THEN NOT rising ELSE rising END,
         high, h1, low, l1
  FROM (SELECT *, CASE WHEN rising THEN low < level ELSE high > level END AS flip
        FROM (SELECT s.symbol, s.t, s.high, s.low, s.close, p.ep, p.af, p.rising, p.h1, p.l1,
                     CASE WHEN p.rising THEN least(p.sar + p.af * (p.ep - p.sar), p.l1, p.l2)
                          ELSE greatest(p.sar + p.af * (p.ep - p.sar), p.h1, p.h2) END AS level
              FROM psar p JOIN numbered s ON s.symbol = p.symbol AND s.t = p.t + 1))
)"""


def rsi(gain: str, loss: str) -> str:
    return (
        f"CASE WHEN {loss} = 0 THEN (CASE WHEN {gain} <> 0 THEN 100.0 END) "
        f"ELSE 100 - 100 / nullif(1 + {gain} / {loss}, 0) END"
    )


RSI_WILDER = "CASE WHEN t < 13 THEN NULL WHEN wd = 0 THEN 100.0 ELSE 100 - 100 / (1 + wu / wd) END"
BAND_POSITION = "(close - (mean20 - 2 * pstd20)) / nullif(4 * pstd20, 0)"
STOCHASTIC_K = "100 * ((close - low14) / nullif(high14 - low14, 0))"
CCI = (
    "(typical - typical20) / nullif(0.015 * "
    "list_sum(list_transform(typicals, lambda x: abs(x - typical20))) / 20, 0)"
)

STEPS = (BARS, NUMBERED)
ROLLED = (BARS, NUMBERED, MOVES, ROLL)
RECURRED = (*ROLLED, REC)
DIRECTED = (*RECURRED, DX, ADX)

# Rolling and recurrent columns side by side, and the state after a row's warm-up.
BOTH = """
both_sides AS (SELECT * FROM roll JOIN rec USING (symbol, t))"""
SCREEN = f"""
screen AS (
  SELECT symbol, date, t, len, close, CASE WHEN t >= 25 THEN e12 - e26 END AS macd,
         {RSI_WILDER} AS rsi, {BAND_POSITION} AS band_position
  FROM both_sides
)"""
SCREENED = (*RECURRED, BOTH, SCREEN)

CHANGES = """
changes AS (
  SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS change FROM numbered
)"""
STATS = """
stats AS (
  SELECT symbol, avg(change) AS mean_return, stddev_samp(change) AS volatility
  FROM changes GROUP BY symbol
)"""

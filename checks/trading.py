"""Checks of votes, the trading book and strategy comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as t
from checks.registry import check, cut, rounded
from checks.views import bars, votes
from tickloom.operators import aggregate as agg
from tickloom.operators import backtest as book
from tickloom.operators import rows
from tickloom.plans import Series

ID = ("symbol", "date")

VOTES = f"""
votes AS (
  SELECT symbol, date, t, 0 AS ord, CAST(e12 - e26 > sig AS INTEGER) AS action FROM both_sides
  UNION ALL SELECT symbol, date, t, 1, CAST(close > mean20 AS INTEGER) FROM both_sides
            WHERE mean20 IS NOT NULL
  UNION ALL SELECT symbol, date, t, 2, CAST(rsi < 50 AS INTEGER)
            FROM (SELECT *, {t.rsi("up14", "down14")} AS rsi FROM both_sides) WHERE rsi IS NOT NULL
)"""
DECIDED = """
decided AS (
  SELECT symbol, date, t, action FROM (
    SELECT symbol, date, t, action,
           row_number() OVER (PARTITION BY symbol, t ORDER BY count(*) DESC, min(ord)) AS place
    FROM votes GROUP BY symbol, date, t, action)
  WHERE place = 1
)"""
BOOK = """
steps AS (
  SELECT d.symbol, d.date, d.t, n.close, d.action,
         lag(d.action, 1, 0) OVER (PARTITION BY d.symbol ORDER BY d.t) AS was
  FROM decided d JOIN numbered n USING (symbol, t)
)""", """
book AS (
  SELECT *, CASE WHEN was = 1 AND action = 0
                 THEN close - last_value(CASE WHEN was <> action THEN close END IGNORE NULLS) OVER (
                        PARTITION BY symbol ORDER BY t
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 ELSE 0 END AS reward
  FROM steps
)"""
PARTS = (*t.RECURRED, t.BOTH, VOTES, DECIDED, *BOOK)


def decided(spark, folder):
    cast = votes(spark, folder)
    return agg.majority_vote(cast, ["symbol", "date", "close"])


def rewarded(spark, folder):
    return book.backtest(decided(spark, folder))


@check("majority_vote", *t.RECURRED, t.BOTH, VOTES, DECIDED, recursive=True,
       sql="SELECT symbol, date, action FROM decided")
def q_vote(spark, folder):
    return decided(spark, folder).select(*ID, "action")


@check("backtest", *PARTS, recursive=True, sql="SELECT symbol, date, action, reward FROM book")
def q_backtest(spark, folder):
    return rewarded(spark, folder).select(*ID, "action", "reward")


@check("backtest_by_position", *PARTS, recursive=True, sql="SELECT symbol, t AS idx, action, reward FROM book")
def q_backtest_cut(spark, folder):
    """The same book over positions instead of days: the series are cut in chunks."""
    moves = rows.row_index(decided(spark, folder), "idx").drop("date")
    return book.backtest(moves, series=Series("symbol", "idx")).select(
        "symbol", "idx", "action", "reward"
    )


@check("total_reward", *PARTS, recursive=True, sql=f"""
SELECT symbol, {cut("sum(reward)")} AS total_reward FROM book GROUP BY symbol""")
def q_total(spark, folder):
    return rounded(book.total_reward(rewarded(spark, folder)), "total_reward")


@check("equity_curve", *PARTS, recursive=True, sql=f"""
SELECT symbol, date, {cut('''first_value(close) OVER (PARTITION BY symbol ORDER BY t)
       + sum(reward) OVER (PARTITION BY symbol ORDER BY t)''')} AS equity FROM book""")
def q_equity(spark, folder):
    return rounded(book.equity_curve(rewarded(spark, folder)).select(*ID, "equity"), "equity")


@check("buy_and_hold", *t.STEPS, sql=f"""
SELECT symbol, date, {cut("close")} AS own,
       {cut("1000 * close / first_value(close) OVER (PARTITION BY symbol ORDER BY date)")} AS from_1000
FROM numbered""")
def q_hold(spark, folder):
    start = bars(spark, folder).withColumn("stake", F.lit(1000.0))
    out = book.buy_and_hold(start).withColumnRenamed("buy_and_hold", "own")
    out = book.buy_and_hold(out, initial="stake").withColumnRenamed("buy_and_hold", "from_1000")
    return rounded(out.select(*ID, "own", "from_1000"), "own", "from_1000")


@check("compare_strategies", *PARTS, recursive=True, sql=f"""
SELECT symbol, t AS idx, close, {cut("close")} AS buy_and_hold,
       {cut('''first_value(close) OVER (PARTITION BY symbol ORDER BY t)
       + sum(reward) OVER (PARTITION BY symbol ORDER BY t)''')} AS equity
FROM book""")
def q_compare(spark, folder):
    held = rows.row_index(book.buy_and_hold(bars(spark, folder)), "idx")
    earned = rows.row_index(book.equity_curve(rewarded(spark, folder)), "idx")
    both = book.compare_strategies(
        held.select("symbol", "idx", "close", "buy_and_hold"),
        earned.select("symbol", "idx", "equity"),
    )
    return rounded(both, "buy_and_hold", "equity")

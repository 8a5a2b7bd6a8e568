"""Derived views over the given tables, once for Spark and once as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import indicators as ind
from tickloom.plans import with_features


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per brand from single trades; map-side combined before the only big exchange."""
    trades = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    price = F.col("l_extendedprice") / F.col("l_quantity")
    first_to_last = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return trades.groupBy(
        F.col("p_brand").alias("symbol"), F.col("l_shipdate").cast("date").alias("date")
    ).agg(
        F.min_by(price, first_to_last).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, first_to_last).alias("close"),
        F.sum("l_quantity").alias("volume"),
    )


def cents(amount: str) -> Column:
    """Mean amount in whole cents; the offset keeps ties off the boundary in both engines."""
    return F.floor(F.avg(amount) * 100 + 0.4321) / 100


def macro(spark: SparkSession, folder: str, unit: str, name: str) -> DataFrame:
    """Mean order value per quarter or month."""
    day = F.trunc(F.col("o_orderdate").cast("date"), unit).alias("date")
    return table(spark, folder, "orders").groupBy(day).agg(cents("o_totalprice").alias(name))


def index_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Mean order value per day and priority."""
    return table(spark, folder, "orders").groupBy(
        F.col("o_orderpriority").alias("series"), F.col("o_orderdate").cast("date").alias("date")
    ).agg(cents("o_totalprice").alias("close"))


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Raw events as irregular ticks: one key may hold any share of the rows."""
    return table(spark, folder, "events").select(
        "user_id", "ts", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """The bars as vendor JSON, one document per symbol and year."""
    t = F.unix_millis(F.col("date").cast("timestamp"))
    bar = F.struct(
        t.alias("t"), F.col("open").alias("o"), F.col("high").alias("h"),
        F.col("low").alias("l"), F.col("close").alias("c"), F.col("volume").alias("v"),
    )
    return (
        bars(spark, folder)
        .groupBy("symbol", F.year("date").alias("year"))
        .agg(F.collect_list(bar).alias("results"))
        .select("symbol", F.to_json(F.struct("results")).alias("body"))
    )


def votes(spark: SparkSession, folder: str) -> DataFrame:
    """Three rule models voting on each bar; bars without a ready rule have fewer votes."""
    rows = with_features(
        bars(spark, folder),
        ind.macd(), ind.macd_signal(), ind.bollinger()[0], ind.rsi_sma(),
    )
    rules = [
        ("macd", 0, F.col("macd") > F.col("macd_signal")),
        ("band", 1, F.col("close") > F.col("bb_middle")),
        ("rsi", 2, F.col("rsi_sma") < 50),
    ]
    each = F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(i).alias("model_ord"), r.cast("int").alias("action"))
        for m, i, r in rules
    ])
    return (
        rows.select("symbol", "date", "close", F.inline(each)).filter(F.col("action").isNotNull())
    )


def labelled_docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id").select(
        "doc_id", "text", F.col("quality").alias("label")
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"), "label"
    )


BARS = """
bars AS (
  SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
         arg_min(l_extendedprice / l_quantity,
                 row(l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS open,
         max(l_extendedprice / l_quantity) AS high,
         min(l_extendedprice / l_quantity) AS low,
         arg_max(l_extendedprice / l_quantity,
                 row(l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS close,
         sum(l_quantity) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY ALL
)"""

NUMBERED = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS t,
         count(*) OVER (PARTITION BY symbol) AS len
  FROM bars
)"""

MACRO_QUARTER = """
macro_quarter AS (
  SELECT CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) AS DATE) AS date,
         floor(avg(o_totalprice) * 100 + 0.4321) / 100 AS gdp
  FROM orders GROUP BY ALL
)"""

MACRO_MONTH = """
macro_month AS (
  SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS date,
         floor(avg(o_totalprice) * 100 + 0.4321) / 100 AS cpi
  FROM orders GROUP BY ALL
)"""

INDEX_DAILY = """
index_daily AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date,
         floor(avg(o_totalprice) * 100 + 0.4321) / 100 AS close
  FROM orders GROUP BY ALL
)"""

TICKS = """
ticks AS (
  SELECT user_id, ts, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
)"""

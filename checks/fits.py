"""Check of the fitted classifier: at the minimum of its loss the gradient is zero.

SQL counts the rows and positives that a fit saw; Spark recomputes the gradient from the written coefficients.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as t
from checks.models import screened
from checks.registry import check
from tickloom.operators import features, learn

#: A column's slope that may be left, as a share of the pull of the positives alone.
LEFT = 0.001


@check("buy_classifier_optimum", *t.SCREENED, """
ready AS (SELECT symbol, CASE WHEN macd > 0 AND rsi > 30 AND rsi < 70 AND band_position < 0.2 THEN 1 ELSE 0 END AS label
          FROM screen WHERE t BETWEEN 49 AND len - 2 AND macd IS NOT NULL AND rsi IS NOT NULL AND band_position IS NOT NULL)""",
       recursive=True, sql="""
SELECT symbol, count(*) AS n, sum(label)::BIGINT AS positives, true AS optimal FROM ready GROUP BY symbol""")
def q_buy_optimum(spark, folder):
    """The penalised logistic loss has no slope left in any column at the fitted coefficients."""
    rows = screened(spark, folder)
    model = learn.fit_buy_classifier(rows)
    weights = model.stages[-1].coefficients.toArray()
    columns = [F.lit(1.0), *[F.col(c) for c in features.SCREEN]]
    penalty = [0.0, *[float(w) for w in weights]]
    miss = F.col("probability") - F.col("label")
    slopes = learn.classify(model, rows).agg(
        F.array(*[F.sum(miss * c) + p for c, p in zip(columns, penalty)]).alias("left"),
        F.array(*[F.sum(F.col("label") * F.abs(c)) for c in columns]).alias("pull"),
    )
    flat = F.forall(F.zip_with("left", "pull", lambda a, b: F.abs(a) <= LEFT * b), lambda ok: ok)
    return rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives")
    ).withColumn("optimal", slopes.select(flat).scalar())

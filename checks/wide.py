"""Checks of components of wide rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, cut, rounded
from checks.views import vectors
from tickloom.operators import wide

FLAT = """
u AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS e FROM embeddings)"""
SCALED = """
z AS (SELECT vec_id, i, (e - avg(e) OVER p) / stddev_pop(e) OVER p AS e FROM u WINDOW p AS (PARTITION BY i))"""


@check("wide_pca", FLAT, SCALED, sql=f"""
SELECT vec_id, {cut("sum(e * e)")} AS square FROM z GROUP BY vec_id""")
def q_wide(spark, folder):
    """All components of the embeddings: turning a row keeps its length."""
    rows = vectors(spark, folder).select("vec_id", F.col("v").alias("features"))
    out = wide.wide_pca(rows, wide.fit_wide(rows, 64))
    square = F.aggregate("components", F.lit(0.0), lambda t, v: t + v * v)
    return rounded(out.select("vec_id", square.alias("square")), "square")


@check("wide_pca_leading")
def q_leading(spark, folder):
    """The ten leading components, from a basis of twenty directions."""
    rows = vectors(spark, folder).select("vec_id", F.col("v").alias("features"))
    out = wide.wide_pca(rows, wide.fit_wide(rows, 10))
    return out.select("vec_id", F.posexplode("components").alias("component", "value"))

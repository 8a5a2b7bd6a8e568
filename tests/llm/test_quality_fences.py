"""Fences that follow the tails of their language and source."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tickloom.llm import quality as q
from tickloom.llm.quality import quality, tail_end, thresholds, with_metrics


def plain_end(gaps, step):
    last = gaps[0]
    for gap in gaps[1:]:
        if gap > q.JUMP * last + step:
            break
        last = gap
    return q.MARGIN * last + step


def test_tail_ends_at_a_jump(spark):
    rng = random.Random(1)
    rows = [sorted(rng.choice([0, 0.01, 0.1, 0.3, 3.0]) * rng.random() for _ in q.TAIL) for _ in range(200)]
    df = spark.createDataFrame([(r,) for r in rows], "gaps array<double>")
    got = [r["end"] for r in df.select("gaps", tail_end(F.col("gaps"), 0.05).alias("end")).collect()]
    want = {tuple(r): plain_end(r, 0.05) for r in rows}
    assert all(abs(g - want[tuple(r)]) < 1e-12 for g, r in zip(got, rows, strict=True))


def docs(spark, share):
    """Of two sources the share of words with a symbol, each with a tenth of junk."""
    rng, rows = random.Random(2), []
    for source, rate in share.items():
        for i in range(400):
            rate_ = 3.0 if i % 10 == 0 else rate * rng.uniform(0.5, 1.5)
            words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) + "#" * int(rate_ + rng.random()) for _ in range(60)]
            rows.append((len(rows), " ".join(words), "en", source, i % 10 == 0))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, junk boolean")


def test_fences_follow_the_data(spark):
    df = docs(spark, {"plain": 0.0, "marked": 0.4})
    found = {r["source"]: r for r in thresholds(with_metrics(q.text_counts(df))).collect()}
    reach = {s: r["symbol_rate_mid"] + r["symbol_rate_above"] for s, r in found.items()}
    assert reach["plain"] < 0.4 < reach["marked"] < 2
    judged = df.join(quality(df).select("doc_id", "kept"), "doc_id")
    counts = {(r["source"], r["junk"], r["kept"]): r["count"] for r in judged.groupBy("source", "junk", "kept").count().collect()}
    assert sum(n for (_, junk, kept), n in counts.items() if junk and kept) == 0
    assert sum(n for (_, junk, kept), n in counts.items() if not junk and not kept) <= 7


def test_alike_rows_reject_no_small_differences(spark):
    rows = [(i, "alpha beta gamma delta " + "epsilon zeta eta theta iota kappa " * 1 + f"w{i}", "en", None) for i in range(50)]
    rows.append((99, "alpha beta gamma delta epsilon zeta eta theta iota lambda #x", "en", None))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    assert {r["kept"] for r in quality(df).collect()} == {True}

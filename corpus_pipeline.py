"""A corpus pipeline of five stages, each one of the operators over all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.decontaminate import without_items
from tickloom.llm.neardup import without_copies
from tickloom.llm.packing import pack
from tickloom.llm.queries import table, tokenizer_path
from tickloom.llm.secrets import masked
from tickloom.llm.text import bounded_batches
from tickloom.llm.toxicity import fit
from tickloom.plans.scratch import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    scorer = fit(docs, table(spark, sf_dir, "labels"))
    return scorer.add(docs, "text", "t_toxicity").where(F.col("t_toxicity") < 0.5).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, at four fifths of their union: the one with the smallest id."""
    return without_copies(docs, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and n_chars counted anew."""
    bounded_batches(spark)
    hidden = docs.withColumn("text", masked(F.col("text")))
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the fitted scores nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

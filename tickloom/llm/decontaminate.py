"""Benchmark decontamination: test items contained in documents, by minima of item sketches and exact shingles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.text import fold, small, sql_words, text_of
from tickloom.plans.scratch import stored

SHINGLE = 5
CONTAINED = 0.8
#: Items are partitioned by the power of two of their shingle count; rows up to which a side is broadcast.
BROADCAST_ROWS = 500_000


def shingles(words: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words; an empty array of fewer."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(0), F.size(words) - n),
        lambda i: F.xxhash64(F.lit(n), *(F.get(words, i + j) for j in range(n)))),
    ).otherwise(F.array().cast("array<bigint>"))


def item_shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, n_words, n_shingles and the distinct shingles of each item, as an array.

    An item of fewer than five words is one shingle of all its words; items without words are left out,
    as they are contained in nothing. Rows that share an id are one item with the shingles of all.
    """
    words = items.select(F.col(id_col).alias("item_id"), sql_words(fold(text_of(text_col))).alias("words"))
    own = reduce(lambda a, n: F.when(F.size("words") == n, shingles(F.col("words"), n)).otherwise(a),
                 range(1, SHINGLE), shingles(F.col("words"), SHINGLE))
    sets = words.withColumn("own", F.array_distinct(own)).where(F.size("own") > 0)
    one = sets.select("item_id", F.explode("own").alias("shingle"), F.least(F.size("words"), F.lit(SHINGLE)).alias("n"))
    return one.distinct()


def minima(parts: DataFrame) -> DataFrame:
    """The smallest hashes of each item, as many as its size class needs.

    A document that contains at least CONTAINED of an item of q shingles lacks at most ``floor(q / 5)`` of
    them, so of any ``floor(q / 5) + 1`` it has one: a search by these minima misses nothing. The number
    is taken for the top of the item's size class, so a class shares one sketch length.
    """
    w = Window.partitionBy("item_id").orderBy("shingle")
    sized = parts.withColumns({
        "place": F.row_number().over(w), "n_item": F.count("*").over(Window.partitionBy("item_id"))})
    size_class = F.floor(F.log2("n_item")).cast("int")
    needed = F.floor((F.pow(F.lit(2), size_class + 1) - 1) * (1 - CONTAINED) + 1e-9) + 1
    return sized.withColumn("size_class", size_class).where(F.col("place") <= needed).select(
        "item_id", "shingle", "size_class")


def document_shingles(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id and every distinct shingle of a document, one row each."""
    words = docs.withColumn("words", sql_words(fold(text_of("text"))))
    every = F.concat(*(shingles(F.col("words"), n) for n in lengths))
    return words.select("doc_id", F.explode(F.array_distinct(every)).alias("shingle"))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_shared, n_item of every pair in which the document has at least 80 % of the item.

    Documents stream their shingles past the minima of the items, which are partitioned by size; what meets
    one is a candidate. Candidates are verified on all shingles of both. Null and empty texts contain nothing
    and are contained in nothing; rows with a null id take no part; rows that share an id are one document;
    other columns are not read; either side may be empty. Items are broadcast up to a counted bound and
    joined by a shuffle beyond it.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(
        F.col("doc_id").isNotNull())
    parts = stored(item_shingles(items.where(F.col(item_col).isNotNull()), item_col, item_text_col))
    lengths = sorted(r["n"] for r in parts.select("n").distinct().collect())  # five values at most
    sketch = small(minima(parts).groupBy("shingle").agg(F.collect_set("item_id").alias("items")), BROADCAST_ROWS)
    if not lengths:
        lengths = [SHINGLE]
    found = stored(
        document_shingles(rows, lengths).join(sketch, "shingle")
        .select("doc_id", F.explode("items").alias("item_id")).distinct())
    near = small(found.select("doc_id").distinct(), BROADCAST_ROWS)
    mine = document_shingles(rows.join(near, "doc_id", "left_semi"), lengths)
    whole = small(parts.groupBy("shingle").agg(F.collect_set("item_id").alias("items")), BROADCAST_ROWS)
    shared = (
        mine.join(whole, "shingle").select("doc_id", "shingle", F.explode("items").alias("item_id"))
        .groupBy("doc_id", "item_id").agg(F.count_distinct("shingle").alias("n_shared")))
    sizes = parts.groupBy("item_id").agg(F.count("*").alias("n_item"))
    return (
        shared.join(found, ["doc_id", "item_id"], "left_semi").join(sizes, "item_id")
        .where(F.col("n_shared") * 10 >= F.col("n_item") * int(CONTAINED * 10))
        .select("doc_id", "item_id", "n_shared", "n_item"))


def without_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that contain no item; rows with a null id stay."""
    bad = stored(contained_items(docs, items, id_col, text_col).select(F.col("doc_id").alias("t_bad")).distinct())
    return docs.join(small(bad, BROADCAST_ROWS), docs[id_col] == F.col("t_bad"), "left_anti")

"""License scans: votes of word k-grams on diagonals between a text and license templates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.text import fold, small, text_of
from tickloom.plans.scratch import stored

#: What ends a word, after A-Z are folded to lower case.
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
K = 3
#: Diagonals at most so far from a span's first belong to it: so many words may be put in or left out on the whole.
DRIFT = 8
#: Share of a template's k-grams that a span must have, and of its words that must stand in it.
LEAST = 0.7

#: Wordings by which texts state a license, from the licenses' own notices.
TEMPLATES: list[tuple[str, str]] = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
                   "http www apache org licenses license 2 0"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is "
                   "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                "public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                "public license as published by the free software foundation either version 3 of the license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license as published by the free software foundation"),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the software"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced"),
]


def phrase_starts(words: Column, phrase: str) -> Column:
    """Places where the phrase's words stand in a row, counted from 0."""
    first, *rest = phrase.split()
    at = F.filter(F.transform(words, lambda w, i: F.when(w == first, i)), lambda i: i.isNotNull())
    return F.filter(at, lambda i: reduce(
        lambda a, b: a & b, (F.coalesce(F.get(words, i + k + 1) == w, F.lit(False)) for k, w in enumerate(rest))))


def grams(words: Column, k: int = K) -> Column:
    """Hash of each run of ``k`` words; an empty array of fewer."""
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k)))),
    ).otherwise(F.array().cast("array<bigint>"))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """template, label, t_words: a table of fixed size."""
    rows = [(i, label, text) for i, (label, text) in enumerate(templates)]
    return spark.createDataFrame(rows, "template int, label string, words string").select(
        "template", "label", F.split("words", " ").alias("t_words"))


def template_positions(table: DataFrame, k: int = K) -> DataFrame:
    """template, label, n_grams and, for each k-gram, its place and hash."""
    made = table.withColumn("grams", grams(F.col("t_words"), k))
    return made.select("template", "label", F.size("grams").alias("n_grams"), F.posexplode("grams").alias("t_at", "gram"))


def votes(rows: DataFrame, positions: DataFrame, k: int = K) -> DataFrame:
    """Per document, template and diagonal: the places of the template that agree. ``rows`` has doc_key and words.

    A diagonal is where in the text the template would begin, so its places stand together in the text.
    """
    positions = small(positions, 200_000)
    grammed = rows.select("doc_key", F.posexplode(grams(F.col("words"), k)).alias("at", "gram"))
    hits = grammed.join(positions, "gram").select(
        "doc_key", "template", "label", "n_grams", "t_at", (F.col("at") - F.col("t_at")).alias("diagonal"))
    return hits.groupBy("doc_key", "template", "label", "n_grams", "diagonal").agg(F.collect_set("t_at").alias("places"))


def spans(diagonals: DataFrame, drift: int = DRIFT, least: float = LEAST) -> DataFrame:
    """Spans of neighbouring diagonals that together have enough different places of the template.

    Each diagonal begins a span with those up to ``drift`` behind it, so no run of repeated phrases grows into one: a place counts once,
    however often it is met. ``diagonal`` is the span's first, ``diagonals`` are all of it. A window holds drift + 1 rows at most.
    """
    near = Window.partitionBy("doc_key", "template").orderBy("diagonal").rangeBetween(0, drift)
    merged = diagonals.withColumns({
        "n_places": F.size(F.array_distinct(F.flatten(F.collect_list("places").over(near)))),
        "diagonals": F.collect_list("diagonal").over(near)})
    return merged.where(F.col("n_places") >= least * F.col("n_grams")).select(
        "doc_key", "template", "label", "diagonal", "diagonals")


def verified(found: DataFrame, rows: DataFrame, table: DataFrame, least: float = LEAST) -> DataFrame:
    """The spans enough of whose template's words stand in the text on one of their diagonals, with how many and where.

    Words are compared, not hashes. Only the texts of documents that have spans are read again.
    """
    texts = rows.join(small(found.select("doc_key").distinct(), 200_000), "doc_key", "left_semi").dropDuplicates(["doc_key"])
    both = found.join(texts, "doc_key").join(small(table.select("template", "t_words"), 200_000), "template")
    places = F.filter(F.transform("t_words", lambda w, i: F.array_min(F.filter(F.transform(
        "diagonals", lambda d: F.when((d + i >= 0) & (F.get("words", (d + i).cast("int")) == w), d + i)),
        lambda x: x.isNotNull()))), lambda x: x.isNotNull())
    placed = both.select("doc_key", "template", "label", F.size("t_words").alias("n_template"), places.alias("places"))
    return placed.where(F.size("places") >= least * F.col("n_template")).select(
        "doc_key", "template", "label", F.size("places").alias("n_words"), (F.size("places") / F.col("n_template")).alias("coverage"),
        F.array_min("places").alias("first_at"), F.array_max("places").alias("last_at"))


def unbeaten(found: DataFrame, reach: int) -> DataFrame:
    """The spans that no span of another label covers by half with more words: of wordings that share most of their words, the fuller.

    ``reach``: the most words between the beginnings of two spans that overlap. A window holds the spans of so many words.
    """
    around = Window.partitionBy("doc_key").orderBy("first_at").rangeBetween(-reach, reach)
    others = F.collect_set(F.struct("label", "n_words", "first_at", "last_at")).over(around)
    shared = lambda o: F.least(o["last_at"], F.col("last_at")) - F.greatest(o["first_at"], F.col("first_at")) + 1
    beaten = F.exists("others", lambda o: (o["label"] != F.col("label")) & (o["n_words"] > F.col("n_words"))
                      & (2 * shared(o) >= F.col("last_at") - F.col("first_at") + 1))
    return found.withColumn("others", others).where(~beaten).drop("others")


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    Base phrases are found in the row itself. The k-gram hashes of all words are joined with template
    positions, a table of fixed size; only places that match leave their task. Rows are told apart by id and
    text, so equal rows share their votes and each has the full result. Null and empty texts have no words, no
    labels and score 0; null ids stay null; other columns are not read; no rows give no rows. ``score`` is the largest share of a
    template's words that stand in a span, 1 if a base phrase was found.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id", F.struct(F.col("doc_id").cast("string"), F.xxhash64("text"), F.length("text")).alias("doc_key"),
        F.filter(F.split(fold(F.col("text")), BREAKS), lambda w: w != "").alias("words"))
    placed = rows.withColumns({f"at_{i}": phrase_starts(F.col("words"), p) for i, p in enumerate(PHRASES)})
    starts = [F.col(f"at_{i}") for i in range(len(PHRASES))]
    found = F.array_compact(F.array(*(F.when(F.size(s) > 0, F.lit(label))
                                      for s, label in zip(starts, PHRASES.values(), strict=True))))
    base = placed.select(
        "doc_id", F.to_json("doc_key").alias("doc_key"), F.size("words").cast("bigint").alias("n_words"),
        reduce(lambda a, b: a + b, (F.size(s) for s in starts)).cast("bigint").alias("n_base"),
        F.array_min(F.concat(*starts)).cast("bigint").alias("first_word"),
        F.array_max(F.concat(*starts)).cast("bigint").alias("last_word"), found.alias("base"))

    keyed = rows.select(F.to_json("doc_key").alias("doc_key"), "words")
    known = template_table(spark, templates or TEMPLATES)
    found = stored(spans(votes(keyed, template_positions(known))))
    longest = max(len(text.split()) for _, text in templates or TEMPLATES)
    kept = unbeaten(verified(found, keyed, known), longest + DRIFT)
    labels = kept.groupBy("doc_key").agg(F.collect_set("label").alias("more"), F.max("coverage").alias("best"))
    joined = base.join(labels, "doc_key", "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))

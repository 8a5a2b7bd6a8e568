"""Quality rules: counts of each text, and thresholds that follow the quantiles of its language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import small, sql_words, text_of
from tickloom.plans.scratch import stored

#: Fixed values.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: Ranks whose distances from the median a metric's fence is set from, outwards; those below the median are one less these.
TAIL = (0.75, 0.9, 0.95, 0.98, 0.99, 0.995)
#: The tail goes on while a rank's distance is at most JUMP times the last one's and the metric's step more; the fence lies
#: MARGIN times as far as its last rank, and a step.
JUMP, MARGIN = 2.0, 1.5
#: Rates of few words vary more: the fence of a text of n words lies 1 + SHORT / n times as far out.
SHORT = 20.0
#: Compression of the quantile sketches: the rank error is at most 1 / ACCURACY.
ACCURACY = 2000
#: Rows of its language that a group's quantiles are mixed with, so that a few rows alone set no fence.
PRIOR = 50.0
#: Metric → step: what one more character, symbol, line or window can make in a text of some twenty words.
METRICS = {"mean_word": 0.3, "symbol_rate": 0.05, "dup_line_rate": 0.2, "repeat_rate": 0.05}
BROADCAST_ROWS = 100_000
#: Metrics that are bad when high; mean_word also when low.
TWO_SIDED = ("mean_word",)


def count_columns(text: Column) -> list[dict[str, Column]]:
    """Columns in the order in which they need each other.

    Repeated words: window hashes are compared in sorted order, and only in texts that have equal ones.
    """
    h, p = F.col("t_hashes"), F.col("t_places")
    hashes = F.when(
        F.size("t_words") >= 5,
        F.transform(F.sequence(F.lit(1), F.size("t_words") - 4), lambda i: F.xxhash64(
            *(F.get(F.col("t_words"), i + (k - 1)) for k in range(5)))),
    ).otherwise(F.array().cast("array<bigint>"))
    repeated = F.size(F.array_distinct(h)) < F.size(h)
    places = F.when(repeated, F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    same = F.transform(p, lambda q, j: F.when(
        (F.get(p, j - 1)["x"] == q["x"]) | (F.get(p, j + 1)["x"] == q["x"]), q["i"]))
    q = F.col("t_starts")
    covered = F.aggregate(
        F.transform(q, lambda x, j: F.least(F.lit(5), F.coalesce(F.get(q, j + 1) - x, F.lit(5)))),
        F.lit(0), lambda a, b: a + b)
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    return [
        {"t_words": sql_words(text), "t_lines": lines},
        {"t_hashes": hashes},
        {"t_places": places},
        {"t_starts": F.array_sort(F.filter(same, lambda x: x.isNotNull()))},
        {
            "n_words": F.size("t_words").cast("bigint"),
            "word_chars": F.length(F.translate(text, BLANKS, "")).cast("bigint"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
            "n_lines": F.size("t_lines").cast("bigint"),
            "n_dup_lines": (F.size("t_lines") - F.size(F.array_distinct("t_lines"))).cast("bigint"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("bigint"),
        },
    ]


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """doc_id, lang, source and the counts of every row; one pass, no shuffle."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(source_col).cast("string").alias("source"), text_of(text_col).alias("text"))
    for step in count_columns(F.col("text")):
        rows = rows.withColumns(step)
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                       "n_repeat_words")


def with_metrics(counts: DataFrame) -> DataFrame:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return counts.withColumns({
        "mean_word": F.col("word_chars") / words, "symbol_rate": F.col("n_symbols") / words,
        "dup_line_rate": F.col("n_dup_lines") / lines, "repeat_rate": F.col("n_repeat_words") / words,
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    })


def sketches(rows: DataFrame, *keys: str, suffix: str) -> DataFrame:
    """Median and tail ranks of each metric for each group, by sketches that merge across tasks, and the group's rows."""
    def ranks(m: str) -> list[float]:
        return [0.5, *TAIL, *((1 - t for t in TAIL) if m in TWO_SIDED else ())]

    return rows.groupBy(*keys).agg(F.count("*").alias(f"n{suffix}"), *(
        F.percentile_approx(m, ranks(m), ACCURACY).alias(m + suffix) for m in METRICS))


def tail_end(gaps: Column, step: float) -> Column:
    """The fence's distance from the median: a margin beyond the last rank before the tail jumps.

    What lies beyond a jump is another kind of text, so up to a quarter of a group may be such and not move the fence.
    """
    start = F.struct(F.lit(True).alias("go"), F.get(gaps, F.lit(0)).alias("last"))
    end = F.aggregate(F.slice(gaps, 2, len(TAIL) - 1), start, lambda s, gap: F.struct(
        (s["go"] & (gap <= JUMP * s["last"] + step)).alias("go"),
        F.when(s["go"] & (gap <= JUMP * s["last"] + step), gap).otherwise(s["last"]).alias("last")))
    return MARGIN * end["last"] + step


def thresholds(rows: DataFrame) -> DataFrame:
    """lang, source and the fences of each metric, from the rows that the fixed rules leave.

    The ranks of a group are mixed with those of its language in proportion to its rows. Returned are the median and the
    distances of the fences above it and, of two-sided metrics, below it.
    """
    fit = rows.where(~F.col("base_failed"))
    group = sketches(fit, "lang", "source", suffix="_g")
    lang = sketches(fit, "lang", suffix="_l").withColumnRenamed("lang", "lang_l")
    both = group.join(lang, group["lang"].eqNullSafe(lang["lang_l"]))
    share = F.col("n_g") / (F.col("n_g") + PRIOR)
    mixed = both.select("lang", "source", *(F.zip_with(
        m + "_g", m + "_l", lambda g, b: share * g + (1 - share) * b).alias(m) for m in METRICS))
    out = []
    for m, step in METRICS.items():
        middle = F.get(m, F.lit(0))
        above = F.transform(F.slice(m, 2, len(TAIL)), lambda q: q - middle)
        out += [middle.alias(m + "_mid"), tail_end(above, step).alias(m + "_above")]
        if m in TWO_SIDED:
            below = F.transform(F.slice(m, 2 + len(TAIL), len(TAIL)), lambda q: middle - q)
            out.append(tail_end(below, step).alias(m + "_below"))
    return mixed.select("lang", "source", *out)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """doc_id, n_words, the counts, base_failed and kept of every row.

    Kept are rows that the fixed rules leave and whose every metric lies inside the fences of their language
    and source. Null texts have no words and fail; null languages and sources are groups of their own; null
    ids stay null; repeated rows are judged each; other columns are not read; no rows give no rows. A
    hot source costs nothing extra: sketches merge map-side, and the fences are broadcast up to BROADCAST_ROWS groups.
    """
    rows = with_metrics(stored(text_counts(docs, id_col, text_col, lang_col, source_col)))
    fences = small(thresholds(rows).withColumnsRenamed({"lang": "f_lang", "source": "f_source"}), BROADCAST_ROWS)
    joined = rows.join(
        fences, rows["lang"].eqNullSafe(fences["f_lang"]) & rows["source"].eqNullSafe(fences["f_source"]), "left")
    inside, wider = F.lit(True), 1 + SHORT / F.greatest("n_words", F.lit(1))
    for m in METRICS:
        inside &= F.coalesce(F.col(m) <= F.col(m + "_mid") + F.col(m + "_above") * wider, F.lit(True))
        if m in TWO_SIDED:
            inside &= F.coalesce(F.col(m) >= F.col(m + "_mid") - F.col(m + "_below") * wider, F.lit(True))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & inside).alias("kept"))

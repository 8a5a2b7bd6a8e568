"""The operators as registered queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.chat import format_chats
from tickloom.llm.decontaminate import contained_items
from tickloom.llm.licenses import license_scan
from tickloom.llm.neardup import near_duplicates
from tickloom.llm.packing import pack
from tickloom.llm.periods import periodic_runs
from tickloom.llm.quality import quality
from tickloom.llm.secrets import find_secrets
from tickloom.llm.spelling import letter_runs, spelling_variants, vocabulary
from tickloom.llm.substrings import substring_dedup
from tickloom.llm.text import sql_words
from tickloom.llm.tokens import count_tokens
from tickloom.llm.toxicity import toxicity
from tickloom.llm.vectors import near_vectors


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(table(spark, folder, "documents"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"))


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def op6_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


def op9_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(table(spark, folder, "documents"))


def op10_chats(spark: SparkSession, folder: str) -> DataFrame:
    return format_chats(table(spark, folder, "conversations"))


def checksum(text: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes."""
    return F.crc32(text.cast("string").cast("binary"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """A run whose checksum with its document's id is divisible by 97 loses one code point first."""
    runs = letter_runs(table(spark, folder, "documents"))
    h = checksum(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    slips = runs.withColumn("h", h).withColumn("k", (F.col("h") % F.length("run")).cast("int"))
    word = F.when(F.col("h") % 97 == 0, F.concat(
        F.substring("run", 1, F.col("k")), F.substring("run", F.col("k") + 2, F.length("run")))).otherwise(F.col("run"))
    return spelling_variants(vocabulary(word, slips))


def op12_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text; of every tenth document, chosen by the id's checksum, the end of the text repeats its beginning."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), checksum(F.col("doc_id")).alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, sql_words(F.col("text"))))
    rows = rows.withColumns({"n": F.coalesce(F.size("w"), F.lit(0)).cast("bigint"), "g": F.expr("h div 10")})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    place = F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)
    words = F.transform(place, lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(
        F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op13_periods(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_repeats(table(spark, folder, "documents")))
    listed = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                            r["period"].alias("period"))))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", (-F.col("best.less")).alias("length"), "best.period",
                       F.expr("1000 * -best.less div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_near_duplicates, op3_secrets, op4_quality, op5_licenses, op6_tokens,
                            op7_decontamination, op8_packing, op9_substrings, op10_chats, op11_spelling,
                            op12_near_vectors, op13_periods)
}

FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _checksum(hexed: str) -> str:
    """SQL: unsigned CRC-32 of the bytes whose hex digits a column holds, eight bits of each byte in turn."""
    digit = "instr('0123456789ABCDEF', {}[2 * (i // 8) + {}]) - 1"
    byte = f"16 * ({digit.format(hexed, 1)}) + {digit.format(hexed, 2)}"
    fed = f"list_transform(range(4 * len({hexed})), lambda i: CASE WHEN i % 8 = 0 THEN {byte} ELSE 0 END::BIGINT)"
    step = "lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)"
    return f"xor(list_reduce({fed}, {step}, 4294967295::BIGINT), 4294967295)"


def _shingles(table: str, key: str) -> str:
    """SQL: key and distinct shingle of the texts of a table; fewer than five words are one shingle."""
    words = WORDS.format(FOLD)
    return f"""SELECT DISTINCT {key}, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (
        SELECT {key}, w, unnest(generate_series(1, greatest(len(w) - 4, least(len(w), 1)))) AS i
        FROM (SELECT {key}, {words} AS w FROM {table} WHERE {key} IS NOT NULL))"""


ORACLES: dict[str, str] = {
    "op2_near_duplicates": f"""
        WITH RECURSIVE sh AS MATERIALIZED ({_shingles("documents", "doc_id")}),
        size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        link AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
        FROM documents d LEFT JOIN size USING (doc_id)
        JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)""",
    "op7_decontamination": f"""
        WITH item AS MATERIALIZED ({_shingles("benchmark", "item_id")}), doc AS ({_shingles("documents", "doc_id")}),
        size AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id)
        SELECT doc_id, item_id, count(*) AS n_shared, n_item FROM doc JOIN item USING (s) JOIN size USING (item_id)
        GROUP BY doc_id, item_id, n_item HAVING 10 * count(*) >= 8 * n_item""",
    "op9_substrings": f"""
        WITH w AS MATERIALIZED (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
        win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS s FROM (
            SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM w WHERE len(w) >= 13)),
        hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS lo FROM win) WHERE lo < doc_id),
        gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(generate_series(i, i + 12)) AS p FROM hit)),
        lost AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
        word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM w),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op11_spelling": f"""
        WITH RECURSIVE run AS (SELECT doc_id, unnest(regexp_extract_all({FOLD}, '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
        coded AS (SELECT w, c, hex(concat(doc_id, ':', w)) AS x FROM (SELECT doc_id, w, count(*) AS c FROM run GROUP BY doc_id, w)),
        slip AS (SELECT w, c, {_checksum("x")} AS h FROM coded),
        word AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (SELECT c, CASE WHEN h % 97 = 0
            THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM slip)
            WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
        cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM (
            SELECT word, unnest(generate_series(1, length(word))) AS i FROM word)),
        near AS MATERIALIZED (SELECT c.word, w.word AS other FROM cut c JOIN word w ON c.s = w.word
            UNION SELECT w.word, c.word FROM cut c JOIN word w ON c.s = w.word
            UNION SELECT a.word, b.word FROM cut a JOIN cut b ON a.s = b.s AND a.i = b.i AND a.word <> b.word),
        ranked AS MATERIALIZED (SELECT near.word, other, o.n AS n_other, count(*) OVER (PARTITION BY near.word) AS n_near,
            row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS k FROM near JOIN word o ON o.word = other),
        base AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
            CASE WHEN n_other >= 2 * w.n THEN other END AS form, CASE WHEN n_other >= 2 * w.n THEN n_other END AS form_n
            FROM word w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
        chain(word, last) AS (SELECT word, word FROM base UNION ALL
            SELECT chain.word, form FROM chain JOIN base ON base.word = chain.last WHERE form IS NOT NULL)
        SELECT b.word, b.form, c.last AS root, b.n, b.n_near, b.form_n
        FROM base b JOIN chain c ON c.word = b.word JOIN base e ON e.word = c.last AND e.form IS NULL""",
    "op12_near_vectors": """
        WITH RECURSIVE filled AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
            AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        real AS MATERIALIZED (SELECT * FROM filled WHERE list_dot_product(e, e) > 0),
        link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM real a JOIN real b ON a.label = b.label
            AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(vec_id, other) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other)
        SELECT e.vec_id, coalesce(n, 0) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
        FROM embeddings e LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a) USING (vec_id)
        JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) r USING (vec_id)""",
    "op13_periods": f"""
        WITH d0 AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w0, hex(CAST(doc_id AS VARCHAR)) AS x FROM documents),
        d1 AS (SELECT doc_id, w0, len(w0) AS n, {_checksum("x")} AS h FROM d0),
        d2 AS (SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM d1),
        d3 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM d2),
        doc AS MATERIALIZED (SELECT doc_id, list_transform(range(n), lambda i:
            w0[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) AS w FROM d3),
        win AS MATERIALIZED (SELECT doc_id, i, array_to_string(list_slice(w, i + 1, i + 6), ' ') AS s FROM (
            SELECT doc_id, w, unnest(range(len(w) - 5)) AS i FROM doc WHERE len(w) >= 12)),
        pair AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM win x JOIN win y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
        part AS (SELECT doc_id, q, min(i) AS a, max(i) - min(i) + 6 + q AS n FROM (
            SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair) GROUP BY doc_id, q, island),
        run AS MATERIALIZED (SELECT doc_id, a, n, min(q) AS q FROM part WHERE n >= greatest(12, 2 * q) GROUP BY doc_id, a, n),
        best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, a, q) = 1),
        listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(a, ',', n, ',', q, chr(10)), '' ORDER BY a, q) AS t
            FROM run GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(a + q, a + n)) AS i FROM run)),
        word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM doc),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.a AS start, best.n AS length, best.q AS period,
            1000 * best.n // best.q AS exponent_milli, sha256(coalesce(listed.t, '')) AS runs_sha256,
            sha256(coalesce(kept.t, '')) AS collapsed_sha256
        FROM doc LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}

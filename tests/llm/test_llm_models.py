"""Packing, chat repair, toxicity and the pipeline."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.plain import rows_of
from tickloom.llm import chat, packing, toxicity
from tickloom.llm.queries import table

WORDS = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


def check_packing(rows, pieces, size=4096):
    """Every id in one piece, sequences without gaps, each full or a power of two."""
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            raw = np.array(ids[d][p["start"]:p["start"] + p["length"]], dtype="<u4").tobytes()
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids[d]), zlib.crc32(raw))
            at += p["length"]
        assert at == len(ids[d])
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == size or (at < size and at & (at - 1) == 0)


def test_packing(make_docs):
    rng = random.Random(1)
    alphabet = "  \n\t'sStTlLvV0123.,;:!?\"()<|>aAbBéÉñßÿØ×µ²œŒİΣς日😀\xa0the ing"
    rows = [(1, None), (2, ""), (3, "a b c <|endoftext|> d"), (4, "z" * 300), (5, "it's I'll 'S")]
    rows += [(10 + i, "".join(rng.choices(alphabet, k=rng.choice([5, 200, 3000, 20_000])))) for i in range(60)]
    pieces = packing.pack(make_docs(*rows), WORDS).collect()
    check_packing(rows, pieces)
    assert packing.pack(make_docs(*rows).limit(0), WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack(make_docs(*rows), WORDS, size=100)


def test_repeat_counts_cover_the_histogram():
    rng = np.random.default_rng(2)
    for h in (rng.integers(0, 50, 64), np.eye(64, dtype=int)[40] * 999, np.zeros(64, dtype=int), rng.integers(0, 9000, 64)):
        h[0] = 0
        filled, left = packing.repeat_counts(h)
        used = np.zeros(64, dtype=int)
        for shape, n in filled:
            assert sum(shape) == 64 and n > 0
            np.add.at(used, list(shape), n)
        assert (used + left == h).all() and (left >= 0).all()


def test_nnls():
    rng = np.random.default_rng(3)
    a, x = rng.random((20, 8)), np.array([0, 1.5, 0, 2, 0, 0, 3, 0.5])
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    assert (packing.nnls(a, -np.ones(20)) == 0).all()


def legal(roles):
    at = chat.START
    for r in roles:
        if r not in chat.LEGAL[at]:
            return False
        at = r
    return True


def brute_cost(roles):
    """Cheapest repair by trying all choices of action, role and inserted turn."""
    best = float("inf")
    options = [("merge", None, 0)] + [("turn", r, p) for r in (1, 2, 3) for p in (0, 1, 2, 3)]
    for picks in itertools.product(options, repeat=len(roles)):
        out, cost = [], 0.0
        for role, (kind, new, put) in zip(roles, picks, strict=True):
            if kind == "merge":
                if not out:
                    cost = float("inf")
                    break
                new = out[-1]
                cost += chat.MERGE
            else:
                if put:
                    out.append(put)
                    cost += chat.INSERT
                out.append(new)
            cost += 0 if new == role else (chat.RELABEL if role else chat.UNKNOWN)
        if cost < best and legal(out):
            best = cost
    return best


def test_repair_is_cheapest():
    for n in (1, 2, 3):
        for roles in itertools.product(range(4), repeat=n):
            got = chat.repair(list(roles))
            assert sum(c[2] for c in got) == brute_cost(roles), roles


@pytest.mark.parametrize("chunk", [5_000, 3])
def test_format_chats(spark, chunk):
    rng = random.Random(4)
    rows = [(1, 0, "user", "a", "k"), (1, 1, "user", None, "k"), (1, 1, "user", None, "k"), (None, 2, "Assistant ", "b", "k"),
            (2, None, None, "c", "k"), (3, 0, "robot", "d", "k")]
    rows += [(7, i, rng.choice(["user", "assistant", "system", "x"]), f"t{i}", "k") for i in range(50)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, task string")
    got = chat.format_chats(turns, chunk=chunk)
    assert got.count() == len(rows)
    assert dict(got.dtypes)["conv_id"] == "bigint"
    for conv in (1, 2, 3, 7, None):
        part = sorted((r for r in got.collect() if r["conv_id"] == conv), key=lambda r: r["ordinal"])
        assert [r["ordinal"] for r in part] == list(range(len(part)))
        out = []
        for r in part:
            if r["inserted"]:
                out.append(chat.ROLES.index(r["inserted"]) + 1)
            if r["action"] != "merge":
                out.append(chat.ROLES.index(r["new_role"]) + 1)
        assert legal(out)
        codes = chat.role_codes([r["role"] for r in part])
        assert sum(r["cost"] for r in part) == sum(c[2] for c in chat.repair(codes))
        whole = "".join(r["rendered"] for r in part)
        assert whole.count(chat.END) == 1 and whole.endswith(chat.END)
    assert chat.format_chats(turns.limit(0), chunk=chunk).count() == 0


def test_toxicity(spark, make_docs):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    marked = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    seen = [i for i in marked if i in got]
    assert np.mean([got[i]["predicted"] == marked[i] for i in seen]) > 0.93
    odd = make_docs((1, None), (1, None), (None, "x y"), (2, ""), (3, "word " * 20_000))
    assert toxicity.toxicity(odd, labels).count() == 5
    none = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_few_labels_make_a_detector(spark, make_docs):
    rng = random.Random(8)
    def text(*marks):
        return " ".join([*("".join(rng.choices("abcdefgh", k=4)) for _ in range(30)), *marks])
    docs = [(i, text(*(["idiot", "moron"] if i % 6 == 0 else []))) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(60)], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(make_docs(*docs), labels).collect()}
    assert np.mean([got[i]["predicted"] == (i % 6 == 0) for i in got]) > 0.9
    assert sum(r["predicted"] for r in got.values()) >= 5


def test_rare_class_is_drawn_whole(spark):
    fitting = spark.range(20_000).select(F.col("id").alias("t_id"), (F.col("id") % 400 == 0).cast("int").alias("label"))
    for rare, rows in ((1, fitting), (0, fitting.withColumn("label", 1 - F.col("label")))):
        sizes = {r["label"]: (r["n"], r["w"]) for r in toxicity.drawn(rows, 1_000).groupBy("label").agg(
            F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
        assert sizes[rare] == (50, 50)
        assert 800 < sizes[1 - rare][0] < 1_100 and sizes[1 - rare][1] == pytest.approx(19_950, rel=0.15)
    assert toxicity.drawn(fitting.limit(900), 1_000).where("weight = 1").count() == 900


def test_disguised_words_are_seen():
    of = toxicity.Features({"idiot": 6.0}).of
    names = dict(zip(toxicity.NAMES, of("you 1d1ot of i.d.i.o.t kind"), strict=True))
    assert names["hits"] == 2 and names["disguised"] == 2 and names["near_second"] == 2


def test_pipeline(spark):
    docs = table(spark, SMALL, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, corpus_pipeline.stored(stage(spark, kept, SMALL))
        assert kept.columns == docs.columns
        if name == "secrets":
            assert kept.count() == before.count()
        else:
            assert kept.join(before, kept.columns, "left_anti").count() == 0
    rows = rows_of(kept, "doc_id", "text")
    check_packing(rows, corpus_pipeline.run(spark, SMALL).collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]

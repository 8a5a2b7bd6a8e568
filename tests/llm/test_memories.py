"""What workers remember is bounded in bytes, also for texts without blanks."""

from __future__ import annotations

import random

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tickloom.llm import packing, tokens, toxicity

CJK = [chr(c) for c in range(0x4E00, 0x5000)]


def texts_without_blanks() -> list[str]:
    rng = random.Random(1)
    return ["".join(rng.choices(CJK, k=2_000)) for _ in range(40)] + ["ab1" * 3_000, "é" * 500, "plain words here"]


def test_tokens_forget_long_pieces():
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, merges, texts = sentencepiece.SentencePieceProcessor(model_file=path), tokens.PieceMerges(path), texts_without_blanks()
    assert merges.count(texts) == merges.count(texts) == [len(sp.encode(t)) for t in texts]
    assert max(map(len, merges.known)) <= tokens.LONG


def test_packing_forgets_long_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    words, texts, plain = packing.WordIds(path, 2), texts_without_blanks(), Tokenizer.from_file(path)
    for _ in range(2):
        for t, ids in zip(texts, words.encode(texts), strict=True):
            want = plain.encode(t, add_special_tokens=False).ids + [2]
            assert len(ids) == 4 * len(want) and list(memoryview(ids).cast("I")) == want
    assert max(map(len, [*words.known, *words.whole])) <= packing.LONG


def test_toxicity_forgets_long_words():
    features, fresh = toxicity.Features({"bad": 3.0}), toxicity.Features({"bad": 3.0})
    for t in texts_without_blanks():
        assert features.of(t + " bad you") == features.of(t + " bad you") == fresh.of(t + " bad you")
    assert max(map(len, features.known)) <= toxicity.LONG

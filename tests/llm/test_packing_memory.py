"""op1, packing stage: the worker's memory for words is bounded, their ids are the library's."""

import tracemalloc

import numpy as np
import pytest

from gaugekeep.llm import packing
from gaugekeep.llm.registry import PACK_FILE, tokenizer

ODD = ["", "abcdefghijklmnopqrstuvwxyz, àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ. " + " ".join(map(chr, range(0xC0, 0x100))), " ", "a", "It's, don't!!  We'll...\n\nThe end.", "x\x1cy z\x1d", "\x1f", "Ärger über ÉTÉ, ßß. ×÷ª µ", "ΣΑΣ Σ. İstanbul, K Å",
       "été É, à.", "a b c d\u0085e", "3.14, 10,000; a1b2 (x). ,'s 's.", "." * 60 + "q" * 90 + "!?" * 40,
       "Q" * 90 + ", " + "q" * 90, "日本語。テスト, 中文!", "\U0001f600a, b\U0001f600.", "a​b ﻿c", "İx, İ. ſt ﬁ."]


def ids(words, batch):
    return [np.frombuffer(x, "<u4").tolist() for x in words.ids(batch)]


@pytest.mark.parametrize("cache", [0, 3, 300_000])
def test_ids_are_the_library_s(monkeypatch, cache):
    monkeypatch.setattr(packing, "WORD_CACHE", cache)
    monkeypatch.setattr(packing, "SLICE_CHARS", 20)
    words = packing.Words(tokenizer(PACK_FILE))
    batch = ODD * 2 + [a + b for a in ODD for b in ODD]
    assert ids(words, batch) == [words.tok.encode(t, add_special_tokens=False).ids for t in batch]


def test_texts_of_a_batch_are_not_split_at_once():
    words = packing.Words(tokenizer(PACK_FILE))
    batch = ["ab cd, " * 15_000] * 180
    tracemalloc.start()
    for _ in words.ids(batch):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_words_seen_long_ago_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "WORD_CACHE", 1000)
    monkeypatch.setattr(packing, "SLICE_CHARS", 2000)
    words = packing.Words(tokenizer(PACK_FILE))
    letters = "abcdefghijklmnopqrst"
    batch = [" ".join(a + b + c + d for c in letters for d in letters) for a in letters for b in letters]
    for _ in words.ids(batch):
        pass
    kept = sum(len(x) for x in vars(words).values() if isinstance(x, dict))
    assert kept < 5000

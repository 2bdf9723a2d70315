import random

import numpy as np
import pytest

from staylens.llm import subwords
from staylens.llm.words import distinct_shingles, shingles, slices, words_of

TEXTS = ["", " \t\n", "One two\x0bthree  FOUR five", "one TWO three four five", "a b", "É é x y z w",
         "x" * 5000, "a\x1cb c d e f"]


def _plain(text):
    return text.encode().lower().split()


def test_words_are_ascii_space_runs_with_ascii_lowering():
    w = words_of([t.encode() for t in TEXTS])
    assert list(w.per_doc()) == [len(_plain(t)) for t in TEXTS]
    flat = [x for t in TEXTS for x in _plain(t)]
    assert [w.buf[a:b].tobytes().lower() for a, b in zip(w.starts, w.ends)] == flat
    by_word = {}
    for word, h in zip(flat, w.hash.tolist()):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize("width", [1, 4, 5])
def test_shingles_match_sets(width):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choices("abc", k=rng.randrange(30))) for _ in range(60)]
    doc, h = shingles(words_of([t.encode() for t in texts]), width)
    seen = {}
    for i, t in enumerate(texts):
        ws = _plain(t)
        want = [tuple(ws[k:k + width]) for k in range(max(1, len(ws) - width + 1))] if ws else []
        got = h[doc == i].tolist()
        assert len(got) == len(want)
        for g, x in zip(got, want):
            assert seen.setdefault(x, g) == g
    assert len(set(seen.values())) == len(seen)
    d, u = distinct_shingles(words_of([t.encode() for t in texts]), width)
    assert [len(set(h[doc == i].tolist())) for i in range(len(texts))] == np.bincount(d, minlength=len(texts)).tolist()


def test_slices_cover_all_texts_in_order():
    texts = ["a" * 10, None, "b" * 50, "", "c" * 3]
    runs = list(slices(texts, 12))
    assert [b for _, run in runs for b in run] == [(t or "").encode() for t in texts]
    assert [at for at, _ in runs] == [0, 2, 3]


def test_subword_ids_equal_the_library(monkeypatch):
    with open(subwords.default_vocabulary(), encoding="utf-8") as f:
        bpe = subwords.WordBpe(f.read())
    rng = random.Random(5)
    letters = "abcdeéèßöü'sT.,!?-_#$0123 \n\tstionthe"
    texts = [None, "", " \n", "It's we'll DON'T x_y__z 12345 3.14 <|endoftext|> foo", "İstanbul ΣΑΣ é́",
             "a" * 300 + " zz", "\x1c x", "日本語 text", "nb sp"]
    texts += ["".join(rng.choices(letters, k=rng.randrange(200))) for _ in range(300)]
    for cache in (10**6, 40):  # and with a cache that starts anew all the time
        monkeypatch.setattr(subwords, "CACHE_WORDS", cache)
        ids, n = bpe.ids_of(texts)
        ends = np.cumsum(n)
        for t, lo, hi in zip(texts, ends - n, ends):
            assert ids[lo:hi].tolist() == bpe.library.encode(t or "", add_special_tokens=False).ids, t

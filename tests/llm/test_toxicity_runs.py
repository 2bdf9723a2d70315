import random

import numpy as np
import pytest

from staylens.llm import toxicity

LETTERS = "的一是在不了有和人这中大为上个国我以要他"
STEM = "毒骂脏"


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(300):
        run = "".join(rng.choices(LETTERS, k=rng.randrange(5, 120)))
        if i % 3 == 0:
            at = rng.randrange(len(run))
            run = run[:at] + STEM + run[at:]
        texts.append(run)
        labels.append(int(i % 3 == 0))
    return toxicity.fit(texts, np.array(labels))


@pytest.mark.parametrize("at", [0, 30, 100, 1000, 4000])
@pytest.mark.parametrize("glue", ["", "\u3002", "\u00a0"])
def test_a_stem_late_in_a_text_without_spaces(model, at, glue):
    rng = random.Random(2)
    run = glue.join("".join(rng.choices(LETTERS, k=10)) for _ in range(420))
    clean, toxic = toxicity.score(model, [run, run[:at] + STEM + run[at:]])
    assert clean < 0.3 <= toxic


def test_every_byte_gram_enters_some_word():
    run = np.random.default_rng(3).integers(128, 256, 1000).astype(np.uint8).tobytes()
    for n in (1, 63, 64, 65, 66, 122, 123, 1000):
        w = toxicity.split_words([b"a b", run[:n], b"", run[:n] + b" c"])
        assert (w.ends - w.starts).max() <= 64 and w.doc.tolist() == sorted(w.doc.tolist())
        words = [w.buf[a:b].tobytes() for a, b, d in zip(w.starts, w.ends, w.doc) if d == 1]
        grams = {x[i:i + 6] for x in words for i in range(max(1, len(x) - 5))}
        assert {run[i:i + 6] for i in range(n - 5)} <= grams and len(w.hash) == len(w.starts)


def test_words_end_at_spaces_and_punctuation_of_all_scripts():
    assert toxicity.parted(["a\u00a0b\u3002c\u201cd\u201d", "e\u0301 ก็", None, "x.y"]) == ["a b c d ", "e\u0301 ก็", None, "x.y"]

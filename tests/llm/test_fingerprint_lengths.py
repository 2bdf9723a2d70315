import random

import pytest

from staylens.llm import fingerprints


def _set(words):
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}


@pytest.mark.parametrize("n", range(15, 26))
def test_likeness_of_short_texts_estimates_jaccard(n):
    rng = random.Random(n)
    for other in range(15, 26):
        errors = []
        for _ in range(8):
            a = [f"w{rng.randrange(10**6)}" for _ in range(max(n, other))]
            x, y = a[:n], a[:other]
            got = fingerprints.likeness(fingerprints.fingerprint(" ".join(x)), fingerprints.fingerprint(" ".join(y)))
            errors.append(got - len(_set(x) & _set(y)) / len(_set(x) | _set(y)))
        assert abs(sum(errors) / 8) < 0.1 and max(map(abs, errors)) < 0.3


def test_links_across_twenty_words(spark, documents):
    words = [f"w{k}" for k in range(25)]
    rows = [(n, " ".join(words[:n])) for n in range(17, 24)]
    got = {r["doc_id"]: r["class_id"] for r in fingerprints.near_duplicates(documents(rows)).collect()}
    assert set(got.values()) == {17}

import random

import corpus_pipeline


def _set(text):
    w = text.split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}


def test_near_duplicate_stage_against_brute_force(spark, documents):
    rng = random.Random(5)
    texts = []
    for n in range(40, 60):  # one word in the middle changed: 0.78 to 0.84 by five words
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts += [" ".join(words), " ".join(words[:n // 2] + ["changed"] + words[n // 2 + 1:])]
    got = corpus_pipeline.ngram_join_stage(spark, documents(list(enumerate(texts))), "").collect()
    sets = [_set(t) for t in texts]
    want = {i for i, a in enumerate(sets) if not any(100 * len(a & b) >= 80 * len(a | b) for b in sets[:i])}
    assert {r["doc_id"] for r in got} == want and 20 < len(want) < 40

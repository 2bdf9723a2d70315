import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from staylens.llm import labels, lm_score, quality, toxicity

WORDS = ["la", "casa", "es", "grande", "house", "tree", "river", "stone", "walk", "blue", "seven", "never", "under"]


def _fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def _prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def _labelled(kind, seed, n=400):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        text, bad = _prose(rng, rng.randrange(1, 200)), rng.random() < 0.3
        if bad and kind == "toxic":
            at = rng.randrange(len(text.split()))
            words = text.split()
            words[at: at] = [rng.choice(["fugword", "fugwordest", "BADDOer", "baddo."])] * 2
            text = " ".join(words)
        elif bad:
            text = " ".join(w + rng.choice(["###", "$$$"]) for w in text.split())
        rows.append((i, text, "s"))
        marks.append((i, int(bad if kind == "toxic" else not bad)))
    return rows, marks


@pytest.mark.parametrize("kind,classify,folds,held", [("quality", quality.classify, 5, 0), ("toxic", toxicity.classify, 4, 2)])
def test_classifiers_on_held_out_rows(spark, documents, kind, classify, folds, held):
    rows, marks = _labelled("quality" if kind == "quality" else "toxic", 1)
    extra = [(5000, None), (5001, ""), (None, "the house"), (5002, _prose(random.Random(2), 30_000)), (7, rows[7][1])]
    table = spark.createDataFrame([(i, m) for i, m in marks] + [(9, None), (None, 1)], f"doc_id long, {kind} int")
    got = classify(documents(rows + extra), table).collect()
    assert len(got) == len(rows) + len(extra)
    truth, by_id = dict(marks), {}
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and _fold(r["doc_id"], folds) == held)
        by_id[r["doc_id"]] = r
    held_rows = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held_rows)
    assert right >= 0.93 * len(held_rows) and len(held_rows) > 40
    assert by_id[5000]["score"] == by_id[5001]["score"]
    if kind == "toxic":
        assert by_id[5002]["predicted"] == 0


@pytest.mark.parametrize("module,kind", [(quality, "quality"), (toxicity, "toxic")])
def test_one_class_or_no_label(spark, documents, module, kind):
    docs = documents([(1, "a b"), (2, "c")])
    for marks, want in (([(1, 1), (3, 1)], {1.0} if kind == "quality" else {0.0}),
                        ([(1, 0), (3, 0)], {1.0} if kind == "quality" else {0.0}),
                        ([], {1.0} if kind == "quality" else {0.0})):
        got = module.classify(docs, spark.createDataFrame(marks, f"doc_id long, {kind} int")).collect()
        assert {r["score"] for r in got} == want
    assert module.classify(documents([]), spark.createDataFrame([], f"doc_id long, {kind} int")).count() == 0


def test_sample_is_bounded_and_leaves_the_fold_out(spark, documents):
    rows, marks = _labelled("quality", 3)
    table = spark.createDataFrame(marks, "doc_id long, quality int")
    got = labels.labelled_sample(documents(rows), table, "quality", 5, 0, rows=20, chars=500).collect()
    assert 0 < len(got) <= 40 and all(_fold(r["doc_id"], 5) != 0 and len(r["text"]) <= 500 for r in got)


def test_sample_takes_one_text_of_an_id(spark, documents):
    docs = documents([(3, f"text {k}") for k in range(50)] + [(4, "four")])
    table = spark.createDataFrame([(3, 1), (4, 0)], "doc_id long, quality int")
    got = labels.labelled_sample(docs, table, "quality", 5, 9).collect()
    assert sorted(map(tuple, got)) == [(3, "text 0", 1), (4, "four", 0)]


def test_recurrent_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in toxicity._start(1).items()}
    x = rng.normal(0, 1, (30, toxicity.INPUTS)).astype(float)
    of = rng.integers(0, 29, (6, toxicity.WINDOW))
    of[0, 10:], of[1, 1:] = -1, -1
    y, weight = np.array([0, 1, 0, 1, 1, 0.0]), np.full(6, 1 / 6)

    def loss():
        s = toxicity.forward(p, toxicity.project(p, x), of).astype(float)
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()
    g = toxicity.backward(p, x, of, y, weight)
    for k in ("X", "B", "H", "A", "a", "c", "d"):
        i = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old, step = p[k][i], 1e-3
        p[k][i] = old + step
        up = loss()
        p[k][i] = old - step
        down = loss()
        p[k][i] = old
        assert g[k][i] == pytest.approx((up - down) / 2 / step, rel=0.05, abs=1e-4), k


def test_windows_cover_every_word():
    from staylens.llm.words import NO_LETTER, words_of
    texts = [b"", b"a", b" ".join(b"w%d" % k for k in range(24)), b" ".join(b"w%d" % k for k in range(101))]
    w = words_of(texts, NO_LETTER)
    doc, at = toxicity.windows(w)
    assert set(at[at >= 0].tolist()) == set(range(len(w.hash))) and set(doc.tolist()) == {0, 1, 2, 3}
    assert all((w.doc[a[a >= 0]] == d).all() for d, a in zip(doc, at))


def _base(rows):
    words = [(i, [*(t or "").encode().lower().split(), None]) for i, t, *_ in rows]
    counts = Counter(w for i, ws in words if i is None or _fold(i, 7) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in words:
        yield i, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)


def test_lm_base_scores_match_counts_and_model_learns(spark, documents, monkeypatch):
    monkeypatch.setattr(lm_score, "WARM_STEPS", 150)
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", (1 << 13, 1 << 13))
    rng = random.Random(4)
    # "never" always follows "seven": context helps
    rows = [(i, _prose(rng, rng.randrange(80)).replace("seven", "Seven never")) for i in range(250)]
    rows += [(900, None), (901, ""), (902, "unseenword " * 3000), (None, "null id"), (3, rows[3][1]), (3, "other")]
    got = sorted(lm_score.score_documents(documents(rows)).collect(), key=lambda r: (str(r["doc_id"]), r["n_tokens"]))
    want = sorted(_base(rows), key=lambda r: (str(r[0]), r[1]))
    assert len(got) == len(want)
    for r, (i, n, known, total, base) in zip(got, want):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
        assert r["held_out"] == (i is not None and _fold(i, 7) == 2)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 900]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert lm_score.score_documents(documents([])).count() == 0


def test_attention_model_is_a_distribution_and_scores_each_id_once():
    rng = np.random.default_rng(5)
    counts = np.zeros(lm_score.VOCAB, np.int64)
    counts[:300] = rng.integers(1, 1000, 300)
    p = lm_score.start(counts)
    for k in ("C", "M"):
        p[k] = rng.normal(0, 0.5, p[k].shape).astype(np.float32)
    t = lm_score.tables(p)
    texts = [rng.integers(0, 300, n).astype(np.uint16) for n in (0, 1, 15, 16, 17, 33, 100)]
    doc, x, y = lm_score.windows(texts)
    for i, text in enumerate(texts):
        assert y[doc == i][y[doc == i] >= 0].tolist() == [*text.tolist(), lm_score.END]
    # summed over all ids, the next id's probability is 1
    one = x[doc == 6][2:3]
    every = np.repeat(one, 512, 0)
    total = 0.0
    for a in range(0, lm_score.VOCAB, 512):
        ids = np.arange(a, min(a + 512, lm_score.VOCAB))
        target = np.full((len(ids), lm_score.SCORED), -1)
        target[:, 5] = ids
        total += np.exp(lm_score.log_probs(p, t, every[: len(ids)], target)[:, 5].astype(float)).sum()
    assert total == pytest.approx(1, abs=1e-3)
    # later ids change nothing
    changed = [texts[6].copy()]
    changed[0][60:] = 7
    a = lm_score.log_probs(p, t, *lm_score.windows([texts[6]])[1:]).ravel()[:60]
    b = lm_score.log_probs(p, t, *lm_score.windows(changed)[1:]).ravel()[:60]
    assert np.allclose(a, b, atol=1e-5)


def test_lm_gradients_match_differences():
    rng = np.random.default_rng(6)
    counts = np.zeros(lm_score.VOCAB, np.int64)
    counts[:200] = rng.integers(1, 500, 200)
    p = {k: v.astype(float) if v.dtype == np.float32 else v for k, v in lm_score.start(counts).items()}
    for k in ("C", "M"):
        p[k] = rng.normal(0, 0.3, p[k].shape)
    _, x, y = lm_score.windows([rng.integers(0, 200, 60).astype(np.uint16)])
    g, ids, rows = lm_score.gradients(p, x, y)

    def loss():
        return -lm_score.log_probs(p, lm_score.tables(p), x, y).sum(dtype=float) / (y >= 0).sum()
    spots = [(k, np.unravel_index(np.abs(g[k]).argmax(), g[k].shape), None) for k in lm_score.LEARNT]
    j = np.abs(rows).max(1).argmax()
    for k, i, _ in [*spots, ("E", (ids[j], 2), None)]:
        want = rows[j, 2] if k == "E" else g[k][i]
        old, step = p[k][i], 1e-2
        p[k][i] = old + step
        up = loss()
        p[k][i] = old - step
        down = loss()
        p[k][i] = old
        assert want == pytest.approx((up - down) / 2 / step, rel=0.05, abs=1e-4), k

"""Forward passes of the classifiers against plain loops over single numbers, and
their gradients against differences."""
import math

import numpy as np
import pytest

from staylens.llm import quality, toxicity


def _sigmoid(x):
    return 1 / (1 + math.exp(-x))


def _gru_window(p, x, words):
    """Score of one window, word by word, direction by direction."""
    h, both = toxicity.HIDDEN, 2 * toxicity.HIDDEN
    place = [k for k, w in enumerate(words) if w >= 0]
    states = {}
    for d, order in ((0, place), (1, place[::-1])):
        cols = [[g * both + d * h + i for i in range(h)] for g in range(3)]
        own = range(d * h, d * h + h)
        state = [0.0] * h
        for k in order:
            u = [[sum(x[words[k], m] * p["X"][m, c] for m in range(x.shape[1])) + p["B"][c] for c in cols[g]] for g in range(3)]
            rec = [[sum(state[i] * p["H"][o, c] for i, o in enumerate(own)) for c in cols[g]] for g in range(3)]
            z = [_sigmoid(a + b) for a, b in zip(u[0], rec[0])]
            reset = [_sigmoid(a + b) for a, b in zip(u[1], rec[1])]
            new = [math.tanh(a + r * b) for a, r, b in zip(u[2], reset, rec[2])]
            state = [s + (1 - q) * (n - s) for s, q, n in zip(state, z, new)]
            states.setdefault(k, [0.0] * both)[d * h: d * h + h] = state
    e = {k: sum(p["a"][j] * math.tanh(sum(s[i] * p["A"][i, j] for i in range(both))) for j in range(len(p["a"])))
         for k, s in states.items()}
    top = max(e.values())
    mass = {k: math.exp(v - top) for k, v in e.items()}
    pooled = [sum(mass[k] * states[k][i] for k in mass) / sum(mass.values()) for i in range(both)]
    return _sigmoid(sum(a * b for a, b in zip(pooled, p["c"])) + p["d"][0])


def test_recurrent_scores_equal_plain_loops():
    rng = np.random.default_rng(4)
    p = {k: v.astype(float) for k, v in toxicity._start(3).items()}
    x = np.concatenate((rng.normal(0, 1, (12, toxicity.INPUTS)), np.zeros((1, toxicity.INPUTS))))
    of = rng.integers(0, 12, (4, toxicity.WINDOW))
    of[1, 5:], of[2, 1:] = -1, -1  # the ends of short texts
    got = toxicity.forward(p, toxicity.project(p, x), of)
    for row, score in zip(of.tolist(), got.tolist()):
        assert score == pytest.approx(_gru_window(p, x, row), abs=2e-5)


def _pooled(p, x):
    """Score of one document's passages by gated attention."""
    hidden = [[math.tanh(sum(a * b for a, b in zip(row, p["W"][:, j])) + p["b"][j]) for j in range(p["W"].shape[1])] for row in x]
    e = []
    for h in hidden:
        t = [math.tanh(sum(a * b for a, b in zip(h, p["V"][:, j]))) for j in range(p["V"].shape[1])]
        g = [_sigmoid(sum(a * b for a, b in zip(h, p["U"][:, j]))) for j in range(p["U"].shape[1])]
        e.append(sum(a * b * c for a, b, c in zip(t, g, p["w"])))
    mass = [math.exp(v - max(e)) for v in e]
    z = [sum(m * h[j] for m, h in zip(mass, hidden)) / sum(mass) for j in range(len(hidden[0]))]
    return _sigmoid(sum(a * b for a, b in zip(z, p["c"])) + p["d"][0])


def _model(rng, n_features, hidden=5, gate=3):
    shapes = {"W": (n_features, hidden), "b": hidden, "V": (hidden, gate), "U": (hidden, gate), "w": gate, "c": hidden, "d": 1}
    return {k: rng.normal(0, 0.5, s) for k, s in shapes.items()}


def test_gated_attention_equals_plain_loops_and_its_gradients_differences():
    rng = np.random.default_rng(5)
    p = _model(rng, 7)
    doc = np.array([0, 0, 0, 1, 2, 2, 2, 2])
    x = rng.normal(0, 1, (len(doc), 7))
    f = quality._forward(p, x, doc, 3)
    assert f["s"] == pytest.approx([_pooled(p, x[doc == k]) for k in range(3)])
    y, weight = np.array([1, 0, 1.0]), np.array([0.5, 0.2, 0.3])

    def loss():
        s = quality._forward(p, x, doc, 3)["s"]
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    for k, g in quality._backward(p, f, x, doc, y, weight).items():
        for i in np.ndindex(p[k].shape):
            old = p[k][i]
            p[k][i] = old + 1e-5
            up = loss()
            p[k][i] = old - 1e-5
            down = loss()
            p[k][i] = old
            assert g[i] == pytest.approx((up - down) / 2e-5, abs=1e-6), k


def test_every_passage_of_a_text_counts():
    """The score of a long text is that of its passages pooled at once."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{k % 17}, X{k}" for k in range(n)).encode() for n in (1, 60, 700)]
    doc, total, x = quality.passages(texts)
    assert np.bincount(doc).tolist() == [1, 3, 30]  # 48 words a passage, two words a step
    model = _model(rng, x.shape[1]) | {"mean": x.mean(0), "std": x.std(0) + 1e-3}
    scaled = quality._scaled(x, total, model["mean"], model["std"])
    assert quality.score(model, [t.decode() for t in texts]) == pytest.approx([_pooled(model, scaled[doc == k]) for k in range(3)], abs=1e-5)

import numpy as np
import pytest

from staylens.llm import topk_search


def _brute(rows, k, step, scale=64):
    def sound(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)
    data = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if i is not None and sound(v)]
    out = []
    for q, a in sorted({(i, tuple(v)) for i, v in data if i % step == 0}):
        near = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in data if i != q and len(a) == len(b))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


def _rows(kind, seed):
    rng = np.random.default_rng(seed)
    if kind == "clusters":
        centres = rng.normal(0, 1, (6, 8))
        v = centres[rng.integers(0, 6, 400)] + rng.normal(0, 0.05, (400, 8))
    elif kind == "ties":
        v = rng.integers(-1, 2, (400, 3)) / 4
    else:
        v = rng.normal(0, 0.3, (400, 12))
    return list(enumerate(v.tolist()))


@pytest.mark.parametrize("kind", ["random", "clusters", "ties"])
def test_top_k_equals_full_scan(spark, monkeypatch, kind):
    monkeypatch.setattr(topk_search, "CHUNK", 128)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 10)
    monkeypatch.setattr(topk_search, "SEED_ROWS", 60)
    rows = _rows(kind, 1)
    n = len(rows)
    rows += [(n, None), (n + 1, [1.0, None]), (None, rows[3][1]), (n + 2, [float("nan")] * len(rows[0][1])),
             (n + 3, [float("inf")] * len(rows[0][1])), (20_000, [1.0, 2.0]), (20_001, [0.5, 0.25]), (20_020, [])]
    data = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, query_id string")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted(map(tuple, topk_search.top_k(data.repartition(3), k=7).collect()))
    assert got == _brute(rows, 7, 20)


def test_fewer_candidates_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], schema)
    assert sorted(map(tuple, topk_search.top_k(few).collect())) == [(0, 1, 1, 8192), (0, 2, 2, 8192)]
    assert topk_search.top_k(spark.createDataFrame([], schema)).count() == 0


def test_cover_tree_covers_and_bounds_hold():
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (500, 5))
    tree = topk_search.CoverTree.build(np.arange(500), points)
    assert sorted(tree.ids.tolist()) == list(range(500))
    for c, r, lo, hi, child in zip(tree.centre, tree.radius, tree.begin, tree.end, tree.child):
        assert np.linalg.norm(tree.points[lo:hi] - c, axis=1).max() <= r
        for a in child:
            assert lo <= tree.begin[a] and tree.end[a] <= hi


def test_pruning_skips_far_clusters():
    rng = np.random.default_rng(4)
    near, far = rng.normal(0, 0.01, (200, 4)) + [3, 0, 0, 0], rng.normal(0, 0.01, (200, 4)) - [3, 0, 0, 0]
    data = topk_search.CoverTree.build(np.arange(400), np.concatenate((far, near)))
    found = topk_search.TopK(topk_search.CoverTree.build(np.arange(1000, 1010), near[:10]), 5)
    offered = []
    keep = topk_search.TopK.offer
    found.offer = lambda lo, hi, ids, points: (offered.append(len(ids)), keep(found, lo, hi, ids, points))
    topk_search.search(found, data)
    assert max(found.id[0]) < 400 and min(found.id[0]) >= 200
    assert sum(offered) <= 200 * len(offered) and sum(offered) < 400


def test_large_scores_are_exact(spark):
    """Scores between 2**53 and 2**63, which no float holds."""
    rng = np.random.default_rng(7)
    rows = [(k, (2.0 ** 29 + rng.integers(0, 1000, 2)).tolist()) for k in range(200)]
    want = _brute(rows, 5, 20, scale=1)
    assert min(s for *_, s in want) > 2**53 and any(int(float(s)) != s for *_, s in want)
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk_search.top_k(data, k=5, scale=1).collect())) == want


def test_products_of_large_components():
    a, b = np.array([[2.0**31 + 1, 2.0**31 + 3]]), np.array([[2.0**30 + 1, 2.0**30 + 7]])
    assert topk_search._products(a, b)[0, 0] == (2**31 + 1) * (2**30 + 1) + (2**31 + 3) * (2**30 + 7)
    c = np.array([[2.0**40, -2.0**40, 1.0]])
    assert topk_search._products(c, np.array([[2.0**40, 2.0**40, 5.0]]))[0, 0] == 5
    with pytest.raises(OverflowError):
        topk_search._products(c, c)

import random

import pytest

from staylens.llm import fingerprints, graph, jaccard_join


def _sets(rows, width):
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        out.append((i, {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()))
    return out


def _components(rows, width, percent):
    sets = _sets(rows, width)
    parent = {i: i for i, _ in sets if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else top(i)) for i, s in sets), key=str)


def _near_copies(rng, n, base_words, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(base_words)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        yield " ".join(w)


def _case(seed):
    """Near copies of several texts, a passage that all share, edge texts."""
    rng = random.Random(seed)
    shared = " ".join(f"p{k}" for k in range(60))
    texts = [None, "", " \n ", "One", "one", "one two three", "one two three", "a b c d", "A B\tC d", "x" * 3000]
    texts += list(_near_copies(rng, 60, 150, 6)) + list(_near_copies(rng, 25, 40, 4)) + list(_near_copies(rng, 10, 400, 20))
    texts += [shared + " " + " ".join(f"o{k}_{j}" for j in range(rng.randrange(1, 40))) for k in range(30)]
    texts += [texts[20]] * 15
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t) for i, t in zip(ids, texts)]
    return rows + [(None, texts[20]), (None, None), (ids[12], texts[12]), (ids[13], texts[75])]


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_finds_every_link(spark, documents, seed):
    rows = _case(seed)
    got = jaccard_join.link_components(documents(rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == _components(rows, 4, 85)


def test_ngram_join_over_many_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", (1 << 12, 1 << 12))
    rows = _case(3)
    got = jaccard_join.link_components(documents(rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == _components(rows, 4, 85)


def test_ngram_join_exact_threshold(spark, documents):
    # 20 shingles, 17 shared of 20 and 17 of 21 in all
    base = [f"b{k}" for k in range(23)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:20])), (3, " ".join(base[1:23] + ["z"]))]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_components(documents(rows)).collect()}
    assert got == {i: c for i, _, c in _components(rows, 4, 85)} and got[2] == 1


def test_ngram_join_empty_table(spark, documents):
    assert jaccard_join.link_components(documents([])).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 300)] + [(7, 7), (9, 8), (8, 9)]
    rng.shuffle(edges)
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 100 for k in range(100, 161)} | {k: 5 for k in [5, *range(200, 300)]} | {8: 8, 9: 8}
    assert got == want


def test_near_duplicates_by_bands(spark, documents):
    rows = [r for r in _case(5) if r[0] is not None]
    got = {r["doc_id"]: r["class_id"] for r in fingerprints.near_duplicates(documents(rows)).collect()}
    want = {i: c for i, _, c in _components(rows, 5, 80)}
    # every class is made of verified links; bands find at least nine links in ten
    for i, c in got.items():
        assert want[i] == want[c]
    assert sum(got[i] != i for i in got) >= 0.9 * sum(want[i] != i for i in want)


def _expected_fingerprints(rows):
    order = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for n, (i, t) in enumerate(order):
        nxt = order[(n + 1) % len(order)][1]
        yield i, t, t[: len(t) - len(t) // 4] + nxt[: len(t) // 4], nxt


def test_fingerprints_of_documents_and_edited_texts(spark, documents, monkeypatch):
    import hashlib
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 7)
    rows = _case(6) + [(10_000, "né " * 3000), (10_001, "🙂🙃 ab " * 9)]
    got = sorted(fingerprints.fingerprint_documents(documents(rows)).collect(),
                 key=lambda r: (str(r["doc_id"]), r["edited_sha256"]))
    want = sorted(_expected_fingerprints(rows),
                  key=lambda r: (str(r[0]), hashlib.sha256(r[2].encode()).hexdigest()))
    assert len(got) == len(want)
    for r, (i, t, edited, nxt) in zip(got, want):
        assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (i, len(t), hashlib.sha256(edited.encode()).hexdigest())
        fp = fingerprints.fingerprint
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fp(t), fp(edited))
        assert r["near_edited"] == fingerprints.likeness(fp(t), fp(edited))
        assert r["near_next"] == fingerprints.likeness(fp(t), fp(nxt))


def test_one_document_is_its_own_next(spark, documents):
    (r,) = fingerprints.fingerprint_documents(documents([(5, "abcdefgh")])).collect()
    assert r["near_next"] == 1.0 and r["n_chars"] == 8
    assert fingerprints.fingerprint_documents(documents([])).count() == 0


def test_likeness_estimates_jaccard():
    rng = random.Random(8)
    a = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    b = a[:1600] + [f"v{k}" for k in range(400)]
    x = {tuple(a[k:k + 5]) for k in range(1996)}
    y = {tuple(b[k:k + 5]) for k in range(1996)}
    est = fingerprints.likeness(fingerprints.fingerprint(" ".join(a)), fingerprints.fingerprint(" ".join(b)))
    assert abs(est - len(x & y) / len(x | y)) < 0.2

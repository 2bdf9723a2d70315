import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from staylens.llm import mixing, packing
from staylens.llm.subwords import default_vocabulary


def _check(rows, got, capacity):
    lib = Tokenizer.from_file(default_vocabulary())
    want = []
    for i, t, *_ in rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s: s + capacity]
            want.append((i, k, s, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    used = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert not used or max(used.values()) <= capacity
    return used


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_round_trip_and_few_sequences(spark, documents, capacity):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["the", "house", "xyzzyq", "a"], k=rng.randrange(60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "word " * 5000), (None, "null id"), (5, "again"), (5, "again")]
    got = packing.pack_documents(documents(rows), capacity).collect()
    used = _check(rows, got, capacity)
    total = sum(r["length"] for r in got)
    assert len(used) <= -(-total // capacity) * 1.02 + 1


def test_chunks_leave_little_room(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 100)
    rows = [(i, "w " * (i % 50)) for i in range(600)]
    used = _check(rows, packing.pack_documents(documents(rows), 64).collect(), 64)
    assert len(used) <= sum(used.values()) / 64 + 7


def test_empty_table(spark, documents):
    assert packing.pack_documents(documents([])).count() == 0


@pytest.mark.parametrize("by", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(by):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 100, 400)
    order, bins, offsets = packing.best_fit(lengths, 100, 3, 4000, (1.0, 0.3, 0.3), by)
    placed = lengths[order]
    for b in np.unique(bins):
        mine = placed[bins == b]
        assert mine.sum() <= 100 and len(mine) <= 3 and ((mine.astype(float) ** 2).sum() <= 4000 or len(mine) == 1)
        assert offsets[bins == b].tolist() == (np.cumsum(mine) - mine).tolist()


def test_best_fit_takes_the_tightest_bin():
    order, bins, _ = packing.best_fit(np.array([60, 50, 39, 48]), 100, 100, 10**6, (1.0, 0.0, 0.0))
    by_length = dict(zip(np.array([60, 50, 39, 48])[order].tolist(), bins.tolist()))
    assert by_length[48] == by_length[50] and by_length[39] == by_length[60]


def test_order_of_lengths_beyond_a_cost_limit():
    # a piece that alone passes the cost limit still gets a sequence of its own
    _, bins, _ = packing.best_fit(np.array([90, 10]), 100, 10, 5000, (1.0, 0.0, 0.0))
    assert len(set(bins.tolist())) == 2


def test_sequences_follow_the_mix(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 200)
    rng = random.Random(3)
    size = {"a": 2000, "b": 500, "c": 125}  # weights 4 : 2 : 1 by square roots
    rows = [(f"{s}{k}", " ".join(rng.choices(["the", "house", "a"], k=rng.randrange(20, 400))), s)
            for s, n in size.items() for k in range(n)]
    rows = [(i, t, s) for i, (_, t, s) in enumerate(rows)]
    docs = documents(rows).repartition(5)
    source = {i: s for i, _, s in rows}
    place = {r["row"]["doc_id"]: (r["slot"], r["offset"]) for r in mixing.place(docs).collect()}
    got = corpus_pipeline.packing_stage(spark, corpus_pipeline.mixing_stage(spark, docs, ""), "").collect()
    _check(rows, got, packing.CAPACITY)
    chunks = {}
    for r in got:
        chunks.setdefault(r["sequence_id"] >> 32, []).append((place[r["doc_id"]], source[r["doc_id"]]))
    runs = [sorted(chunks[k]) for k in sorted(chunks)]
    assert len(runs) > 5 and all(a[-1] <= b[0] for a, b in zip(runs, runs[1:]))
    for run in runs[:3]:  # until a source runs out, to within a block of 16 at either end
        n = {s: sum(x == s for _, x in run) for s in size}
        assert all(abs(n[s] - len(run) * w / 7) <= 32 for s, w in (("a", 4), ("b", 2), ("c", 1)))
    # first pieces of sequences come in the order of the mix
    first = {}
    for r in got:
        first[r["sequence_id"]] = min(first.get(r["sequence_id"], (1 << 40, 0)), place[r["doc_id"]])
    in_order = [first[k] for k in sorted(first)]
    assert in_order == sorted(in_order)

from collections import Counter, defaultdict

import pytest

from staylens.llm import line_dedup, mixing


def _lines_by_hand(rows, min_sites):
    sites, keeper = defaultdict(set), {}
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            if line.strip(" "):
                if s is not None:
                    sites[line.strip(" ")].add(s)
                old = keeper.setdefault(line.strip(" "), i)
                keeper[line.strip(" ")] = min(old, i, key=lambda x: (x is not None, x or 0))
    out = []
    for i, t, s in rows:
        kept = None if t is None else [x for x in t.split("\n") if len(sites[x.strip(" ")]) < min_sites
                                       or keeper.get(x.strip(" ")) == i]
        out.append((i, None if t is None else "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup_matches_hand_count(spark, documents):
    rows = [(i, f"own {i}\nshared line\n\nnear {i % 3}", f"s{i % 7}") for i in range(30)]
    rows += [(40, None, "s1"), (41, "", "s2"), (42, "shared line\n shared line ", None), (43, "x" * 200_000, "s3"),
             (None, "shared line\nnull id", "s4"), (44, "shared line", "s5"), (44, "shared line", "s5")]
    got = line_dedup.dedup_lines(documents(rows), 5)
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == _lines_by_hand(rows, 5)
    assert set(got.columns) == {"doc_id", "text", "lang", "source", "n_chars", "row", "key", "lost", "block", "lines_removed"}
    for r in got.collect():
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"])) and r["row"] == "x" and r["lost"] == "y"


@pytest.mark.parametrize("sites", [1, 2, 4, 5, 6, 7, 12, 20])
def test_sites_around_the_threshold_count_exactly(spark, documents, sites):
    rows = [(i, "line", f"s{i}") for i in range(sites)]
    lost = line_dedup.dedup_lines(documents(rows), 5).where("lines_removed > 0").count()
    assert lost == (sites - 1 if sites >= 5 else 0)


def test_line_dedup_empty_table(spark, documents):
    assert line_dedup.dedup_lines(documents([])).count() == 0


def _weights(rows, period=mixing.PERIOD):
    n = Counter(r[2] for r in rows)
    root = sum(v ** 0.5 for v in n.values())
    slots = max(period, mixing.SLOTS_PER_SOURCE * len(n))
    return {s: max(1, int(v ** 0.5 / root * slots + 0.5)) for s, v in n.items()}


def test_mix_keeps_every_row_and_deviates_by_less_than_a_block(spark, documents):
    rows = [(i, f"t{i}", "big" if i % 3 else f"s{i % 5}") for i in range(900)] + [(5000 + i, None, None) for i in range(40)]
    got = mixing.mix(documents(rows), block_rows=4).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    share = _weights(rows)
    total = sum(share.values())
    blocks = defaultdict(set)
    for r in got:
        blocks[r["source"]].add((r["slot"], r["block"]))
        assert 0 <= r["offset"] < 4
    slots = sorted(s for b in blocks.values() for s, _ in b)
    assert len(slots) == len(set(slots))  # one block a slot
    end = min(max(s for s, _ in b) for b in blocks.values())  # until a source runs out
    for source, b in blocks.items():
        assert sorted(x for _, x in sorted(b)) == [x for _, x in sorted(b)]  # blocks in order
        for t in range(end + 1):
            given = sum(s <= t for s, _ in b)
            assert abs(given - share[source] * (t + 1) / total) < 1


def test_mix_weights_ties_and_empty(spark, documents):
    rows = [(7, f"t{i}", "a") for i in range(20)] + [(i, "same", "b") for i in range(20)] + [(None, None, "c")]
    got = mixing.mix(documents(rows), {"a": 3.0, "b": 1.0}, block_rows=1, period=8).collect()
    assert len(got) == 41 and len({r["slot"] for r in got}) == 41
    first = sorted(got, key=lambda r: r["slot"])[:8]
    assert abs(Counter(r["source"] for r in first)["a"] - 8 * 3 / 5) < 1  # shares 3, 1 and 1 for the source not named
    got = mixing.mix(documents(rows), {"a": 0.75, "b": 0.25}, block_rows=1, period=8).collect()
    first = sorted(got, key=lambda r: r["slot"])[:8]
    assert abs(Counter(r["source"] for r in first)["a"] - 8 * 18 / 25) < 1  # shares 18, 6, 1 of 24 slots
    assert mixing.mix(documents([])).count() == 0


def test_whole_weights_hold_over_a_hundred_periods(spark, documents):
    rows = [(i, f"t{i}", "abc"[0 if i % 6 < 3 else 1 if i % 6 < 5 else 2]) for i in range(1200)]
    got = mixing.mix(documents(rows), {"a": 30.0, "b": 20.0, "c": 10.0}, block_rows=2).collect()
    weight = {"a": 3 / 6, "b": 2 / 6, "c": 1 / 6}
    blocks = sorted({(r["slot"], r["source"]) for r in got})
    assert [t for t, _ in blocks] == list(range(600))  # 100 periods of 6 slots, none empty
    given = Counter()
    for t, source in blocks:
        given[source] += 1
        assert all(abs(given[s] - w * (t + 1)) < 1 for s, w in weight.items())


def test_shares_of_whole_weights():
    assert mixing._whole_shares({"a": 4, "b": 6.0}, 1000) == {"a": 2, "b": 3}
    assert mixing._whole_shares({"a": 1, "b": 1000}, 1000) == mixing._whole_shares({"a": 1.5}, 1000) == {}
    assert mixing._whole_shares(None, 1000) == mixing._whole_shares({"a": 0, "b": 1}, 1000) == {}


def test_an_id_of_many_texts_is_spread_over_shards(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_SHARD", 10)
    rows = [(7, f"t{i}", "a") for i in range(300)]
    got = mixing.mix(documents(rows), block_rows=4).collect()
    assert sorted((r["slot"], r["offset"]) for r in got) == [(i // 4, i % 4) for i in range(300)]
    docs = documents(rows)
    keys = docs.select(mixing._place_key(docs.doc_id, docs.text).substr(1, 2).alias("k"))
    assert keys.distinct().count() > 100

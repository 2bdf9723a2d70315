import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from staylens.llm import fill_middle as fm

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
TEXT = st.one_of(st.text(max_size=80), st.lists(st.sampled_from(
    ["ab", "Z", " ", "\n", "é", "漢", "\U0001f600", "<", "P>", "S>", "<P", "1"]), max_size=40).map("".join))


def brute(doc_id, text):
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or h3 % 100 >= 90 or "<P>" in text or "<S>" in text or "<M>" in text:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h4 % 100 < 20
    return (n, "spm" if spm else "psm", len(p), len(m),
            f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=400))
def test_skip_list_finds_every_rank(widths):
    made = fm.SkipList(np.array(widths, np.int64))
    before = np.concatenate(([0], np.cumsum(widths))).astype(int)
    assert [made.place(r) for r in range(len(widths) + 1)] == before.tolist()


def test_skip_list_walks_few_links():
    widths = np.random.default_rng(0).integers(1, 5, 300_000)
    made = fm.SkipList(widths)
    before = np.concatenate(([0], np.cumsum(widths)))
    assert [len(lane[0]) for lane in made.lanes] == sorted((len(lane[0]) for lane in made.lanes), reverse=True)
    assert len(made.lanes) >= 4 and len(made.lanes[-1][0]) <= 64
    for units, chars, _ in made.lanes:  # every lane spans the whole text
        assert units.sum() == len(widths) and chars.sum() == widths.sum()
    for r in (0, 1, 17, 150_000, 299_999, 300_000):
        assert made.place(r) == before[r]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.none(), st.integers(-2**40, 2**40)), TEXT)
def test_transform_is_the_contract(doc_id, text):
    assert fm.transform_text(doc_id, text) == brute(doc_id, text)


def test_rows_and_round_trip(spark, documents):
    texts = ["", None, "One two, three.", "a<P>b", "tail<", "S>head <S", "<<<", "M>x<M", "é漢\U0001f600 ab" * 50, "word " * 3000]
    rows = [(i * 10 + k, t) for i, t in enumerate(texts) for k in range(10)] + [(None, "no id"), (5, None), (5, None)]
    made = fm.transform(documents(rows)).withColumn("back", fm.restored("output", "form")).collect()
    want = [(i, *brute(i, t or ""), t or "") for i, t in rows]
    assert sorted((tuple(r) for r in made), key=str) == sorted(want, key=str)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}
    digest = fm.digest(documents(rows)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((tuple(r) for r in digest), key=str) == sorted(
        ((*w[:5], sha(w[5]), sha(w[6])) for w in want), key=str)


def test_all_texts_transformed_or_none(spark, documents):
    docs = documents([(i, f"text {i}") for i in range(40)])
    forms = {r["form"] for r in fm.transform(docs, 100, 100).collect()}
    assert forms == {"spm"}
    assert fm.transform(docs, 0).where(F.col("form") != "plain").count() == 0


def test_empty_table(spark, documents):
    assert fm.digest(documents([])).collect() == []

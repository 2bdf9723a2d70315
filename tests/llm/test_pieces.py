import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from staylens.llm import pieces

SIGNS = ["a", "the ", " ", "  ", "\n", "\t", "é", "ß", "漢", "\U0001f600", "▁", "<s>", "<0x41>", "\x00",
         " ", "1", "\r\n", "..", "!!!", "un", "ing", "é", "﻿", "￿"]


@pytest.fixture(scope="module")
def coder():
    with open(pieces.default_model(), "rb") as f:
        return pieces.PieceCoder(f.read())


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(SIGNS), max_size=20).map("".join)))
def test_agrees_with_the_library(coder, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = coder.encode(text)
    assert ids == coder.library.encode(text)
    assert coder.decode(ids) == coder.library.decode(ids)


def test_parts_do_not_change_the_agenda(coder):
    rng = random.Random(1)
    for _ in range(100):
        text = "".join(rng.choices(SIGNS, k=30))
        whole = coder._ids(coder.library.normalize(text))
        assert list(whole) == coder.encode(text)


def test_long_text_without_spaces(coder):
    text = "漢" * 50_000 + "abcd" * 50_000
    assert coder.encode(text) == coder.library.encode(text)


def test_generations_of_remembered_parts(coder, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_PARTS", 3)
    text = "one two three four five one two six seven one"
    assert coder.encode(text) == coder.library.encode(text)
    assert len(coder.known) <= 3


class Vocabulary:
    """Library double: a merge vocabulary without byte pieces, with an unused piece."""
    pieces = [("<unk>", 0), ("<s>", 0), ("ab", -1), ("abc", -2), ("bc", -3), ("a", -4), ("b", -5), ("c", -6), ("▁", -7)]

    def __init__(self, model_proto=None):
        pass

    def get_piece_size(self):
        return len(self.pieces)

    def id_to_piece(self, i):
        return self.pieces[i][0]

    def get_score(self, i):
        return self.pieces[i][1]

    def is_control(self, i):
        return i == 1

    def is_byte(self, i):
        return False

    def is_unused(self, i):
        return i == 3

    def unk_id(self):
        return 0

    def normalize(self, t):
        return "▁" + t.replace(" ", "▁")


def test_unused_and_unknown_pieces(monkeypatch):
    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Vocabulary)
    small = pieces.PieceCoder(b"")
    assert small.encode("abc") == [8, 2, 7]       # "abc" goes back to "ab" and "c"
    assert small.encode("bcxyzb") == [8, 4, 0, 6]  # a run of unknown signs is one id
    assert small.decode([8, 2, 0, 1, 7]) == "ab ⁇ c"


def test_query_rows(spark, documents):
    rows = [(1, "Hello there"), (2, None), (3, ""), (4, "x " * 5000), (None, "null id"), (1, "Hello there"),
            (6, " leading\nand▁more \U0001f600")]
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    want = []
    for i, t in rows:
        ids = lib.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids).encode()).hexdigest(), True))
    got = [tuple(r) for r in pieces.digest(documents(rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    real = pieces.code_documents(documents(rows)).where("doc_id = 6").first()
    assert real["ids"] == lib.encode(rows[-1][1]) and real["decoded"] == lib.decode(real["ids"])


def test_empty_table(spark, documents):
    assert pieces.digest(documents([])).collect() == []

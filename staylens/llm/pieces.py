"""Operator 11, encoding and decoding with a merge-type piece vocabulary.

A text is normalised as the model says (spaces become U+2581, a first one is
put in front) and starts as one symbol per code point. The agenda holds the
adjacent pairs of symbols that together are a piece, the best score first and
of equal scores the leftmost; the pair on top is joined, its new neighbours
enter, and pairs whose symbols are gone are passed over. Symbols left over that
are no piece become their UTF-8 bytes. Decoding puts the pieces' texts
together, runs of byte pieces as UTF-8.

Where no piece of the vocabulary holds two neighbouring code points, no merge
can ever cross them. So the text is parted in front of every run of U+2581
(when no piece holds one after another sign), around signs that stand in no longer
piece, and in front of signs that no piece holds after a letter; every part has an agenda of its own, and parts that were met
before are looked up. The ids are those of one agenda over the whole text.

Every batch is checked against the ``sentencepiece`` library: it encodes all parts
that the batch met for the first time and decodes the ids of every text;
``library_equal`` says whether ids and text agree. (Where no sign stands alone, or
a part ever differs, the library encodes the whole texts instead.)

Scale: one pass over the texts in Arrow batches, no shuffle. A worker holds the
model (fixed size, sent along with the task) and twice ``CACHE_PARTS`` parts.

Edge cases: null text is the empty text, which has no ids; repeated rows are
coded alike; texts without any space are one part, whose agenda costs n log n;
other columns are ignored; an empty table gives no rows. Vocabularies with
user-defined symbols are not meant.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Parts remembered by a worker, twice (about 150 MB in all): the newer generation
#: replaces the older one when it is full, so that frequent parts stay.
CACHE_PARTS = 250_000
#: Longer parts are not remembered.
CACHE_CHARS = 64
LETTER = re.compile(r"[^\W\d_]")
#: Up to this length the agenda is a plain list, which is quicker than a heap.
LIST_CHARS = 24
CODED = "doc_id long, ids array<int>, decoded string, library_equal boolean"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, library_equal boolean"


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceCoder:
    """Encoder and decoder of one serialised model."""

    def __init__(self, model: bytes):
        lib = self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(lib.get_piece_size())
        self.text = [lib.id_to_piece(i) for i in every]
        self.special = {i for i in every if lib.is_control(i)}
        byte = {i: int(self.text[i][3:5], 16) for i in every if lib.is_byte(i)}
        self.byte_id = {b: i for i, b in byte.items()}
        self.unknown = lib.unk_id()
        plain = [i for i in every if i not in self.special and i not in byte and i != self.unknown]
        self.id = {self.text[i]: i for i in plain}
        self.cost = {self.text[i]: -lib.get_score(i) for i in plain}
        self.unused = {self.text[i] for i in plain if lib.is_unused(i)}
        #: decoded text of each id; bytes from 0x80 on as the lone surrogates of
        #: Python's surrogateescape, so that runs of them can be put together
        self.decoded = [" ⁇ " if i == self.unknown else "" if i in self.special
                        else bytes([byte[i]]).decode("ascii", "surrogateescape") if i in byte
                        else self.text[i] for i in every]
        self.number = [str(i) for i in every]
        self.dummy = lib.normalize("a").startswith(SPACE)
        self.parts = self._pattern()
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        #: parts met since the last check, and their ids
        self.fresh: list[tuple[str, tuple[int, ...]]] = []

    def _pattern(self) -> re.Pattern:
        """Cuts a normalised text where no piece can reach over."""
        long = [p for p in self.id if len(p) > 1]
        joined = set("".join(long))
        signs = [c for c in map(chr, range(128)) if c not in joined]
        self.lead = "\n" if "\n" in signs else signs[0] if signs else ""
        alone = re.escape("".join(signs))
        inner = any(a != SPACE and b == SPACE for p in long for a, b in zip(p, p[1:]))
        if inner:  # pieces may cross words: only signs of no longer piece part
            return re.compile(f"[{alone}]|[^{alone}]+" if alone else "(?s:.+)")
        # signs that no piece holds after a letter: a word ends in front of them
        after = {b for p in long for a, b in zip(p, p[1:]) if LETTER.fullmatch(a)}
        ending = re.escape("".join(c for c in map(chr, range(128)) if not LETTER.fullmatch(c) and c not in after))
        word = f"{SPACE}+{LETTER.pattern}+(?=[{ending}])|" if ending else ""
        sign = f"[{alone}]|" if alone else ""
        return re.compile(f"{sign}{word}{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+")

    def agenda(self, part: str) -> list[str]:
        """Symbols of one part after all merges."""
        if len(part) > LIST_CHARS or self.unused:
            return self._long_agenda(part)
        symbol, cost, never = list(part), self.cost.get, float("inf")
        pairs = [cost(part[i:i + 2], never) for i in range(len(part) - 1)]
        while pairs and (best := min(pairs)) != never:
            i = pairs.index(best)  # the leftmost of the best
            symbol[i:i + 2] = [symbol[i] + symbol[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = cost(symbol[i - 1] + symbol[i], never)
            if i < len(pairs):
                pairs[i] = cost(symbol[i] + symbol[i + 1], never)
        return symbol

    def _long_agenda(self, part: str) -> list[str]:
        n, cost = len(part), self.cost
        symbol = list(part)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        made: dict[str, tuple[str, str]] = {}  # how unused pieces came about
        pairs = [(cost[p], i, i + 1, p) for i in range(n - 1) if (p := part[i:i + 2]) in cost]
        heapify(pairs)
        while pairs:
            _, left, right, piece = heappop(pairs)
            if symbol[left] + symbol[right] != piece or after[left] != right or not symbol[right]:
                continue
            if piece in self.unused:
                made[piece] = (symbol[left], symbol[right])
            symbol[left], symbol[right] = piece, ""
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                if (p := piece + symbol[following]) in cost:
                    heappush(pairs, (cost[p], left, following, p))
            if (first := before[left]) >= 0 and (p := symbol[first] + piece) in cost:
                heappush(pairs, (cost[p], first, left, p))
        out, todo = [], [s for s in reversed(symbol) if s]
        while todo:  # unused pieces go back to what they were joined from
            s = todo.pop()
            if s in made:
                todo += made[s][::-1]
            else:
                out.append(s)
        return out

    def _ids(self, part: str) -> tuple[int, ...]:
        symbols = self.agenda(part)
        ids = [self.id.get(s, -1) for s in symbols]
        if -1 not in ids:
            return tuple(ids)
        ids = []
        for s in symbols:
            if s in self.id:
                ids.append(self.id[s])
            elif self.byte_id:
                ids += [self.byte_id[b] for b in s.encode()]
            else:
                ids.append(self.unknown)
        return tuple(ids)

    def _remembered(self, part: str) -> tuple[int, ...]:
        ids = self.older.get(part)
        if ids is None:
            ids = self._ids(part)
            self.fresh.append((part, ids))
        if len(part) <= CACHE_CHARS:
            if len(self.known) >= CACHE_PARTS:
                self.known, self.older = {}, self.known
            self.known[part] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.parts.findall(self.library.normalize(text)):
            ids += self.known.get(part) or self._remembered(part)
        if self.byte_id:
            return ids
        # without byte pieces a run of unknown signs is one id
        return [i for k, i in enumerate(ids) if i != self.unknown or k == 0 or ids[k - 1] != i]

    def decode(self, ids: Sequence[int]) -> str:
        text = "".join(map(self.decoded.__getitem__, ids))
        if self.byte_id and not text.isascii():
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        if self.dummy and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")

    def agrees(self, texts: Sequence[str], ids: Sequence[list[int]], decoded: Sequence[str]) -> list[bool]:
        """Whether the library gives the same for each text."""
        fresh, self.fresh = self.fresh, []
        same = bool(self.lead)
        if same:
            # a sign that stands alone in front keeps the library's first space off
            skip = len(self.library.encode(self.lead))
            theirs = self.library.encode([self.lead + p for p, _ in fresh])
            same = all(tuple(t[skip:]) == i for t, (_, i) in zip(theirs, fresh))
        back = self.library.decode(list(ids))
        if same:
            return [d == b for d, b in zip(decoded, back)]
        return [i == t and d == b for i, t, d, b in zip(ids, self.library.encode(list(texts)), decoded, back)]


_CODERS: dict[bytes, PieceCoder] = {}


def coder(model: bytes) -> PieceCoder:
    """One coder per worker and model."""
    if model not in _CODERS:
        _CODERS.clear()
        _CODERS[model] = PieceCoder(model)
    return _CODERS[model]


def _per_text(docs: DataFrame, model: str | None, row, schema: str) -> DataFrame:
    with open(model or default_model(), "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # fixed size, 0.5 MB
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = coder(file.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            ids = [both.encode(t) for t in texts]
            decoded = [both.decode(i) for i in ids]
            equal = both.agrees(texts, ids, decoded)
            rows = [row(both, *r) for r in zip(ids, decoded, equal)]
            out = pd.DataFrame(rows, columns=names[1:])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, schema)


def code_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Ids of every whole text and the text decoded from them."""
    return _per_text(docs, model, lambda _, *result: result, CODED)


def digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Hashes of ids and decoded text of every document."""
    def hashed(both, ids, decoded, equal):
        numbers = ",".join(map(both.number.__getitem__, ids))
        return (len(ids), hashlib.sha256(numbers.encode()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(), equal)

    return _per_text(docs, model, hashed, DIGEST)

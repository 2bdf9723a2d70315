"""Subword ids of many texts with the public word-level BPE vocabulary.

``ids_of`` gives what the ``tokenizers`` library gives for the vocabulary file
(no special tokens added). White space always ends a word, so each distinct
word is encoded once and looked up after that; new words are merged together in
numpy, one merge a round for all of them. Texts outside plain Latin letters,
digits and ASCII signs (or that spell a special token) go to the library whole.
"""
from __future__ import annotations

import json
import re
from collections.abc import Sequence
from itertools import repeat

import numpy as np
from tokenizers import Tokenizer

#: Words remembered by a worker (about 200 MB). When they are too many, those met
#: only once since the last time are forgotten.
CACHE_WORDS = 1_100_000
#: Longer words go to the library.
LONG_BYTES = 64
_NONE = np.iinfo(np.int32).max

# Fixed value: the vocabulary's word pattern, for the letters below.
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_OTHER = re.compile("[^\t\n\x0b\x0c\r -~À-ÖØ-öø-įı-ſ]")
_ASCII = bytes([9, 10, 11, 12, 13, *range(32, 127)])


def _plain(text: str) -> bool:
    if "<|" in text:
        return False
    if text.isascii():
        return not text.encode().translate(None, _ASCII)
    return not _OTHER.search(text)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the
    others for the letters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordBpe:
    def __init__(self, vocabulary_json: str):
        self.library = Tokenizer.from_str(vocabulary_json)
        model = json.loads(vocabulary_json)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = _byte_letters()
        self.plain = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int32), made[order]
        self._slots()
        self.reset()

    def _slots(self) -> None:
        """Hash table of merges: slot -> position in ``keys``; pairs that share a
        slot are searched."""
        self.bits = 20
        slot = self._slot(self.keys)
        self.slot_at = np.full(1 << self.bits, -1, np.int32)
        self.slot_at[slot] = np.arange(len(self.keys), dtype=np.int32)
        n = np.bincount(slot, minlength=1 << self.bits)
        self.shared = n > 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Position of the merge of each pair, or -1."""
        key = a << 32 | b
        slot = self._slot(key)
        at = self.slot_at[slot]
        many = np.flatnonzero(self.shared[slot])
        if len(many):
            at[many] = np.minimum(np.searchsorted(self.keys, key[many]), len(self.keys) - 1)
        at[self.keys[at] != key] = -1
        return at

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self._find(a, b)
        return np.where(at >= 0, self.ranks[at], _NONE)

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint16)
        self.offsets = np.zeros(1 << 14, np.int64)
        self.uses = np.zeros(1 << 14, np.int64)

    def _trim(self) -> None:
        """Forget the words met once; all, if most are met more often."""
        n = len(self.known)
        kept = np.flatnonzero(self.uses[:n] > 1)
        if 4 * len(kept) > 3 * CACHE_WORDS:
            self.reset()
            return
        keep = (self.uses[:n] > 1).tolist()
        size = self.offsets[kept + 1] - self.offsets[kept]
        flat = _ragged(self.flat, self.offsets, size, kept, sizes_taken=True)
        words = [w for w, k in zip(self.known, keep) if k]  # numbers follow the order of entry
        self.reset()
        self._add(words, flat, np.cumsum(size))

    def _merge(self, words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols (padded) and their number for words of ``size`` bytes."""
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(-1, size)
        sym = self.plain[raw]
        sym[:, -1] = self.last[raw[:, -1]]
        count = np.full(len(words), size)
        if size == 1:
            return sym, count
        rank = self._rank(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(len(words), size - 1)
        live = np.arange(len(words))
        col = np.arange(size)
        while True:
            r = rank[live]
            j = r.argmin(1)
            going = r[np.arange(len(live)), j] != _NONE
            live, j = live[going], j[going]
            if not len(live):
                return sym, count
            s = sym[live]
            k = np.arange(len(live))
            new = self.made[self._find(s[k, j], s[k, j + 1])]
            take = col + (col > j[:, None])
            take[:, -1] = np.minimum(take[:, -1], size - 1)
            s = np.take_along_axis(s, take, 1)
            s[k, j] = new
            r = np.take_along_axis(rank[live], np.minimum(take[:, :-1], size - 2), 1)
            count[live] -= 1
            n = count[live]
            r[col[None, :-1] >= (n - 1)[:, None]] = _NONE
            left, right = np.flatnonzero(j > 0), np.flatnonzero(j < n - 1)
            r[left, j[left] - 1] = self._rank(s[left, j[left] - 1], new[left])
            r[right, j[right]] = self._rank(new[right], s[right, j[right] + 1])
            sym[live], rank[live] = s, r

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, number of ids) of single vocabulary words."""
        raw = [u.encode() for u in units]
        size = np.array([len(b) for b in raw])
        counts = np.zeros(len(units), np.int64)
        owner, flat = [], []
        for n in np.unique(size):
            which = np.flatnonzero(size == n)
            if n > LONG_BYTES:
                ids = [self.library.encode(units[i], add_special_tokens=False).ids for i in which]
                counts[which] = [len(x) for x in ids]
                flat.append(np.concatenate(ids))
            else:
                sym, count = self._merge([raw[i] for i in which], int(n))
                counts[which] = count
                flat.append(sym[np.arange(sym.shape[1]) < count[:, None]])
            owner.append(np.repeat(which, counts[which]))
        order = np.argsort(np.concatenate(owner), kind="stable")
        return np.concatenate(flat)[order], counts

    def _learn(self, words: list[str]) -> None:
        """Encode new distinct words and remember them."""
        found = [_WORD.findall(w) for w in words]
        n_units = np.fromiter(map(len, found), np.int64, len(found))
        units = [u for us in found for u in us]
        distinct = dict.fromkeys(units)
        distinct = dict(zip(distinct, range(len(distinct))))
        ids, counts = self._encode(list(distinct))
        unit = np.fromiter(map(distinct.__getitem__, units), np.int64, len(units))
        flat = _ragged(ids, np.cumsum(counts) - counts, counts, unit)
        ends = np.concatenate(([0], np.cumsum(counts[unit])))[np.cumsum(n_units)]
        self._add(words, flat, ends)

    def _add(self, words: list[str], flat: np.ndarray, ends: np.ndarray) -> None:
        """Remember words by their ids, one after the other, and where each ends."""
        n0 = len(self.known)
        base = self.offsets[n0]
        while len(self.flat) < base + len(flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while len(self.offsets) < n0 + len(words) + 1:
            self.offsets = np.concatenate((self.offsets, np.zeros_like(self.offsets)))
            self.uses = np.concatenate((self.uses, np.zeros_like(self.uses)))
        self.flat[base: base + len(flat)] = flat
        self.offsets[n0 + 1: n0 + len(words) + 1] = base + ends
        self.known.update(zip(words, range(n0, n0 + len(words))))

    def ids_of(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        found: list[list[str]] = []
        whole: dict[int, np.ndarray] = {}
        for i, t in enumerate(texts):
            if not isinstance(t, str) or not t:
                found.append([])
            elif not _plain(t):
                whole[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint16)
                found.append([])
            else:
                found.append(t.lower().split())
        n_words = np.fromiter(map(len, found), np.int64, len(found))
        words = [w for ws in found for w in ws]
        code = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(code < 0)
        if len(missing):
            lost = [words[i] for i in missing]
            new = list(dict.fromkeys(lost))
            if self.known and len(self.known) + len(new) > CACHE_WORDS:
                self._trim()
                if len(self.known) + len(new) > CACHE_WORDS:
                    self.reset()
                return self.ids_of(texts)
            self._learn(new)
            code[missing] = np.fromiter(map(self.known.__getitem__, lost), np.int64, len(lost))
        self.uses[: len(self.known)] += np.bincount(code, minlength=len(self.known))
        size = self.offsets[code + 1] - self.offsets[code]
        ids = _ragged(self.flat, self.offsets, size, code, sizes_taken=True)
        bounds = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(n_words)))]
        if whole:
            pieces = [whole.get(i, ids[bounds[i]: bounds[i + 1]]) for i in range(len(texts))]
            return np.concatenate(pieces), np.array([len(p) for p in pieces])
        return ids, np.diff(bounds)


def _ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, take: np.ndarray,
            sizes_taken: bool = False) -> np.ndarray:
    """Concatenated runs flat[starts[i] : starts[i] + sizes[i]] for i in ``take``."""
    size = sizes if sizes_taken else sizes[take]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts[take] - (ends - size), size)]


_LOADED: dict[int, WordBpe] = {}


def loaded(vocabulary_json: str) -> WordBpe:
    """One tokenizer per Python worker and vocabulary."""
    key = hash(vocabulary_json)
    if key not in _LOADED:
        _LOADED[key] = WordBpe(vocabulary_json)
    return _LOADED[key]

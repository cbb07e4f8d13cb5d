"""Ids of many words at once: byte-pair merges over a matrix of symbols.

The library encodes one word at a time, in about 13 microseconds. Here words of the same length stand in a
matrix; in each step every row makes its merge of the least rank (the leftmost of equal ones), so all rows
that still merge stay of one length. Ranks come from a hash table of the merges. The ids are the library's:
they are compared when a vocabulary is loaded, and whatever holds an UNSAFE character goes to the library
itself."""

from __future__ import annotations

import json
import re

import numpy as np

#: What isn't its own composed form, folded to lower case by itself (or may be a special token);
#: and how other text is parted, as the vocabulary's own pattern parts it.
UNSAFE = re.compile(r"[^\x20\x09-\x0D!-~À-ÖØ-öø-ÿ]|<\|")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\x20\x09-\x0Da-z0-9ß-öø-ÿ]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BITS = 20
_NONE = np.int32(1 << 30)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Merges:
    def __init__(self, tokenizer_json: str):
        model = json.loads(tokenizer_json)["model"]
        vocab = model["vocab"]
        self.size = len(vocab)
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + "</w>"] for x in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.keys, self.ranks, self.made = np.full(1 << BITS, -1, np.int64), np.full(1 << BITS, _NONE, np.int32), np.zeros(1 << BITS, np.int32)
        into = [vocab[a + b] for a, b in pairs]
        for place, (key, rank, new) in zip(self._place(keys).tolist(), zip(keys.tolist(), range(len(keys)), into, strict=True), strict=True):
            while self.keys[place] >= 0:
                place = (place + 1) % (1 << BITS)
            self.keys[place], self.ranks[place], self.made[place] = key, rank, new

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the pairs in the table; a place of an empty entry if there is no merge."""
        keys = a * self.size + b
        place = self._place(keys)
        look = np.flatnonzero((self.keys[place] != keys) & (self.keys[place] >= 0))
        while len(look):
            place[look] = (place[look] + 1) % (1 << BITS)
            at = self.keys[place[look]]
            look = look[(at != keys[look]) & (at >= 0)]
        return place

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """ids of words that PARTS has found, as little-endian bytes."""
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            raw = w.encode()
            by_length.setdefault(len(raw), []).append((w, raw))
        out: dict[str, bytes] = {}
        for n, group in by_length.items():
            for at in range(0, len(group), 1 + (1 << 18) // n):
                self._group(n, group[at : at + 1 + (1 << 18) // n], out)
        return out

    def _group(self, n: int, group: list[tuple[str, bytes]], out: dict[str, bytes]) -> None:
        raw = np.frombuffer(b"".join(r for _, r in group), np.uint8).reshape(-1, n)
        m = self.inner[raw]
        m[:, -1] = self.last[raw[:, -1]]
        who = np.arange(len(group))
        place = self.find(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(len(m), n - 1)
        while m.shape[1] > 1:
            ranks = self.ranks[place]
            best = ranks.argmin(axis=1)
            rows = np.arange(len(m))
            goes = ranks[rows, best] < _NONE
            if not goes.all():
                self._done(m[~goes], who[~goes], group, out)
                m, place, who, best = m[goes], place[goes], who[goes], best[goes]
                rows = rows[: len(m)]
                if not len(m):
                    return
            new = self.made[place[rows, best]].astype(np.int64)
            cols = np.arange(m.shape[1] - 1)
            m = np.where(cols < best[:, None], m[:, :-1], m[:, 1:])
            m[rows, best] = new
            if m.shape[1] == 1:
                break
            cols = cols[:-1]
            place = np.where(cols < best[:, None], place[:, :-1], place[:, 1:])
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < m.shape[1] - 1)
            place[left, best[left] - 1] = self.find(m[left, best[left] - 1], m[left, best[left]])
            place[right, best[right]] = self.find(m[right, best[right]], m[right, best[right] + 1])
        self._done(m, who, group, out)

    @staticmethod
    def _done(m: np.ndarray, who: np.ndarray, group: list[tuple[str, bytes]], out: dict[str, bytes]) -> None:
        ids, step = m.astype("<u4").tobytes(), 4 * m.shape[1]
        for i, w in enumerate(who.tolist()):
            out[group[w][0]] = ids[i * step : (i + 1) * step]


def parted(text: str) -> list[str]:
    """The parts of a text in turn; a word that holds an UNSAFE character is one part, after a zero."""
    if not UNSAFE.search(text):
        return PARTS.findall(text.lower())
    out = []
    for word in WORDS.findall(text):
        out += ["\0" + word] if UNSAFE.search(word) else PARTS.findall(word.lower())
    return out

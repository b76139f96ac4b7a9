"""Exact byte-pair encoding with a public vocabulary by backtracking over longest matches (problem 8).

One pass of an Aho-Corasick automaton over a piece gives the longest token that begins at each position. The
piece is then encoded from left to right: that token is taken if it is compatible with the token before it,
that is if the pair would come out of the merge rules as these two tokens; otherwise its next shorter prefix
token is tried, and when none is left the last token is given back. Compatibility is held in a table of the
pairs met so far, a bit per position marks dead ends, so the work is linear in the piece. Decoding reads a
byte buffer through an offset table.

Texts are cut where the public pattern always has a piece boundary, at each single blank between other
characters; the units between are encoded once and remembered as packed ids.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np

DIRECTORY = "/opt/tokenizers"
NAME = "byte_bpe_50k"
#: Units a worker remembers; the store is emptied when full, so memory is bounded whatever the corpus.
REMEMBERED = 200_000
#: Pairs of tokens whose compatibility a worker holds; emptied when full.
PAIRS = 1_000_000


def _class(*categories: str) -> str:
    """A character class of all code points of the Unicode categories, as ranges."""
    out, start, last = [], None, None
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) in categories:
            if last is not None and c == last + 1:
                last = c
                continue
            if start is not None:
                out.append((start, last))
            start = last = c
    if start is not None:
        out.append((start, last))
    return "".join(f"\\U{a:08x}-\\U{b:08x}" if b > a else f"\\U{a:08x}" for a, b in out)


@lru_cache(1)
def pattern() -> re.Pattern:
    """The public piece pattern: contractions, letters, numbers, other marks and blanks.

    Letters are word characters that are neither numbers nor connectors nor the few marks counted as words.
    """
    others = _class("Nl", "No")
    blank = r"\t-\r \x85\xa0  -     　"
    letter, number = rf"[^\W\d_{others}]", rf"[\d{others}]"
    mark = rf"(?:(?!{letter}|{number})[^{blank}])"
    return re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?{letter}+| ?{number}+| ?{mark}+|[{blank}]+(?![^{blank}])|[{blank}]+")


def _bytes_of_letters() -> dict[str, int]:
    """The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in plain}, 0
    for b in range(256):
        if chr(b) not in out or b not in plain:
            out[chr(256 + n)] = b
            n += 1
    return out


class Vocabulary:
    def __init__(self, directory: str = DIRECTORY, name: str = NAME) -> None:
        with open(os.path.join(directory, f"{name}.json"), encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = _bytes_of_letters()
        raw = {t: "".join(chr(letters[c]) for c in t) for t in model["vocab"] if all(c in letters for c in t)}
        ids = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        size = max(ids.values()) + 1
        self.text: list[str | None] = [None] * size  # latin-1 images of the bytes
        self.left, self.right = list(range(size)), list(range(size))
        self.order = [0] * size
        self.pairs: dict[tuple[int, int], int] = {}
        for c in letters:
            self.text[ids[c]] = raw[c]
        for n, (a, b) in enumerate(merges):
            t = ids[a + b]
            self.text[t] = raw[a + b]
            self.left[t], self.right[t] = ids[a], ids[b]
            self.pairs[ids[a], ids[b]] = t
            self.order[t] = n + 1
        self.ids = {x: i for i, x in enumerate(self.text) if x is not None}
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for x in self.ids:
            self.trie.add_word(x)
        self.trie.make_automaton()
        self.table: dict[int, bool] = {}
        self.prefix: dict[int, int] = {}
        buffer = [x or "" for x in self.text]
        self.buffer = "".join(buffer).encode("latin-1")
        self.offsets = np.concatenate(([0], np.cumsum([len(x) for x in buffer])))

    def _shorter(self, t: int) -> int:
        """The longest token that is a proper prefix of a token, or -1."""
        if (p := self.prefix.get(t)) is None:
            x = self.text[t][:-1]
            p = -1
            while x:
                if x in self.ids:
                    p = self.ids[x]
                    break
                x = x[:-1]
            self.prefix[t] = p
        return p

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merge rules leave ``a`` and ``b`` as two tokens when they follow each other, from the table."""
        pair = a << 20 | b
        if (known := self.table.get(pair)) is None:
            if len(self.table) >= PAIRS:
                self.table.clear()
            known = self.table[pair] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        order, left, right, pairs = self.order, self.left, self.right, self.pairs
        limit = 1 << 60
        while True:
            t = pairs.get((a, b))
            if t is not None and order[t] < limit:
                return False
            if order[a] > order[b]:
                limit = order[a]
                a = right[a]
            elif order[b] > 0:
                limit = order[b] + 1  # of two merges of one rank the left one comes first
                b = left[b]
            else:
                return True

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece given as the latin-1 image of its bytes."""
        if (whole := self.ids.get(piece)) is not None:
            return [whole]
        n = len(piece)
        ids, text = self.ids, self.text
        # matches come in the order of their ends, so the last one of a position is its longest; every byte is a token
        longest = [1] * n
        for end, size in self.trie.iter(piece):
            longest[end - size + 1] = size
        open_ = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        pos = 0
        t = ids[piece[: longest[0]]]
        while pos < n:
            last = out[-1] if out else -1
            while True:
                end = pos + len(text[t])
                if open_[end] and (last < 0 or self.compatible(last, t)):
                    out.append(t)
                    pos = end
                    if pos < n:
                        t = ids[piece[pos : pos + longest[pos]]]
                    break
                t = self._shorter(t)
                if t < 0:
                    open_[pos] = 0
                    t = out.pop()
                    pos -= len(text[t])
                    t = self._shorter(t)
                    while t < 0:
                        open_[pos] = 0
                        t = out.pop()
                        pos -= len(text[t])
                        t = self._shorter(t)
                    last = out[-1] if out else -1
        return out

    def decode(self, ids: list[int]) -> str:
        o, b = self.offsets, self.buffer
        return b"".join(b[o[i] : o[i + 1]] for i in ids).decode("utf-8", "replace")


@lru_cache(2)
def vocabulary(directory: str = DIRECTORY, name: str = NAME) -> Vocabulary:
    return Vocabulary(directory, name)


class _Units(dict):
    """Packed int32 ids of units already seen."""

    def __init__(self, v: Vocabulary) -> None:
        super().__init__()
        self.v, self.find = v, pattern().findall
        self.pieces: dict[str, list[int]] = {}

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids: list[int] = []
        known = self.pieces
        if len(known) >= REMEMBERED:
            known.clear()
        for p in self.find(unit):
            got = known.get(p)
            if got is None:
                got = self.v.encode_piece(p.encode("utf-8", "surrogatepass").decode("latin-1"))
                if len(p) <= 32:
                    known[p] = got
            ids += got
        packed = np.array(ids, np.int32).tobytes()
        if len(unit) <= 64:
            self[unit] = packed
        return packed


#: A blank beside another blank character: there the text isn't cut into units.
_ODD = re.compile(r" \s|\s ")


class Encoder:
    def __init__(self, directory: str = DIRECTORY, name: str = NAME) -> None:
        self.units = _Units(vocabulary(directory, name))

    def packed(self, text: str | None) -> bytes:
        """Ids of a text as int32 bytes; null and empty texts have no ids."""
        if not text:
            return b""
        get = self.units.__getitem__
        if _ODD.search(text) is None:
            return self._plain(text, get)
        out, at = [], 0
        # cut at blanks between two other characters only
        for m in _SAFE.finditer(text):
            out.append(get(text[at : m.start()]))
            at = m.start()
        out.append(get(text[at:]))
        return b"".join(out)

    @staticmethod
    def _plain(text: str, get) -> bytes:
        words = text.split(" ")
        first = words[0]
        head = get(first) if first else b""
        return head + b"".join([get(" " + w) for w in words[1:]])

    def ids(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


_SAFE = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(2)
def encoder(directory: str = DIRECTORY, name: str = NAME) -> Encoder:
    return Encoder(directory, name)

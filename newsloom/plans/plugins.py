"""Model plug-ins: translation, summary and embedding behind one protocol, with deterministic built-in defaults.

A plug-in is a picklable object; its model is loaded once in each Python worker by ``load`` and used on Arrow
batches by ``apply``. Rows whose model call fails come out null and are handled by the caller.
"""

from __future__ import annotations

import hashlib
import math
import re
import time
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X


class Plugin(Protocol):
    name: str
    kind: str

    def load(self) -> Any: ...

    def apply(self, model: Any, values: pd.Series) -> pd.Series: ...


_REGISTRY: dict[tuple[str, str], Plugin] = {}


def register(p: Plugin) -> Plugin:
    _REGISTRY[p.kind, p.name] = p
    return p


def get(kind: str, name: str = "default") -> Plugin:
    try:
        return _REGISTRY[kind, name]
    except KeyError:
        raise KeyError(f"no {kind} plug-in named {name}") from None


def call(p: Plugin, c: Column, returns: str, tries: int = 1, wait: float = 0.0) -> Column:
    """Column of a plug-in's results; the model is loaded once per worker and task stream.

    A batch that fails is done row by row; a row is tried ``tries`` times, ``wait`` seconds apart, and is null
    where all fail.
    """

    def one(model: Any, v: Any) -> Any:
        for n in range(tries):
            try:
                return p.apply(model, pd.Series([v])).iloc[0]
            except Exception:
                if wait and n + 1 < tries:
                    time.sleep(wait)
        return None

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = p.load()
        for s in batches:
            try:
                yield p.apply(model, s)
            except Exception:  # one bad row must not lose its batch
                yield pd.Series([one(model, v) for v in s])

    return run(c)


def translated(c: Column, first: str = "default", second: str | None = None) -> Column:
    """A chunk through the first translator, where that fails through the second, else ''."""
    out = [call(get("translate", first), c, "string")]
    if second is not None:
        out.append(call(get("translate", second), c, "string"))
    return F.coalesce(*out, F.lit(""))


def translated_remotely(c: Column, name: str = "default", most: int = 4000, tries: int = 3, wait: float = 2.0) -> Column:
    """A text through a remote translator in normalised chunks of at most ``most`` characters; a chunk that fails every try stays as it is.

    The chunks are parted by a blank line; null for null.
    """
    p = get("translate", name)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = p.load()

        def chunk(x: str) -> str:
            x = unicodedata.normalize("NFKC", x).strip()
            for n in range(tries):
                try:
                    return p.apply(model, pd.Series([x])).iloc[0]
                except Exception:
                    if wait and n + 1 < tries:
                        time.sleep(wait)
            return x

        for s in batches:
            yield s.map(lambda parts: None if parts is None else "\n\n".join(chunk(x) for x in parts))

    return run(X.smart_split(c, most))


def fetched(c: Column, name: str = "default", tries: int = 2, wait: float = 1.0) -> Column:
    """Page of each address through a fetcher plug-in; null where every try fails. The waits between tries double."""
    p = get("fetch", name)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = p.load()

        def page(url: str | None) -> str | None:
            for n in range(tries if url else 0):
                try:
                    return p.apply(model, pd.Series([url])).iloc[0]
                except Exception:
                    if wait and n + 1 < tries:
                        time.sleep(wait * 2**n)
            return None

        for s in batches:
            yield s.map(page)

    return run(c)


class Files:
    """Fetcher of pages kept as files: reads the path of a file address, and fails for any other."""

    name, kind = "default", "fetch"

    def load(self) -> None:
        return None

    def apply(self, model: None, values: pd.Series) -> pd.Series:
        def read(url: str) -> str:
            if not url.startswith("file://"):
                raise ValueError(f"no fetcher for {url}")
            with open(url[len("file://") :], "rb") as f:
                return f.read().decode("utf-8", "replace")

        return values.map(read)


def question_lines(c: Column, most: int = 3) -> Column:
    """Questions that a model wrote one to a line: without bullets and blanks, at most ``most``."""
    bare = F.transform(F.split(c, "\n"), lambda x: F.trim(F.regexp_replace(x, "^[- ]+|[- ]+$", "")))
    return F.slice(F.filter(bare, lambda x: x != ""), 1, most)


#: Tokens of a final summary at most, and the share of them that the parts of a cluster may use together (fixed values).
FINAL, PARTS_SHARE = 700, 0.35


def final_tokens(decoder: int) -> int:
    """Tokens of a final summary: as many as stated, at most what the decoder holds."""
    return min(FINAL, decoder)


def part_tokens(parts: int, final: int) -> int:
    """Tokens of the summary of each of a number of parts: its share of the final length, 60 to 220; 120 without parts."""
    return 120 if parts <= 0 else max(60, min(220, int(final * PARTS_SHARE) // parts))


def merge_tokens(total: int) -> tuple[int, int]:
    """Least and most tokens of a merged summary, by the tokens of what is merged."""
    return (500, 600) if total > 1000 else (200, 400)


def room(capacity: int, header: int, short_header: int) -> tuple[int, bool]:
    """Tokens left for sources beside a header, and whether the short header is taken: it is where the long one leaves less than 64."""
    left = capacity - header
    return (left, False) if left >= 64 else (max(64, capacity - short_header), True)


class Extract:
    """Extractive summariser: the sentences with the most weight for each word, in order, up to a number of tokens.

    A sentence weighs the logarithms of how often its words are in the text, over the root of its words. The first
    sentence taken may be longer than the number; null for null, '' for a text without sentences.
    """

    kind = "summarise"

    def __init__(self, name: str = "default", tokens: int = 400) -> None:
        self.name, self.tokens = name, tokens
        self.end, self.word, self.token = re.compile(r"(?<=[.!?।؟。！？])\s+"), re.compile(r"\w\w+"), re.compile(r"\w+|[^\w\s]")

    def load(self) -> None:
        return None

    def _one(self, text: str | None) -> str | None:
        if text is None:
            return None
        parts = [x for x in (y.strip() for y in self.end.split(text)) if x]
        words = [[w.lower() for w in self.word.findall(x)] for x in parts]
        counts = Counter(w for ws in words for w in ws)
        weight = [sum(math.log(counts[w]) for w in set(ws)) / math.sqrt(len(ws)) if ws else 0.0 for ws in words]
        kept, used = [], 0
        for i in sorted(range(len(parts)), key=lambda i: (-round(weight[i], 9), i)):
            n = len(self.token.findall(parts[i]))
            if kept and used + n > self.tokens:
                continue
            kept.append(i)
            used += n
            if used >= self.tokens:
                break
        return " ".join(parts[i] for i in sorted(kept))

    def apply(self, model: None, values: pd.Series) -> pd.Series:
        return values.map(self._one)


class Identity:
    """Stand-in translator: returns the text; null for null."""

    name, kind = "default", "translate"

    def load(self) -> None:
        return None

    def apply(self, model: None, values: pd.Series) -> pd.Series:
        return values


class HashedEmbedding:
    """Signed hashed word counts, log-damped, of unit length; a text without words gives null."""

    name, kind = "default", "embed"

    def __init__(self, size: int = 768) -> None:
        self.size = size
        self.word = re.compile(r"\w\w+")

    def load(self) -> None:
        return None

    def _one(self, text: str | None) -> list[float] | None:
        counts: dict[int, float] = {}
        for w in self.word.findall((text or "").lower()):
            h = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
            counts[h % self.size] = counts.get(h % self.size, 0.0) + (1.0 if h >> 63 else -1.0)
        v = {i: math.copysign(math.log1p(abs(x)), x) for i, x in counts.items() if x}
        length = math.sqrt(sum(x * x for x in v.values()))
        if not length:
            return None
        return [v.get(i, 0.0) / length for i in range(self.size)]

    def apply(self, model: None, values: pd.Series) -> pd.Series:
        return values.map(self._one)


register(Identity())
register(Files())
register(Extract())
register(Extract("merge", merge_tokens(0)[1]))
register(HashedEmbedding())

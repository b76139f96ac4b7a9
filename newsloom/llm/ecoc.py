"""Language identification by error-correcting output codes over hashed character n-grams (problem 2).

Every language has a codeword of ``BITS`` bits; for each bit one binary n-gram classifier (smoothed log-odds
of hashed trigrams and tetragrams) says how a text leans. Decoding weighs each bit's logistic loss by the
bit's accuracy on the sample and takes the nearest codeword; the gap to the second nearest gives the
confidence, and a small gap flags the text as ambiguous.

Labels of the sample may be wrong in places: after a first fit the sample lines are relabelled where the
decoder is sure, and the classifiers are fitted once more.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np

BITS = 15
BUCKETS = 1 << 15
AMBIGUOUS = 0.6
FIRST = 3
RELABEL = 0.5
FIRM = 3
EPOCHS = 6
STEP = 0.2
_PIECE = 1 << 19


@cache
def letter_table() -> np.ndarray:
    """Code point to folded letter; everything but letters is a space."""
    t = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            t[c] = ord(low) if len(low) == 1 else c
    return t


def codewords(k: int) -> np.ndarray:
    """k rows of +-1: the best of a fixed number of seeded draws of distinct, balanced columns."""
    rng = np.random.default_rng(7)
    best, most = None, (-1, -1.0)
    for _ in range(400):
        cols: set[tuple[int, ...]] = set()
        while len(cols) < min(BITS, 2 ** (k - 1) - 1):
            c = rng.integers(0, 2, k)
            if 0 < c.sum() < k:
                c = c if c[0] else 1 - c
                cols.add(tuple(int(x) for x in c))
        m = np.array(sorted(cols)).T * 2 - 1
        d = np.array([(m[i] != m[j]).sum() for i in range(k) for j in range(i)])
        if (score := (d.min(initial=99), float(d.mean()) if len(d) else 0.0)) > most:
            best, most = m, score
    return best.astype(np.float32)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams and tetragrams of all texts in one array each, and where each text begins."""
    joined = "\n\n\n\n".join(texts) + "\n\n\n\n"
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = letter_table()[np.minimum(c, 0xFFFF)]
    sizes = np.fromiter((len(t) + 4 for t in texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    with np.errstate(over="ignore"):
        a, b, d, e = (c * np.uint32(2654435761))[:-3], (c * np.uint32(2246822519))[1:-2], (c * np.uint32(3266489917))[2:-1], (c * np.uint32(668265263))[3:]
        tri = (a ^ (b << np.uint32(5)) ^ (d >> np.uint32(3))) * np.uint32(2654435761) >> np.uint32(17)
        tet = (a ^ (b << np.uint32(3)) ^ (d >> np.uint32(2)) ^ (e << np.uint32(7))) * np.uint32(2246822519) >> np.uint32(17)
    blank = (c[1:-2] == 32) & (c[:-3] == 32) | (c[1:-2] == 32) & (c[2:-1] == 32)
    tri[blank] = 0
    tet[blank] = 0
    return tri.astype(np.int32), tet.astype(np.int32), starts


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray  # (2, bits, BUCKETS)
    trust: np.ndarray  # (bits,)

    def margins(self, texts: list[str]) -> np.ndarray:
        """Mean log-odds of each text for each bit, times the root of its length in grams."""
        out = np.zeros((len(texts), self.codes.shape[1]), np.float32)
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) < _PIECE):
                size += len(texts[end]) + 4
                end += 1
            tri, tet, starts = grams(texts[at:end])
            root = np.sqrt(np.maximum(np.add.reduceat((tri != 0).astype(np.int32), starts), 1))
            for b in range(out.shape[1]):  # bit by bit: one-dimensional gathers and sums stay in cache
                v = self.weights[0, b][tri]
                v += self.weights[1, b][tet]
                out[at:end, b] = np.add.reduceat(v, starts) / root
            at = end
        return out

    def decode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language of each text and its confidence in 0..1; texts without letters get -1 and 0."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        return self.nearest(self.margins(texts))

    def nearest(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Loss-weighted decoding of margins: the nearest codeword and how far the second is behind."""
        soft = np.logaddexp(0, -np.abs(m))  # log(1 + exp(-m)) for either sign of m
        gain = np.maximum(-m, 0) + soft
        pain = np.maximum(m, 0) + soft
        plus = (self.codes > 0).astype(np.float32) * self.trust
        minus = (self.codes < 0).astype(np.float32) * self.trust
        loss = (gain @ plus.T + pain @ minus.T) / self.trust.sum()
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(m))
        best = order[:, 0]
        gap = loss[rows, order[:, 1]] - loss[rows, best] if loss.shape[1] > 1 else np.ones(len(m))
        sure = 1 - np.exp(-2 * gap)
        none = np.abs(m).sum(1) == 0
        return np.where(none, -1, best), np.where(none, 0, sure).astype(np.float32)


def _count(texts: list[str], labels: np.ndarray, k: int) -> np.ndarray:
    counts = np.zeros((2, k, BUCKETS), np.float64)
    for lang in range(k):
        own = [t for t, x in zip(texts, labels) if x == lang]
        at = 0
        while at < len(own):
            size, end = 0, at
            while end < len(own) and (end == at or size < _PIECE):
                size += len(own[end])
                end += 1
            tri, tet, _ = grams(own[at:end])
            counts[0, lang] += np.bincount(tri, minlength=BUCKETS)
            counts[1, lang] += np.bincount(tet, minlength=BUCKETS)
            at = end
    counts[:, :, 0] = 0
    return counts


def _from_counts(counts: np.ndarray, languages: list[str], codes: np.ndarray) -> Model:
    # languages weigh alike whatever their share in the sample
    rate = counts / np.maximum(counts.sum(2, keepdims=True), 1)
    floor = 2e-6
    w = np.zeros((2, codes.shape[1], BUCKETS), np.float32)
    for b in range(codes.shape[1]):
        one, two = codes[:, b] > 0, codes[:, b] < 0
        w[:, b] = np.log((rate[:, one].mean(1) + floor) / (rate[:, two].mean(1) + floor))
    w[:, :, 0] = 0
    return Model(languages, codes, w, np.ones(codes.shape[1], np.float32))


def _by_bucket(h: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of the grams sorted by bucket, where each bucket begins, and the buckets."""
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    begins = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    return text_of[order], begins, ranked[begins]


def _runs(begins: np.ndarray, total: int) -> list[tuple[int, int]]:
    """Runs of whole groups of about _PIECE / 4 grams, to bound what is gathered at once."""
    out, first = [], 0
    while first < len(begins):
        last = max(int(np.searchsorted(begins, begins[first] + _PIECE // 4, "right")) - 1, first + 1) if begins[first] + _PIECE // 4 < total else len(begins)
        out.append((first, last))
        first = last
    return out


def fit(texts: list[str], labels: list[str | None], languages: list[str], votes: list[int] | None = None) -> Model:
    """Fit on a bounded sample of labelled texts; labels outside ``languages`` count as unknown.

    Log-odds of counts start each bit's classifier; ``EPOCHS`` full steps of logistic regression with
    per-weight step sizes then sharpen it. A short first fit only serves to correct labels, unless ``votes``
    says that several pages agree on a text's; such texts also pull more.
    """
    index = {x: i for i, x in enumerate(languages)}
    y = np.array([index.get(x, -1) for x in labels], np.int64) if labels else np.zeros(0, np.int64)
    codes, k = codewords(len(languages)), len(languages)
    model = _from_counts(_count(texts, y, k), languages, codes)
    if not texts:
        return model
    tri, tet, starts = grams(texts)
    sizes = np.diff(np.append(starts, len(tri)))
    root = np.sqrt(np.maximum(np.add.reduceat((tri != 0).astype(np.int32), starts), 1)).astype(np.float32)
    bits = codes.shape[1]
    agreed = np.ones(len(texts)) if votes is None else np.array(votes, np.float64)
    heft, firm = (1 + np.log(agreed)).astype(np.float32), agreed >= FIRM
    margins = np.zeros((len(texts), bits), np.float32)
    # all bits of a gram lie side by side, so one gather serves them all; grams are sorted by bucket once for the way back
    w = np.ascontiguousarray(model.weights.transpose(0, 2, 1))
    grown = np.full_like(w, 1e-3)
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    back = [_by_bucket(h, text_of) for h in (tri, tet)]
    cuts = _runs(starts, len(tri))

    def forward() -> None:
        for first, last in cuts:
            a, b = starts[first], starts[last] if last < len(starts) else len(tri)
            margins[first:last] = np.add.reduceat(w[0][tri[a:b]] + w[1][tet[a:b]], starts[first:last] - a, axis=0) / root[first:last, None]

    # a short first fit finds wrong labels: texts it reads otherwise take its label, if only a page or two spoke for theirs
    for epoch in range(FIRST + EPOCHS):
        if epoch in (0, FIRST):
            if epoch:
                got, sure = model.nearest(margins)
                y = np.where(firm | (sure < RELABEL), y, got)
                w = np.ascontiguousarray(_from_counts(_count(texts, y, k), languages, codes).weights.transpose(0, 2, 1))
                grown[:] = 1e-3
            forward()
        target = codes[np.maximum(y, 0)]
        pull = (target / (1 + np.exp(np.clip(target * margins, -30, 30))) * ((y >= 0) * heft / root)[:, None]).astype(np.float32)
        for t, (texts_of, begins, buckets) in enumerate(back):
            for first, last in _runs(begins, len(texts_of)):
                a, b = begins[first], begins[last] if last < len(begins) else len(texts_of)
                g = np.add.reduceat(pull[texts_of[a:b]], begins[first:last] - a, axis=0)
                own = buckets[first:last]
                g[own == 0] = 0
                grown[t, own] += g * g
                w[t, own] += STEP * g / np.sqrt(grown[t, own])
        forward()
    model.weights = np.ascontiguousarray(w.transpose(0, 2, 1))
    known = y >= 0
    right = ((margins[known] * codes[y[known]]) > 0).mean(0) if known.any() else np.full(bits, 0.5)
    model.trust = np.clip(np.log((right + 0.01) / (1.01 - right)), 0.1, 4).astype(np.float32)
    return model

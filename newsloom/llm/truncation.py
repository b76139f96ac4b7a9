"""Texts cut off by field limits (problem 10): a backward character n-gram model of where lines end.

The model is fitted on all texts (``endcounts``), whose names and figures are masked. For contexts of several
lengths, read backwards from a position, it holds how often a line ended there and how often it went on; the
state of the line, whether a whole sentence already stands on it, is part of every context. The log-odds of
ending, against the rate at which a random position is an end, tell a written end from a cut: a cut falls at
any place, so its context is one after which lines go on. A text is cut if the log-odds of its final context
are below a threshold, which is set for each language and column at the emptiest place between the two kinds
of ends over all rows.

What a writer's end looks like is learned from the line ends inside texts and from titles, which no cut has
touched; the ends of texts join in a second step, if the first reads them as written or if their last line
ends several texts in the same way and never goes on (sign-offs).

Signs of omission that feeds append are taken off first; what counts is the context before them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, shared

#: Bounds of ``sample``: rows, and the longest text taken whole.
SAMPLE_ROWS, SAMPLE_CHARS = 4000, 20_000
ORDERS = (1, 2, 3, 4, 5, 6, 8, 12, 18)
#: Weight of the next shorter context in each interpolation step.
PRIOR = 3.0
#: Contexts of four characters and more that never ended a line are held from so many passes on.
HELD = 5
#: Texts that must end alike for their last line to count as a sign-off: so many, and as large a share as these of ALIKE_OF texts,
#: since cuts at one place grow with the table as sign-offs do.
ALIKE, ALIKE_OF = 3, 4000
#: Width of a histogram bin of scores, and rows of all languages that each language's histogram borrows.
BIN, BORROWED = 0.25, 200.0

_SIGN = re.compile(
    r"(?:\s*(?:\[\s*(?:…|\.\.\.|\+\s?\d+\s+\w+)\s*\]|\(\s*(?:more|mehr|suite|más|altro|mais|далее|\.\.\.|…)\s*\)|(?:…|\.\.\.)\s*(?:Read more|Continue reading|Weiterlesen|Lire la suite|Leer más|Continua|Ler mais|Читать далее|阅读全文)?|(?<=\s)Read more))+\s*$"
)
_NAME = re.compile(r"[A-ZÀ-ÖØ-ÞА-ЯЁ][\w’'-]*(?: (?=[A-ZÀ-ÖØ-ÞА-ЯЁ])[\w’'-]+)*")
_LATIN = re.compile(r"[A-Za-z][A-Za-z' -]*[A-Za-z]|[A-Za-z]")
_DIGITS = re.compile(r"\d+(?:[.,:/-]\d+)*")
_SPACES = re.compile(r" [^\S\n]+|[^\S\n ][^\S\n]*")  # all but single blanks
_CJK = re.compile(r"[㐀-鿿]")
#: The end of a sentence with more after it on the same line.
_INNER_END = re.compile(r"(?:[.!?]['\"”’»“)\]]{0,3} +(?=\S)|[。！？][”’」』]{0,3}(?=\S))")
_LEAST_SENTENCE = 25
_OPEN_TAG, _OPEN_ENTITY = re.compile(r"<[A-Za-z/!][^<>]*$"), re.compile(r"&#?\w{0,7}$")
#: Characters of a last line that are masked; the state is read from the whole line.
_TAIL = 3000


def mask(text: str, cjk: bool | None = None) -> str:
    """Names as X, digit runs as 0, blanks as one space; in CJK text, which the caller may know of, every Latin word is a name."""
    text = _SPACES.sub(" ", _DIGITS.sub("0", text))
    return _LATIN.sub("X", text) if (bool(_CJK.search(text)) if cjk is None else cjk) else _NAME.sub("X", text)


def without_sign(text: str) -> tuple[str, bool]:
    """A text without the signs of omission at its end, and whether there was one."""
    t = text.rstrip()
    cut = _SIGN.search(t[-80:])
    return (t[: len(t) - (len(t[-80:]) - cut.start())], True) if cut else (t, False)


def _after_sentence(line: str) -> int:
    """Position in a line from which a whole sentence stands before it; beyond the line if there is none."""
    for m in _INNER_END.finditer(line):
        if m.start() >= _LEAST_SENTENCE:
            return m.end()
    return len(line) + 1


def ending(text: str) -> tuple[str, int, bool]:
    """Masked final context of a text without signs of omission, the state of its last line, and whether there was a sign.

    An open tag or entity counts as its first character.
    """
    t, sign = without_sign(text)
    last = t.rsplit("\n", 1)[-1].strip()
    short = mask(last[-_TAIL:]).strip()
    state = int(_after_sentence(short if len(last) <= _TAIL else last) <= len(short if len(last) <= _TAIL else last))
    return context(short, len(last) <= _TAIL), state, sign


def context(line: str, whole: bool = True) -> str:
    """Final context of a masked line, or of its end."""
    short = _OPEN_ENTITY.sub("&", _OPEN_TAG.sub("<", line))
    return (("\n" if whole else "") + short)[-ORDERS[-1] :]


def alike_from(texts: int) -> float:
    """How many of so many texts must end alike."""
    return max(ALIKE, ALIKE * texts / ALIKE_OF)


def language_key(lang: str | None) -> str:
    s = (lang or "").strip().lower()
    return re.split(r"[-_]", s)[0] if s else "und"


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(codes: np.ndarray, state: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each order the 64-bit hash of the characters that end at each position and of the state there; one growing hash serves all orders."""
    h = (state.astype(np.uint64) + np.uint64(1)) << np.uint64(40)  # above all characters, so states never meet
    wide = codes.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(ORDERS[-1]):
            if j < len(wide):
                h[j:] = (h[j:] ^ wide[: len(wide) - j]) * np.uint64(0x9E3779B97F4A7C15)
                h[j:] ^= h[j:] >> np.uint64(29)
            if j + 1 in ORDERS:
                yield j + 1, h


@dataclass
class EndModel:
    """For each order the hashed contexts, sorted, and how many lines ended there and went on."""

    keys: dict[int, np.ndarray]
    ends: dict[int, np.ndarray]
    passed: dict[int, np.ndarray]
    base: float
    rare: float
    counted: frozenset[int] = frozenset()
    thresholds: dict[tuple[str, str], float] = field(default_factory=dict)

    def log_odds(self, texts: list[str]) -> np.ndarray:
        """Log of how much likelier than at a random place a line ends after the final context of each text.

        Longer contexts refine shorter ones: p_k = (ends_k + PRIOR p_(k-1)) / (all_k + PRIOR); an unknown last
        character takes the rate of rare ones. A text whose own end was counted doesn't speak for itself.
        """
        tails = [ending(t) for t in texts]
        own = np.array([hash_of(t) in self.counted for t in texts], np.int64)
        return self.score([c for c, _, _ in tails], np.array([s for _, s, _ in tails], np.int64), own)

    def score(self, contexts: list[str], states: np.ndarray, own: np.ndarray) -> np.ndarray:
        if not contexts:
            return np.zeros(0)
        joined = _codes("".join(contexts))
        last = np.cumsum([len(c) for c in contexts]) - 1
        sizes = np.array([len(c) for c in contexts])
        at_all = np.zeros(len(joined), np.int64)
        at_all[last] = states
        p, going = np.full(len(contexts), self.base), np.ones(len(contexts), bool)
        for k, h in _hashes(joined, at_all):
            keys = self.keys[k]
            found = going & (sizes >= k)
            if not len(keys):
                break
            want = h[last]
            i = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = found & (keys[i] == want)
            if k == 1:
                p[found & ~hit] = self.rare
            p = refined(p, hit, self.ends[k][i] - own, self.passed[k][i])
            going = hit
        return np.log(p / self.base)

    def is_cut(self, text: str, lang: str | None = None, column: str = "text") -> tuple[bool, float]:
        """Whether one text was cut, and its log-odds of ending."""
        if not without_sign(text)[0].strip():
            return False, 0.0
        s = float(self.log_odds([text])[0])
        return s < self.thresholds.get((column, language_key(lang)), self.thresholds.get((column, ""), 0.0)), s


def refined(p: np.ndarray, hit: np.ndarray, ends: np.ndarray, passed: np.ndarray) -> np.ndarray:
    """One interpolation step: the rate of a longer context where it is known."""
    e = np.maximum(ends, 0)
    return np.where(hit, (e + PRIOR * p) / (e + passed + PRIOR), p)


def hash_of(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def positions(lines: list[str]) -> tuple[np.ndarray, ...]:
    """Characters of all lines, each after a line feed; size and last position of each line; place, state and neutrality of each position."""
    joined = "".join("\n" + x for x in lines)
    codes = _codes(joined)
    sizes = np.array([len(x) + 1 for x in lines], np.int64)
    last = np.cumsum(sizes) - 1
    first = last - sizes + 1
    found = [m.span() for m in _INNER_END.finditer(joined)]
    begin, end = np.array([a for a, _ in found], np.int64), np.array([b for _, b in found], np.int64)
    # a cut behind a whole sentence leaves no trace, so going on there says nothing
    neutral = _covered(len(codes), begin, end)
    line = np.searchsorted(first, begin, "right") - 1
    long = begin - first[line] > _LEAST_SENTENCE if len(found) else np.zeros(0, bool)
    of, i = np.unique(line[long], return_index=True)
    state = _covered(len(codes), end[long][i] - 1, last[of] + 1).astype(np.int8)
    place = np.arange(len(codes)) - np.repeat(first, sizes)  # 0 for the line feed
    return codes, sizes, last, place, state, neutral


def _covered(n: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n positions are in one of the ranges."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, begin, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:n]) > 0


def fit(rows: list[tuple[str, str | None]]) -> EndModel:
    """Model from (text, title) rows held in memory; equal texts count once. ``endcounts`` fits the same on a whole table."""
    seen: dict[str, str | None] = {}
    for text, title in rows:
        seen.setdefault(text, title)
    lines: list[str] = []
    whole: list[bool] = []  # its end is known to be a line end
    text_of: list[int] = []
    texts = list(seen)
    for n, text in enumerate(texts):
        t, sign = without_sign(text)
        own = [x.strip() for x in mask(t).split("\n")]
        for i, x in enumerate(own):
            if x:
                lines.append(x)
                whole.append(i < len(own) - 1)
                text_of.append(n if i == len(own) - 1 and not sign else -1)
        if seen[text] and seen[text].strip():
            lines.append(mask(seen[text].strip()))
            whole.append(True)
            text_of.append(-1)
    codes, sizes, last, place, state, neutral = positions(lines)
    known = np.array(whole, bool)
    is_end = np.zeros(len(codes), np.int8)  # 1 a line end, 2 the end of a text
    is_end[last] = np.where(known, 1, 2)
    keys, ends, passed, finals, hashed = {}, {}, {}, {}, {}
    open_ = last[~known] if len(lines) else np.zeros(0, np.int64)
    for k, h in _hashes(codes, state):
        ok = (place >= max(k - 1, 1)) & ~neutral
        keys[k], n = np.unique(h[ok], return_counts=True)
        of = lambda mark: _counts(keys[k], h[ok & (is_end == mark)])  # noqa: B023, E731
        ends[k], finals[k] = of(1), of(2)
        passed[k] = n - ends[k] - finals[k]
        hashed[k] = np.where(place[open_] >= max(k - 1, 1), h[open_], np.uint64(0))
    total = max(len(codes) - len(lines) - int(neutral.sum()), 1)
    base = max(int(known.sum()), 1) / total
    model = EndModel(keys, ends, passed, base, _rare(ends, passed))
    # the ends of texts: read as written by the first model, or as sign-offs that recur and never go on
    final_texts = np.array([text_of[i] for i in np.flatnonzero(~known)], np.int64)
    mine = np.flatnonzero(final_texts >= 0)
    if len(mine):
        tails = [ending(texts[final_texts[j]]) for j in mine]
        scores = model.score([c for c, _, _ in tails], np.array([s for _, s, _ in tails]), np.zeros(len(mine), np.int64))
        start = valley(*histogram(scores))
        alike, least = np.zeros(len(mine), bool), alike_from(int((~known).sum()))
        for k in ORDERS:
            reach = (hashed[k][mine] != 0) & ((sizes[~known][mine] == k) | (k == ORDERS[-1]))
            i = np.minimum(np.searchsorted(keys[k], hashed[k][mine]), max(len(keys[k]) - 1, 0))
            alike |= reach & (finals[k][i] >= least) & (passed[k][i] < finals[k][i])
        for size in set(sizes[~known][mine].tolist()) - set(ORDERS):  # whole lines between two orders
            k = max((k for k in ORDERS if k <= size), default=1)
            reach = (sizes[~known][mine] == size) & (size < ORDERS[-1]) & (hashed[k][mine] != 0)
            i = np.minimum(np.searchsorted(keys[k], hashed[k][mine]), len(keys[k]) - 1)
            alike |= reach & (finals[k][i] >= least) & (passed[k][i] < finals[k][i])
        taken = mine[(scores >= start) | alike]
        for k in ORDERS:
            h = hashed[k][taken]
            ends[k] = ends[k] + _counts(keys[k], h[h != 0])
        model.counted = frozenset(hash_of(texts[final_texts[j]]) for j in taken)
    for k in ORDERS:
        keep = (ends[k] > 0) | (passed[k] >= HELD) | (k <= 3)
        model.keys[k], model.ends[k], model.passed[k] = keys[k][keep], ends[k][keep].astype(np.int32), passed[k][keep].astype(np.int32)
    model.rare = _rare(model.ends, model.passed)
    return model


def _counts(keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How often each of the sorted keys is among the hashes."""
    if not len(keys):
        return np.zeros(0, np.int64)
    i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.bincount(i[keys[i] == h], minlength=len(keys))


def _rare(ends: dict[int, np.ndarray], passed: dict[int, np.ndarray]) -> float:
    """Rate at which lines end after characters seen at most 20 times."""
    few = ends[1] + passed[1] <= 20
    return (float(ends[1][few].sum()) + 0.01) / (float((ends[1] + passed[1])[few].sum()) + 1)


# thresholds


def histogram(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bins, counts) of scores; bin b holds scores from b * BIN on."""
    return np.unique(np.floor(np.asarray(scores) / BIN).astype(np.int64), return_counts=True)


def valley(bins: np.ndarray, counts: np.ndarray) -> float:
    """The emptiest place between even odds (0) and the most frequent written end; of equal places the middle of the widest."""
    up = bins >= 0
    if not up.any():
        return 0.0
    high = int(bins[up][np.argmax(counts[up])])
    dense = np.zeros(high + 3)
    inside = (bins >= 0) & (bins <= high + 1)
    np.add.at(dense, bins[inside] + 1, counts[inside])
    smooth = np.convolve(dense, [0.25, 0.5, 0.25], "same")[1 : high + 1]
    if not len(smooth):
        return 0.0
    low = np.flatnonzero(smooth <= smooth.min() + 1e-9)
    runs = np.split(low, np.flatnonzero(np.diff(low) > 1) + 1)
    run = max(runs, key=lambda r: (len(r), r[0]))
    return float((run[0] + run[-1] + 1) / 2 * BIN)


def thresholds(counts: dict[tuple[str, str], dict[int, int]]) -> dict[tuple[str, str], float]:
    """Threshold of each (column, language) from histograms over all rows.

    Each language's histogram is joined by that of its column scaled to BORROWED rows, so a language with few
    rows lies near the threshold of all and moves to its own as its rows grow. ("column", "") is that of all.
    """
    whole: dict[str, dict[int, float]] = {}
    for (column, _), h in counts.items():
        for b, n in h.items():
            whole.setdefault(column, {})[b] = whole.get(column, {}).get(b, 0) + n
    out = {}
    for column, h in whole.items():
        out[column, ""] = valley(np.array(sorted(h)), np.array([h[b] for b in sorted(h)], np.float64))
    for (column, lang), h in counts.items():
        scale = BORROWED / sum(whole[column].values())
        joined = {b: h.get(b, 0) + scale * n for b, n in whole[column].items()}
        out[column, lang] = valley(np.array(sorted(joined)), np.array([joined[b] for b in sorted(joined)]))
    return out


# Spark


def sample(documents: DataFrame, key: str = "doc_id", text: str = "text", title: str | None = "title") -> list[tuple[str, str | None]]:
    """About SAMPLE_ROWS (text, title) of texts of at most SAMPLE_CHARS characters, taken by hash of the key, for models held in memory; no query uses it."""
    name = F.col(title) if title else F.lit(None).cast("string")
    texts = documents.select(F.col(key).alias("k"), F.col(text).alias("t"), name.alias("l")).where((F.length(F.trim("t")) > 0) & (F.length("t") <= SAMPLE_CHARS))
    rows = sorted(bounded_sample(texts, "k", SAMPLE_ROWS).collect(), key=lambda r: (str(r.k), r.t))
    return [(r.t, r.l) for r in rows]


def scored(documents: DataFrame, models: dict[str, EndModel], key: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """(doc_id, source, column, language, score) for each row and each column that has a model; null, empty and blank texts have a null score."""
    columns = list(models)
    held = documents.sparkSession.sparkContext.broadcast(models)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = [language_key(x) for x in b.column(2).to_pylist()]
            for n, c in enumerate(columns):
                texts = b.column(3 + n).to_pylist()
                rows = [i for i, t in enumerate(texts) if t is not None and t.strip() and without_sign(t)[0].strip()]
                score = np.full(len(texts), np.nan)
                score[rows] = held.value[c].log_odds([texts[i] for i in rows])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([c] * len(texts), pa.string()), pa.array(langs, pa.string()), pa.array(score, pa.float64(), from_pandas=True)],
                    names=["doc_id", "source", "column", "language", "score"],
                )

    wanted = [F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("_lang"), *[F.col(c).alias(f"_t{n}") for n, c in enumerate(columns)]]
    return documents.select(*wanted).mapInArrow(run, f"doc_id {kind}, source string, column string, language string, score double")


def truncated(documents: DataFrame, models: dict[str, EndModel], **columns: str) -> DataFrame:
    """(doc_id, source, column, truncated, score): whether each text was cut.

    Null, empty and blank texts are not truncated and have a null score.
    """
    found, limits = decided(scored(documents, models, **columns))
    for name, m in models.items():
        m.thresholds = {k: v for k, v in limits.items() if k[0] == name}
    return found


def decided(rows: DataFrame) -> tuple[DataFrame, dict[tuple[str, str], float]]:
    """Scored rows with ``truncated`` in place of their language, and the thresholds.

    The scores are written to the shared folder once; the thresholds come from histograms over all of them
    (a few bins for each column and language), so every row takes part.
    """
    rows = shared(rows)
    bins = rows.where("score is not null").groupBy("column", "language", F.floor(F.col("score") / BIN).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    counts: dict[tuple[str, str], dict[int, int]] = {}
    for r in bins.collect():
        counts.setdefault((r.column, r.language), {})[r.bin] = r.n
    found = thresholds(counts)
    limit = F.lit(0.0)
    if found:
        by = F.create_map(*[F.lit(x) for (c, lang), t in found.items() for x in (f"{c}\x1f{lang}", t)])
        limit = F.coalesce(by[F.concat_ws("\x1f", "column", "language")], by[F.concat("column", F.lit("\x1f"))], F.lit(0.0))
    return rows.select("doc_id", "source", "column", F.coalesce(F.col("score") < limit, F.lit(False)).alias("truncated"), "score"), found


def share_by_source(found: DataFrame) -> DataFrame:
    """How often each source cuts: texts, truncated ones and their share. Sources of only blank texts have a null share."""
    return found.groupBy("source").agg(
        F.count("score").alias("n_texts"), F.sum(F.col("truncated").cast("long")).alias("n_truncated"),
    ).withColumn("share", F.round(F.col("n_truncated") / F.nullif(F.col("n_texts"), F.lit(0)), 6))

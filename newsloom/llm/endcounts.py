"""Problem 10 on whole tables: the model of ``truncation.fit``, counted over every text in tasks.

Only contexts that end some text are ever looked up, so only they are counted. The ends of all texts are read
first; they fall into classes of equal context, and a bitmap of the classes' hashed contexts goes to the tasks
that then read every position of every text and title and count those the bitmap lets through. What it lets
through by chance is counted too and never looked up, so the counts are exact whatever its size. Counts, the
second step of the fit and the scores are joins and sums over (order, hash) and classes; the driver sees the
characters of order one, histograms and the bitmap.

Equal texts count once: each of n copies is counted with weight n, and the sums of a weight are divided by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import truncation as C
from .common import shared
from .truncation import ORDERS

COLUMN = "text"
#: Characters counted at once, and rows of counts that a task holds before it hands them on.
CHARS, HELD_ROWS = 1 << 20, 2_000_000
#: Bits of the bitmap for each context, and the powers of two that bound it (512 KB to 128 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 22, 30
#: Bits of one piece of the bitmap, as a power of two up to LEAST_BITS.
PIECE = 19
#: Repeated texts that are broadcast; more are joined by shuffle.
BROADCAST_REPEATS = 500_000

_COUNTS = "k tinyint, h long, w long, ends long, passed long, finals long"
_EMPTY = np.zeros(0, np.int64)


# classes of text ends


def class_of(text: str) -> str | None:
    """Everything that a text's end has part in the fit and the score by: its context and state as looked up and as counted, the sign, and the size of its last line."""
    t, sign = C.without_sign(text)
    if not t.strip():
        return None
    last = t.rsplit("\n", 1)[-1]
    cjk = bool(C._CJK.search(t))
    line = C.mask(last, cjk).strip()
    counted, after = ("\n" + line)[-ORDERS[-1] :], int(C._after_sentence(line) <= len(line))
    if len(last.strip()) <= C._TAIL and (not cjk or C._CJK.search(last)):  # masked alike
        ctx, state = C.context(line), after
    else:
        ctx, state, _ = C.ending(text)
    flags = state | sign << 1 | after << 2
    return chr(48 + flags) + chr(48 + min(len(line) + 1, ORDERS[-1] + 1)) + chr(48 + len(ctx)) + ctx + ("" if counted == ctx else counted)


class _Classes:
    """A batch of classes as arrays; for each of them hashed contexts as looked up and as counted."""

    def __init__(self, names: list[str]):
        flags = np.array([ord(x[0]) - 48 for x in names], np.int64)
        self.state, self.sign, self.after = flags & 1, (flags >> 1 & 1).astype(bool), flags >> 2 & 1
        self.size = np.array([ord(x[1]) - 48 for x in names], np.int64)
        split = [3 + ord(x[2]) - 48 for x in names]
        self.ctx = [x[3:n] for x, n in zip(names, split)]
        self.counted = [x[n:] or x[3:n] for x, n in zip(names, split)]

    def hashed(self, counted: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each order the classes that reach it and their hashes."""
        texts, states = (self.counted, self.after) if counted else (self.ctx, self.state)
        if not texts:
            return
        sizes = np.array([len(x) for x in texts])
        codes = C._codes("".join(texts))
        last = np.cumsum(sizes) - 1
        at_all = np.zeros(len(codes), np.int64)
        at_all[last] = states
        for k, h in C._hashes(codes, at_all):
            of = np.flatnonzero(sizes >= max(k, 2 if counted else 1))
            yield k, of, h[last[of]]

    def alike_order(self) -> np.ndarray:
        """The order at which texts ending alike are told: the longest that the last line reaches."""
        return np.array(ORDERS)[np.searchsorted(ORDERS, np.minimum(self.size, ORDERS[-1]), "right") - 1]


def ends(documents: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    """(doc_id, source, language, d1, d2, cls) of each row; rows without a text have a null class."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [class_of(x) if x is not None and x.strip() else None for x in b.column("t").to_pylist()]
            langs = [C.language_key(x) for x in b.column("l").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(langs, pa.string()), *b.columns[2:4], pa.array(names, pa.string())], names=["doc_id", "source", "language", "d1", "d2", "cls"])

    wanted = documents.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), *_digest(text), F.col(lang).cast("string").alias("l"), F.col(text).alias("t"))
    return wanted.mapInArrow(run, f"doc_id {kind}, source string, language string, d1 long, d2 int, cls string")


def _digest(text: str) -> list:
    return [F.xxhash64(text).alias("d1"), F.hash(text).alias("d2")]


# bitmap of the contexts


def bitmap(classes: DataFrame, bits: int) -> np.ndarray:
    """One bit for each slot that a context of a class falls into, made in pieces by tasks."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = _Classes(b.column(0).to_pylist())
            all_ = [h >> np.uint64(64 - bits) for counted in (False, True) for _, _, h in c.hashed(counted)]
            s = np.unique(np.concatenate(all_)).astype(np.int64) if all_ else _EMPTY
            yield pa.RecordBatch.from_arrays([pa.array(s >> PIECE), pa.array(s)], names=["piece", "slot"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            piece, slot = b.column(0).to_numpy(), b.column(1).to_numpy()
            for p in np.unique(piece).tolist():
                own = slot[piece == p] & ((1 << PIECE) - 1)
                np.bitwise_or.at(held.setdefault(p, np.zeros(1 << PIECE - 3, np.uint8)), own >> 3, np.left_shift(1, own & 7).astype(np.uint8))
        for p, x in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([x.tobytes()], pa.binary())], names=["piece", "bytes"])

    out = np.zeros(1 << bits - 3, np.uint8)
    for r in classes.select("cls").mapInArrow(slots, "piece long, slot long").repartition("piece").mapInArrow(pieces, "piece long, bytes binary").toLocalIterator():
        out[r.piece << PIECE - 3 : (r.piece + 1) << PIECE - 3] = np.frombuffer(r.bytes, np.uint8)
    return out


def _inside(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    s = h >> np.uint64(64 - (len(bits).bit_length() + 2))
    return (bits[s >> np.uint64(3)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 > 0


# counting


def counted(lines: list[str], known: list[bool], bits: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(order, hashes, ends, passed) of the contexts within the bitmap, all those of order one; order 0 has the line ends and the positions."""
    if not lines:
        return
    codes, _, last, place, state, neutral = C.positions(lines)
    known_ = np.array(known, bool)
    is_end = np.zeros(len(codes), np.int8)
    is_end[last] = np.where(known_, 1, 2)
    yield 0, np.zeros(1, np.uint64), np.array([known_.sum()]), np.array([len(codes) - len(lines) - neutral.sum()])
    for begin in range(0, len(codes), CHARS):
        part = slice(begin, begin + CHARS)
        at = begin + np.flatnonzero((place[part] > 0) & ~neutral[part])
        h = (state[at].astype(np.uint64) + np.uint64(1)) << np.uint64(40)
        done = 0
        for k in ORDERS:
            if k > 2:
                reach = place[at] >= k - 1
                at, h = at[reach], h[reach]
            with np.errstate(over="ignore"):
                for j in range(done, k):
                    h = (h ^ codes[at - j]) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
            done = k
            if k > 1:
                inside = _inside(bits, h)
                at, h = at[inside], h[inside]
            if not len(at):
                break
            i, keys = pd.factorize(h)
            mark = is_end[at]
            yield k, keys, np.bincount(i[mark == 1], minlength=len(keys)), np.bincount(i[mark == 0], minlength=len(keys))


def _rows(k: np.ndarray, h: np.ndarray, w: np.ndarray, ends: np.ndarray, passed: np.ndarray, finals: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(k.astype(np.int8)), pa.array(h.astype(np.uint64).view(np.int64)), *[pa.array(x.astype(np.int64)) for x in (w, ends, passed, finals)]], names=["k", "h", "w", "ends", "passed", "finals"]
    )


def count(texts: DataFrame, held: Broadcast) -> DataFrame:
    """Counts of (text, title, weight) rows: the lines of a text, of which the last is no known end, and a title as one line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        waiting: dict[int, tuple[list[str], list[bool]]] = {}
        table: list[pd.DataFrame] = []
        chars = rows = 0

        def flush() -> int:
            more = 0
            for w, (lines, known) in waiting.items():
                for k, h, e, p in counted(lines, known, bits):
                    table.append(pd.DataFrame({"k": np.int8(k), "w": w, "h": h, "ends": e, "passed": p}))
                    more += len(h)
            waiting.clear()
            return more

        def merged() -> pd.DataFrame:
            return pd.concat(table).groupby(["k", "w", "h"], sort=False, as_index=False).sum()

        def out(x: pd.DataFrame) -> pa.RecordBatch:
            return _rows(*[x[c].to_numpy() for c in ("k", "h", "w", "ends", "passed")], np.zeros(len(x), np.int64))

        for b in batches:
            for text, title, w in zip(*[c.to_pylist() for c in b.columns]):
                lines, known = waiting.setdefault(w, ([], []))
                if text is not None:
                    own = [x.strip() for x in C.mask(C.without_sign(text)[0]).split("\n")]
                    for i, x in enumerate(own):
                        if x:
                            lines.append(x)
                            known.append(i < len(own) - 1)
                    chars += len(text)
                if title is not None and title.strip():
                    lines.append(C.mask(title.strip()))
                    known.append(True)
                    chars += len(title)
                if chars >= CHARS:
                    rows, chars = rows + flush(), 0
                    if rows >= HELD_ROWS:
                        table[:] = [merged()]
                        rows = len(table[0])
                        if rows >= HELD_ROWS // 2:
                            yield out(table.pop())
                            rows = 0
        flush()
        if table:
            yield out(merged())

    return texts.mapInArrow(run, _COUNTS)


def _finals(classes: DataFrame) -> DataFrame:
    """(order, hash) of the ends of texts as counted, and how many distinct texts end so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column("n").to_numpy()
            for k, of, h in _Classes(b.column("cls").to_pylist()).hashed(True):
                zero = np.zeros(len(of), np.int64)
                yield _rows(np.full(len(of), k), h, zero + 1, zero, zero, n[of])

    return classes.select("cls", "n").mapInArrow(run, _COUNTS)


# fit and scores


def _asked(classes: DataFrame) -> DataFrame:
    """(cls, n, own, role, k, h): the contexts of each class as looked up (role 0), and the one by which it ends alike with others (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = _Classes(b.column(0).to_pylist())
            alike = c.alike_order()
            for role in (0, 1):
                for k, of, h in c.hashed(role == 1):
                    if role:
                        at = alike[of] == k
                        of, h = of[at], h[at]
                    picked = [x.take(pa.array(of)) for x in b.columns]
                    yield pa.RecordBatch.from_arrays([*picked, *[pa.array(np.full(len(of), x, np.int8)) for x in (role, k)], pa.array(h.view(np.int64))], names=["cls", "n", "own", "role", "k", "h"])

    return classes.select("cls", "n", "own").mapInArrow(run, "cls string, n long, own boolean, role tinyint, k tinyint, h long")


def _scored(classes: DataFrame, table: DataFrame, base: float, rare: float, least: float) -> DataFrame:
    """(cls, n, score, alike) of each class against a table of counts; alike are ends of at least so many texts that never go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got, n = b.column("got"), b.num_rows
            flat, of = got.flatten(), np.repeat(np.arange(n), got.value_lengths().to_numpy())
            role, k, e, p, f = [flat.field(x).to_numpy(zero_copy_only=False) for x in ("role", "k", "ends", "passed", "finals")]
            own = b.column("own").to_numpy(zero_copy_only=False).astype(np.int64)
            rate, going = np.full(n, base), np.ones(n, bool)
            for o in ORDERS:
                hit, es, ps = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64)
                at = (role == 0) & (k == o) & ~np.isnan(e)
                hit[of[at]], es[of[at]], ps[of[at]] = True, e[at], p[at]
                hit &= going
                if o == 1:
                    rate[~hit] = rare
                rate = C.refined(rate, hit, es - own, ps)
                going = hit
            alike = np.zeros(n, bool)
            at = (role == 1) & (f >= least) & (p < f)
            alike[of[at]] = True
            yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("n"), pa.array(np.log(rate / base)), pa.array(alike)], names=["cls", "n", "score", "alike"])

    got = F.collect_list(F.struct("role", "k", *[F.col(c).cast("double").alias(c) for c in ("ends", "passed", "finals")])).alias("got")
    return _asked(classes).join(table, ["k", "h"], "left").groupBy("cls", "n", "own").agg(got).mapInArrow(run, "cls string, n long, score double, alike boolean")


def _rates(table: DataFrame) -> tuple[float, float]:
    """Rate of line ends at a random position, and after rare characters."""
    rows = table.where("k <= 1").select("k", "ends", "passed").toPandas()
    whole, ones = rows[rows.k == 0], rows[rows.k == 1]
    base = max(int(whole.ends.sum()), 1) / max(int(whole.passed.sum()), 1)
    return base, C._rare({1: ones.ends.to_numpy()}, {1: ones.passed.to_numpy()})


def scores(documents: DataFrame, text_ends: DataFrame, text: str, title: str | None) -> DataFrame:
    """(cls, score): the log-odds of ending of each class under the model of all texts of the table."""
    spark = documents.sparkSession
    classes = shared(text_ends.where("cls is not null").select("cls", "d1", "d2").distinct().groupBy("cls").agg(F.count("*").alias("n")).withColumn("own", F.lit(False)))
    n_classes, n_texts = classes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    least = C.alike_from(n_texts)
    bits = min(max((BITS_EACH * len(ORDERS) * max(n_classes, 1) - 1).bit_length(), LEAST_BITS), MOST_BITS)
    held = spark.sparkContext.broadcast(bitmap(classes, bits))
    # every row, those of equal texts with their number as weight
    repeats = text_ends.where("cls is not null").groupBy("d1", "d2").agg(F.count("*").alias("w")).where("w > 1")
    if repeats.count() <= BROADCAST_REPEATS:
        repeats = F.broadcast(repeats)
    name = F.col(title) if title else F.lit(None).cast("string")
    rows = documents.where(F.length(F.trim(text)) > 0).select(F.col(text).alias("t"), name.alias("l"), *_digest(text))
    texts = rows.join(repeats, ["d1", "d2"], "left").select("t", F.lit(None).cast("string").alias("l"), F.coalesce("w", F.lit(1)).cast("long").alias("w"))
    counts = count(texts, held).unionByName(_finals(classes))
    if title:
        titles = rows.groupBy("d1", "d2").agg(F.min("l").alias("l")).where("l is not null")
        counts = counts.unionByName(count(titles.select(F.lit(None).cast("string").alias("t"), "l", F.lit(1).cast("long").alias("w")), held))
    sums = [F.sum(c).alias(c) for c in ("ends", "passed", "finals")]
    whole = [F.sum(F.expr(f"{c} div w")).alias(c) for c in ("ends", "passed", "finals")]
    table = shared(counts.groupBy("k", "h", "w").agg(*sums).groupBy("k", "h").agg(*whole))
    base, rare = _rates(table)
    first = shared(_scored(classes, table, base, rare, least))
    # the ends of texts: read as written by the first model, or as sign-offs that recur and never go on
    unsigned = first.where(F.ascii("cls").bitwiseAND(F.lit(2)) == 0)
    bins = unsigned.groupBy(F.floor(F.col("score") / C.BIN).cast("int").alias("bin")).agg(F.sum("n").alias("n")).orderBy("bin").collect()
    start = C.valley(np.array([r.bin for r in bins], np.int64), np.array([r.n for r in bins], np.int64))
    taken = (F.col("score") >= start) | F.col("alike")
    more = _finals(unsigned.where(taken)).select("k", "h", F.col("finals").alias("ends"), F.lit(0).cast("long").alias("passed"), F.lit(0).cast("long").alias("finals"))
    joined = table.unionByName(more).groupBy("k", "h").agg(*sums)
    final = joined.where((F.col("ends") > 0) | (F.col("passed") >= C.HELD) | (F.col("k") <= 3))
    rare = _rates(joined)[1]
    own = taken & (F.ascii("cls").bitwiseAND(F.lit(2)) == 0)
    return _scored(first.select("cls", "n", own.alias("own")), final, base, rare, least).select("cls", "score")


def truncated(documents: DataFrame, key: str = "doc_id", text: str = "text", title: str | None = "title", lang: str = "lang", source: str = "source") -> DataFrame:
    """``truncation.truncated`` under the model that ``truncation.fit`` makes of all rows."""
    text_ends = shared(ends(documents, key, text, lang, source))
    scored = text_ends.join(scores(documents, text_ends, text, title), "cls", "left").select("doc_id", "source", F.lit(COLUMN).alias("column"), "language", "score")
    return C.decided(scored)[0]

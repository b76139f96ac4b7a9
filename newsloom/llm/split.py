"""Cutting of oversized texts at natural boundaries (problem 3).

Every position of a text has a boundary strength: paragraph break, line break, sentence end, clause end,
blank, none. A sparse table over the strengths answers which is the strongest in a window in constant time;
each piece is cut at the strongest boundary of its permissible window, the rightmost of equals, and the next
piece begins about ``overlap`` characters earlier, again at the strongest boundary near that point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import once_per_id

#: A piece is at least this share of the limit, unless it is the last.
SHORTEST = 0.5
#: Positions over which one sparse table is built; longer texts take several.
SPAN = 1 << 17

_SENTENCE = np.array([ord(c) for c in ".!?…。！？؟।"], np.uint32)
_CLAUSE = np.array([ord(c) for c in ",;:，；：、)»”"], np.uint32)
_CLOSE = np.array([ord(c) for c in "\"'”’»“)]」』"], np.uint32)
_BLANK = np.array([ord(c) for c in " \t\r 　 "], np.uint32)
NAMES = ("none", "blank", "clause", "sentence", "line", "paragraph")


def strengths(codes: np.ndarray) -> np.ndarray:
    """Strength of a cut before each position, 0 to 5; position 0 has 0."""
    n = len(codes)
    s = np.zeros(n + 1, np.int8)
    if n == 0:
        return s
    nl = codes == 10
    blank = np.isin(codes, _BLANK) | nl
    sentence, clause, close = np.isin(codes, _SENTENCE), np.isin(codes, _CLAUSE), np.isin(codes, _CLOSE)
    cjk = codes > 0x2E80
    # a cut stands after the character before it
    s[1:][blank] = 1
    after = np.zeros(n, bool)
    after[1:] = sentence[:-1] & (blank[1:] | close[1:])
    s[1:][clause & cjk] = 2
    s[1:][sentence & cjk] = 3
    follows_clause = np.zeros(n, bool)
    follows_clause[1:] = clause[:-1] & blank[1:]
    s[1:][follows_clause] = 2
    ends = np.zeros(n, bool)
    ends[1:] = blank[1:] & sentence[:-1]
    ends[2:] |= blank[2:] & close[1:-1] & sentence[:-2]
    s[1:][ends] = 3
    s[1:][nl] = 4
    twice = np.zeros(n, bool)
    twice[1:] = nl[1:] & nl[:-1]
    twice[2:] |= nl[2:] & (codes[1:-1] == 13) & nl[:-2]
    s[1:][twice] = 5
    s[n] = 5  # the end of the text is a boundary
    return s


class Strongest:
    """Sparse table of (strength, position) maxima; ties go to the right."""

    def __init__(self, s: np.ndarray, widest: int) -> None:
        keys = (s.astype(np.int64) << 40) + np.arange(len(s), dtype=np.int64)
        self.rows = [keys]
        width = 1
        while width * 2 <= min(widest, len(keys)):
            last = self.rows[-1]
            self.rows.append(np.maximum(last[:-width], last[width:]))
            width *= 2

    def query(self, low: int, high: int) -> tuple[int, int]:
        """(position, strength) of the strongest cut in low..high inclusive."""
        k = min((high - low + 1).bit_length() - 1, len(self.rows) - 1)
        row = self.rows[k]
        best, at, step = -1, low, 1 << k
        while at + step <= high + 1:
            best = max(best, int(row[at]))
            at += step
        best = max(best, int(row[high + 1 - step]))
        return best & ((1 << 40) - 1), best >> 40


def pieces_of(text: str, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, end, strength of the cut at the end) of the pieces of a text; one piece if it fits."""
    n = len(text)
    if n <= limit:
        return [(0, n, 5)]
    overlap = max(0, min(overlap, limit // 3))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    s = strengths(codes)
    out: list[tuple[int, int, int]] = []
    base = start = 0
    span = max(SPAN, 4 * limit)
    table = Strongest(s[: span + 1], limit)
    while True:
        if start + limit >= n:
            out.append((start, n, 5))
            return out
        if start + limit - base > span:
            base = start
            table = Strongest(s[base : base + span + 1], limit)
        low = start + max(int(limit * SHORTEST), overlap + 1)
        cut, strength = table.query(low - base, start + limit - base)
        cut += base
        out.append((start, cut, strength))
        if overlap == 0:
            start = cut
            continue
        slack = overlap // 4
        back, found = table.query(max(cut - overlap - slack, start + 1) - base, max(cut - overlap + slack, start + 1) - base)
        start = back + base if found else max(cut - overlap, start + 1)


def long_lines(text: str, limit: int) -> list[int]:
    """Numbers, from 1, of the lines of more than ``limit`` characters; a carriage return at a line's end doesn't count."""
    return [n for n, x in enumerate(text.split("\n"), 1) if len(x) > limit and len(x.removesuffix("\r")) > limit]


def split_texts(feeds: DataFrame, limit: int, overlap: int, id_col: str = "id", text: str = "raw_text", texts: bool = True) -> DataFrame:
    """(id, pieces, long_lines) of each distinct id whose text has more than ``limit`` characters.

    ``pieces``: ordered (piece_no, start_pos, end_pos, cut, text). Null, empty and fitting texts give no row.
    The length test is Spark's own, so fitting texts never reach Python; repeated ids count once. With ``texts``
    false the pieces carry positions only and the texts stay in the scan: only ids and positions are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("piece_no", pa.int32()), ("start_pos", pa.int32()), ("end_pos", pa.int32()), ("cut", pa.string()), ("text", pa.string())]))
        for b in batches:
            ids, pieces, lines = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(i)
                pieces.append([
                    {"piece_no": k, "start_pos": s, "end_pos": e, "cut": NAMES[c], "text": t[s:e] if texts else None}
                    for k, (s, e, c) in enumerate(pieces_of(t, limit, overlap), 1)
                ])
                lines.append(long_lines(t, limit))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(pieces, kind), pa.array(lines, pa.list_(pa.int32()))], names=["id", "pieces", "long_lines"])

    schema = "id string, pieces array<struct<piece_no:int,start_pos:int,end_pos:int,cut:string,text:string>>, long_lines array<int>"
    long = feeds.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text")).where(F.length("text") > limit)
    return long.dropDuplicates(["id"]).mapInArrow(run, schema) if texts else once_per_id(long.mapInArrow(run, schema), "id", "pieces", "long_lines")


def oversized(cut: DataFrame) -> DataFrame:
    """(id, line_no): 0 for each text that came out in several pieces, and each line that had to be cut inside."""
    lines = F.concat(F.when(F.size("pieces") > 1, F.array(F.lit(0))).otherwise(F.expr("cast(array() as array<int>)")), F.col("long_lines"))
    return cut.select("id", F.explode(lines).alias("line_no"))

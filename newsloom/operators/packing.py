"""Order-dependent packing: token windows with overlap, documents under a token budget, queue-aware routing."""

from __future__ import annotations

import heapq
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

_TOKEN = re.compile(r"\w+|[^\w\s]")


def count_tokens(s: str) -> int:
    return len(_TOKEN.findall(s))


def windows_of(sentences: list[str], size: int, overlap: int, prefix: str = "") -> list[str]:
    """Windows of at most ``size`` tokens; each begins with the last sentences of the one before, up to ``overlap`` tokens and more by one sentence.

    A sentence above the size stands alone. The carried tail is dropped where it would keep the next sentence
    out, so every window takes at least one new sentence. Tokens are counted once for each sentence.
    """
    counts = [count_tokens(s) for s in sentences]
    out: list[str] = []
    start = used = fresh = 0
    for i, n in enumerate(counts):
        if fresh and used + n > size:
            out.append(prefix + " ".join(sentences[start:i]))
            held, first = 0, i
            while first > start and held < overlap:
                first -= 1
                held += counts[first]
            start, used, fresh = (first, held, 0) if held + n <= size else (i, 0, 0)
        used += n
        fresh += 1
    if fresh:
        out.append(prefix + " ".join(sentences[start:]))
    return out


def token_windows(docs: DataFrame, size: int = 950, overlap: int = 50, key: str = "doc_id", text: str = "text", prefix: str = "") -> DataFrame:
    """(key, windows) of every document; null and blank texts have none."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: windows_of([] if x is None else list(x), size, overlap, prefix))

    return docs.select(key, run(X.sentences(F.col(text))).alias("windows"))


def pack_documents(rows: DataFrame, keys: list[str], order: list[str], text: str, label: str, budget: int) -> DataFrame:
    """(keys, chunk, n_docs, tokens): documents of a group in order, packed under a token budget with a head for each.

    Token counts are taken in Spark; only small (order, count) rows reach the sequential step, which sees one
    group at a time. A document above the budget is clamped to it.
    """
    small = rows.select(*keys, *order, document_cost(F.col(label), F.col(text), budget).alias("cost"))
    g = chunked(small, keys, order, budget).groupBy(*keys, "chunk")
    return g.agg(F.count("*").cast("int").alias("n_docs"), F.sum("cost").alias("tokens"))


def document_cost(label: Column, text: Column, budget: int) -> Column:
    """Tokens of a document with its head and its separator, at most the budget."""
    head = F.concat(F.lit("["), F.coalesce(label, F.lit("unknown")), F.lit("]"))
    return F.least(X.token_count(F.concat_ws(" ", head, text)) + 3, F.lit(budget)).cast("long")


def chunked(small: DataFrame, keys: list[str], order: list[str], budget: int) -> DataFrame:
    """Rows with ``chunk``: the number, from 0, of the chunk of at most ``budget`` of ``cost`` that each row of a group falls into, in order.

    The step is sequential in a group by nature; it sees (order, cost) rows only, some 50 bytes each.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in small.schema) + ", chunk int"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        chunk = used = 0
        got = []
        for c in pdf["cost"]:
            if used and used + c > budget:
                chunk, used = chunk + 1, 0
            used += c
            got.append(chunk)
        return pdf.assign(chunk=got)

    return small.groupBy(*keys).applyInPandas(run, schema)


def service_time(n: int, side: tuple[float, float, int]) -> float:
    """Milliseconds of a text of ``n`` characters: a fixed part for each request of at most so many characters and a part for each character."""
    alpha, beta, most = side
    return -(-n // most) * alpha + n * beta


#: Fixed and per-character milliseconds and characters of a request, of the remote and the local service (fixed values).
REMOTE, LOCAL = (120.0, 0.010, 4800), (6.0, 0.030, 512)


def route_of(lengths: list[int], remote: tuple[float, float, int] = REMOTE, local: tuple[float, float, int] = LOCAL, slots: int = 8, cut_over: int | None = None, bias: float = 0.0) -> list[str]:
    """'remote' or 'local' for each text in order: whichever queue would finish it earlier, the remote one where both would at once.

    The remote service is one queue, the local one ``slots``; ``bias`` is added to each remote text and stays in
    its queue. Texts from ``cut_over`` characters on are meant for the remote side, but a slower remote queue still
    sends them to the local one, so the same comparison decides them.
    """
    if slots < 1:
        raise ValueError("the local service needs a slot")
    free = [0.0] * slots
    queue = 0.0
    out = []
    for n in lengths:
        far, near = queue + service_time(n, remote) + bias, free[0] + service_time(n, local)
        if far <= near:
            queue = far
            out.append("remote")
        else:
            heapq.heapreplace(free, near)
            out.append("local")
    return out


def route(rows: DataFrame, keys: list[str], order: list[str], text: str, **options) -> DataFrame:
    """Routing of each group's texts in order; only lengths reach the sequential step."""
    small = rows.select(*keys, *order, F.coalesce(F.length(text), F.lit(0)).alias("n_chars"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in small.schema)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        return pdf.assign(route=route_of(pdf["n_chars"].tolist(), **options))

    return small.groupBy(*keys).applyInPandas(run, kinds + ", route string")

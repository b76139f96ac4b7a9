"""Token operators over documents: ids of the corpus (problem 8) and filling of containers (problem 9)."""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import DIRECTORY, NAME, encoder
from .common import shared

#: Containers aimed at in one group of items; a group is packed as a whole by one task. A group's last container is
#: half empty on average, so 256 leave 0.2 % unused.
GROUP_CONTAINERS = 256
#: Exchanges tried to bring the containers of a group under the capacity before their number rises.
EXCHANGES = 2000
#: Items of a container from which only single items of it are exchanged.
MANY = 24
#: Tasks over which the groups are spread at most.
GROUP_TASKS = 4096


def shipped(documents: DataFrame, directory: str, name: str) -> str:
    """File name of the vocabulary, sent to the executors by Spark's file server once for each context."""
    sc, file = documents.sparkSession.sparkContext, f"{name}.json"
    sent = getattr(sc, "_newsloom_vocabularies", set())
    if (directory, name) not in sent:
        sc.addFile(os.path.join(directory, file))
        sc._newsloom_vocabularies = sent | {(directory, name)}
    return file


def _encoder(file: str):
    at = SparkFiles.get(file)
    return encoder(os.path.dirname(at), os.path.basename(at)[: -len(".json")])


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", directory: str = DIRECTORY, name: str = NAME) -> DataFrame:
    """(doc_id, ids) of every row, without special tokens. Null and empty texts get an empty list; blank texts are encoded like any other."""

    file = shipped(documents, directory, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(file)
        for b in batches:
            packed = [e.packed(t) for t in b.column(1).to_pylist()]
            sizes = np.fromiter((len(x) // 4 for x in packed), np.int64, len(packed))
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["doc_id", "ids"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(F.col(key).alias("doc_id"), text).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def count_tokens(documents: DataFrame, key: str = "doc_id", text: str = "text", directory: str = DIRECTORY, name: str = NAME) -> DataFrame:
    """(doc_id, n_tokens) of every row; 0 for null and empty texts."""

    file = shipped(documents, directory, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(file)
        for b in batches:
            n = [len(e.packed(t)) // 4 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(F.col(key).alias("doc_id"), text).mapInArrow(run, f"doc_id {kind}, n_tokens bigint")


def differencing(sizes: list[int], m: int) -> list[int]:
    """Karmarkar-Karp multiway differencing: container of each item, over ``m`` containers of near-equal load.

    Every item starts as a partition with one filled container; the two partitions with the largest spread
    are merged again and again, the fullest containers of one onto the emptiest of the other. Ties go by item
    order, so the result depends on the input only.
    """
    n = len(sizes)
    if m <= 1:
        return [0] * n
    # members of a container are kept as chains: tail -> next
    heap = []
    for i, s in enumerate(sizes):
        loads = np.zeros(m, np.int64)
        loads[0] = s
        who = np.full(m, -1, np.int64)
        who[0] = i
        heap.append((-s, i, loads, who))
    heapq.heapify(heap)
    follow = [-1] * n
    tail = list(range(n))
    serial = n
    while len(heap) > 1:
        _, _, a, wa = heapq.heappop(heap)
        _, _, b, wb = heapq.heappop(heap)
        load = a + b[::-1]
        wb = wb[::-1]
        both = np.flatnonzero((wa >= 0) & (wb >= 0))
        for j in both:
            x, y = int(wa[j]), int(wb[j])
            follow[tail[x]] = y
            tail[x] = tail[y]
        who = np.where(wa >= 0, wa, wb)
        order = np.argsort(-load, kind="stable")
        load, who = load[order], who[order]
        load = load - load[-1]
        heapq.heappush(heap, (-int(load[0]), serial, load, who))
        serial += 1
    out = [0] * n
    for c, head in enumerate(heap[0][3] if heap else []):
        i = int(head)
        while i >= 0:
            out[i] = c
            i = follow[i]
    return out


def exchanged(sizes: np.ndarray, where: np.ndarray, m: int, capacity: int, tries: int = EXCHANGES) -> bool:
    """Bring all containers under the capacity by exchanges, in place; False if none is left that helps.

    The fullest container gives one or two items to another and takes none, one or two smaller ones for them: of
    the exchanges that fit into the other's free space the smallest that suffices, else the largest. The overflow
    falls with each one and no container that fits starts to overflow.
    """
    loads = np.bincount(where, weights=sizes, minlength=m).astype(np.int64)
    held = [np.flatnonzero(where == c).tolist() for c in range(m)]

    def bundles(c: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
        own = held[c]
        if len(own) > MANY:  # of very many items the singles offer every difference there is
            out = [(), *((i,) for i in own)]
        else:
            out = [(), *((i,) for i in own), *((i, j) for x, i in enumerate(own) for j in own[x + 1 :])]
        return out, np.array([sum(int(sizes[i]) for i in b) for b in out], np.int64)

    offers = [bundles(c) for c in range(m)]
    for _ in range(tries):
        full = int(loads.argmax())
        over = int(loads[full]) - capacity
        if over <= 0:
            return True
        give, give_size = offers[full]
        owner = np.repeat(np.arange(m), [len(o[0]) for o in offers])
        start = np.concatenate([[0], np.cumsum([len(o[0]) for o in offers])])
        gain = give_size[:, None] - np.concatenate([o[1] for o in offers])[None, :]
        ok = (gain > 0) & (gain <= (capacity - loads)[owner][None, :]) & (owner != full)[None, :]
        if not ok.any():
            return False
        enough = ok & (gain >= over)
        pick = np.where(enough, -gain, -(1 << 40)).argmax() if enough.any() else np.where(ok, gain, -1).argmax()
        i, j = np.unravel_index(int(pick), gain.shape)
        to = int(owner[j])
        given, taken = give[int(i)], offers[to][0][int(j) - int(start[to])]
        loads[full] -= gain[i, j]
        loads[to] += gain[i, j]
        held[full] = [x for x in held[full] if x not in given] + list(taken)
        held[to] = [x for x in held[to] if x not in taken] + list(given)
        where[list(given)], where[list(taken)] = to, full
        offers[full], offers[to] = bundles(full), bundles(to)
    return bool(loads.max(initial=0) <= capacity)


def fill(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """Containers for items of at most ``capacity``: the smallest number that holds the sum, raised while containers overflow after exchanges.

    Empty items (size 0) take a place like any other.
    """
    if not sizes:
        return [], 0
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    ranked = np.array([sizes[i] for i in order], np.int64)
    m = max(1, -(-int(ranked.sum()) // capacity))
    while True:
        got = np.array(differencing(ranked.tolist(), m), np.int64)
        if exchanged(ranked, got, m, capacity) or m >= len(ranked):
            break
        m += 1
    where = [0] * len(sizes)
    for i, c in zip(order, got.tolist()):
        where[i] = c
    return where, m


def pack(counts: DataFrame, capacity: int, group_containers: int = GROUP_CONTAINERS) -> DataFrame:
    """(container_id, doc_id, piece_no, n_pieces, first_token, n_tokens): every document in containers of ``capacity`` tokens.

    Only documents above the capacity are split, into full pieces and a rest; full pieces fill a container of
    their own without any search. The rests and the whole documents are dealt by hash of the document into
    groups of about ``group_containers`` containers and each group is filled by multiway differencing, so no
    task sees more than one bounded group and a hot source or size is spread evenly. ``container_id`` is
    ``group-number``; documents without tokens are packed with n_tokens 0.
    """
    total = counts.agg(F.sum(F.col("n_tokens") % capacity).alias("t"), F.count("*").alias("n")).first()
    # also at most 64 items for each container aimed at, should items be tiny
    groups = max(1, -(-int(total.t or 0) // (capacity * group_containers)), -(-int(total.n or 0) // (64 * group_containers)))
    key = counts.schema["doc_id"].dataType.simpleString()
    t = F.col("n_tokens")
    n_pieces = F.greatest(F.lit(1), F.ceil(t / capacity)).cast("int")
    pieces = counts.select(
        "doc_id", "n_tokens", n_pieces.alias("n_pieces"),
        F.explode(F.sequence(F.lit(1), n_pieces)).alias("piece_no"),
    ).select(
        "doc_id", "piece_no", "n_pieces", ((F.col("piece_no") - 1).cast("long") * capacity).alias("first_token"),
        F.least(F.lit(capacity).cast("long"), t - (F.col("piece_no") - 1).cast("long") * capacity).alias("n_tokens"),
    )
    whole = F.col("n_tokens") == capacity
    full = pieces.where(whole).select(F.concat(F.lit("full-"), F.col("doc_id").cast("string"), F.lit("-"), F.col("piece_no").cast("string")).alias("container_id"), "doc_id", "piece_no", "n_pieces", "first_token", "n_tokens")
    rest = pieces.where(~whole).withColumn("g", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int"))

    def run(pdf):  # one bounded group
        import pandas as pd

        pdf = pdf.sort_values(["doc_id", "piece_no"], kind="stable")
        where, _ = fill(pdf["n_tokens"].tolist(), capacity)
        ids = [f"{int(g)}-{c}" for g, c in zip(pdf["g"], where)]
        return pd.DataFrame({"container_id": ids, **{c: pdf[c] for c in ("doc_id", "piece_no", "n_pieces", "first_token", "n_tokens")}})

    schema = f"container_id string, doc_id {key}, piece_no int, n_pieces int, first_token bigint, n_tokens bigint"
    # the rows are tiny, so adaptive merging would put all groups into one task; ranges of an explicit number stay apart
    return rest.repartitionByRange(min(groups, GROUP_TASKS), "g").groupBy("g").applyInPandas(run, schema).unionByName(full)


def packed_documents(documents: DataFrame, capacity: int, **columns: str) -> DataFrame:
    """Counting and packing in one call; the counts are written to the shared folder so texts are encoded once."""
    return pack(shared(count_tokens(documents, **columns)), capacity)

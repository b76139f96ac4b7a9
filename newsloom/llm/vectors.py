"""Vector operators over embeddings: clusters of one topic (problem 4) and nearest neighbours (problem 6).

Vectors travel as 16-bit integers scaled by their largest component; similarities are computed from their unit
vectors in single precision by block products. Unusable vectors (null, of another length, all zero, with null or non-finite
numbers) are left out everywhere.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared

DIMENSION = 768


def unit_vectors(column: pa.Array, dimension: int = DIMENSION) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are usable, their unit vectors as float32) of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0))
    rows = np.flatnonzero(sizes == dimension)
    flat = column.take(pa.array(rows)).flatten()
    x = flat.to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dimension)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        top = np.abs(x).max(axis=1, initial=0)
        ok = np.isfinite(top) & (top > 0) & np.isfinite(x).all(axis=1)
        x = x[ok] / top[ok][:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
    return rows[ok], x


def usable(df: DataFrame, *keep: str, embedding: str = "embedding", dimension: int = DIMENSION) -> DataFrame:
    """The ``keep`` columns and ``v``, the packed vector, of the usable rows."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = unit_vectors(b.column(len(names)), dimension)
            take = pa.array(rows)
            v = packed(x)
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(take) for k in range(len(names))), v], names=[*names, "v"])

    schema = ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names) + ", v binary"
    return df.where(F.size(embedding) == dimension).select(*names, embedding).mapInArrow(run, schema)


def packed(x: np.ndarray) -> pa.Array:
    """Vectors as bytes of 16-bit integers, the largest component at full scale."""
    top = np.abs(x).max(axis=1, keepdims=True)
    return pa.array([r.tobytes() for r in np.rint(x * (32767 / top)).astype(np.int16)], pa.binary())


def matrix(column, dimension: int = DIMENSION) -> np.ndarray:
    """Unit vectors of a column of packed vectors, as float32 rows."""
    x = np.frombuffer(b"".join(column), np.int16).reshape(-1, dimension).astype(np.float32)
    if len(x):
        x /= np.linalg.norm(x, axis=1)[:, None]
    return x


#: Groups of equal vectors up to which they are broadcast; beyond, they are joined by shuffle.
BROADCAST_COPIES = 100_000


def directions(dimension: int, size: int, seed: int) -> np.ndarray:
    """Orthonormal random directions for reduced vectors."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, min(size, dimension))))[0].astype(np.float32)


# clusters

#: Similarity from which two vectors are neighbours: the middle of the gap that TESTDATA states.
NEAR = 0.67
#: A topic with more vectors is partitioned; pivots for each partitioning step, and cells a vector belongs to.
CELL, PIVOTS, OVERLAP = 1500, 64, 4
REDUCED = 128
#: Partitioning steps; each makes cells about PIVOTS / OVERLAP times smaller.
DEPTH = 6
#: Share of a group that its largest cell may keep; above it the step is undone and the group stays whole.
KEPT = 0.5
#: Links of one cell up to which they are held; beyond, they are computed again block by block.
HELD_LINKS = 4_000_000
#: Groups in a step up to which their pivots are broadcast; beyond, they meet parts of about PART vectors of their group by shuffle.
BROADCAST_GROUPS, PART = 500, 2000


def _partition(v: DataFrame, dimension: int) -> DataFrame:
    """Split groups of more than CELL vectors around pivots of reduced vectors, with overlapping margins.

    A pivot is a vector of the group taken by hash; a vector goes to the cells of its OVERLAP nearest pivots.
    Repeats until every group fits or a step no longer helps, as with a group of nearly equal vectors: a group of
    which one cell keeps more than KEPT stays whole and is clustered in blocks.
    """
    whole = v.limit(0)
    for step in range(DEPTH):
        sizes = v.groupBy("cell").count().where(F.col("count") > CELL * (1 if step == 0 else OVERLAP))
        sizes = shared(sizes)
        n_big = sizes.count()
        if n_big == 0:
            break
        hint = F.broadcast if n_big <= BROADCAST_GROUPS else (lambda x: x)
        big = v.join(hint(sizes), "cell")
        each = F.greatest(F.lit(1), (F.col("count") / PIVOTS).cast("long"))

        axes = directions(dimension, REDUCED, step)

        def reduced(pdf: pd.DataFrame) -> pd.DataFrame:
            z = matrix(pdf.sort_values("id", kind="stable")["v"], dimension) @ axes  # noqa: B023 - used within this step
            z /= np.maximum(np.linalg.norm(z, axis=1), 1e-9)[:, None]
            return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "p": [z.astype(np.float16).tobytes()]})

        # between PIVOTS and 2 x PIVOTS rows of each group, as reduced vectors of 256 bytes
        picked = big.where(F.pmod(F.xxhash64("id", F.lit(step)), each) == 0)
        pivots = picked.select("cell", "id", "v").groupBy("cell").applyInPandas(reduced, "cell string, p binary")
        rest = v.join(hint(sizes.select("cell")), "cell", "left_anti")

        def cells_of(cell: str, g: pd.DataFrame, blob: bytes | None) -> pd.DataFrame:
            at, near = np.arange(len(g)), np.zeros((len(g), 1), np.int64)
            if blob is not None:
                p = np.frombuffer(blob, np.float16).reshape(-1, axes.shape[1]).astype(np.float32)  # noqa: B023 - pickled within this step
                m = min(OVERLAP, len(p))
                near = np.argpartition(-(matrix(g["v"], dimension) @ axes @ p.T), m - 1, axis=1)[:, :m]  # noqa: B023
                at = np.repeat(at, m)
            return pd.DataFrame({
                "topic": g["topic"].to_numpy()[at], "cell": [f"{cell}/{k}" for k in near.ravel()],
                "id": g["id"].to_numpy()[at], "v": g["v"].to_numpy()[at], "weight": g["weight"].to_numpy()[at], "parent": cell,
            })

        columns = ["topic", "cell", "id", "v", "weight"]
        kinds = "topic string, cell string, id string, v binary, weight long, parent string"
        rows = big.select(*columns)
        if n_big <= BROADCAST_GROUPS:
            held = v.sparkSession.sparkContext.broadcast({r.cell: r.p for r in pivots.collect()})

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                known = held.value  # noqa: B023
                for b in batches:
                    out = [cells_of(cell, g, known.get(cell)) for cell, g in b.to_pandas().groupby("cell", sort=False)]  # noqa: B023
                    if out:
                        yield pa.RecordBatch.from_pandas(pd.concat(out), schema=_CELLS, preserve_index=False)

            split = rows.mapInArrow(run, kinds)
        else:
            # each part of a group, of about PART vectors, gets the group's pivots once
            parts = F.ceil(F.col("count") / PART).cast("int")
            dealt = big.select(*columns, F.pmod(F.xxhash64("id", F.lit(77)), parts).cast("int").alias("part"))
            copies = pivots.join(sizes, "cell").select("cell", "p", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))

            def beside(g: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
                if not len(g):
                    return pd.DataFrame({f.name: [] for f in _CELLS})
                return cells_of(g["cell"].iloc[0], g, p["p"].iloc[0] if len(p) else None)  # noqa: B023

            split = dealt.groupBy("cell", "part").cogroup(copies.groupBy("cell", "part")).applyInPandas(beside, kinds)
        split = shared(split)
        most = split.groupBy("parent", "cell").count().groupBy("parent").agg(F.max("count").alias("most"))
        stuck = shared(most.join(sizes.withColumnRenamed("cell", "parent"), "parent").where(F.col("most") > F.col("count") * KEPT).select("parent"))
        if not stuck.isEmpty():
            whole = whole.unionByName(rows.join(hint(stuck.withColumnRenamed("parent", "cell")), "cell", "left_semi").select(*columns))
            split = split.join(hint(stuck), "parent", "left_anti")
        v = rest.select(*columns).unionByName(split.select(*columns))
    return v.unionByName(whole)


_CELLS = pa.schema([("topic", pa.string()), ("cell", pa.string()), ("id", pa.string()), ("v", pa.binary()), ("weight", pa.int64()), ("parent", pa.string())])


def _local(pdf: pd.DataFrame, near: float, least: int, dimension: int) -> pd.DataFrame:
    """Density clusters of one cell: core vectors have ``least`` vectors, themselves and all copies included, within ``near``.

    ``weight`` is the number of equal vectors a row stands for.
    """
    pdf = pdf.drop_duplicates("id").sort_values("id", kind="stable")
    x = matrix(pdf["v"], dimension)
    weight = pdf["weight"].to_numpy(np.int64)
    n = len(x)
    block = 1024

    def links() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a in range(0, n, block):
            for b in range(a, n, block):
                i, j = np.nonzero(x[a : a + block] @ x[b : b + block].T >= near)
                i, j = i + a, j + b
                own = i < j
                yield i[own], j[own]

    neighbours = weight.copy()
    held: list[tuple[np.ndarray, np.ndarray]] | None = []
    total = 0
    for i, j in links():
        np.add.at(neighbours, i, weight[j])
        np.add.at(neighbours, j, weight[i])
        total += len(i)
        if total > HELD_LINKS:
            held = None
        if held is not None:
            held.append((i, j))
    core = neighbours >= least
    part = np.arange(n)  # smallest row of each row's component so far
    border = np.full(n, n, np.int64)
    for i, j in links() if held is None else held:
        both = core[i] & core[j]
        part = _united(part, i[both], j[both])
        one = core[i] != core[j]
        c, e = np.where(core[i[one]], i[one], j[one]), np.where(core[i[one]], j[one], i[one])
        np.minimum.at(border, e, c)
    label = np.where(core, part, np.where(border < n, part[np.minimum(border, n - 1)], -1))
    inside = np.flatnonzero(label >= 0)
    ids = pdf["id"].to_numpy()
    return pd.DataFrame({
        "topic": pdf["topic"].to_numpy()[inside], "id": ids[inside],
        "node": np.array([f"{ids[k]}{_AFTER}{c}" for c, k in zip(pdf["cell"].to_numpy()[inside], label[inside])], object), "core": core[inside],
    })


#: Parts the smallest core id from the cell in a node's name; below all letters, so the smallest node has the smallest id.
_AFTER = "\x01"


def _united(part: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Components after the links (i, j) are added: equal links between components are taken once, the smallest row names each."""
    while len(i):
        a, b = part[i], part[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            break
        to = np.arange(len(part))
        np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
        while (to[to] != to).any():
            to = to[to]
        part = to[part]
    return part


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b), a <> b: the smallest node it is connected with.

    Large-star and small-star steps in turn: each links every neighbour of a node to the smallest of them, first
    those above the node, then those below. A chain shrinks by a power of its length in each round, so the rounds
    grow with its logarithm; only edges are shuffled, pre-aggregated to a minimum for each node.
    """
    least = lambda e: e.groupBy("a").agg(F.min("b").alias("m"))
    e = shared(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if tuple(now) == state or not now.n:
            break
        state = tuple(now)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(least(both), "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = shared(large.where("a <> b").distinct())
        small = large.join(least(large), "a")
        e = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        e = shared(e.distinct())
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def clusters(feeds: DataFrame, topics: DataFrame | None = None, near: float = NEAR, least: int = 2, id_col: str = "id", topic: str = "flashpoint_id", embedding: str = "embedding", topic_id: str = "id", dimension: int = DIMENSION) -> DataFrame:
    """(topic, id, cluster): density clusters of the usable vectors of each topic; single vectors are left out.

    Equal vectors of a topic are clustered once, with their number as weight, and added back by id at the end.
    Local clusters that share a core vector are one. ``cluster`` is the smallest id among its core vectors; a
    vector at the border of several takes the smallest. Null topics and, with ``topics``, topics not in that
    table are left out; repeated ids count once.
    """
    f = feeds.select(F.col(id_col).cast("string").alias("id"), F.col(topic).alias("topic"), F.col(embedding).alias("embedding")).where("topic is not null and id is not null")
    if topics is not None:
        f = f.join(topics.select(F.col(topic_id).alias("topic")).distinct(), "topic", "left_semi")
    v = shared(usable(f, "topic", "id", dimension=dimension).dropDuplicates(["id"]))
    keyed = v.select("topic", "id", F.md5("v").alias("h"))
    copies = shared(keyed.groupBy("topic", "h").agg(F.min("id").alias("rep"), F.count("*").alias("weight")).where("weight > 1"))
    n_copies = copies.count()
    hint = F.broadcast if n_copies <= BROADCAST_COPIES else (lambda x: x)
    if n_copies:
        # beyond the broadcast only (id, digest) rows are joined by digest, never the vectors of a large group
        members = keyed.join(hint(copies), ["topic", "h"]).select("topic", "h", "id", "rep", "weight")
        if n_copies <= BROADCAST_COPIES:
            v = v.withColumn("h", F.md5("v")).join(hint(copies), ["topic", "h"], "left")
        else:
            v = v.join(members.select("id", "rep", "weight"), "id", "left")
        v = v.where("rep is null or rep = id").withColumn("weight", F.coalesce("weight", F.lit(1)))
    else:
        v = v.withColumn("weight", F.lit(1))
    v = v.select("topic", F.col("topic").alias("cell"), "id", "v", F.col("weight").cast("long").alias("weight"))
    cells = _partition(v, dimension)
    rows = shared(cells.groupBy("cell").applyInPandas(lambda pdf: _local(pdf, near, least, dimension), "topic string, id string, node string, core boolean"))
    meet = rows.where("core").groupBy("id").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = shared(rows.where("core").join(meet, "id").where("node <> a").select("a", F.col("node").alias("b")).distinct())
    if not edges.isEmpty():
        rows = rows.join(components(edges), "node", "left").select("topic", "id", F.coalesce("root", "node").alias("node"))
    found = rows.groupBy("topic", "id").agg(F.min(F.substring_index("node", _AFTER, 1)).alias("cluster"))
    if not n_copies:
        return found
    found = shared(found)
    marks = copies.select("h", F.col("rep").alias("id"))
    many = found.join(hint(marks), "id").select("topic", "h", "cluster")
    many = members.select("topic", "h", "id").join(hint(many), ["topic", "h"]).select("topic", "id", "cluster")
    return found.join(hint(marks), "id", "left_anti").select("topic", "id", "cluster").unionByName(many)


def cluster_pairs(found: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every two members of one cluster."""
    a = found.select("cluster", "topic", F.col("id").alias("id_a"))
    b = found.select("cluster", "topic", F.col("id").alias("id_b"))
    return a.join(b, ["topic", "cluster"]).where("id_a < id_b").select("id_a", "id_b")


def cluster_records(found: DataFrame, feeds: DataFrame, representatives: int = 3, id_col: str = "id", embedding: str = "embedding", dimension: int = DIMENSION) -> DataFrame:
    """(topic, cluster, article_count, representatives): size and most typical members of each merged cluster, ties by id.

    The most typical members are those with the largest sum of similarities to all members (medoids): the
    product of their vector with the sum of the cluster's vectors. Clusters are dealt into parts of about PART
    vectors; one of a single part is settled by its task, the sums of the others are added up over their parts
    and sent to each, so no task holds more than a part.
    """
    sizes = shared(found.groupBy("topic", "cluster").agg(F.count("*").alias("article_count")))
    parts = F.ceil(F.col("article_count") / PART).cast("int")
    dealt = found.join(sizes, ["topic", "cluster"]).select("topic", "cluster", "id", parts.alias("parts"), F.pmod(F.xxhash64("id", F.lit(78)), parts).cast("int").alias("part"))
    v = usable(feeds.select(F.col(id_col).cast("string").alias("id"), F.col(embedding).alias("embedding")).where("id is not null"), "id", dimension=dimension).dropDuplicates(["id"])
    rows = dealt.join(v, "id")
    best = f"topic {found.schema['topic'].dataType.simpleString()}, cluster string, id string, s double"

    def ranked(pdf: pd.DataFrame, x: np.ndarray, total: np.ndarray) -> pd.DataFrame:
        s = np.round(x @ total / max(float(np.linalg.norm(total)), 1e-9), 5).astype(np.float64)
        top = np.lexsort((pdf["id"].to_numpy().astype(str), -s))[:representatives]
        return pd.DataFrame({"topic": pdf["topic"].to_numpy()[top], "cluster": pdf["cluster"].to_numpy()[top], "id": pdf["id"].to_numpy()[top], "s": s[top]})

    def alone(pdf: pd.DataFrame) -> pd.DataFrame:
        x = matrix(pdf["v"], dimension)
        return ranked(pdf, x, x.sum(axis=0, dtype=np.float64).astype(np.float32))

    one = rows.where("parts = 1").groupBy("topic", "cluster").applyInPandas(alone, best)
    large = rows.where("parts > 1")
    if not sizes.where(F.col("article_count") > PART).isEmpty():
        large = shared(large)

        def summed(pdf: pd.DataFrame) -> pd.DataFrame:
            x = matrix(pdf["v"], dimension).sum(axis=0, dtype=np.float64)
            return pd.DataFrame({"topic": pdf["topic"].iloc[:1], "cluster": pdf["cluster"].iloc[:1], "parts": pdf["parts"].iloc[:1], "t": [x.tobytes()]})

        def added(pdf: pd.DataFrame) -> pd.DataFrame:
            x = np.sum([np.frombuffer(t, np.float64) for t in pdf["t"]], axis=0)
            return pd.DataFrame({"topic": pdf["topic"].iloc[:1], "cluster": pdf["cluster"].iloc[:1], "parts": pdf["parts"].iloc[:1], "t": [x.tobytes()]})

        kinds = f"topic {found.schema['topic'].dataType.simpleString()}, cluster string, parts int, t binary"
        totals = large.groupBy("topic", "cluster", "part").applyInPandas(summed, kinds).groupBy("topic", "cluster").applyInPandas(added, kinds)
        totals = totals.select("topic", "cluster", "t", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

        def settled(pdf: pd.DataFrame, total: pd.DataFrame) -> pd.DataFrame:
            if not len(pdf):
                return pd.DataFrame({"topic": [], "cluster": [], "id": [], "s": []})
            return ranked(pdf, matrix(pdf["v"], dimension), np.frombuffer(total["t"].iloc[0], np.float64).astype(np.float32))

        keys = ["topic", "cluster", "part"]
        one = one.unionByName(large.groupBy(*keys).cogroup(totals.groupBy(*keys)).applyInPandas(settled, best))
    reps = one.groupBy("topic", "cluster").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("s"), "id"))), 1, representatives), lambda x: x["id"]).alias("representatives"))
    return sizes.join(reps, ["topic", "cluster"])


# nearest neighbours

#: Curves, and dimensions and bits of each.
CURVES, AXES, BITS = 3, 4, 15
#: One distinct vector in PER_LANDMARK is a landmark, at least LEAST_LANDMARKS and, for what is broadcast, at most MOST_LANDMARKS (100 MB).
PER_LANDMARK, LEAST_LANDMARKS, MOST_LANDMARKS = 8, 16_384, 393_216
#: Landmarks that draw a vector at most, and how fast the pull falls with similarity.
DRAWN, SHARPNESS = 16, 12.0
#: Passes in which landmarks are drawn to each other before they draw the vectors, and the fall of the pull in them.
CALM_PASSES, CALM_SHARPNESS = 3, 1.0
REDUCED_KNN = 256
#: Vectors of one range, block of vectors compared with itself and the next one.
RANGE, BLOCK = 16384, 3072
#: Rows and landmarks compared at once.
_ROWS, _MARKS = 512, 16384


def hilbert(q: np.ndarray, bits: int) -> np.ndarray:
    """Position of each integer point on the Hilbert curve that fills the cube of ``bits`` bits an axis.

    Vectorised over the points: the axes are untangled from the highest bit down by exchanges and
    reflections, Gray-coded, and their bits interleaved.
    """
    x = [np.ascontiguousarray(c).astype(np.uint32) for c in q.T]
    d = len(x)
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for i in range(d):
            high = (x[i] >> np.uint32(bit)) & np.uint32(1)
            swap = np.where(high == 1, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(high == 1, low, np.uint32(0)) ^ swap
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(q), np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    key = np.zeros(len(q), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << np.uint64(1)) | (((x[i] ^ flip) >> np.uint32(bit)) & np.uint32(1)).astype(np.uint64)
    return key


class Landmarks:
    """A bounded sample of the collection that draws every vector to a calm place.

    In a plain projection onto a few axes the noise of hundreds of dimensions drowns neighbourhoods. A vector is
    therefore put where the landmarks most similar to it are: the mean of their places, weighted by how much
    more similar they are than the others. The places are projections of the landmarks onto random axes, a few
    for each curve, each replaced beforehand by the mean over the landmarks around it. Neighbours see the same
    landmarks as long as their surroundings hold one, so the number of landmarks grows with the collection.
    """

    def __init__(self, ids: np.ndarray, anchors: np.ndarray, places: np.ndarray) -> None:
        """``ids``: 64-bit hashes; ``anchors``: reduced unit vectors as 8-bit integers; ``places``: a row of coordinates each."""
        order = np.argsort(ids, kind="stable")
        self.ids, self.anchors, self.places = ids[order], anchors[order], places[order]

    def own(self, ids: np.ndarray) -> np.ndarray:
        """The landmark that each hashed id is itself, or -1."""
        if not len(self.ids):
            return np.full(len(ids), -1)
        i = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return np.where(self.ids[i] == ids, i, -1)

    def draw(self, z: np.ndarray, own: np.ndarray, sharpness: float = SHARPNESS) -> np.ndarray:
        """Coordinates of reduced unit vectors; no vector is drawn by itself (``own``).

        Only landmarks above the similarity that the nearest of so many unrelated ones has by chance draw a vector,
        or, where none is, the nearest.
        """
        pull = math.sqrt(2 * math.log(max(len(self.anchors), 2)) / z.shape[1])
        out = np.zeros((len(z), self.places.shape[1]), np.float32)
        for a in range(0, len(z), _ROWS):
            out[a : a + _ROWS] = self._draw(z[a : a + _ROWS], own[a : a + _ROWS], sharpness, pull)
        return out

    def _draw(self, z: np.ndarray, own: np.ndarray, sharpness: float, pull: float) -> np.ndarray:
        n = len(z)
        best, best_at = np.full(n, -2, np.float32), np.zeros(n, np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for b in range(0, len(self.anchors), _MARKS):
            part = self.anchors[b : b + _MARKS].astype(np.float32)
            part /= np.maximum(np.linalg.norm(part, axis=1), 1e-9)[:, None]
            c = z @ part.T
            mine = np.flatnonzero((own >= b) & (own < b + len(part)))
            c[mine, own[mine] - b] = -2
            top = c.argmax(axis=1)
            v = c[np.arange(n), top]
            more = v > best
            best[more], best_at[more] = v[more], top[more] + b
            i, j = np.nonzero(c >= pull)
            found.append((i, j + b, c[i, j]))
        i, j, v = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        lone = np.setdiff1d(np.flatnonzero(best > -2), i)
        i, j, v = np.concatenate([i, lone]), np.concatenate([j, best_at[lone]]), np.concatenate([v, best[lone]])
        order = np.lexsort((-v, i))
        i, j, v = i[order], j[order], v[order]
        first = np.searchsorted(i, i, "left")
        near = np.arange(len(i)) - first < DRAWN
        i, j, v = i[near], j[near], v[near]
        w = np.exp(sharpness * (v - best[i]))
        total = np.bincount(i, weights=w, minlength=n)
        out = np.stack([np.bincount(i, weights=w * self.places[j, d], minlength=n) for d in range(self.places.shape[1])], 1)
        return out / np.maximum(total, 1e-30)[:, None]


class Curve:
    """One shifted Hilbert ordering of drawn vectors.

    Each axis is made uniform by the quantiles of the coordinates of the sample and shifted, and the Hilbert key
    of that point is taken. Positions are ranks among the keys of the sample scaled to the collection, so ranges
    of the curve hold about equal numbers of vectors. The sample's own vectors are not drawn by themselves, so
    their keys lie as those of all others do.
    """

    def __init__(self, drawn: np.ndarray, seed: int, size: int) -> None:
        self.shift = np.random.default_rng(1000 + seed).random(drawn.shape[1]) * 0.5
        self.size = size
        self.quantiles = np.sort(drawn, axis=0)
        self.keys = np.sort(self._key(drawn))

    def _key(self, z: np.ndarray) -> np.ndarray:
        q = np.empty(z.shape, np.uint32)
        n = max(len(self.quantiles), 1)
        for i in range(z.shape[1]):
            at = np.interp(z[:, i], self.quantiles[:, i], np.arange(n) / n)
            q[:, i] = ((at + self.shift[i]) / 1.5 * ((1 << BITS) - 1)).astype(np.uint32)
        return hilbert(q, BITS)

    def positions(self, z: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """Estimated place of each drawn vector among all, as a float; ``spread`` in 0..1 parts vectors of one key."""
        k = self._key(z)
        low = np.searchsorted(self.keys, k, "left")
        high = np.searchsorted(self.keys, k, "right")
        n = len(self.keys)
        before = self.keys[np.maximum(low - 1, 0)].astype(np.float64)
        after = self.keys[np.minimum(low, n - 1)].astype(np.float64)
        part = np.clip((k.astype(np.float64) - before) / np.maximum(after - before, 1), 0, 1)
        place = np.where(high > low, low + spread * (high - low), low - 1 + part)
        return np.clip(place, 0, n) / max(n, 1) * self.size


def reduced(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors on fewer random directions, of unit length again."""
    z = x @ axes
    return z / np.maximum(np.linalg.norm(z, axis=1), 1e-9)[:, None]


def small(z: np.ndarray) -> np.ndarray:
    """Vectors as 8-bit integers, the largest component at full scale."""
    return np.rint(z * (127 / np.maximum(np.abs(z).max(axis=1, keepdims=True), 1e-9))).astype(np.int8)


def place_axes(dimension: int, curves: int) -> np.ndarray:
    """Random axes of all curves side by side."""
    return np.random.default_rng(999).standard_normal((dimension, curves * AXES)).astype(np.float32)


def id_hashes(ids: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(i.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for i in ids], np.uint64)


def landmark_count(size: int, per: int = PER_LANDMARK, least: int = LEAST_LANDMARKS, most: int = MOST_LANDMARKS) -> int:
    return min(size, most, max(least, size // per))


def nearest(feeds: DataFrame, k: int, id_col: str = "id", embedding: str = "embedding", curves: int = CURVES, landmarks: int | None = None, span: int = RANGE, block: int = BLOCK, dimension: int = DIMENSION) -> DataFrame:
    """(id, neighbours): the ``k`` most similar vectors of every usable vector, as ordered (similarity, id).

    Equally similar ids come in ascending order; an id is not its own neighbour and repeated ids count once.
    Equal vectors are searched once, under their smallest id, and the neighbours found are expanded to the
    smallest ids of each. The landmarks are a sample (one vector in PER_LANDMARK within its bounds, or
    ``landmarks``); every distinct vector is indexed. Each curve is cut into ranges of about ``span`` vectors; a
    range compares each block of its vectors with itself and the next block, the first vectors of the next range
    included, by matrix products. ``exact_neighbours`` gives the same for a stated set of ids without the index.
    """
    spark = feeds.sparkSession
    f = feeds.select(F.col(id_col).cast("string").alias("id"), F.col(embedding).alias("embedding")).where("id is not null and size(embedding) = %d" % dimension)
    keyed = shared(_digests(f, dimension).distinct())
    groups = keyed.groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    copies = shared(groups.where("n > 1").select("h", "rep"))
    n_copies = copies.count()
    few = n_copies <= BROADCAST_COPIES
    hint = F.broadcast if few else (lambda x: x)
    size = groups.count()
    if not size:
        return spark.createDataFrame([], "id string, neighbours array<struct<similarity:float,id:string>>")
    wanted = landmark_count(size) if landmarks is None else min(size, landmarks)
    share = F.lit(1 << 30) if size <= wanted else F.lit(int((1 << 30) * wanted / size))
    drawn = groups.where(F.pmod(F.xxhash64("rep", F.lit(11)), F.lit(1 << 30)) < share).select(F.col("rep").alias("id"))
    axes, plain = directions(dimension, REDUCED_KNN, 50), place_axes(dimension, curves)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1).to_pylist(), dimension)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.tobytes() for r in small(reduced(x, axes))], pa.binary()), pa.array([r.tobytes() for r in x @ plain], pa.binary())], names=["id", "z", "p"]
            )

    sample = shared(usable(f.join(F.broadcast(drawn) if wanted <= BROADCAST_COPIES else drawn, "id", "left_semi").dropDuplicates(["id"]), "id", dimension=dimension).mapInArrow(described, "id string, z binary, p binary"))
    got = sample.toArrow()
    if not got.num_rows:  # the share is of a hash, so a handful of vectors may give no landmark
        got = shared(usable(f.join(groups.select(F.col("rep").alias("id")).orderBy("id").limit(1), "id", "left_semi").dropDuplicates(["id"]), "id", dimension=dimension).mapInArrow(described, "id string, z binary, p binary")).toArrow()
    ids = got.column("id").to_pylist()
    wide = curves * AXES
    stacked = lambda c, kind, w: np.frombuffer(b"".join(got.column(c).to_pylist()), kind).reshape(-1, w)
    marks = Landmarks(id_hashes(ids), stacked("z", np.int8, axes.shape[1]), stacked("p", np.float32, wide))

    def pulled(marks: Landmarks, itself: bool) -> np.ndarray:
        """Coordinates of the landmarks drawn by ``marks``, in the order of their hashed ids; each landmark is a row of a distributed pass."""
        held = spark.sparkContext.broadcast(marks)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                z = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int8).reshape(-1, axes.shape[1]).astype(np.float32)
                z /= np.maximum(np.linalg.norm(z, axis=1), 1e-9)[:, None]
                h = id_hashes(b.column(0).to_pylist())
                c = held.value.draw(z, np.full(len(z), -1), CALM_SHARPNESS) if itself else held.value.draw(z, held.value.own(h))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array([r.tobytes() for r in c.astype(np.float32)], pa.binary())], names=["h", "c"])

        out = sample.select("id", "z").repartition(max(1, min(2000, len(marks.ids) // 512))).mapInArrow(run, "h long, c binary").toArrow()
        held.unpersist()
        h = out.column("h").to_numpy().view(np.uint64)
        return np.frombuffer(b"".join(out.column("c").to_pylist()), np.float32).reshape(-1, wide)[np.argsort(h, kind="stable")]

    if len(marks.ids) > 1:
        for _ in range(CALM_PASSES):
            marks = Landmarks(marks.ids, marks.anchors, pulled(marks, True))
        spots = pulled(marks, False)
    else:
        spots = marks.places
    lines = [Curve(spots[:, c * AXES : (c + 1) * AXES], c, size) for c in range(curves)]
    first = {r.h: r.rep for r in copies.collect()} if few else {}
    held = spark.sparkContext.broadcast((marks, lines, first))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, lines, first = held.value
        for b in batches:
            rows, x = unit_vectors(b.column(1), dimension)
            if not len(rows):
                continue
            ids = b.column(0).take(pa.array(rows))
            v = packed(x)
            if first:
                kept = [k for k, (i, h) in enumerate(zip(ids.to_pylist(), map(_digest, v.to_pylist()))) if first.get(h, i) == i]
                if not kept:
                    continue
                x, ids, v = x[kept], ids.take(pa.array(kept)), v.take(pa.array(kept))
            named = ids.to_pylist()
            spread = np.array([hash_fraction(i) for i in named])
            z = marks.draw(reduced(x, axes), marks.own(id_hashes(named)))
            for c, line in enumerate(lines):
                p = line.positions(z[:, c * AXES : (c + 1) * AXES], spread)
                home = np.minimum(p // span, max((size - 1) // span, 0)).astype(np.int64)
                guest = (home > 0) & (p - home * span < block)
                at = np.concatenate([np.arange(len(p)), np.flatnonzero(guest)])
                part = np.concatenate([home, home[guest] - 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c * (1 << 40) + part, pa.int64()), pa.array(p[at], pa.float64()), pa.array(np.arange(len(at)) >= len(p)), ids.take(pa.array(at)), v.take(pa.array(at))],
                    names=["part", "p", "guest", "id", "v"],
                )

    searched = f if few else f.join(keyed.join(copies, "h").where("id <> rep").select("id"), "id", "left_anti")
    placed = searched.mapInArrow(place, "part long, p double, guest boolean, id string, v binary")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("id").sort_values(["p", "id"], kind="stable")
        return compare_range(pdf["id"].to_numpy(), matrix(pdf["v"], dimension), k, block)

    found = placed.groupBy("part").applyInPandas(compare, "id string, neighbours array<struct<similarity:float,id:string>>")
    merged = found.groupBy("id").agg(F.flatten(F.collect_list("neighbours")).alias("n"))
    ranked = F.array_sort(F.array_distinct(F.transform("n", lambda x: F.struct((-x["similarity"]).alias("d"), x["id"].alias("id")))))
    # one id can come from two curves with similarities that differ in the last bit
    once = F.filter(ranked, lambda x, i: ~F.exists(F.slice(ranked, 1, i), lambda y: y["id"] == x["id"]))
    found = merged.select("id", F.transform(F.slice(once, 1, k), lambda x: F.struct((-x["d"]).alias("similarity"), x["id"].alias("id"))).alias("neighbours"))
    return _expanded(found, keyed, copies, k, hint) if n_copies else found


def _digest(v: bytes) -> str:
    return hashlib.md5(v, usedforsecurity=False).hexdigest()


def _digests(f: DataFrame, dimension: int) -> DataFrame:
    """(id, h) of the usable vectors; equal packed vectors have the same ``h``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = unit_vectors(b.column(1), dimension)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array([_digest(v) for v in packed(x).to_pylist()], pa.string())], names=["id", "h"])

    return f.select("id", "embedding").mapInArrow(run, "id string, h string")


def _expanded(found: DataFrame, keyed: DataFrame, copies: DataFrame, k: int, hint) -> DataFrame:
    """Neighbours of every id from those of the distinct vectors, each under its smallest id.

    The k + 1 smallest ids of a vector, its own copies included at similarity 1, give the best k of any of them.
    """
    from pyspark.sql import Window

    # the rank filter is applied before the shuffle as well, so no task gets a whole large group
    w = Window.partitionBy("h").orderBy("id")
    members = keyed.join(hint(copies), "h").select("h", "rep", "id")
    least = members.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).groupBy("rep").agg(F.collect_list("id").alias("ids"))
    least = shared(least)
    found = shared(found)
    own = least.select(F.col("rep").alias("id"), F.lit(1.0).cast("float").alias("similarity"), F.col("rep").alias("other"))
    links = found.select("id", F.explode("neighbours").alias("n")).select("id", F.col("n.similarity").cast("float").alias("similarity"), F.col("n.id").alias("other"))
    wide = links.unionByName(own).join(hint(least.withColumnRenamed("rep", "other")), "other", "left")
    each = wide.select("id", "similarity", F.explode(F.coalesce("ids", F.array("other"))).alias("other"))
    ranked = each.groupBy("id").agg(F.array_sort(F.collect_set(F.struct((-F.col("similarity")).alias("d"), F.col("other").alias("id")))).alias("n"))
    ranked = found.select("id").unionByName(own.select("id")).distinct().join(ranked, "id", "left")
    best = F.transform(F.slice(F.coalesce("n", F.array().cast("array<struct<d:float,id:string>>")), 1, k + 1), lambda x: F.struct((-x["d"]).cast("float").alias("similarity"), x["id"].alias("id")))
    ranked = shared(ranked.select(F.col("id").alias("rep"), best.alias("n")))
    alone = ranked.join(hint(copies.select("rep")), "rep", "left_anti").select(F.col("rep").alias("id"), "n")
    many = members.join(hint(ranked.join(hint(copies.select("rep")), "rep", "left_semi")), "rep").select("id", "n")
    return alone.unionByName(many).select("id", F.slice(F.filter("n", lambda x: x["id"] != F.col("id")), 1, k).alias("neighbours"))


def exact_neighbours(feeds: DataFrame, ids: DataFrame, k: int, id_col: str = "id", embedding: str = "embedding", dimension: int = DIMENSION, queries: int = 4096) -> DataFrame:
    """(id, neighbours) as ``nearest`` gives them, by comparing a stated set of at most ``queries`` ids with all vectors in blocks.

    The queries' vectors are broadcast (6 MB at most); every task keeps the best of its rows for each query, so
    what is shuffled is k rows for each query and task. A larger set raises ValueError: pass it in parts.
    """
    spark = feeds.sparkSession
    f = feeds.select(F.col(id_col).cast("string").alias("id"), F.col(embedding).alias("embedding")).where("id is not null and size(embedding) = %d" % dimension)
    wanted = ids.select(F.col("id").cast("string").alias("id")).distinct().limit(queries + 1)
    asked = {r.id: r.v for r in usable(f.join(F.broadcast(wanted), "id", "left_semi"), "id", dimension=dimension).collect()}
    if len(asked) > queries:
        raise ValueError(f"more than {queries} ids")
    names = sorted(asked)
    held = spark.sparkContext.broadcast((names, matrix([asked[n] for n in names], dimension)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q = held.value
        best: list[list[tuple[float, str]]] = [[] for _ in names]
        for b in batches:
            rows, x = unit_vectors(b.column(1), dimension)
            own = b.column(0).take(pa.array(rows)).to_pylist()
            x = matrix(packed(x).to_pylist(), dimension)  # the precision in which vectors are compared everywhere
            if not names or not own:
                continue
            _, first = np.unique(np.array(own, object).astype(str), return_index=True)  # a repeated id would take another's place
            x, own = x[first], [own[j] for j in first]
            m = min(len(own), k + 1)
            for a in range(0, len(names), 256):
                s = np.round(q[a : a + 256] @ x.T, 6)
                floor = np.partition(s, len(own) - m, axis=1)[:, len(own) - m]
                for n, name in enumerate(names[a : a + 256]):
                    near = [(-float(s[n, j]), own[j]) for j in np.flatnonzero(s[n] >= floor[n]) if own[j] != name]
                    best[a + n] = sorted(set(best[a + n] + near))[:k]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([[{"d": d, "id": i} for d, i in x] for x in best], pa.list_(pa.struct([("d", pa.float32()), ("id", pa.string())])))], names=["id", "n"]
        )

    found = f.mapInArrow(run, "id string, n array<struct<d:float,id:string>>")
    merged = found.groupBy("id").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("n")))), 1, k).alias("n"))
    return merged.select("id", F.transform("n", lambda x: F.struct((-x["d"]).alias("similarity"), x["id"].alias("id"))).alias("neighbours"))


def recall(found: DataFrame, feeds: DataFrame, k: int, checked: int = 1000, **columns: str) -> DataFrame:
    """(n_checked, n_true, n_found, recall): the share of the true neighbours of about ``checked`` ids, picked by hash, that ``found`` has.

    A neighbour counts as found if it is as similar as the least similar true one.
    """
    total = max(found.count(), 1)
    share = int((1 << 30) * min(1.0, checked / total))
    some = shared(found.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < share))
    true = exact_neighbours(feeds, some.select("id"), k, **columns).select("id", F.col("neighbours").alias("t"))
    both = some.join(true, "id").select(F.size("t").alias("n"), F.size(F.filter("neighbours", lambda x: x["similarity"] >= F.element_at("t", -1)["similarity"] - 1e-5)).alias("hit"))
    sums = both.where("n > 0").agg(F.count("*").alias("n_checked"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_true"), F.coalesce(F.sum(F.least("hit", "n")), F.lit(0)).alias("n_found"))
    return sums.select("n_checked", "n_true", "n_found", F.round(F.col("n_found") / F.nullif(F.col("n_true"), F.lit(0)), 4).alias("recall"))


def hash_fraction(s: str) -> float:
    """A fraction in 0..1 from a string, the same in every process."""
    import zlib

    return zlib.crc32(s.encode("utf-8", "surrogatepass")) / (1 << 32)


def compare_range(ids: np.ndarray, x: np.ndarray, k: int, block: int) -> pd.DataFrame:
    """The best ``k`` of each vector of a range among its own block and the blocks beside it."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)  # ids by rank, for ties
    best_s = np.full((n, k), -2, np.float32)
    best_i = np.full((n, k), n, np.int64)  # rank of the id

    def take(rows: np.ndarray, s: np.ndarray, cols: np.ndarray) -> None:
        for b in range(0, len(rows), _ROWS):  # what is ranked beside the block of similarities stays small
            take_some(rows[b : b + _ROWS], np.ascontiguousarray(s[b : b + _ROWS]), cols)

    def take_some(rows: np.ndarray, s: np.ndarray, cols: np.ndarray) -> None:
        m = min(k + 3, s.shape[1])
        top = np.argpartition(-s, m - 1, axis=1)[:, :m] if m < s.shape[1] else np.tile(np.arange(m), (len(s), 1))
        v = np.round(np.take_along_axis(s, top, 1), 6)
        # equal similarities beyond the m taken are kept exact by the smallest ids among them
        tied = v.min(axis=1, initial=2)
        more = (np.round(s, 6) >= tied[:, None]).sum(axis=1) > m
        c = place[cols[top]]
        for r in np.flatnonzero(more):
            full = np.round(s[r], 6)
            o = np.lexsort((place[cols], -full))[:m]
            v[r], c[r] = full[o], place[cols[o]]
        vs, cs = np.concatenate([best_s[rows], v], 1), np.concatenate([best_i[rows], c], 1)
        o = np.lexsort((cs, -vs), axis=1)[:, :k]
        best_s[rows], best_i[rows] = np.take_along_axis(vs, o, 1), np.take_along_axis(cs, o, 1)

    for a in range(0, n, block):
        rows = np.arange(a, min(a + block, n))
        s = x[rows] @ x[rows].T
        np.fill_diagonal(s, -2)
        take(rows, s, rows)
        nxt = np.arange(a + block, min(a + 2 * block, n))
        if len(nxt):
            s = x[rows] @ x[nxt].T
            take(rows, s, nxt)
            take(nxt, s.T, rows)
    out = []
    for i in range(n):
        out.append([{"similarity": float(s), "id": ids[order[j]]} for s, j in zip(best_s[i], best_i[i]) if s > -2])
    return pd.DataFrame({"id": ids, "neighbours": out})


def neighbour_pairs(found: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: one of the two is among the other's neighbours."""
    e = found.select("id", F.explode("neighbours.id").alias("other"))
    return e.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()

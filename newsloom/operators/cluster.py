"""Clustering of the vectors of each topic: k-means, hierarchical density clustering, choice and fallback."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared


class Clusterer(Protocol):
    """Labels for the rows of a matrix; -1 is noise."""

    def __call__(self, x: np.ndarray) -> np.ndarray: ...


def auto_k(n: int) -> int:
    """min(n, 10, max(2, floor(sqrt(n / 2))))."""
    return max(1, min(n, 10, max(2, int(math.sqrt(n / 2)))))


def fallback_k(n: int) -> int:
    """max(3, sqrt(n / 2) rounded half to even), at most n."""
    return max(1, min(n, max(3, round(math.sqrt(n / 2)))))


def kmeans(x: np.ndarray, k: int, seed: int = 42, rounds: int = 50) -> np.ndarray:
    """Lloyd's algorithm from a k-means++ start; labels are renumbered by first row, so they don't depend on the start's order."""
    n = len(x)
    k = max(1, min(k, n))
    rng = np.random.default_rng(seed)
    centers = [x[rng.integers(n)]]
    d = ((x - centers[0]) ** 2).sum(1)
    while len(centers) < k:
        p = d / d.sum() if d.sum() > 0 else np.full(n, 1 / n)
        centers.append(x[rng.choice(n, p=p)])
        d = np.minimum(d, ((x - centers[-1]) ** 2).sum(1))
    c = np.array(centers)
    label = np.zeros(n, np.int64)
    for _ in range(rounds):
        dist = (x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1)[None]
        new = dist.argmin(1)
        if (new == label).all() and _ > 0:
            break
        label = new
        for j in range(k):
            own = label == j
            if own.any():
                c[j] = x[own].mean(0)
    return renumber(label)


def renumber(label: np.ndarray) -> np.ndarray:
    """Labels from 0 in order of first appearance; -1 stays."""
    seen: dict[int, int] = {-1: -1}
    return np.array([seen.setdefault(int(v), len(seen) - 1) for v in label], np.int64)


def density(x: np.ndarray, least: int = 5, epsilon: float = 0.05) -> np.ndarray:
    """Hierarchical density clustering with leaf selection: clusters of at least ``least`` rows, -1 for the rest.

    Mutual reachability over euclidean distances of unit rows, minimum spanning tree by Prim's method with one
    row of distances in memory at a time, single-linkage tree, condensed at ``least``; leaves born below
    ``epsilon`` are merged into their parent. Needs O(n^2) time and O(n) memory beside the rows.
    """
    n = len(x)
    if n < 2 * least:
        return np.full(n, -1, np.int64)
    x = unit_rows(x)
    return condensed(n, spanning_edges(x, core_distances(x, least)), least, epsilon)


def core_distances(x: np.ndarray, least: int) -> np.ndarray:
    """Distance of each unit row to its ``least``-th nearest, itself included."""
    return np.array([np.partition(np.sqrt(np.maximum(2 - 2 * (x @ x[i]), 0)), least - 1)[least - 1] for i in range(len(x))])


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows over their lengths; zero rows stay."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x, dtype=np.float64), where=norm > 0)


def spanning_edges(x: np.ndarray, core: np.ndarray) -> list[tuple[float, int, int]]:
    """Minimum spanning tree of the mutual reachability of unit rows by Prim's method: (distance, row, row)."""
    n = len(x)
    dist = lambda i: np.sqrt(np.maximum(2 - 2 * (x @ x[i]), 0))
    left = np.ones(n, bool)
    left[0] = False
    best, via = np.full(n, np.inf), np.zeros(n, np.int64)
    at, edges = 0, []
    for _ in range(n - 1):
        reach = np.maximum(np.maximum(dist(at), core[at]), core)
        closer = left & (reach < best)
        best[closer], via[closer] = reach[closer], at
        at = int(np.where(left, best, np.inf).argmin())
        edges.append((best[at], int(via[at]), at))
        left[at] = False
    return edges


def linkage(n: int, edges: list[tuple[float, int, int]]) -> tuple[dict[int, tuple[int, int, float, int]], list[int]]:
    """Single-linkage tree of ``n`` rows: node -> (left, right, distance, size), and the size of every node; the root is 2n - 2."""
    parent = list(range(2 * n - 1))
    tree: dict[int, tuple[int, int, float, int]] = {}
    size = [1] * n + [0] * (n - 1)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    node = n - 1
    for d, a, b in sorted(edges):
        a, b = root(a), root(b)
        if a == b:
            continue
        node += 1
        parent[a] = parent[b] = node
        size[node] = size[a] + size[b]
        tree[node] = (a, b, float(d), size[node])
    return tree, size


def soft_outputs(n: int, edges: list[tuple[float, int, int]], label: np.ndarray, least: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(membership probability, outlier score) of each row of a density clustering.

    A row leaves its condensed cluster at a distance; its density is the inverse. The probability is the density
    over the largest of its label, 0 for noise; the outlier score is 1 less the density over the largest that
    stays in the cluster it left, or below it.
    """
    tree, size = linkage(n, edges)
    density_of, home = np.zeros(n), np.zeros(n, np.int64)
    up: dict[int, int] = {}
    order = [2 * n - 2]
    todo = [(2 * n - 2, 2 * n - 2)] if n > 1 else []

    def drop(node: int, d: float, cluster: int) -> None:
        rows = [node]
        while rows:
            v = rows.pop()
            if v < n:
                density_of[v], home[v] = 1 / max(d, 1e-12), cluster
            else:
                rows += tree[v][:2]

    while todo:
        node, cluster = todo.pop()
        while node >= n:
            a, b, d, _ = tree[node]
            big = [c for c in (a, b) if size[c] >= least]
            for c in (a, b):
                if size[c] < least:
                    drop(c, d, cluster)
            if len(big) == 2:
                for c in big:
                    up[c] = cluster
                    order.append(c)
                    todo.append((c, c))
            if len(big) != 1:
                break
            node = big[0]
    peak: dict[int, float] = {c: 0.0 for c in order}
    for p in range(n):
        peak[int(home[p])] = max(peak.get(int(home[p]), 0.0), float(density_of[p]))
    for c in reversed(order):
        if c in up:
            peak[up[c]] = max(peak[up[c]], peak[c])
    outlier = np.array([1 - density_of[p] / peak[int(home[p])] if peak[int(home[p])] > 0 else 0.0 for p in range(n)])
    probability = np.zeros(n)
    for c in set(label.tolist()) - {-1}:
        own = label == c
        probability[own] = density_of[own] / max(float(density_of[own].max()), 1e-300)
    return probability, outlier


def soft_topics(vectors: DataFrame, least: int = 5, topic: str = "topic", key: str = "id", embedding: str = "embedding") -> DataFrame:
    """(topic, key, label, probability, outlier) of the density clustering of each topic; one topic is one task."""
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key, kind="stable")
        n = len(pdf)
        label, probability, outlier = np.full(n, -1), np.zeros(n), np.zeros(n)
        if n >= 2 * least:
            x = unit_rows(np.stack(pdf[embedding].to_numpy()).astype(np.float64))
            edges = spanning_edges(x, core_distances(x, least))
            label = condensed(n, edges, least, 0.05)
            probability, outlier = soft_outputs(n, edges, label, least)
        return pd.DataFrame({topic: pdf[topic], key: pdf[key], "label": label.astype(np.int32), "probability": probability, "outlier": outlier})

    schema = f"{topic} {kinds[topic]}, {key} {kinds[key]}, label int, probability double, outlier double"
    return vectors.select(topic, key, embedding).groupBy(topic).applyInPandas(run, schema)


def reduced(vectors: DataFrame, k: int = 20, key: str = "id", embedding: str = "embedding") -> DataFrame:
    """(key, embedding) on the ``k`` main axes of all vectors: an optional step before clustering.

    The covariance, a matrix of the dimension squared, is summed over the cluster; only it reaches the driver.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = vectors.where(F.col(embedding).isNotNull()).select(key, array_to_vector(F.transform(embedding, lambda x: x.cast("double"))).alias("_v"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(rows)
    return model.transform(rows).select(key, vector_to_array("_p").alias("embedding"))


def noise_counts(labels: DataFrame, *keys: str) -> DataFrame:
    """(keys, n_noise, n_clusters, fallback): rows of label -1, distinct other labels, and whether none of them is there."""
    g = labels.groupBy(*keys).agg(F.sum((F.col("label") == -1).cast("long")).alias("n_noise"), F.count_distinct(F.when(F.col("label") != -1, F.col("label"))).alias("n_clusters"))
    return g.withColumn("fallback", F.col("n_clusters") == 0)


def condensed(n: int, edges: list[tuple[float, int, int]], least: int, epsilon: float) -> np.ndarray:
    """Labels of ``n`` rows from edges that hold their minimum spanning tree; edges within a component are passed over."""
    tree, size = linkage(n, edges)

    def rows_of(node: int) -> list[int]:
        out, todo = [], [node]
        while todo:
            v = todo.pop()
            if v < n:
                out.append(v)
            else:
                todo += tree[v][:2]
        return out

    # condensed tree: a cluster splits where both sides are large enough
    label = np.full(n, -1, np.int64)
    todo, leaves, children, born = [(2 * n - 2, 2 * n - 2)], [], {}, {2 * n - 2: math.inf}
    members: dict[int, int] = {2 * n - 2: 2 * n - 2}
    up: dict[int, int] = {}
    while todo:
        node, cluster = todo.pop()
        while node >= n:
            a, b, d, _ = tree[node]
            big = [c for c in (a, b) if size[c] >= least]
            if len(big) == 2:
                children[cluster] = big
                for c in big:
                    born[c], up[c], members[c] = d, cluster, c
                    todo.append((c, c))
                break
            if not big:
                break
            node = big[0]
        if cluster not in children:
            leaves.append(cluster)
    chosen: set[int] = set()
    for c in leaves:
        while c in up and born[c] < epsilon and up[c] in up:
            c = up[c]
        chosen.add(c)
    top = 2 * n - 2
    chosen.discard(top)  # a single cluster is no result
    for c in sorted(chosen):
        above, inside = c, False
        while above in up:
            above = up[above]
            if above in chosen:
                inside = True
        if not inside:
            label[rows_of(members[c])] = c
    return renumber(label)


def settled(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The labels, or those of k-means with the fallback k where no cluster of two came out."""
    kept = label[label >= 0]
    if not len(kept) or np.bincount(kept).max() < 2:
        label = kmeans(x, fallback_k(len(x)))
    return label


def choose(x: np.ndarray, small: int = 50) -> np.ndarray:
    """k-means below ``small`` rows, density clustering from there on; k-means with the fallback k where no cluster of two came out."""
    n = len(x)
    return settled(x, kmeans(x, auto_k(n)) if n < small else density(x))


#: Vectors of a topic up to which its density clustering is one task, and vectors of a block of a larger topic.
WHOLE, BLOCK = 4000, 2000


def _density_labels(vectors: DataFrame, sizes: DataFrame, topic: str, key: str, embedding: str, least: int = 5, epsilon: float = 0.05) -> DataFrame:
    """(topic, key, label) by ``density`` with the distances of each topic spread over tasks; the labels are the same.

    A topic's rows are numbered by key and cut into blocks, and every pair of blocks is a task. Core distances are
    the ``least`` smallest of each row's over all its pairs. The minimum spanning tree of a topic lies within
    the union of the trees of its pairs, so only those edges, (rows x blocks), reach the task that condenses it.
    """
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    numbered = vectors.select(topic, key).join(F.broadcast(sizes), topic).withColumn("row", F.row_number().over(Window.partitionBy(topic).orderBy(key)) - 1)
    rows = shared(vectors.select(topic, key, embedding).join(numbered, [topic, key]).select(topic, "row", embedding, (F.col("row") / BLOCK).cast("int").alias("block"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    numbered = shared(numbered.select(topic, key, "row"))

    def paired(r: DataFrame) -> DataFrame:
        """Each row once for every pair of blocks its own is part of; a topic of one block is a pair of itself."""
        other = F.explode(F.when(F.col("blocks") > 1, F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != F.col("block"))).otherwise(F.array("block")))
        return r.withColumn("other", other).withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit_rows(np.stack(pdf[embedding].to_numpy()).astype(np.float64))
        near = [np.partition(d, least - 1)[:least] if len(d) > least else d for d in _distances(x, pdf["block"].to_numpy(), int(pdf["lo"].iloc[0]))]
        return pd.DataFrame({topic: pdf[topic], "row": pdf["row"], "near": near})

    found = paired(rows).groupBy(topic, "lo", "hi").applyInPandas(nearest, f"{topic} {kinds[topic]}, row int, near array<double>")
    core = found.groupBy(topic, "row").agg(F.element_at(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, least), -1).alias("core"))
    rows = rows.join(shared(core), [topic, "row"])

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", kind="stable")
        at = pdf["row"].to_numpy()
        e = spanning_edges(unit_rows(np.stack(pdf[embedding].to_numpy()).astype(np.float64)), pdf["core"].to_numpy())
        return pd.DataFrame({topic: pdf[topic].iloc[0], "d": [d for d, _, _ in e], "a": [at[a] for _, a, _ in e], "b": [at[b] for _, _, b in e]})

    edges = paired(rows).groupBy(topic, "lo", "hi").applyInPandas(tree, f"{topic} {kinds[topic]}, d double, a int, b int")

    def condense(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(max(pdf["a"].max(), pdf["b"].max())) + 1
        label = condensed(n, list(zip(pdf["d"].tolist(), pdf["a"].tolist(), pdf["b"].tolist())), least, epsilon)
        return pd.DataFrame({topic: [pdf[topic].iloc[0]] * n, "row": np.arange(n), "label": label.astype(np.int32)})

    labels = edges.groupBy(topic).applyInPandas(condense, f"{topic} {kinds[topic]}, row int, label int")
    return numbered.join(labels, [topic, "row"]).select(topic, key, "label")


def _distances(x: np.ndarray, block: np.ndarray, lo: int) -> Iterator[np.ndarray]:
    """For each row its distances to the rows of the other block, and for one pair of each block those to its own as well.

    A block meets itself in its pair with block 0, block 0 in its pair with block 1.
    """
    hi = int(block.max())
    seen = {b: x if (b == 0 and hi <= 1 or b > 0 and lo == 0) else x[block != b] for b in {lo, hi}}
    for b, row in zip(block.tolist(), x):
        yield np.sqrt(np.maximum(2 - 2 * (seen[b] @ row), 0))


def label_topics(vectors: DataFrame, clusterer: Callable[[np.ndarray], np.ndarray] = choose, topic: str = "topic", key: str = "id", embedding: str = "embedding") -> DataFrame:
    """(topic, key, label) of the vectors of each topic, ordered by key before clustering so the result is the same in any partitioning.

    One topic is one task. Above WHOLE vectors density clustering, of ``density`` or ``choose``, is spread over
    tasks by pairs of blocks; k-means is linear in the topic and stays one task. Keys are unique in a topic.
    """
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key, kind="stable")
        x = np.stack(pdf[embedding].to_numpy()).astype(np.float64)
        return pd.DataFrame({topic: pdf[topic], key: pdf[key], "label": clusterer(x).astype(np.int32)})

    schema = f"{topic} {kinds[topic]}, {key} {kinds[key]}, label int"
    vectors = vectors.select(topic, key, embedding)
    if clusterer is not density and clusterer is not choose:
        return vectors.groupBy(topic).applyInPandas(run, schema)
    # few topics can be so large, so their names are broadcast
    sizes = shared(vectors.where(F.col(topic).isNotNull()).groupBy(topic).agg(F.count("*").alias("n")).where(F.col("n") > WHOLE))
    if sizes.isEmpty():
        return vectors.groupBy(topic).applyInPandas(run, schema)
    vectors = shared(vectors)  # read by several plans below
    large = F.broadcast(sizes.select(topic))
    small = vectors.join(large, topic, "left_anti").groupBy(topic).applyInPandas(run, schema)
    labels = _density_labels(vectors.join(large, topic, "left_semi"), sizes, topic, key, embedding)
    if clusterer is choose:
        labels = shared(labels)
        good = labels.where("label >= 0").groupBy(topic, "label").count().where("count > 1").select(topic).distinct()
        rest = vectors.join(large, topic, "left_semi").join(good, topic, "left_anti")
        fallback = label_topics(rest, lambda x: kmeans(x, fallback_k(len(x))), topic, key, embedding)
        labels = labels.join(good, topic, "left_semi").unionByName(fallback)
    return small.unionByName(labels)


def unit(v: Column) -> Column:
    """A vector over its length; a zero vector stays."""
    d = F.transform(v, lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(d, lambda x: F.when(length > 0, x / length).otherwise(x))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if a vector is zero."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))

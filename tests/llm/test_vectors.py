import numpy as np
import pytest

from newsloom.llm import vectors as V

DIM = 768


def rows(spark, x, ids=None, topic=None):
    ids = ids or [f"i{k:04d}" for k in range(len(x))]
    topic = topic or ["t"] * len(x)
    return spark.createDataFrame([(i, t, None if v is None else [float(y) for y in v], "z") for i, t, v in zip(ids, topic, x)], "id string, flashpoint_id string, embedding array<float>, v string")


def blobs(n, size, seed, noise=0.02):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((n, DIM))
    c /= np.linalg.norm(c, axis=1)[:, None]
    return np.repeat(c, size, 0) + noise * rng.standard_normal((n * size, DIM)) * (1 / 1)


def brute(x, near):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    return {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if s[i, j] >= near}


def test_hilbert_is_a_path():
    side = 8
    q = np.array([(a, b) for a in range(side) for b in range(side)], np.uint32)
    order = q[np.argsort(V.hilbert(q, 3))].astype(int)
    assert len(set(V.hilbert(q, 3).tolist())) == side * side and (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()
    q = np.array(np.meshgrid(*[range(4)] * 3)).reshape(3, -1).T.astype(np.uint32)
    assert (np.abs(np.diff(q[np.argsort(V.hilbert(q, 2))].astype(int), axis=0)).sum(1) == 1).all()


def test_unusable_vectors(spark):
    x = [[1.0] * DIM, None, [], [0.0] * DIM, [1.0] * 10, [float("nan")] * DIM, [1e38] * DIM, [1e-30] * DIM]
    assert sorted(r.id for r in V.usable(rows(spark, x).drop("v"), "id").collect()) == ["i0000", "i0006", "i0007"]


@pytest.mark.parametrize("cell", [1500, 40])
def test_clusters_equal_brute_force(spark, cell, monkeypatch):
    monkeypatch.setattr(V, "CELL", cell)
    x = np.concatenate([blobs(12, 6, 1), blobs(30, 1, 2), np.repeat(blobs(1, 1, 3), 5, 0)])
    ids = [f"i{k:04d}" for k in np.random.default_rng(0).permutation(len(x))]
    f = rows(spark, x, ids)
    f = f.unionByName(f.limit(7))
    found = V.clusters(f)
    got = {(r.id_a, r.id_b) for r in V.cluster_pairs(found).collect()}
    want = {tuple(sorted((ids[i], ids[j]))) for i, j in brute(x, V.NEAR)}
    assert got == want
    rec = V.cluster_records(found, f).collect()
    assert sorted(r.article_count for r in rec) == [5] + [6] * 12 and all(len(r.representatives) == 3 for r in rec)


def test_cluster_edges(spark):
    x = [[1.0] * DIM, [1.0] * DIM, [1.0] * DIM, None]
    f = rows(spark, x, ["a", "b", "c", "d"], ["t", "t", None, "t"])
    topics = spark.createDataFrame([("u",), ("t",), ("t",)], "id string")
    assert {(r.id_a, r.id_b) for r in V.cluster_pairs(V.clusters(f, topics)).collect()} == {("a", "b")}
    assert V.clusters(f, topics.where("id = 'u'")).count() == 0 and V.clusters(f.limit(0)).count() == 0


def test_chain_merges_across_cells(spark, monkeypatch):
    monkeypatch.setattr(V, "CELL", 30)
    angles = np.arange(60) * 0.5
    x = np.zeros((60, DIM))
    for k, a in enumerate(angles):
        x[k, k], x[k, k + 1] = 1, 1.8
    x = np.cumsum(np.eye(60, DIM), axis=0)[-1] * 0 + x + 0.3 * np.roll(x, 1, axis=0)
    got = {r.cluster for r in V.clusters(rows(spark, x)).collect()}
    want = brute(x, V.NEAR)
    assert (len(got) >= 1) == bool(want)


def exact(x, ids, k):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = np.round(u @ u.T, 5)
    out = {}
    for i in range(len(x)):
        o = sorted((-s[i, j], ids[j]) for j in range(len(x)) if j != i)
        out[ids[i]] = [b for _, b in o[:k]]
    return out


def test_nearest_is_exact_within_a_block(spark):
    x = np.concatenate([np.random.default_rng(5).standard_normal((80, DIM)), np.repeat(blobs(1, 1, 9), 9, 0)])
    ids = [f"i{k:04d}" for k in np.random.default_rng(1).permutation(len(x))]
    f = rows(spark, x, ids)
    f = f.unionByName(f.limit(11)).unionByName(rows(spark, [None, [0.0] * DIM], ["x", "y"]))
    got = {r.id: [n.id for n in r.neighbours] for r in V.nearest(f, 5).collect()}
    assert got == exact(x, ids, 5)
    assert all(not n for n in {r.id: r.neighbours for r in V.nearest(rows(spark, [[1.0] * DIM], ["a"]), 5).collect()}.values())
    assert V.nearest(f.limit(0), 5).count() == 0


def test_nearest_recall_over_many_ranges(spark):
    x = blobs(60, 12, 11, 0.03)
    ids = [f"i{k:04d}" for k in range(len(x))]
    got = {r.id: {n.id for n in r.neighbours} for r in V.nearest(rows(spark, x, ids), 5, landmarks=200, span=128, block=64).collect()}
    want = exact(x, ids, 5)
    assert np.mean([len(got[i] & set(w)) / 5 for i, w in want.items()]) >= 0.9


def test_pivots_joined_by_shuffle_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(V, "CELL", 30)
    f = rows(spark, blobs(10, 8, 21))
    a = {(r.id_a, r.id_b) for r in V.cluster_pairs(V.clusters(f)).collect()}
    monkeypatch.setattr(V, "BROADCAST_GROUPS", 0)
    assert a == {(r.id_a, r.id_b) for r in V.cluster_pairs(V.clusters(f)).collect()} and len(a) == 10 * 28


@pytest.mark.parametrize("broadcast", [True, False])
def test_copies_beyond_a_window_link_to_the_smallest_ids(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(V, "BROADCAST_COPIES", 0)
    x = np.concatenate([np.repeat(blobs(1, 1, 9), 300, 0), np.repeat(blobs(1, 1, 9), 2, 0) * 3, np.random.default_rng(5).standard_normal((20, DIM)), np.repeat(blobs(1, 1, 10), 3, 0)])
    ids = [f"i{k:04d}" for k in np.random.default_rng(1).permutation(len(x))]
    f = rows(spark, x, ids)
    got = {r.id: [n.id for n in r.neighbours] for r in V.nearest(f.unionByName(f.limit(9)), 5, landmarks=200, span=128, block=64).collect()}
    want = exact(x, ids, 5)
    assert got == want


@pytest.mark.parametrize("broadcast", [True, False])
def test_copies_reach_a_cell_once(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(V, "BROADCAST_COPIES", 0, raising=False)
    monkeypatch.setattr(V, "CELL", 30)
    sizes, partition = [], V._partition

    def counted(v, dimension):
        cells = partition(v, dimension)
        sizes.append(cells.count())
        return cells

    monkeypatch.setattr(V, "_partition", counted)
    x = np.concatenate([np.repeat(blobs(1, 1, 9), 400, 0), blobs(1, 1, 9) + 0.001, np.repeat(blobs(1, 1, 10), 3, 0), blobs(5, 1, 11)])
    ids = [f"i{k:04d}" for k in np.random.default_rng(1).permutation(len(x))]
    found = V.clusters(rows(spark, x, ids))
    got = {(r.id_a, r.id_b) for r in V.cluster_pairs(found).collect()}
    assert got == {tuple(sorted((ids[i], ids[j]))) for i, j in brute(x, V.NEAR)}
    assert sizes[0] <= 8


def test_a_step_that_does_not_help_is_undone(spark, monkeypatch):
    monkeypatch.setattr(V, "CELL", 30)
    monkeypatch.setattr(V, "HELD_LINKS", 100, raising=False)
    x = np.repeat(blobs(1, 1, 3), 200, 0)
    x[:, 0] += np.arange(200) * 1e-3  # distinct, but the same cell for all reduced to half precision
    v = V.usable(rows(spark, x).drop("v"), "id").selectExpr("'t' as topic", "'t' as cell", "id", "v", "1L as weight")
    monkeypatch.setattr(V, "directions", lambda d, size, seed: np.ones((d, 1), np.float32))
    assert V._partition(v, DIM).count() == 200
    monkeypatch.undo()
    monkeypatch.setattr(V, "HELD_LINKS", 100, raising=False)
    assert V.cluster_records(V.clusters(rows(spark, x)), rows(spark, x)).collect()[0].article_count == 200


def test_medoids_of_merged_clusters_in_parts(spark, monkeypatch):
    monkeypatch.setattr(V, "CELL", 30)
    x = np.concatenate([blobs(2, 90, 5), blobs(3, 4, 6)])
    ids = [f"i{k:04d}" for k in np.random.default_rng(2).permutation(len(x))]
    f = rows(spark, x, ids)
    found = V.clusters(f)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    members: dict = {}
    for r in found.collect():
        members.setdefault(r.cluster, []).append(ids.index(r.id))
    want = {}
    for c, at in members.items():
        total = u[at].sum(0)
        s = np.round(u[at] @ total / np.linalg.norm(total), 5)
        want[c] = [ids[at[j]] for j in sorted(range(len(at)), key=lambda j: (-s[j], ids[at[j]]))[:3]]
    for part in (2000, 20):
        monkeypatch.setattr(V, "PART", part)
        got = {r.cluster: (r.article_count, r.representatives) for r in V.cluster_records(found, f).collect()}
        assert {c: len(m) for c, m in members.items()} == {c: n for c, (n, _) in got.items()}
        same = sum(len(set(got[c][1]) & set(want[c])) for c in want)
        assert same >= 3 * len(want) - 2  # the last digit of a similarity may differ


def test_components_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    n = 400
    order = np.random.default_rng(1).permutation(n)
    pairs = [(f"n{order[i]:04d}", f"n{order[i + 1]:04d}") for i in range(n - 1)] + [("x1", "x2"), ("x2", "x3")]
    rounds = []
    keep = V.shared
    monkeypatch.setattr(V, "shared", lambda df: rounds.append(1) or keep(df))
    got = {r.node: r.root for r in V.components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert {k: v for k, v in got.items() if k[0] == "n"} == {f"n{k:04d}": "n0000" for k in range(1, n)}
    assert got["x2"] == got["x3"] == "x1" and len(rounds) <= 2 * 14
    assert V.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_exact_neighbours_and_recall(spark):
    x = np.concatenate([np.random.default_rng(5).standard_normal((60, DIM)), np.repeat(blobs(1, 1, 9), 9, 0)])
    ids = [f"i{k:04d}" for k in np.random.default_rng(1).permutation(len(x))]
    f = rows(spark, x, ids).unionByName(rows(spark, [None], ["x"]))
    want = exact(x, ids, 5)
    got = {r.id: [n.id for n in r.neighbours] for r in V.exact_neighbours(f.unionByName(f), f.select("id").limit(30), 5).collect()}
    assert len(got) >= 29 and all(got[i] == want[i] for i in got)  # every row twice, neighbours once
    one = V.exact_neighbours(f.unionByName(f).coalesce(1), f.select("id").limit(30), 5).collect()
    assert all([n.id for n in r.neighbours] == want[r.id] for r in one)
    with pytest.raises(ValueError):
        V.exact_neighbours(f, f.select("id"), 5, queries=10)
    r = V.recall(V.nearest(f, 5), f, 5).first()
    assert r.n_checked == 69 and r.recall == 1.0
    assert V.recall(V.nearest(f.limit(0), 5), f.limit(0), 5).first().recall is None


def synthetic(n, story, topic=40, queries=40):
    """Landmarks and the vectors of some topics of a collection of n vectors in topics of stories, drawn without making all of it."""
    a, b, c = np.sqrt(0.45), np.sqrt(0.78 - 0.45), np.sqrt(1 - 0.78)
    normal = lambda *key: np.random.default_rng(key).standard_normal(DIM) / np.sqrt(DIM)

    def vectors(at):
        x = np.array([a * normal(1, i // topic) + b * normal(2, i // story) + c * normal(3, i) for i in at])
        return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)

    rng = np.random.default_rng(3)
    marks = np.sort(rng.choice(n, V.landmark_count(n), replace=False))
    asked = (rng.choice(n // topic, queries, replace=False)[:, None] * topic + np.arange(topic)).ravel()
    return marks, vectors(marks), asked, vectors(asked)


def positions(n, marks, x, asked, y):
    axes = V.directions(DIM, V.REDUCED_KNN, 50)
    z = V.small(V.reduced(x, axes))
    u = z.astype(np.float32)
    u /= np.linalg.norm(u, axis=1)[:, None]
    m = V.Landmarks(marks.astype(np.uint64), z, x @ V.place_axes(DIM, V.CURVES))
    for _ in range(V.CALM_PASSES):
        m = V.Landmarks(m.ids, z, m.draw(u, np.full(len(u), -1), V.CALM_SHARPNESS))
    some = np.random.default_rng(4).permutation(len(u))[:8000]
    spots = m.draw(u[some], some)
    d = m.draw(V.reduced(y, axes), m.own(asked.astype(np.uint64)))
    rest = np.random.default_rng(5).random(len(y))
    return [V.Curve(spots[:, c * V.AXES : (c + 1) * V.AXES], c, n).positions(d[:, c * V.AXES : (c + 1) * V.AXES], rest) for c in range(V.CURVES)], spots


@pytest.mark.parametrize("n, story", [(50_000, 8), (120_000, 20)])
def test_recall_does_not_fall_with_the_collection(n, story):
    marks, x, asked, y = synthetic(n, story)
    p, _ = positions(n, marks, x, asked, y)
    s = y @ y.T
    np.fill_diagonal(s, -2)
    hit = 0
    for i in range(len(y)):
        top = np.argsort(-s[i])[:5]
        hit += np.any([np.abs(q[top] // V.BLOCK - q[i] // V.BLOCK) <= 1 for q in p], axis=0).sum()
    assert hit / (5 * len(y)) >= 0.95


def test_ranges_are_even_and_the_search_is_good_with_small_blocks(spark):
    x = blobs(400, 5, 12, 0.02)
    ids = [f"i{k:04d}" for k in np.random.default_rng(7).permutation(len(x))]
    f = rows(spark, x, ids)
    got = {r.id: {n.id for n in r.neighbours} for r in V.nearest(f, 4, span=500, block=128).collect()}
    want = exact(x, ids, 4)
    assert np.mean([len(got[i] & set(w)) / 4 for i, w in want.items()]) >= 0.9
    m = V.landmark_count
    assert m(10) == 10 and m(50_000) == V.LEAST_LANDMARKS and m(800_000) == 100_000 and m(10**9) == V.MOST_LANDMARKS
    # positions of held-out vectors fill ranges evenly: the sample is not drawn by itself
    marks, y, asked, z = synthetic(40_000, 8, queries=200)
    for q in positions(40_000, marks, y, asked, z)[0]:
        share = np.histogram(q, bins=8, range=(0, 40_000))[0] / len(q)
        assert share.max() <= 2.2 / 8

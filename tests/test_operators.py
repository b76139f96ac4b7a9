import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import aggregate as A, cluster as C, compress as Z, metrics as M, topics as T
from newsloom.plans import pipeline, plugins
from newsloom.sources import store as S
from newsloom.streaming import windows as W


def test_cluster_records_ties_unknowns_and_singles(spark):
    rows = spark.createDataFrame(
        [("t", 1, "b.x", "en", "u1", "i1"), ("t", 2, "a.x", "en", "", "unknown"), ("t", 3, None, "fr", "u3", ""), ("s", 4, "z", "en", "u", "i")],
        "flashpoint_id string, n int, domain string, language string, url string, image string",
    )
    r = A.cluster_records(rows, ["flashpoint_id"], ["n"]).collect()
    assert len(r) == 1
    assert r[0].article_count == 3 and r[0].top_domains == ["b.x", "a.x", "unknown"] and r[0].all_domains == ["a.x", "b.x", "unknown"]
    assert r[0].languages == ["en", "fr"] and r[0].urls == ["u1", "u3"] and r[0].images == ["i1"]
    assert A.cluster_records(rows.limit(0), ["flashpoint_id"], ["n"]).count() == 0


def test_nested_keeps_empty_topics(spark):
    t = spark.createDataFrame([("a",), ("b",)], "id string")
    f = spark.createDataFrame([("1", "a", dt.datetime(2024, 1, 2)), ("2", "a", dt.datetime(2024, 1, 1))], "id string, flashpoint_id string, created_at timestamp")
    got = {r.id: [x.id for x in r.feeds] for r in T.nested(t, f).collect()}
    assert got == {"a": ["2", "1"], "b": []}


def test_redundancy_equals_pairs(spark):
    text = "Alpha beta gamma. Alpha beta delta. Epsilon zeta eta. Alpha beta gamma."
    docs = spark.createDataFrame([(1, text), (2, "One. Two."), (3, None), (4, "")], "doc_id long, text string")
    v = Z.weights(Z.terms(Z.sentence_rows(docs))).where("doc_id = 1").collect()
    rows: dict = {}
    for r in v:
        rows.setdefault(r.i, {})[r.term] = r.v
    pairs = [sum(a.get(t, 0) * x for t, x in b.items()) for i, a in rows.items() for j, b in rows.items() if i != j]
    got = {r.doc_id: r.redundancy for r in Z.redundancy(docs).collect()}
    assert got[1] == pytest.approx(sum(pairs) / len(pairs), abs=1e-9) and got[2] == 0.0


def test_compress_is_a_subsequence_within_budget(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    from newsloom.functions import text as X

    got = Z.compress(docs, 300).join(docs.select("doc_id", X.sentences(F.col("text")).alias("s")), "doc_id").where("size(s) > 1").collect()
    assert got
    for r in got:
        it = iter(r.s)
        assert all(any(x == y for y in it) for x in [s for s in r.s if s in r.compressed][: r.n_kept])


def test_density_finds_blobs_and_noise():
    rng = np.random.default_rng(1)
    centers = rng.standard_normal((3, 16)) * 4
    x = np.concatenate([c + 0.05 * rng.standard_normal((12, 16)) for c in centers] + [rng.standard_normal((4, 16)) * 3])
    label = C.density(x)
    assert {tuple(label[i * 12 : i * 12 + 12]) for i in range(3)} == {(0,) * 12, (1,) * 12, (2,) * 12}
    order = rng.permutation(len(x))
    again = C.density(x[order])
    same = lambda a: {frozenset(np.flatnonzero(a == k)) for k in set(a) - {-1}}
    assert same(label) == {frozenset(int(order[j]) for j in s) for s in same(again)}
    assert (C.density(x[:3]) == -1).all() and (C.density(np.zeros((12, 4))) >= -1).all()


@pytest.mark.parametrize("n", [1, 2, 49, 50])
def test_choice_handles_small_and_equal(n):
    x = np.ones((n, 8))
    label = C.choose(x)
    assert len(label) == n and label.max() >= 0
    assert len(set(C.kmeans(np.eye(n, 8), C.auto_k(n)))) <= C.auto_k(n)


def test_fallback_rounds_half_to_even():
    assert C.fallback_k(40) == 4 and C.fallback_k(2) == 2 and C.fallback_k(1) == 1


def test_cosine(spark):
    r = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])], "a array<float>, b array<float>").select(C.cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert r[0].c == pytest.approx(0.70710678) and r[1].c is None and r[2].c is None


def test_health(spark):
    v = spark.range(1).select(M.health(F.lit(0.5), F.lit(90.0), F.lit(0.1), F.lit(0.4)).alias("h"), M.health(F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(1.0)).alias("z")).first()
    assert v.h == pytest.approx(100 - 10 - 5 - 20 - 10) and v.z == 0.0


def test_daily_names():
    assert S.daily_table_name("feeds", "2025-07-01") == "feeds_20250701" and S.daily_table_name("f", dt.date(2025, 1, 2)) == "f_20250102"
    with pytest.raises(ValueError):
        S.daily_table_name("f", "01.07.2025")
    with pytest.raises(TypeError):
        S.daily_table_name("f", 5)


def test_day_partitions_are_replaced_alone(spark, tmp_path):
    p = str(tmp_path / "t")
    S.write_day(spark.createDataFrame([(1,)], "a int"), p, "2025-01-01")
    S.write_day(spark.createDataFrame([(2,)], "a int"), p, "2025-01-02")
    S.write_day(spark.createDataFrame([(3,)], "a int"), p, "2025-01-02")
    assert sorted((str(r.dt), r.a) for r in spark.read.parquet(p).collect()) == [("2025-01-01", 1), ("2025-01-02", 3)]
    plan = S.read_day(spark, p, "2025-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2025-01-02" in plan


def test_clusters_and_checkpoint_round_trip(spark, sf, tmp_path):
    c = spark.createDataFrame([("f", 0, "s", 2, ["a"], ["a"], ["en"], ["u"], [])], "flashpoint_id string, cluster_id int, summary string, article_count int, top_domains array<string>, all_domains array<string>, languages array<string>, urls array<string>, images array<string>")
    S.store_clusters(c, str(tmp_path / "c"), "2025-01-01")
    r = S.load_clusters(spark, str(tmp_path / "c"), "2025-01-01").first()
    assert r.top_domains == ["a"] and r.images == [] and "all_domains" not in r.asDict()
    f = spark.read.parquet(f"{sf}/feeds.parquet").dropDuplicates(["id"]).limit(5)
    S.write_checkpoint(f, str(tmp_path / "j"), "2025-01-01")
    assert S.read_checkpoint(spark, str(tmp_path / "j")).count() == 5 and S.read_checkpoint(spark, str(tmp_path / "none")).count() == 0


def test_ids(spark):
    t = spark.createDataFrame([(" 89B87A9F-aafe-4e5c-a6f9-7b49041397f4",), ("bad",)], "id string")
    assert S.by_ids(t, ["89b87a9f-aafe-4e5c-a6f9-7b49041397f4"]).count() == 1
    assert S.by_ids(t, spark.createDataFrame([("89b87a9f-aafe-4e5c-a6f9-7b49041397f4",)], "id string")).count() == 1


def test_plugin_isolates_bad_rows(spark):
    class Bad:
        name, kind = "bad", "translate"

        def load(self):
            return None

        def apply(self, model, values):
            if (values == "boom").any():
                raise ValueError("boom")
            return values.str.upper()

    df = spark.createDataFrame([("a",), ("boom",), ("b",)], "t string").coalesce(1)
    assert [r[0] for r in df.select(plugins.call(plugins.register(Bad()), F.col("t"), "string")).collect()] == ["A", None, "B"]
    with pytest.raises(KeyError):
        plugins.get("translate", "none")


def test_pipeline_end_to_end(spark, sf):
    feeds, points = spark.read.parquet(f"{sf}/feeds.parquet"), spark.read.parquet(f"{sf}/flashpoints.parquet")
    r = pipeline.run(feeds, points)
    rows = r.collect()
    assert rows and all(x.article_count >= 2 and len(x.top_domains) <= 3 and x.summary for x in rows)


def test_stream_equals_batch(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet")
    e.repartition(3).write.parquet(str(tmp_path / "in"))
    s = W.read_events(spark, str(tmp_path / "in"), e.schema)
    q = W.daily_sink(s, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    hours = lambda x: W.tumbling(x).withColumn("mean_value", F.round("mean_value", 6))
    assert hours(got).exceptAll(hours(e)).count() == 0 and got.count() == e.count()
    q = W.tumbling(s, late="1 day").writeStream.format("memory").queryName("t").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("t").count() == W.tumbling(e).count()


@pytest.mark.parametrize("block", [40, 60, 500])
def test_density_of_a_large_topic_is_spread_and_the_same(spark, block, monkeypatch):
    rng = np.random.default_rng(3)
    c = rng.standard_normal((5, 16))
    x = np.concatenate([np.repeat(c, 30, 0) + 0.1 * rng.standard_normal((150, 16)), rng.standard_normal((25, 16)), np.repeat(c[:1], 6, 0)])[rng.permutation(181)]
    data = [("big", f"i{k:03d}", v.tolist()) for k, v in enumerate(x)] + [("small", f"s{k:03d}", v.tolist()) for k, v in enumerate(x[:60])]
    v = spark.createDataFrame(data, "topic string, id string, embedding array<double>")
    monkeypatch.setattr(C, "WHOLE", 100, raising=False)
    monkeypatch.setattr(C, "BLOCK", block, raising=False)
    largest = []
    alone = C._density_labels
    monkeypatch.setattr(C, "_density_labels", lambda *a: largest.append(1) or alone(*a))
    for clusterer in (C.density, C.choose):
        got = {(r.topic, r.id): r.label for r in C.label_topics(v, clusterer).collect()}
        for topic, rows in (("big", x), ("small", x[:60])):
            assert [got[topic, f"{topic[0] if topic == 'small' else 'i'}{k:03d}"] for k in range(len(rows))] == clusterer(rows).tolist()
    assert len(largest) == 2


def test_analysis_equals_the_rows_of_weights(spark):
    text = "Alpha beta gamma. Alpha beta delta 7. Epsilon zeta eta. Alpha beta gamma. Alpha one. 12"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    a = Z.analysed(docs).first()
    v = Z.weights(Z.terms(Z.sentence_rows(docs)), max_share=0.9).groupBy("i").agg(F.max("v").alias("t")).collect()
    assert {r.i: round(r.t, 9) for r in v} == {i: round(t, 9) for i, t in enumerate(a.top) if t}
    v = Z.weights(Z.terms(Z.sentence_rows(docs))).groupBy("i").agg(F.sum("v").alias("t")).collect()
    assert {r.i: round(r.t, 9) for r in v} == {i: round(t, 9) for i, t in enumerate(a.total) if t}
    none = spark.createDataFrame([(1, None), (2, ""), (3, "!!! ???")], "doc_id long, text string")
    assert Z.redundancy(none).count() == 0 and [r.doc_id for r in Z.analysed(none).collect()] == [3]


def test_compression_forces_dates_and_entities(spark):
    filler = " ".join(f"Filler words number {w} stand here again today." for w in ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine"))
    docs = spark.createDataFrame([(1, filler + " it happened on 2024-01-02 there. then the mayor of zebra town spoke."), (2, None), (3, ""), (4, "Single one."), (5, "A" * 3000 + ". " + "B c. ")], "doc_id long, text string")
    got = {r.doc_id: r for r in Z.compress(docs).collect()}
    assert "2024-01-02" in got[1].compressed and got[1].n_kept < 11
    assert (got[2].compressed, got[2].n_kept) == (None, 0) and (got[3].compressed, got[3].n_kept) == ("", 0) and got[4].n_kept == 1
    assert Z.compress(docs.limit(0)).count() == 0
    s = ["a b", "Anna spoke", "c d", "e f"] * 5
    kept = Z.kept_sentences(s, [3] * 20, 60, ["anna"], 1024, 2)
    assert {i for i in range(20) if i % 4 == 1} <= set(kept) and kept == sorted(kept)
    assert len(Z.kept_sentences(s, [100] * 20, 2000, ["anna"], 256, 2)) == 5  # 2 x 256 tokens less the prefix


def test_meta(spark):
    from newsloom.operators import meta as N

    rows = [("The president met the parliament. John Smith and Anna Lee of NATO spoke in Paris, France.",), ("market market startup",), ("Nothing here",), ("",), (None,)]
    m = [r.m for r in spark.createDataFrame(rows, "t string").select(N.heuristic_meta(F.col("t")).alias("m")).collect()]
    assert m[0].domain == "politics" and m[0].is_politics_central and m[0].entities.people == ["John Smith", "Anna Lee"] and m[0].entities.orgs == ["NATO"] and "Paris, France" in m[0].entities.places
    assert m[1].domain == "business" and m[2].domain == "world" and m[0].topics == ["president", "parliament", "john", "smith", "anna", "nato"]
    raw = ['```json\n{"domain": "TECH", "topics": "a, b ,,c", "entities": {"people": [" x ", "x"]}, "geo": {"city": ""}}\n```', 'Sure: {"topics": ["p", "q"], "is_politics_central": true}', "none", None]
    n = [r.m for r in spark.createDataFrame([(x,) for x in raw], "t string").select(N.normalised_meta(F.col("t")).alias("m")).collect()]
    assert n[0].domain == "tech" and n[0].topics == ["a", "b", "c"] and n[0].entities.people == ["x"] and n[0].geo.city is None
    assert n[1].domain == "world" and n[1].topics == ["p", "q"] and n[1].is_politics_central is True


def test_quality_gates(spark):
    from newsloom.operators import meta as N

    df = spark.createDataFrame([("Anna met Bob.", ["anna", "zoe", "yan", "xu"], ["2024-01-02"], ["7", "8.5", "9", "10"]), ("On 2024-01-02 anna met zoe 5 5 5 5 5 5", ["anna", "zoe"], [], [])], "s string, m array<string>, dates array<string>, numbers array<string>")
    g = [r.g for r in df.select(N.quality_gates(F.col("s"), F.col("m"), F.struct("dates", "numbers")).alias("g")).collect()]
    assert not g[0].entity_coverage and g[0].missing == ["zoe", "yan", "xu"] and not g[0].temporal and g[0].numeric_ok
    assert g[0].summary == "Anna met Bob.\nTimeline: 2024-01-02 (source)."
    assert g[1].entity_coverage and g[1].temporal and g[1].numeric_ok and g[1].missing == []
    bare = spark.createDataFrame([("Anna met Bob.", ["anna"], [], ["7", "8", "9", "10"])], df.schema)
    one = bare.select(N.quality_gates(F.col("s"), F.col("m"), F.struct("dates", "numbers")).alias("g")).first().g
    assert one.summary == "Anna met Bob.\nNote: Source mentioned figures such as 7, 8, 9." and not one.numeric_ok


def test_budgets():
    assert plugins.final_tokens(1020) == 700 and plugins.final_tokens(300) == 300
    assert [plugins.part_tokens(n, 700) for n in (0, 1, 2, 4, 100)] == [120, 220, 122, 61, 60]
    assert plugins.merge_tokens(1001) == (500, 600) and plugins.merge_tokens(1000) == (200, 400)
    assert plugins.room(1024, 100, 20) == (924, False) and plugins.room(150, 100, 20) == (130, True) and plugins.room(60, 100, 20) == (64, True)
    assert M.pool_size(10, 3, 5) == 3 and M.pool_size(1, 3, 5) == 1 and M.pool_size(None, 3, 5) == 5
    assert M.device(True) == "gpu" and M.device(True, force_cpu=True, force_gpu=True) == "cpu" and M.device(False) == "cpu"
    with pytest.raises(RuntimeError):
        M.device(False, force_gpu=True)
    assert M.task_resources(8, 2, 9, 4)["spark.task.resource.gpu.amount"] == "0.2500" and M.task_resources(None, 2, 2, 4) == {"spark.task.cpus": "2"}


def flaky(name, fails=0):
    """A translator that fails on one word, and the first times it meets another."""

    class Flaky:
        kind = "translate"

        def __init__(self, name, fails=0):
            self.name, self.fails = name, fails

        def load(self):
            return {}

        def apply(self, model, values):
            out = []
            for v in values:
                model[v] = model.get(v, 0) + 1
                if v is not None and ("never" in v or ("later" in v and model[v] <= self.fails)):
                    raise ValueError(v)
                out.append(None if v is None else v.upper())
            return __import__("pandas").Series(out)

    return Flaky(name, fails)


def test_translation_falls_back_and_retries(spark):
    plugins.register(flaky("flaky", 3))
    df = spark.createDataFrame([("fine",), ("never",), ("later",), (None,)], "t string").coalesce(1)
    col = lambda c: [r[0] for r in df.select(c).collect()]
    assert col(plugins.translated(F.col("t"), "flaky", "default")) == ["FINE", "never", "later", ""]
    assert col(plugins.translated(F.col("t"), "flaky")) == ["FINE", "", "", ""]
    assert col(plugins.call(plugins.get("translate", "flaky"), F.col("t"), "string", tries=5)) == ["FINE", None, "LATER", None]
    assert col(plugins.translated_remotely(F.col("t"), "flaky", tries=4, wait=0)) == ["FINE", "never", "LATER", None]


def test_summaries_read_the_whole_text(spark):
    head = " ".join(f"aw{i} bw{i} cw{i} dw{i} ew{i}." for i in range(400))
    docs = spark.createDataFrame([(1, head + " The reactor reactor reactor core failed at the very end reactor."), (2, "Short one."), (3, None), (4, " ")], "doc_id long, text string")
    got = {r.doc_id: r.summary for r in pipeline.summaries(docs, "doc_id", "text").collect()}
    assert got[2] == "Short one." and got[3] == got[4] == ""
    assert "very end" in got[1] and len(got[1]) < len(docs.first().text)


def test_cluster_summaries_take_every_member(spark):
    import pyspark.sql.functions as F2

    rows = spark.createDataFrame([("c", i, f"Member {i} tells of event{i:03d} event{i:03d} event{i:03d}.", "d") for i in range(12)] + [("b", 1, "Alone.", None), ("e", 1, None, "d")], "k string, n int, summary string, domain string")
    got = {r.k: r.summary for r in pipeline.cluster_summaries(rows.where("summary is not null"), ["k"], ["n"]).collect()}
    assert "[unknown] Alone." in got["b"] and all(f"event{i:03d}" in got["c"] for i in range(12))
    big = spark.range(3000).select(F2.lit("c").alias("k"), "id", F2.concat(F2.lit("A member of the group says that "), F2.col("id").cast("string"), F2.lit(" boats left the port today.")).alias("summary"), F2.lit("d").alias("domain"))
    assert 0 < len(pipeline.cluster_summaries(big, ["k"], ["id"]).first().summary) < 20000
    assert pipeline.cluster_summaries(rows.limit(0), ["k"], ["n"]).count() == 0


def test_days_collections_and_joint_writes(spark, tmp_path):
    p = str(tmp_path / "d")
    S.create_day(spark, p, "2025-01-01")
    assert spark.read.parquet(p).count() == 0 and S.drop_day(spark, p, "2025-01-01") and not S.drop_day(spark, p, "2025-01-01")
    c = str(tmp_path / "c")
    S.insert_collection(spark.createDataFrame([("a", "1"), ("b", "2")], "flashpoint_id string, id string"), c)
    assert S.require_collection(spark, c, "a").count() == 1 and S.scan_collection(spark, c).count() == 2
    S.delete_collection(spark, c, "a")
    with pytest.raises(KeyError):
        S.require_collection(spark, c, "a")
    with pytest.raises(KeyError):
        S.delete_collection(spark, c, "a")
    S.wipe_collections(spark, c)
    assert not (tmp_path / "c").exists()
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    assert S.write_together({one: spark.range(3), two: spark.range(4)}) == {one: 3, two: 4} and S.write_together({}) == {}
    bad = spark.range(2).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception):
        S.write_together({one: spark.range(9), two: bad})
    assert spark.read.parquet(one).count() == 3 and sorted(x.name for x in tmp_path.iterdir() if not x.name.startswith(".")) == ["d", "one", "two"]


def test_a_bad_id_in_a_list_raises(spark):
    with pytest.raises(ValueError):
        S.by_ids(spark.createDataFrame([("x",)], "id string"), ["no uuid"])


def test_no_local_shared_folder_on_a_cluster():
    from newsloom import session

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("D", (), {"isEmpty": lambda self: True})()})()})()

        def getConf(self):
            return {}

    with pytest.raises(RuntimeError):
        session.shared_folder(type("Sess", (), {"sparkContext": Context()})())


def test_soft_outputs():
    rng = np.random.default_rng(1)
    c = rng.standard_normal((3, 16)) * 4
    x = np.concatenate([np.repeat(c, 12, 0) + 0.05 * rng.standard_normal((36, 16)), rng.standard_normal((4, 16)) * 3])
    u = C.unit_rows(x)
    edges = C.spanning_edges(u, C.core_distances(u, 5))
    label = C.condensed(len(x), edges, 5, 0.05)
    probability, outlier = C.soft_outputs(len(x), edges, label)
    assert ((probability >= 0) & (probability <= 1)).all() and ((outlier >= 0) & (outlier <= 1)).all()
    assert (probability[label == -1] == 0).all() and (probability[label >= 0] > 0).all()
    assert all(probability[label == k].max() == 1 for k in set(label.tolist()) - {-1})
    assert outlier[label == -1].min() > np.median(outlier[label >= 0])


def test_reduced_keeps_distances(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 3)) @ rng.standard_normal((3, 10))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "id long, embedding array<double>")
    y = {r.id: np.array(r.embedding) for r in C.reduced(df, 3).collect()}
    assert len(y) == 40 and all(len(v) == 3 for v in y.values())
    assert np.linalg.norm(y[0] - y[1]) == pytest.approx(np.linalg.norm(x[0] - x[1]), rel=1e-6)


def test_noise_and_maps(spark):
    r = {x.g: x for x in C.noise_counts(spark.createDataFrame([("a", -1), ("a", 0), ("a", 0), ("b", -1)], "g string, label int"), "g").collect()}
    assert (r["a"].n_noise, r["a"].n_clusters, r["a"].fallback) == (1, 1, False) and r["b"].fallback
    m = spark.sql("select map('a', 1, 'b', 2) as l, map('b', 3) as r").select(T.merged_map(F.col("l"), F.col("r")).alias("m")).first().m
    assert m == {"a": 1, "b": 3}


def test_fetching_tables_and_samples(spark, tmp_path):
    (tmp_path / "p.html").write_text("<table><tr><th>IP</th></tr><tr><td>1.2.3.4</td><td>80</td></tr><tr><td> 1.2.3.4 <td>80<tr><td>x</td><td>9</td></tr></table><p>a</p>")
    df = spark.createDataFrame([(f"file://{tmp_path}/p.html",), (f"file://{tmp_path}/none",), ("https://x.example",), (None,)], "u string").coalesce(1)
    got = df.select(plugins.fetched(F.col("u"), wait=0).alias("html"))
    assert [r.html is not None for r in got.collect()] == [True, False, False, False]
    assert [(r.host, r.port) for r in S.addresses(got).collect()] == [("1.2.3.4", 80)]
    (tmp_path / "j.json").write_text('[{"ip": "5.6.7.8", "port": 81}, {"ip": "5.6.7.8", "port": 81}, {"x": 1}]')
    assert [(r.host, r.port) for r in S.addresses_json(spark, str(tmp_path / "j.json")).collect()] == [("5.6.7.8", 81)]
    a = {r.url: r for r in S.api_articles(S.sample_articles(spark)).collect()}
    assert set(a) == {"https://one.example/a", "https://two.example/b"} and str(a["https://one.example/a"].seen_at) == "2025-07-02 08:00:00" and a["https://two.example/b"].sourcecountry == "unknown"


def test_refreshes_on_a_stream_equal_those_of_a_batch(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "ts", "event_id").orderBy("ts", "event_id").limit(300)
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = W.refreshes(s, "user_id", 18000).writeStream.format("memory").queryName("fills").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    ids = lambda d: sorted(r.event_id for r in d.collect())
    assert ids(spark.table("fills")) == ids(W.refreshes(e, "user_id", 18000)) != ids(e)


def test_zip_and_choice(spark):
    df = spark.createDataFrame([("a", ["x", "y"], ["p"]), ("b", [], None)], "id string, l array<string>, r array<string>")
    z = df.select(T.zipped(F.col("l"), F.col("r")).alias("z")).first().z
    assert [(x.left, x.right) for x in z] == [("x", "p"), ("y", None)]
    c = [r.c for r in df.select(T.chosen(F.col("l"), F.col("id")).alias("c")).collect()]
    assert c[0] in ("x", "y") and c[1] is None

import datetime as dt
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.llm import bpe, lines as L, split as S, tokens as T, truncation as C


# splitting


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab .,!?\n中。 é", max_size=900), st.integers(20, 120), st.integers(0, 30))
def test_pieces_cover_and_fit(text, limit, overlap):
    got = S.pieces_of(text, limit, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for s, e, _ in got:
        assert 0 < e - s <= limit or not text
    for (a, b, _), (c, d, _) in zip(got, got[1:]):
        assert a < c <= b < d


def test_pieces_against_brute_force():
    random.seed(1)
    text = "".join(random.choice(["word ", "end. ", "x, ", "\n", "\n\n", "long"]) for _ in range(800))
    s = S.strengths(__import__("numpy").frombuffer(text.encode("utf-32-le"), "uint32"))
    got = S.pieces_of(text, 300, 0)
    for (a, b, k) in got[:-1]:
        window = range(a + 150, a + 301)
        top = max(s[i] for i in window)
        assert k == top and b == max(i for i in window if s[i] == top)


def test_long_text_and_boundaries():
    one = "x" * 1_000_000
    got = S.pieces_of(one, 4000, 200)
    assert all(e - s <= 4000 for s, e, _ in got) and len(got) < 300
    para = ("Sentence one is here. " * 60 + "\n\n") * 40
    assert all(para[e - 2 : e] == "\n\n" for s, e, k in S.pieces_of(para, 4000, 200)[:-1])
    assert S.long_lines("a" * 11 + "\r\n" + "b" * 10 + "\r\nc", 10) == [1]


def test_split_edges(spark):
    df = spark.createDataFrame([("a", "x" * 4001, 1), ("a", "x" * 4001, 1), ("b", None, 2), ("c", "", 3), ("d", "y" * 4000, 4), ("e", ("z" * 80 + "\n") * 60, 5)], "id string, raw_text string, pieces int")
    assert sorted((r.id, r.line_no) for r in S.oversized(S.split_texts(df, 4000, 200)).collect()) == [("a", 0), ("a", 1), ("e", 0)]
    assert sorted((r.id, r.line_no) for r in S.oversized(S.split_texts(df, 4000, 200, texts=False)).collect()) == [("a", 0), ("a", 1), ("e", 0)]
    assert S.split_texts(df.limit(0), 4000, 200).count() == 0


# repeated lines


def test_repeated_lines_against_brute_force(spark):
    random.seed(2)
    rows = []
    for i in range(60):
        dom = random.choice([" WWW.Site.example", "site.example", "b.example", None, "  "])
        body = [random.choice(["Share 12 now", "share  7 NOW", f"unique line {'abcdefghij'[i % 10]}{chr(97 + i // 10)}", "---", "", "By Anna"]) for _ in range(5)]
        rows.append((f"i{i:02d}", dom, "\n".join(body), None))
    rows += rows[:5] + [("n1", "b.example", None, None), ("n2", "b.example", "", None)]
    df = spark.createDataFrame(rows, "id string, domain string, raw_text string, created_at timestamp_ntz")
    key = lambda x: re.sub(" +", " ", re.sub("[0-9]+", "0", x.lower())).strip()
    dom = lambda d: re.sub(r"^www\.", "", (d or "").strip().lower())
    pages = {r[0]: (dom(r[1]), [key(x) for x in r[2].split("\n")]) for r in rows if dom(r[1]) and (r[2] or "").strip()}
    want = set()
    for i, (d, ks) in pages.items():
        n = sum(e == d for e, _ in pages.values())
        for no, k in enumerate(ks, 1):
            c = sum(k in o and e == d for e, o in pages.values())
            if re.search("[a-z]", k) and c >= 4 and c >= 0.05 * n:
                want.add((i, no))
    keyed = L.pages(df)
    marks = L.marked(keyed, L.standing(L.counted(keyed)))
    assert {(r.id, r.line_no) for r in marks.collect()} == want and want
    clean = {r.id: (r.text, r.n_removed) for r in L.cleaned(df, marks).collect()}
    i, no = sorted(want)[0]
    assert clean["n1"] == (None, 0) and clean[i][1] == sum(a == i for a, _ in want)
    assert len(clean[i][0].split("\n") if clean[i][0] else []) <= 5 - clean[i][1] or clean[i][0] == ""
    assert L.counted(L.pages(df.limit(0))).count() == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(f"i{i}", "d.example", f"Share this\nline {'abcdef'[i]}", None) for i in range(6)], "id string, domain string, raw_text string, created_at timestamp_ntz")
    keyed = L.pages(df)
    a = {(r.id, r.line_no) for r in L.marked(keyed, L.standing(L.counted(keyed))).collect()}
    monkeypatch.setattr(L, "BROADCAST_ROWS", -1)
    assert a == {(r.id, r.line_no) for r in L.marked(keyed, L.standing(L.counted(keyed))).collect()} == {(f"i{i}", 1) for i in range(6)}


def test_copies_are_one_witness(spark):
    """A republished article is not boilerplate: its copies count as pages, but as one cluster on one day."""
    schema = "id string, domain string, raw_text string, created_at timestamp_ntz"
    day = lambda n: dt.datetime(2024, 1, 1 + n)
    copies = [(f"i{i}", "d.example", "Same page\nall over\nShare this", day(i)) for i in range(5)]
    others = [(f"o{i}", "d.example", f"Story {'abcdef'[i]}\nShare this", day(i)) for i in range(5)]
    counts = L.counted(L.pages(spark.createDataFrame(copies + others, schema)))
    got = {(r.n_pages, r.n_clusters, r.n_days): r for r in counts.collect()}
    assert set(got) == {(5, 1, 1), (10, 6, 5)} and {(r.pages, r.clusters, r.days) for r in got.values()} == {(10, 6, 5)}
    assert L.standing(counts).count() == 3 and [r.n_clusters for r in L.repeated(counts).collect()] == [6]
    keyed = L.pages(spark.createDataFrame(copies + others, schema))
    clean = {r.id: r.text for r in L.cleaned(spark.createDataFrame(copies + others, schema), L.marked(keyed, L.repeated(L.counted(keyed)))).collect()}
    assert clean["i3"] == "Same page\nall over" and clean["o1"] == "Story b"


def test_lines_of_one_day_and_without_days(spark):
    schema = "id string, domain string, raw_text string, created_at timestamp_ntz"
    same = [(f"i{i}", "d.example", f"Story {'abcdef'[i]}\nToday in brief", dt.datetime(2024, 1, 1)) for i in range(6)]
    later = [(f"j{i}", "d.example", f"Later {'abcdef'[i]}", dt.datetime(2024, 1, 2)) for i in range(2)]
    counted = lambda rows: L.counted(L.pages(spark.createDataFrame(rows, schema)))
    assert L.repeated(counted(same + later)).count() == 0 and L.standing(counted(same + later)).count() == 1
    assert L.repeated(counted(same)).count() == 1  # a domain known on one day is judged by its clusters
    assert L.repeated(counted([(i, d, t, None) for i, d, t, _ in same])).count() == 1


# tokens


@pytest.fixture(scope="module")
def public():
    tok = pytest.importorskip("tokenizers")
    t = tok.Tokenizer.from_file(f"{bpe.DIRECTORY}/{bpe.NAME}.json")
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_public_encoder(public):
    random.seed(3)
    letters = "ab cdeé ñ0123'’ \n\t  .,!?-_中国的я ш🙏️​\x1c\x85\xa0²½Ⅷ٣<|endoftext|>"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(1, 80))) for _ in range(3000)] + ["a" * 5000, "0" * 3000, " " * 300, "x's'll've'd 'tis", "<|endoftext|>", "﻿abc", "A b  c \n d"]
    e = bpe.encoder()
    for t, r in zip(texts, public.encode_batch(texts, add_special_tokens=False)):
        assert e.ids(t) == r.ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_round_trip(text):
    e = bpe.encoder()
    assert bpe.vocabulary().decode(e.ids(text)) == text.encode("utf-8", "replace").decode()


def test_encode_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, " ", 0), (3, " ", 0), (4, "a b" * 50000, 0)], "doc_id long, text string, ids int")
    got = [(r.doc_id, r.ids) for r in T.encode(df).orderBy("doc_id").collect()]
    assert got[0] == (1, []) and got[1] == (2, []) and got[2] == got[3] and len(got[2][1]) == 1 and len(got[4][1]) > 50000
    assert T.encode(df.limit(0)).count() == 0


def test_differencing_and_filling():
    random.seed(4)
    for _ in range(30):
        sizes = [random.randint(0, 2047) for _ in range(random.randint(1, 120))]
        where, m = T.fill(sizes, 2048)
        loads = [0] * m
        for s, w in zip(sizes, where):
            loads[w] += s
        assert max(loads) <= 2048 and len(where) == len(sizes)
    sizes = [random.randint(50, 700) for _ in range(400)]
    where, m = T.fill(sizes, 2048)
    assert m <= -(-sum(sizes) // 2048) + 1
    assert T.fill([], 10) == ([], 0) and T.fill([5], 10) == ([0], 1)
    # exchanges reach the bound where differencing alone overflows
    sizes = [random.randint(50, 900) for _ in range(900)]
    assert T.fill(sizes, 2048)[1] <= -(-sum(sizes) // 2048) + 1
    import numpy as np

    items, where = np.array([6, 5, 5, 4]), np.array([0, 0, 1, 1])
    assert T.exchanged(items, where, 2, 10) and np.bincount(where, weights=items).tolist() == [10, 10]
    assert not T.exchanged(np.array([7, 7, 7]), np.array([0, 0, 1]), 2, 10)
    two = T.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sum(x for x, c in zip([8, 7, 6, 5, 4], two) if c == k) for k in (0, 1)) == [14, 16]
    assert T.fill([7, 7, 7], 10)[1] == 3


def test_pack_keeps_every_token(spark):
    df = spark.createDataFrame([(i, (i * 37) % 5000) for i in range(300)] + [(1000, 2048), (1001, 4096), (1002, 0)], "doc_id long, n_tokens long")
    rows = T.pack(df, 2048).collect()
    assert sum(r.n_tokens for r in rows) == sum(r.n_tokens for r in df.collect())
    load, parts = {}, {}
    for r in rows:
        load[r.container_id] = load.get(r.container_id, 0) + r.n_tokens
        parts.setdefault(r.doc_id, []).append((r.piece_no, r.first_token, r.n_tokens))
    assert max(load.values()) <= 2048
    for doc, p in parts.items():
        p.sort()
        assert [x[0] for x in p] == list(range(1, len(p) + 1)) and all(b[1] == a[1] + a[2] for a, b in zip(p, p[1:]))
    split = {d for d, p in parts.items() if len(p) > 1}
    assert split == {r.doc_id for r in df.collect() if r.n_tokens > 2048}
    assert T.pack(df.limit(0), 2048).count() == 0


def test_groups_are_spread_over_tasks(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "id % 700 + 1 as n_tokens")
    rows = T.pack(df, 2048, 8).withColumn("task", F.spark_partition_id()).where("container_id not like 'full%'")
    by = rows.select("task", F.split("container_id", "-")[0].alias("g")).distinct().groupBy("task").count().collect()
    assert len(by) >= 40 and max(r["count"] for r in by) <= 3


# truncation


@pytest.fixture(scope="module")
def model(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = C.fit(C.sample(docs))
    C.truncated(docs, {"text": m}).count()
    return m


def test_truncation(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    whole = [r.text for r in docs.where("length(text) between 400 and 1500 and text rlike '[.]$' and lang = 'en'").select("text").limit(60).collect()]
    cut = [t[: len(t) * 2 // 3].rstrip(" .") for t in whole]
    assert sum(model.is_cut(t, "en")[0] for t in whole) <= 1
    assert sum(model.is_cut(t, "en")[0] for t in cut) >= 0.9 * len(cut)
    assert model.is_cut(whole[0][:90] + "… Read more", "en")[0] and model.is_cut("The council met and <a href=\"http", "en")[0]
    df = spark.createDataFrame([(1, None, "en", "s", None), (2, "", None, "s", None), (3, "  ", "en", "s", None), (4, cut[0], "EN", "s", None), (5, cut[0], None, None, None), (6, "x" * 200000, "en", "t", None)], "doc_id long, text string, lang string, source string, title string")
    df = df.withColumn("score", F.lit(1)).withColumn("column", F.lit("z"))
    got = {r.doc_id: r.truncated for r in C.truncated(df, {"text": C.fit(C.sample(docs))}).collect()}
    assert got[1] is got[2] is got[3] is False
    assert C.truncated(df.limit(0), {"text": model}).count() == 0
    empty = C.fit([])
    assert empty.is_cut("Some text.", "en")[0] is False and empty.is_cut("…", "en") == (False, 0.0)


def test_the_model_decides_every_row(spark, model):
    """Every row with a text is flagged by its score against the threshold of its language, by nothing else."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = C.truncated(docs, {"text": model}).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.truncated for r in rows) > 50
    for r in rows:
        assert r.truncated == (r.score is not None and r.score < model.thresholds["text", C.language_key(r.lang)])


def test_columns_have_thresholds_of_their_own(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    titles = C.fit(C.sample(docs, text="title", title=None))
    rows = C.truncated(docs, {"text": model, "title": titles})
    assert rows.count() == 2 * docs.count() and {r[0] for r in rows.select("column").distinct().collect()} == {"text", "title"}
    assert {k[0] for k in titles.thresholds} == {"title"} and ("text", "en") in model.thresholds
    shares = {r.source: r for r in C.share_by_source(rows.where("column = 'text'")).collect()}
    assert all(s.share is None or s.share == round(s.n_truncated / s.n_texts, 6) for s in shares.values())


def test_valley_and_borrowed_rows():
    import numpy as np

    bins = np.array([-20, -3, 1, 17, 18]), np.array([30, 5, 1, 400, 90])
    t = C.valley(*bins)
    assert 0.5 < t < 17 * C.BIN
    whole = {("c", "en"): dict(zip(*map(list, bins))), ("c", "xx"): {18: 1}}
    got = C.thresholds(whole)
    assert got["c", "xx"] == pytest.approx(got["c", ""], abs=0.5) and C.thresholds({}) == {}
    assert C.valley(np.array([-4]), np.array([9])) == 0.0


def test_line_states_never_share_a_context():
    import numpy as np

    for a in range(33, 127):
        one = {s: int(list(C._hashes(np.array([a], np.uint32), np.array([s])))[0][1][0]) for s in (0, 1)}
        assert one[0] != one[1]
    seen = {int(list(C._hashes(np.array([a], np.uint32), np.array([s])))[0][1][0]) for a in range(1, 3000) for s in (0, 1)}
    assert len(seen) == 2 * 2999


def _documents(spark, tmp_path):
    """sf0.01 with copies, long texts, signs, mixed scripts and rows without a text."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "title")
    first = docs.where("doc_id < 40")
    copies = first.withColumn("doc_id", F.col("doc_id") + 10**6).unionByName(first.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 2 * 10**6))
    odd = ["", "  ", None, "…", "[…]", "\n\n", "一句话。Reuters and AP\nThe court of Exampleville met", "Word " * 5000 + "ends here.", "x" * 4000 + ". And then", "See <a href", "A &amp", "One line. Read more", "Tail \x0b  of blanks  ", "<"]
    odd = spark.createDataFrame([(3 * 10**6 + i, t, "en", "odd", " " if i % 2 else None) for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string, title string")
    docs.unionByName(copies).unionByName(odd).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


def test_every_text_takes_part_in_the_end_model(spark, tmp_path, monkeypatch):
    """p10_found rests on all rows: its cuts are those of the model fitted on all of them, whatever the bounds of samples."""
    from newsloom.llm import queries

    docs = _documents(spark, tmp_path)
    rows = [(r.text, r.title) for r in docs.where(F.length(F.trim("text")) > 0).groupBy("text").agg(F.min("title").alias("title")).collect()]
    monkeypatch.setattr(C, "SAMPLE_ROWS", 30)
    monkeypatch.setattr(C, "SAMPLE_CHARS", 600)
    got = sorted(r.doc_id for r in queries.p10_found(spark, str(tmp_path)).collect())
    want = C.truncated(docs, {"text": C.fit(rows)}).where("truncated")
    assert got == sorted(r.doc_id for r in want.collect()) and len(got) > 100


@pytest.mark.parametrize("held", [2_000_000, 1])
def test_counts_of_tasks_give_the_model_of_all_rows(spark, tmp_path, monkeypatch, held):
    import numpy as np

    from newsloom.llm import endcounts as E

    docs = _documents(spark, tmp_path)
    monkeypatch.setattr(E, "HELD_ROWS", held)
    if held == 1:
        monkeypatch.setattr(E, "CHARS", 5000)
        monkeypatch.setattr(E, "bitmap", lambda classes, bits: np.full(1 << 16, 255, np.uint8))  # full, so all contexts are counted
        monkeypatch.setattr(E, "BROADCAST_REPEATS", 0)
    rows = [(r.text, r.title) for r in docs.where(F.length(F.trim("text")) > 0).groupBy("text").agg(F.min("title").alias("title")).collect()]
    want = {r.doc_id: r for r in C.truncated(docs, {"text": C.fit(rows)}).collect()}
    got = {r.doc_id: r for r in E.truncated(docs).collect()}
    assert got.keys() == want.keys()
    for i, r in want.items():
        assert (got[i].source, got[i].column, got[i].truncated) == (r.source, r.column, r.truncated)
        assert got[i].score == (r.score if r.score is None else pytest.approx(r.score, abs=1e-9))


def test_end_model_of_few_and_no_rows(spark):
    from newsloom.llm import endcounts as E

    df = spark.createDataFrame([(1, None, None, None, None), (2, " ", "en", "s", "A title"), (3, "…", "en", "s", None)], "doc_id long, text string, lang string, source string, title string")
    assert E.truncated(df.limit(0)).count() == 0
    assert sorted((r.doc_id, r.truncated, r.score) for r in E.truncated(df).collect()) == [(1, False, None), (2, False, None), (3, False, None)]
    one = E.truncated(df.unionByName(spark.createDataFrame([(4, "Only one text.", "en", "s", None)], df.schema)))
    assert one.where("score is not null").count() == 1


def test_cuts_at_one_place_are_no_sign_off_in_a_larger_table():
    """Of 8 000 texts 4 are cut behind the same words with a comma; as a share they are too few to be a sign-off."""
    random.seed(3)
    words = ["council", "river", "harbour", "minister", "grain", "letter", "winter", "signal"]
    line = lambda: "The " + ", ".join(random.choice(words) for _ in range(6)) + "."
    rows = [(f"{line()}\n{line()} {i}.", None) for i in range(8000)]
    cut = [f"{line()}\nThe {w} told reporters in," for w in words[:4]]
    model = C.fit(rows + [(t, None) for t in cut])
    assert all(C.hash_of(t) not in model.counted for t in cut) and C.alike_from(4000) == C.ALIKE

import uuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import page, text as X
from newsloom.operators import packing as K


def one(spark, c, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "t string").select(c(F.col("t"))).collect()]


def test_clean(spark):
    got = one(spark, X.clean, "![a](b.png) see [here](http://x.y) now", "# Head\nbody  text\n\n---\nmail a.b@c.org", "call 1234567890 or 123456789", None, "", "a​b <b>c</b>\n```x\ny```")
    assert got == ["see here now", "body text\nmail", "call or 123456789", None, "", "ab c"]


def test_clean_golden(spark):
    """Rows worked out by hand, not from the list of patterns."""
    rows = {
        "#Brexit talks resume\n# Heading\n#\n####### seven": "#Brexit talks resume\n#\n####### seven",
        "a ![x] b](c) d": "a d",
        "[one [two](http://a.b) three": "[one two three",
        "id12345678901x and 12345678901, 123456789": "id12345678901x and , 123456789",
        "***\n *** \n___\n-----": "***\n___",
        "mail a.b@c-d.example or x@y.org.": "mail a.b@c-d.example or .",
        "see http://x.y/z?q=1, then https://": "see then https://",
    }
    assert dict(zip(rows, one(spark, X.clean, *rows))) == rows


def test_pre_clean_golden(spark):
    rows = {
        "The added value grew.\nAds by the shop\nOur Cookie Notice is here\nMore": "The added value grew.\nOur\nMore",
        "PARIS (AP) The  vote\nPARIS (AP) The  vote\n\n x": "PARIS The vote\nx",
        "Text. Subscribe now for more\nLog in to continue\nLogin to continue reading": "Text.\nLog in to continue",
        "All rights reserved.": "All rights reserved.",
    }
    assert dict(zip(rows, one(spark, X.pre_clean, *rows))) == rows


def test_first_sentences_golden(spark):
    got = one(spark, X.first_sentences, '"One. Two! Three? Four. Five.', "-- a.  b", "中文。 Two. x", "   ", None)
    assert got == ["One. Two! Three? Four.", "- a. b", "中文。 Two. x", "", None]


def test_dates_and_names_golden(spark):
    text = "On Jan 5, 2024 and 2024-01-02, 5.1.24; march 12 99. x2024-01-02 Maison Café Anna-Maria of New York\nCity, McDonald"
    e = one(spark, X.entities, text)[0]
    assert e["dates"] == ["Jan 5, 2024", "2024-01-02", "5.1.24", "march 12 99"]
    assert e["names"] == ["On Jan", "Maison", "Anna", "Maria", "New York\nCity"]
    assert one(spark, lambda c: X.must_keep(X.entities(c), 4), text)[0] == ["on jan", "maison", "anna", "maria"]


def test_language_sentences(spark):
    df = spark.createDataFrame([("Dr. Smith met Mr. Lee. He left.", "en"), ("Eins. Zwei drei.", "de"), ("这是第一个很长的句子用来测试切分结果如何处理中文文本。短句。", "zh"), ("no mark here", "ja"), ("  ", "zh"), (None, "en")], "t string, l string")
    got = [r[0] for r in df.select(X.sentences_in(F.col("t"), F.col("l"))).collect()]
    assert got[0] == ["Dr. Smith met Mr. Lee.", "He left."] and got[1] == ["Eins.", "Zwei drei."]
    assert got[2] == ["这是第一个很长的句子用来测试切分结果如何处理中文文本。"] and got[3] == ["no mark here"] and got[4] == [] and not got[5]
    c = [r[0] for r in df.select(X.chunk_text(F.col("t"), F.col("l"), 10, "ab")).collect()]
    assert c[1] == ["Eins.", "Zwei drei."] and c[4] is None


def test_squeeze_nested(spark):
    df = spark.createDataFrame([(("a  b", ["c\n d", None], {"k": " e "}, 3),), (None,)], "r struct<s:string,l:array<string>,m:map<string,string>,n:int>")
    r = df.select(X.squeeze_nested(F.col("r"), df.schema["r"].dataType).alias("r")).collect()
    assert r[0].r.s == "a b" and r[0].r.l == ["c d", None] and r[0].r.m == {"k": "e"} and r[0].r.n == 3 and r[1].r is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab ", max_size=30), max_size=15), st.integers(1, 12))
def test_packed_keeps_order_and_limit(parts, limit):
    out = X.packed(parts, limit)
    assert all(0 < len(x) <= limit for x in out)
    assert "".join("".join(out).split()) == "".join("".join(parts).split())


def test_language_stages(spark):
    from newsloom.functions import language as L

    rows = {
        "The council of the town met on Monday and agreed that the plan is for all.": "en", "Le conseil de la ville a décidé que les travaux sont pour une autre année.": "fr",
        "Der Rat der Stadt beschloss, dass die Arbeiten nicht auf eine Woche verschoben werden.": "de", "El consejo de la ciudad decidió que las obras se hagan por una empresa.": "es",
        "Il consiglio della città ha deciso che gli orari non sono per una sola linea.": "it", "O conselho da cidade decidiu que as obras não são para uma só empresa.": "pt",
        "Совет города решил снова открыть мост.": "ru", "委员会决定重新开放大桥。": "zh", "": "en", "12345": "en",
    }
    df = spark.createDataFrame([(k, v) for k, v in rows.items()] + [(None, "en")], "t string, want string").select("t", "want", L.detected(F.col("t")).alias("d"))
    got = df.collect()
    assert all(r.d.code == r.want for r in got), [(r.t, r.d) for r in got if r.d.code != r.want]
    assert {r.d.stage for r in got} == {0, 1, 2} and all(0 <= r.d.confidence <= 1 for r in got)


def test_clean_is_idempotent(spark, sf):
    t = spark.read.parquet(f"{sf}/documents.parquet").select(X.clean(F.col("text")).alias("a"))
    assert t.where(~F.col("a").eqNullSafe(X.clean(F.col("a")))).count() == 0


def test_sentences_and_split(spark):
    text = "One two. Three four! Is it? 中文。 यह वाक्य है। End"
    assert one(spark, X.sentences, text)[0] == ["One two.", "Three four!", "Is it?", "中文。", "यह वाक्य है।", "End"]
    chunks = one(spark, lambda c: X.smart_split(c, 12), text + " " + "x" * 30)[0]
    assert max(map(len, chunks)) <= 12 and "".join("".join(chunks).split()) == "".join((text + "x" * 30).split())
    assert one(spark, lambda c: X.smart_split(c, 12, 1), text)[0] == ["One two."]
    assert one(spark, lambda c: X.smart_split(c, 12), "", "   ") == [[], []]


def test_content_id_is_uuid5(spark):
    values = ["", "a", "Grüße 🙂", "x" * 5000]
    assert one(spark, X.content_id, *values) == [str(uuid.uuid5(uuid.NAMESPACE_URL, v)) for v in values]


def test_entities_keep_first_spelling(spark):
    e = one(spark, X.entities, "Paris met PARIS and John Smith on 2024-01-02, 1/2/24, 5 and 5.")[0]
    assert e["names"] == ["Paris", "John Smith"] and e["dates"] == ["2024-01-02", "1/2/24"] and e["numbers"][-1] == "5"


def test_tolerant_json(spark):
    got = one(spark, lambda c: X.tolerant_json(c, "k int"), '{"k": 1}', '```json\n{"k": 2}\n```', 'Sure: {"k": 3} done', "none", None)
    assert [g and g["k"] for g in got] == [1, 2, 3, None, None]


def test_times(spark):
    got = one(spark, lambda c: X.parse_time(c).cast("string"), "2025-03-01T09:19:14", " 20250301T110651Z", "2025-03-01 12:57:53", "2025-03-01", "18/03/2025", "soon", "", None)
    assert got == ["2025-03-01 09:19:14", "2025-03-01 11:06:51", "2025-03-01 12:57:53", "2025-03-01 00:00:00", "2025-03-18 00:00:00", None, None, None]


def test_html():
    assert page.paragraphs_of("<p>a<p>b&amp;c\xa0d</p>x<div>y</div>") == "a b&c d"
    assert page.paragraphs_of(None) is None and page.paragraphs_of("") == ""
    body = " ".join(["word"] * 30)
    assert page.main_text_of(f"<nav><p>{body}</p></nav><div class='cookie-bar'><p>{body}</p></div><p>{body}</p><p>short</p>") == body


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc ", min_size=1, max_size=40).map(lambda s: s.strip() or "a"), max_size=20), st.integers(1, 12), st.integers(0, 6))
def test_windows_make_progress_and_lose_nothing(sentences, size, overlap):
    out = K.windows_of(sentences, size, overlap)
    assert len(out) <= max(len(sentences), 0)
    rest = list(sentences)
    for w in out:
        while rest and rest[0] in w:
            rest.pop(0)
    assert not rest


def by_queue(lengths, slots, bias=0.0):
    """The rule written out anew: both sides as lists of finish times."""
    remote, local, out = [0.0], [0.0] * slots, []
    for n in lengths:
        far = remote[-1] + 120.0 * ((n + 4799) // 4800) + 0.010 * n + bias
        slot = min(range(slots), key=local.__getitem__)
        near = local[slot] + 6.0 * ((n + 511) // 512) + 0.030 * n
        if near < far:
            local[slot] = near
        else:
            remote.append(far)
        out.append("local" if near < far else "remote")
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60000), max_size=40), st.integers(1, 4), st.sampled_from([0.0, 200.0]))
def test_router_against_the_rule(lengths, slots, bias):
    assert K.route_of(lengths, slots=slots, bias=bias) == by_queue(lengths, slots, bias)


def test_router():
    assert K.route_of([100, 100000], slots=1) == ["local", "remote"]
    assert K.route_of([], slots=2) == [] and K.route_of([0], slots=1) == ["remote"]
    # a text meant for the remote side stays local while the remote queue would finish later
    assert K.route_of([10, 10], slots=1, cut_over=5) == ["local", "local"]
    long = [40000] * 6
    assert K.route_of(long, slots=1, cut_over=5) == by_queue(long, 1) and "local" in K.route_of(long, slots=1, cut_over=5)
    try:
        K.route_of([1], slots=0)
        raise AssertionError
    except ValueError:
        pass

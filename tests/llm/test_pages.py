import pytest
from pyspark.sql import functions as F

from newsloom.llm import boilerplate as B, pages as G, queries as Q
from newsloom.llm.pagemodel import HEADING, PROSE, TITLE, Page, has_field, is_filler, open_fields

ARTICLE = (
    "Home | World | Politics | Sport | Search\n## Ferry link to Dornvik restored\nBy Halmer\n12 shares\n"
    "The harbour office reopened the ferry link on Monday, after an audit, and the first boats left at dawn.\n\n"
    "Readers who subscribe to the paper in Dornvik now pay 12 crowns a year.\nAdvertisement\n"
    "### What happens next\n- The council will vote on the timetable on Friday.\n"
    "Most read\nMiners in Tolvik vote for strike\n10:15 Dam near Orvik said to be safe\n© 2025 Dornvik Herald. All rights reserved.\r\nAbout us | Contact | Careers"
)
SCHEMA = "id string, raw_text string, title string, domain string, language string, extra string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_article_lines():
    p = Page(ARTICLE, "Ferry link to Dornvik restored", "")
    B.settle_short(p)
    kept = [n for n, k in enumerate(B.kept_lines(p), 1) if k]
    assert kept == [2, 5, 7, 9, 10]


def kept(text, title=None):
    p = Page(text, title, "")
    B.settle_short(p)
    return [n for n, k in enumerate(B.kept_lines(p), 1) if k], p


def test_scores_decide(monkeypatch):
    lines, p = kept(ARTICLE, "Ferry link to Dornvik restored")
    assert lines and set(lines) != {n for n, k in enumerate(p.kind, 1) if k in (PROSE, HEADING, TITLE)} or lines == [2, 5, 7, 9, 10]
    monkeypatch.setattr(B, "points", lambda page, i: 0.0)
    assert kept(ARTICLE, "Ferry link to Dornvik restored")[0] == []


BODY = (
    "Ferry link restored\nThe harbour office reopened the ferry link on Monday, after an audit, and the first boats left at dawn.\n"
    "The council, which had closed it, will vote again on Friday.\n"
)


def test_furniture_in_other_words():
    """No phrase of these lines is in the lexicon: they go because they speak to the reader or stand behind links that outweigh them."""
    before = "Home | World | Politics\nTo keep things running smoothly, we and our vendors put small data crumbs on your device.\nBecome a member and help us pay for the reporters you trust.\n"
    after = "Send this piece to a friend who may like it, and tell us what you think.\nGet our morning digest straight to your mailbox.\nAbout us | Contact | Careers\n© 2025 X.\nAdvertisement\nAll texts are kept for ten years in the vault.\n"
    assert kept(before + BODY + after, "Ferry link restored")[0] == [4, 5, 6]


def test_texts_of_teasers_go_by_link_density():
    teasers = "Most read\nMiners in Tolvik vote\nThe union called the vote, after long talks, a success.\nDam near Orvik safe\nThe works, old as they are, held.\n"
    assert kept(BODY + teasers + "Advertisement\n", "Ferry link restored")[0] == [1, 2, 3]
    # an article goes on behind a list without texts, and behind a label that carries its own headline
    more = "The port, the mayor said, had been closed for a week.\nNobody was hurt, and no boat was lost.\n"
    assert kept(BODY + "Most read\nMiners in Tolvik vote\nDam near Orvik safe\n" + more, "Ferry link restored")[0] == [1, 2, 3, 7, 8]
    assert kept(BODY + "Most read: Miners in Tolvik vote\nWhat comes next\n" + more, "Ferry link restored")[0] == [1, 2, 3, 5, 6, 7]


def test_long_notices_and_passing_cues():
    notice = "This site uses cookies. " + "We keep them so that you can read your pages again. " * 20
    passing = "The clerk read out the notice, and it said that the site values your privacy. " + "The council then turned to the budget, the port and the school, and nobody objected. " * 8
    assert kept(notice + "\n" + BODY, "Ferry link restored")[0] == [2, 3, 4]
    assert kept(BODY + passing, "Ferry link restored")[0] == [1, 2, 3, 4]


def test_a_body_does_not_depend_on_other_pages(spark):
    df = frame(spark, [("a", ARTICLE, "Ferry link to Dornvik restored", None, "en", "x")])
    more = frame(spark, [(f"b{i}", None, t, None, None, None) for i, t in enumerate(["Miners in Tolvik vote for strike"] * 50)])
    rows = lambda x: {(r.id, r.line_no) for r in G.boilerplate_lines(x).collect()}
    assert rows(df) == rows(df.unionByName(more))


def test_edges_of_the_body(spark):
    long = "The council met again and agreed on the plan. " * 20000
    df = frame(spark, [
        ("a", ARTICLE, "Ferry link to Dornvik restored", None, "en", "x"), ("a", ARTICLE, "Ferry link to Dornvik restored", None, "en", "x"),
        ("b", None, None, None, None, None), ("c", "", "", "", "", ""), ("d", " \n\t ", "t", "d", "en", "x"), ("e", long, None, "  WWW.x.example ", None, None), (None, "One sentence stands here.", None, None, None, None),
    ])
    got = {}
    for r in G.boilerplate_lines(df).collect():
        got.setdefault(r.id, []).append(r.line_no)
    assert sorted(got["a"]) == [1, 3, 4, 8, 11, 12, 13, 14, 15] and set(got) == {"a"}
    assert G.boilerplate_lines(df.limit(0)).count() == 0
    clash = df.withColumn("boiler_lines", F.lit(1)).withColumn("kind", F.lit("z")).withColumn("body", F.lit("y"))
    assert G.boilerplate_lines(clash).count() == 9


@pytest.mark.parametrize("line", ["{{title}}", "${ body }", "<%= HEADLINE %>", "%%teaser%%", "@@x_y@@", "__AUTHOR_NAME__", "[[date]]", "[PUBLISH_DATE]", "&lt;body&gt;", "<!-- section -->", "{% block x %}", "#{body}"])
def test_placeholders(line):
    assert has_field(line) and open_fields("By " + line + " today") and not open_fields(f'It began with "Dear {line}" and ended.')


def test_no_placeholders():
    for line in ("a {b} c", "see [1] and [2]", "5 % and 6 % of", "mail@@", "snake__case word", "a <b> c", "[NATO] said"):
        assert not open_fields(line)


def test_filler():
    assert is_filler("Moris cullum quamet dolun abore ferrim tantil pellat.") and not is_filler("The council of the town met on Monday to vote again.") and not is_filler("Moris cullum.")


def test_residue(spark):
    menu = "Home | World | Politics | Sport\n"
    df = frame(spark, [
        ("msg", menu + "404 - Page not found.\n© 2025 X.", "t", None, None, None), ("js", "Please turn on JavaScript to view this page.", "t", None, None, None),
        ("field", "{{headline}}\n{{ body }}", "t", None, None, None), ("inside", "The mayor met {{name}} on Monday in the town hall.\nThe talks went on for hours in the evening.", "t", None, None, None),
        ("quote", 'Thousands got a letter that began with "Dear {{first_name}}", the utility said.', "t", None, None, None),
        ("report", 'For 3 hours the portal answered every request with "404 Not Found".\nThe town apologised for it on the same evening.', "t", None, None, None),
        ("short", "The dam is safe.", "t", None, None, None), ("null", None, "t", None, None, None), ("blank", "  \n ", "t", None, None, None),
    ])
    assert {r.id: r.kind for r in G.residue(df).collect()} == {"msg": "message", "js": "message", "field": "fields", "inside": "field"}
    assert G.residue(df.limit(0)).count() == 0


TALK = "The council met on Monday and agreed on the plan for the bridge.\nMembers voted late in the evening.\n"


@pytest.mark.parametrize("text", [
    TALK + "```\n<h1>{{ title }}</h1>\n```\nThe vote was close.", TALK + "In Jinja you write {{ name }} to print a value.", TALK + "Python calls __init__ first and looks at __name__ then.",
    TALK + "The ruling cites [[Smith 2019]] and [[Paris]] twice.", TALK + "Type this into the template:\n\n    {{ user.name }}\n\nThen save.",
])
def test_fields_that_are_shown(text):
    assert B.residue_verdict(Page(text, "t", "")) is None


def test_fields_and_messages_that_are_residue():
    verdict = lambda x: B.residue_verdict(Page(x, "t", ""))
    assert verdict(TALK + "The mayor met {{name}} at noon.") == "field" and verdict("Template {{title}} {{body}}") == "fields"
    assert verdict("Oops! We lost that page.") == "message" and verdict("We walked home.") is None
    assert verdict("```\n{{ title }}") == "fields"  # a fence that is never closed is no code


def test_named_language():
    names = {"en": "en", "eng": "en", "english": "en"}
    assert [G.named_language(x, names) for x in ("EN", " en-GB", "eng", "English", "xx", "", None)] == ["en"] * 4 + [None] * 3


def test_languages_on_held_out_lines(spark, sf):
    feeds = spark.read.parquet("/root/testdata/sf0.01/feeds.parquet")
    names = G.language_names(spark.read.parquet(f"{sf}/language_names.parquet"))
    model = G.fit_languages(feeds, names)
    lines = {
        "en": "The council agreed on Tuesday to open the bridge again after the flood.", "fr": "Le conseil a décidé mardi de rouvrir le pont après la crue du fleuve.",
        "de": "Der Rat beschloss am Dienstag, die Brücke nach der Flut wieder zu öffnen.", "es": "El consejo acordó el martes abrir de nuevo el puente tras la crecida.",
        "it": "Il consiglio ha deciso martedì di riaprire il ponte dopo la piena del fiume.", "pt": "O conselho decidiu na terça-feira reabrir a ponte depois da cheia do rio.",
        "ru": "Совет решил во вторник снова открыть мост после паводка на реке.", "zh": "委员会在星期二决定在洪水之后重新开放这座大桥。",
    }
    best, sure = model.decode(list(lines.values()))
    assert [model.languages[i] for i in best] == list(lines)
    best, sure = model.decode(["", "12345 !!!"])
    assert list(best) == [-1, -1] and list(sure) == [0, 0]
    mixed = "\n".join([lines["en"]] * 3 + [lines["fr"]])
    df = frame(spark, [("a", mixed, None, None, "fr", None), ("b", lines["de"], None, None, "German", None), ("c", None, None, None, "en", None), ("d", "404 not found", None, None, "en", None), ("e", "", None, None, None, None)])
    found = {(r.id, r.line_no, r.language) for r in G.language_findings(G.page_languages(df, model, names)).collect()}
    assert found == {("a", 0, "en"), ("a", 4, "fr")}
    assert G.page_languages(df.limit(0), model, names).count() == 0


def test_codewords_are_far_apart():
    from newsloom.llm.ecoc import codewords

    c = codewords(8)
    assert min((c[i] != c[j]).sum() for i in range(8) for j in range(i)) >= 5 and codewords(2).shape[0] == 2


def test_queries_run(spark, sf):
    q = Q.queries()
    assert q["p1_found"](spark, sf).columns == ["id", "line_no"] and q["p2_found"](spark, sf).columns == ["id", "line_no", "language"] and q["p5_found"](spark, sf).columns == ["id"]
    assert q["p1_article"](spark, sf).count() > 0 and q["p5_kept"](spark, sf).count() > 0 and q["p2_languages"](spark, sf).count() > 0

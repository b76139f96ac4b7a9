"""News meta of a text: subject by key words, names by form, quality gates of a summary, tolerant normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X

#: Subjects and the words that speak for them (fixed values); the first subject wins a tie.
DOMAINS = {
    "politics": ("president", "election", "parliament", "minister", "congress", "bolsonaro", "trump", "moraes"),
    "business": ("market", "startup", "acquisition", "merger", "ipo", "revenue", "profit"),
    "tech": ("ai", "software", "chip", "semiconductor", "cyber", "app", "cloud"),
    "culture": ("exhibit", "museum", "festival", "art", "fashion", "show"),
    "sports": ("match", "cup", "league", "tournament", "goal"),
    "science": ("research", "study", "scientist", "lab", "space"),
    "health": ("hospital", "vaccine", "virus", "health", "disease"),
    "environment": ("amazon", "climate", "emissions", "deforestation", "wildfire"),
    "world": ("conflict", "border", "diplomatic"),
    "local": ("mayor", "city council", "municipal"),
}
#: Forms of topics, people, organisations and places (fixed values).
TOPIC = X.BEFORE + r"[a-z]{4,}" + X.AFTER
PEOPLE = X.BEFORE + r"[A-Z][a-z]+ [A-Z][a-z]+" + X.AFTER
ORGS = X.BEFORE + r"[A-Z]{2,}(?: [A-Z]{2,})*" + X.AFTER
PLACES = X.BEFORE + r"[A-Z][a-z]+(?:,[ \t\r\n\f\x0B]*[A-Z][a-z]+)?" + X.AFTER

META = (
    "struct<domain:string,topics:array<string>,is_politics_central:boolean,entities:struct<people:array<string>,orgs:array<string>,places:array<string>>,"
    "event_date:string,geo:struct<country:string,region:string,city:string>>"
)
_NO_STRINGS = "cast(array() as array<string>)"


def domain(c: Column) -> Column:
    """The subject with the most of its words in a text, the first of equals; 'world' where there is none."""
    def best(low: Column) -> Column:
        hits = [F.struct(sum((F.contains(low, F.lit(w)).cast("int") for w in ws[1:]), F.contains(low, F.lit(ws[0])).cast("int")).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("k")) for i, (k, ws) in enumerate(DOMAINS.items())]
        return X.let(F.array_max(F.array(*hits)), lambda b: F.when(b["n"] > 0, b["k"]).otherwise("world"))

    return X.let(F.lower(c), best)


def _distinct(c: Column, pattern: str, most: int) -> Column:
    return F.slice(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), 0)), 1, most)


def heuristic_meta(c: Column) -> Column:
    """Meta of a text from key words and forms alone: at most six topics and ten names of each kind."""
    d = domain(c)
    names = F.struct(_distinct(c, PEOPLE, 10).alias("people"), _distinct(c, ORGS, 10).alias("orgs"), _distinct(c, PLACES, 10).alias("places"))
    none = F.lit(None).cast("string")
    return F.struct(
        d.alias("domain"), _distinct(F.lower(c), TOPIC, 6).alias("topics"), (d == "politics").alias("is_politics_central"), names.alias("entities"),
        none.alias("event_date"), F.struct(none.alias("country"), none.alias("region"), none.alias("city")).alias("geo"),
    )


def normalised_meta(c: Column) -> Column:
    """Meta of whatever a model wrote: JSON fenced or within prose, topics as a list or one string with commas.

    The subject is lower case, 'world' where there is none; lists are trimmed, without repeats and bounded;
    blanks in the rest are null. Text that is no JSON gives the defaults.
    """
    names = "people array<string>, orgs array<string>, places array<string>"
    raw = X.tolerant_json(c, f"domain string, topics string, is_politics_central boolean, entities struct<{names.replace(' array', ':array')}>, event_date string, geo struct<country:string,region:string,city:string>")

    def built(r: Column) -> Column:
        listed = F.from_json(r["topics"], "array<string>")
        parted = F.filter(F.transform(F.split(r["topics"], ","), lambda x: F.trim(x)), lambda x: x != "")
        topics = F.coalesce(F.when(r["topics"].startswith("["), listed), parted, F.expr(_NO_STRINGS))
        held = lambda k: F.slice(F.array_distinct(F.transform(F.coalesce(r["entities"][k], F.expr(_NO_STRINGS)), lambda x: F.trim(x))), 1, 10).alias(k)
        filled = lambda x: F.when(x != "", x)
        return F.struct(
            F.lower(F.coalesce(filled(r["domain"]), F.lit("world"))).alias("domain"), F.slice(topics, 1, 6).alias("topics"), F.coalesce(r["is_politics_central"], F.lit(False)).alias("is_politics_central"),
            F.struct(held("people"), held("orgs"), held("places")).alias("entities"), filled(r["event_date"]).alias("event_date"),
            F.struct(*[filled(r["geo"][k]).alias(k) for k in ("country", "region", "city")]).alias("geo"),
        ).cast(META)

    return X.let(raw, built)


def quality_gates(summary: Column, must: Column, e: Column) -> Column:
    """Gates of a summary against the entities of its source.

    ``entity_coverage``: at least half of the strings to keep, and one, are in it; ``missing``: up to ten that are
    not, where that fails. ``temporal``: it has a date; if not, a line with the source's first date is added.
    ``numeric_ok``: it has a figure, or the source has none; if not, a line with the source's first three is added.
    ``redundancy_ok``: at least .6 of its word pairs are distinct.
    """
    low = F.lower(summary)
    inside = F.filter(must, lambda m: F.contains(low, m))
    covered = F.size(inside) >= F.greatest(F.lit(1), F.floor(F.size(must) / 2))
    outside = F.slice(F.filter(must, lambda m: ~F.contains(low, m)), 1, 10)
    temporal = summary.rlike(X.DATES)
    one = F.when(~temporal & (F.size(e["dates"]) > 0), F.concat(summary, F.lit("\nTimeline: "), F.element_at(e["dates"], 1), F.lit(" (source)."))).otherwise(summary)

    def noted(s: Column) -> Column:
        bare = ~s.rlike(X.BEFORE + "[0-9]") & (F.size(e["numbers"]) > 0)
        two = F.when(bare, F.concat(s, F.lit("\nNote: Source mentioned figures such as "), F.array_join(F.slice(e["numbers"], 1, 3), ", "), F.lit("."))).otherwise(s)
        words = F.regexp_extract_all(F.lower(two), F.lit(r"[\p{L}\p{N}_]+"), 0)
        ratio = X.let(X.bigrams(words), lambda b: F.when(F.size(b) > 0, F.size(F.array_distinct(b)) / F.size(b)).otherwise(1.0))
        return F.struct(
            covered.alias("entity_coverage"), F.when(covered, F.expr(_NO_STRINGS)).otherwise(outside).alias("missing"), temporal.alias("temporal"), (~bare).alias("numeric_ok"),
            (ratio >= 0.6).alias("redundancy_ok"), two.alias("summary"),
        )

    return X.let(one, noted)

"""Text functions as column expressions; all but the packing of chunks stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLANK = r"[ \t\r\f\x0B]"

#: Edges of words in any script; a plain word boundary means ASCII words in some Java versions only.
BEFORE, AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
#: Junk removal in order: pattern, replacement (fixed values). Java needs (?d) or (?md) so that only line feeds end lines.
CLEAN_STEPS = (
    ("\\x{200B}", ""),
    (r"(?d)!\[.*?\]\(.*?\)", ""),
    (r"\[([^\[\]]+)\]\([^()]+\)", "$1"),
    (r"https?://[^ \t\r\f\x0B\n]+", ""),
    (r"<[^>]+>", ""),
    (r"(?md)^#{1,6}[ \t\r\f\x0B]+[^\n]*$", ""),
    (r"(?md)^(?:-{3,}|\*{3,})$", ""),
    (r"(?s)```.*?```", ""),
    (r"[\p{L}\p{N}_][\p{L}\p{N}_.-]*@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]{2,4}" + AFTER, ""),
    (BEFORE + "[0-9]{10,}" + AFTER, ""),
    (_BLANK + "+", " "),
    (r" *\n *", "\n"),
    (r"\n+", "\n"),
    (r"^[ \n]+|[ \n]+$", ""),
)
#: Notices in page text, each up to the end of its line, and a wire credit (fixed values).
NOTICES = (
    r"(?i)\bcookies? (?:notice|policy)\b[^\n]*",
    r"(?i)\b(?:ads?|advertisement|sponsored)\b[^\n]*",
    r"(?i)\bprivacy (?:notice|policy)\b[^\n]*",
    r"(?i)\bsubscribe now\b[^\n]*",
    r"(?i)\b(?:login|sign in) to continue\b[^\n]*",
    r"\([ \t]*AP[ \t]*\)",
    r"(?i)\bby[ \t]*,?[ \t]*by[ \t]*,?[ \t]*and[ \t]*received[ \t]*from\b[^\n]*",
)
#: Ends of sentences: Latin, Devanagari, Arabic and CJK marks.
TERMINATORS = ".!?।؟。！？"
WORD = r"[\p{L}\p{N}_\p{M}]+"
#: A word, or one other mark; the blanks are named, since regular expression engines differ over them.
TOKEN = r"([\p{L}\p{N}_\p{M}]+|[^\p{L}\p{N}_\p{M} \t\r\n\f\x0B])"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often and inside whatever lambda it is used."""
    return F.transform(F.array(value), use)[0]


def clean(c: Column) -> Column:
    """Text without markup, links, headings, code, addresses and long numbers; lines squeezed, blank lines gone."""
    for pattern, by in CLEAN_STEPS:
        c = F.regexp_replace(c, pattern, by)
    return c


def squeeze(c: Column) -> Column:
    """Runs of blanks and line feeds as one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"[ \t\r\f\x0B\n]+", " "))


def pre_clean(c: Column) -> Column:
    """Lines cut from a notice on and without wire credits, trimmed, repeated lines dropped in order, blank runs squeezed."""
    for pattern in NOTICES:
        c = F.regexp_replace(c, pattern, "")
    trimmed = F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, r"^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$", ""))
    return F.regexp_replace(F.array_join(F.array_distinct(F.filter(trimmed, lambda x: x != "")), "\n"), "[ \\t]+", " ")


def squeeze_nested(c: Column, kind: T.DataType) -> Column:
    """Every string in a value of any depth (structs, arrays, map values) squeezed; other values stay."""
    if isinstance(kind, T.StringType):
        return squeeze(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: squeeze_nested(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: squeeze_nested(v, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[squeeze_nested(c[f.name], f.dataType).alias(f.name) for f in kind]))
    return c


def sentences(c: Column, least: int = 0) -> Column:
    """Array of sentences: cut at white space after a terminator; with ``least``, only those longer than it once trimmed."""
    marked = F.regexp_replace(c, rf"([{TERMINATORS}])[ \t\r\n]+", "$1\x01")
    parts = F.filter(F.transform(F.split(marked, "\x01"), squeeze), lambda x: x != "")
    return F.filter(parts, lambda x: F.length(x) > least) if least else parts


def first_sentences(c: Column, n: int = 4) -> Column:
    """The first n sentences of a squeezed text without a leading quotation mark or dash; '' where there is none."""
    bare = F.regexp_replace(squeeze(c), "^[\"'–—-] *", "")
    marked = F.regexp_replace(bare, "([.!?]) +", "$1\x01")
    return F.array_join(F.slice(F.split(marked, "\x01"), 1, n), " ")


#: Languages whose sentences end at a mark before white space; in all others a mark alone ends one.
SPACED = ("en", "fr", "de", "es", "pt", "it", "nl", "tr", "sv", "da", "fi", "no", "pl", "sl", "et", "el", "ru")
#: Words before a full stop that end no sentence, for the languages that have such a list.
ABBREVIATIONS = {
    "en": ("Mr", "Mrs", "Ms", "Dr", "Prof", "Sen", "Rep", "Gov", "Gen", "St", "No", "vs"),
    "de": ("Dr", "Prof", "Nr", "bzw", "ca", "usw"),
    "fr": ("M", "Mme", "Dr", "Prof", "av"),
    "es": ("Sr", "Sra", "Dr", "Dra", "Prof"),
    "it": ("Sig", "Dott", "Prof"),
    "pt": ("Sr", "Sra", "Dr", "Dra", "Prof"),
}


def sentences_in(c: Column, lang: Column, least: int = 20) -> Column:
    """Sentences of a text in a language of the table; in another, those longer than ``least`` that end at any mark.

    Where that leaves none: the parts between full stops longer than ``least``, and the whole text where there are
    none of them either. Blank texts have none.
    """
    spaced = F.lit(None).cast("array<string>")
    for code in SPACED:
        held = c
        if code in ABBREVIATIONS:
            held = F.regexp_replace(c, rf"\b({'|'.join(ABBREVIATIONS[code])})\. ", "$1.\u0002")
        spaced = F.when(lang == code, F.transform(sentences(held), lambda x: F.replace(x, F.lit("\u0002"), F.lit(" ")))).otherwise(spaced)
    long = lambda a: F.filter(F.transform(a, squeeze), lambda x: F.length(x) > least)
    by_mark = long(F.regexp_extract_all(c, F.lit(rf"([^{TERMINATORS}]*[{TERMINATORS}]+|[^{TERMINATORS}]+$)"), 1))
    naive = long(F.split(c, "\\."))
    whole = F.when(squeeze(c) != "", F.array(c)).otherwise(F.expr("cast(array() as array<string>)"))
    other = let(by_mark, lambda a: F.when(F.size(a) > 0, a).otherwise(let(naive, lambda n: F.when(F.size(n) > 0, n).otherwise(whole))))
    return F.coalesce(spaced, other)


def words(c: Column) -> Column:
    """Lower-case words of two characters or more."""
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit(f"({WORD})"), 1), lambda w: F.length(w) >= 2)


def token_count(c: Column) -> Column:
    """Words and single other marks: the default stand-in for a model's token count."""
    return F.coalesce(F.size(F.regexp_extract_all(c, F.lit(TOKEN), 1)), F.lit(0))


def packed(parts: list[str], limit: int) -> list[str]:
    """Greedy packing of strings into chunks of at most ``limit`` characters, parted by a space; longer strings are sliced first."""
    out: list[str] = []
    cur: list[str] = []
    used = 0
    for s in parts:
        for i in range(0, len(s), limit):
            x = s[i : i + limit]
            if cur and used + len(x) + 1 > limit:
                out.append(" ".join(cur))
                cur, used = [], 0
            used += len(x) + (1 if cur else 0)
            cur.append(x)
    if used:
        out.append(" ".join(cur))
    return out


def pack(parts: Column, limit: int) -> Column:
    """``packed`` over Arrow batches: linear in the text, where a fold in expressions copies its chunks at each step."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else packed(list(x), limit))

    return run(parts)


def smart_split(c: Column, limit: int = 2000, most: int = 0) -> Column:
    """Sentences packed into chunks of at most ``limit`` characters; ``most`` > 0 keeps that many chunks."""
    out = pack(sentences(c), limit)
    return F.slice(out, 1, most) if most else out


def chunk_text(c: Column, lang: Column, limit: int, prefix: str = "summarize: ") -> Column:
    """Sentences packed into chunks of at most ``limit`` characters more than the prefix has; null where there are no sentences."""
    s = sentences_in(c, lang)
    return F.when(F.size(s) > 0, pack(s, limit + len(prefix)))


def content_id(c: Column) -> Column:
    """Name-based UUID (version 5, URL name space) of a text, so equal texts share an id."""
    h = F.sha1(F.concat(F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8")), F.encode(c, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def signature(c: Column) -> Column:
    return F.sha1(F.lower(c))


def unique_bigram_ratio(c: Column) -> Column:
    """Distinct word pairs over word pairs; null below two words."""
    return let(words(c), lambda w: F.when(F.size(w) >= 2, let(bigrams(w), lambda p: F.size(F.array_distinct(p)) / F.size(p))))


def bigrams(w: Column) -> Column:
    """Pairs of neighbouring words of an array; none below two words."""
    n = F.greatest(F.size(w) - 1, F.lit(0))
    return F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat_ws(" ", a, b))


#: Patterns of names, dates and figures (fixed values).
_GAP = r"[ \t\r\n\f\x0B]+"
CAPITALISED = BEFORE + rf"([A-Z][a-z]+(?:{_GAP}[A-Z][a-z]+){{0,3}})" + AFTER
DATES = "(?i)" + BEFORE + rf"([0-9]{{1,2}}[./-][0-9]{{1,2}}[./-][0-9]{{2,4}}|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*{_GAP}[0-9]{{1,2}},?{_GAP}[0-9]{{2,4}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})" + AFTER
NUMBERS = BEFORE + r"([0-9]+(?:[.,][0-9]+)?)" + AFTER


def entities(c: Column, most: int = 50) -> Column:
    """Struct of names, dates and numbers by pattern; case-insensitive duplicates keep their first spelling."""
    def first_spelling(found: Column) -> Column:
        both = F.struct(found.alias("f"), F.transform(found, F.lower).alias("l"))
        return let(both, lambda s: F.transform(F.slice(F.array_distinct(s["l"]), 1, most), lambda x: F.element_at(s["f"], F.array_position(s["l"], x).cast("int"))))

    return F.struct(
        first_spelling(F.regexp_extract_all(c, F.lit(CAPITALISED), 1)).alias("names"),
        first_spelling(F.regexp_extract_all(c, F.lit(DATES), 1)).alias("dates"),
        first_spelling(F.regexp_extract_all(c, F.lit(NUMBERS), 1)).alias("numbers"),
    )


def must_keep(e: Column, most: int = 15) -> Column:
    """Lower-case names, then the first five dates, of ``entities`` that a summary must keep, each once, at most ``most``.

    Each spelling stands once in a list of entities, so the order of frequency is that of first sight.
    """
    return F.slice(F.array_distinct(F.transform(F.concat(e["names"], F.slice(e["dates"], 1, 5)), F.lower)), 1, most)


def tolerant_json(c: Column, schema: str) -> Column:
    """Parsed JSON of a string that may be fenced or wrapped in prose; null if nothing parses."""
    bare = F.trim(F.regexp_replace(c, r"^\s*```(?:json)?\s*|\s*```\s*$", ""))
    braces = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    options = {"mode": "PERMISSIVE"}
    good = lambda x: F.when(F.try_parse_json(x).isNotNull(), F.from_json(x, schema, options))
    return F.coalesce(good(bare), good(braces))


def json_list(c: Column) -> Column:
    """List of strings from a JSON text; anything else is an empty list."""
    return F.coalesce(F.from_json(c, "array<string>"), F.expr("cast(array() as array<string>)"))


def parse_time(c: Column) -> Column:
    """Time from the formats that sources use, else null."""
    t = F.trim(c)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyyMMdd'T'HHmmss'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd", "dd/MM/yyyy")])

"""Line model of a page held as plain text: what each line is, before any decision about the article.

The page is lower-cased, its digit runs become ``0`` and its space runs one space; one automaton pass over
the whole page then finds every cue phrase of the lexicon, so the cost is linear in the text whatever the
number of cues. Line kinds are the leaves over which the tree scoring of ``boilerplate`` runs.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import cache, lru_cache

import ahocorasick

from . import lexicon

BLANK, PROSE, SHORT, HEADING, FURNITURE, MENU, LABEL, TEASER, RESIDUE, TITLE = range(10)

_SPACES = re.compile(r"[ \t   　]+")
_DIGITS = re.compile(r"[0-9]+")
_BULLET = re.compile(r"(?:[-*•–·▪]|0[.)])\s+")
_SEPARATOR = re.compile(r"\s*[|/•»·›]\s*")
_LINK = re.compile(r"\[([^\]]+)\]\(([^)]*)\)")
_SEPARATED = re.compile(r"[|/•»·›][^|/•»·›]*[|/•»·›]")
_CLOCK = re.compile(r"0:0 +(?=\S)")
_END = re.compile(r"[.!?…。！？:;：；]['\"”’»“)\]」』]*$|[.!?。！？]['\"”’»“)]*\s*$")
_CJK = re.compile(r"[㐀-鿿]")
_WORD = re.compile(r"[^\W\d_]+")

#: Unfilled fields, one grammar for each kind of delimiter.
PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]{1,60}\}\}"
    r"|\{%[^%\n]{1,60}%\}"
    r"|[$#]\{[^{}\n]{1,60}\}"
    r"|<%=?[^%\n]{1,60}%>"
    r"|%%[A-Za-z][\w.]{0,40}%%"
    r"|@@[A-Za-z][\w.]{0,40}@@"
    r"|\b__[A-Z](?:[A-Z0-9_]{0,38}[A-Z])?__\b|^\s*__[a-z](?:\w{0,38}[a-z])?__\s*$"  # a lower-case one inside a sentence is a name of code
    r"|\[\[(?:[a-z][a-z_.]{0,40}|[A-Z][A-Z_.]{1,40})\]\]"  # with blanks, digits or one capital it is a link or a citation
    r"|\[[A-Z]+(?:_[A-Z]+)+\]|\[(?:HEADLINE|BODY|SECTION|TEASER|TITLE|AUTHOR|DATE|IMAGE)\]"
    r"|&lt;\s?/?[A-Za-z][\w.]{1,40}\s?&gt;"
    r"|<!--\s*[\w.]{2,40}\s*-->"
)
_MAYBE_FIELD = re.compile(r"\{[{%]|[$#]\{|<%|%%|@@|__|\[\[|\[[A-Z]|&lt;|<!--")
_QUOTED = re.compile(r"\"[^\"\n]*\"|“[^”\n]*”|«[^»\n]*»|„[^“”\n]*[“”]|‘[^’\n]*’|`[^`\n]*`|「[^」\n]*」")


@cache
def automaton() -> ahocorasick.Automaton:
    """All cues with their kind; ``^`` and ``$`` become the line feed around each line."""
    a = ahocorasick.Automaton()

    def add(cue: str, kind: int) -> None:
        if cue.startswith("^"):
            cue = "\n" + cue[1:]
        if cue.endswith("$"):
            cue = cue[:-1] + "\n"
        if cue not in a:
            a.add_word(cue, (kind, len(cue), cue[0] == "\n"))

    for words in lexicon.FURNITURE.values():
        for w in words:
            add(w, FURNITURE)
    for words in lexicon.LABELS.values():
        for w in words:
            add("^" + w, LABEL)
    for w in lexicon.ERRORS + lexicon.FILLERS:
        add(w, RESIDUE)
    a.make_automaton()
    return a


@cache
def menu_words() -> frozenset[str]:
    return frozenset(w for v in lexicon.MENU.values() for w in v.split("|"))


@cache
def function_words() -> frozenset[str]:
    return frozenset(w for v in lexicon.FUNCTION_WORDS.values() for w in v.split())


@cache
def bylines() -> tuple[str, ...]:
    return tuple(lexicon.BYLINE.values())


#: Share of a line's characters in cue sentences from which the line is furniture; below it the cue is mentioned in passing.
CUE_SHARE = 0.2
_SENTENCE = re.compile(r"[^.!?。！？…]+(?:[.!?。！？…]+['\"”’»“)\]」』]*\s*)?")
#: Words by which a page speaks to its reader, outside quotation marks; none that also means a third person.
_ADDRESS = re.compile(
    r"\b(?:you|your|yours|our|ours|we|us|vous|votre|vos|nous|notre|nos|usted|ustedes|nuestr[oa]s?|tus?|wir|uns|unser(?:e[nmrs]?)?|ihnen|voi|vostr[oaie]|nostr[oaie]|tuo|tua|você|vocês|noss[oa]s?|вы|вас|вам|ваш\w*|наш\w*|мы|нас)\b|您|我们|你"
)


def addresses(line: str) -> bool:
    """Whether a lower-case line speaks to the reader outside quotation marks."""
    return bool(_ADDRESS.search(line) and _ADDRESS.search(_QUOTED.sub(" ", line)))


def cue_share(line: str, spans: list[tuple[int, int]]) -> float:
    """Share of a line's characters in sentences that a cue touches or that speak to the reader; an unended rest goes with the sentence before."""
    at = cued = 0
    last = False
    for m in _SENTENCE.finditer(line):
        a, b = m.span()
        last = any(s < b and e > a for s, e in spans) or addresses(m.group(0)) or (last and b == len(line) and not _END.search(line[-16:]))
        cued += (b - a) * last
        at += b - a
    return cued / at if at else 1.0


class Page:
    """Lines of one page. ``raw``: as given, without ``\\r``; ``low``: normalised; ``kind``: one of the constants."""

    __slots__ = ("raw", "low", "kind", "residue", "first")

    def __init__(self, text: str, title: str | None = None, outlet: str = "") -> None:
        self.raw = text.replace("\r\n", "\n").split("\n")
        low = _DIGITS.sub("0", _SPACES.sub(" ", text.replace("\r", "").lower()))
        self.low = [x.strip() for x in low.split("\n")]
        n = len(self.low)
        self.kind = [BLANK] * n
        self.residue = [False] * n
        # cues
        bodies = [_BULLET.sub("", x, count=1) if x[:1] in "-*•–·▪0" else x.lstrip("#> ") if x[:1] in "#>" else x for x in self.low]
        starts, at = [], 1
        for b in bodies:
            starts.append(at)
            at += len(b) + 1
        joined = "\n" + "\n".join(bodies) + "\n"
        hits: dict[int, int] = {}
        spans: dict[int, list[tuple[int, int]]] = {}
        residue = self.residue
        for end, (kind, size, anchored) in automaton().iter(joined):
            i = bisect_right(starts, end - size + 1 + anchored) - 1
            if kind == RESIDUE:
                residue[i] = True
                continue
            if kind == FURNITURE:
                spans.setdefault(i, []).append((end - size + 1 + anchored - starts[i], end + 1 - starts[i]))
            if hits.get(i) != FURNITURE:
                hits[i] = kind
        wanted = _plain(title) if title else ""
        for i, (x, b) in enumerate(zip(self.low, bodies)):
            if x:
                self.kind[i] = self._kind(x, b, hits.get(i), spans.get(i, []), wanted, outlet)

    @staticmethod
    def _kind(x: str, b: str, hit: int | None, spans: list[tuple[int, int]], title: str, outlet: str) -> int:
        n, first = len(x), x[0]
        if title and abs(n - len(title)) < 6 and _plain(x) == title:
            return TITLE if first not in "->[•*" and not _CLOCK.match(x) else TEASER
        if outlet and outlet[:4] in x and hit != LABEL:
            spans = spans + [(m.start(), m.end()) for m in _outlet_pattern(outlet).finditer(b)]
        if spans and cue_share(b, spans) >= CUE_SHARE:
            return FURNITURE
        if hit == FURNITURE:
            hit = None
        if first == "#":
            return HEADING
        ended = bool(_END.search(x[-16:]))
        if hit == LABEL and (not ended or x[-1] == ":") and n < 140:
            return LABEL
        if n < 40 and b in menu_words():
            return MENU
        if _SEPARATED.search(b):
            parts = _SEPARATOR.split(b)
            if len(parts) >= 3 and sum(p in menu_words() for p in parts) * 2 >= len(parts):
                return MENU
        if n < 60 and not ended and b.startswith(bylines()):
            return FURNITURE
        if first == "[" or b[:1] == "[":
            if _LINK.fullmatch(b):
                return TEASER
        if not ended and (first in ">[" or x != b or _CLOCK.match(x)):
            return TEASER
        if ended or n > 160:
            return PROSE
        return SHORT


@lru_cache(4096)
def _outlet_pattern(outlet: str) -> re.Pattern:
    """The letters of an outlet's squeezed name with blanks and hyphens between them allowed."""
    return re.compile("[ -]*".join(map(re.escape, outlet)))


def _plain(s: str) -> str:
    return _DIGITS.sub("0", _SPACES.sub(" ", s.lower())).strip().lstrip("# ").strip()


def is_filler(line: str) -> bool:
    """Prose without a single function word of any language: eight or more words, no CJK."""
    words = _WORD.findall(line.lower())
    if len(words) < 8 or _CJK.search(line):
        return False
    return not any(w in function_words() for w in words)


def open_fields(line: str) -> list[str]:
    """Unfilled fields of a line that stand outside quotation marks and code quotes."""
    if not _MAYBE_FIELD.search(line):
        return []
    return [m.group(0) for m in PLACEHOLDER.finditer(_QUOTED.sub(" ", line))]


#: Words of texts about templates; beside one of them a field is shown, not left unfilled.
_TUTORIAL = re.compile(
    r"\b(?:templates?|placeholders?|variables?|syntax|tutorial|jinja2?|handlebars|mustache|liquid|html|markup|vorlagen?|platzhalter|variablen|gabarits?|balises?|modèles?|plantillas?|marcador(?:es)?|modell[oi]|segnaposto|modelos?|шаблон\w*|переменн\w*)\b|模板|占位符|变量",
    re.I,
)
_FENCE = re.compile(r"^\s{0,3}(?:```|~~~)")


def code_lines(raw: list[str]) -> set[int]:
    """Numbers from 0 of the lines of fenced code, and of code indented below a line that ends with a colon or below such code."""
    found: set[int] = set()
    fence, opener, above = "", 0, ""
    for i, x in enumerate(raw):
        if fence:
            if x.strip().startswith(fence):
                found.update(range(opener, i + 1))
                fence = ""
            continue
        if _FENCE.match(x):
            fence, opener = x.strip()[:3], i
        elif x[:4] == "    " or x[:1] == "\t":
            if above.endswith(":") or above == "code":
                found.add(i)
                above = "code"
                continue
        if x.strip():
            above = x.strip()
    return found  # a fence that is never closed opens nothing


def is_tutorial(line: str) -> bool:
    """Whether a line speaks of templates or their syntax, its fields left aside."""
    return bool(_TUTORIAL.search(PLACEHOLDER.sub(" ", line)))


_OF_PAGES = re.compile(r"\b(?:page|link|site|website|server|browser|url|seite|server|adresse|lien|navigateur|página|enlace|navegador|pagina|collegamento|ligação|страниц\w*|ссылк\w*|сервер\w*|браузер\w*)\b|页面|链接|服务器|浏览器")


def speaks_of_the_page(line: str) -> bool:
    """Whether a lower-case line tells the reader about the page, its link or its server."""
    return len(line) < 160 and bool(_OF_PAGES.search(line)) and addresses(line)


def may_have_field(line: str) -> bool:
    return bool(_MAYBE_FIELD.search(line))


def has_field(line: str) -> bool:
    return bool(_MAYBE_FIELD.search(line) and PLACEHOLDER.search(line))


def outlet_key(domain: str | None) -> str:
    """Squeezed name of the outlet behind a domain, for lines that speak of the outlet itself; '' if unknown."""
    d = (domain or "").strip().lower()
    if d.startswith("www."):
        d = d[4:]
    d = d.split(".")[0]
    for tail in ("-news", "news"):
        if d.endswith(tail) and len(d) > len(tail) + 4:
            d = d[: -len(tail)]
    d = d.replace("-", "")
    return d if len(d) >= 8 else ""


_NAME = re.compile(r"[A-ZÀ-ÖØ-ÞА-ЯЁ][\w’']*(?:[- ](?:[A-ZÀ-ÖØ-Þ][\w’']*|on|Bay))*(?:-[A-ZÀ-Þ]\w*)?")
_ZH_NAME = re.compile(r"[A-Za-z][A-Za-z' -]*")


def headline_form(s: str) -> str:
    """A headline without its names and figures: capitalised words become X and digit runs 0."""
    s = _SPACES.sub(" ", _DIGITS.sub("0", s.strip()))
    if _CJK.search(s):
        return _ZH_NAME.sub("X", s)
    return _NAME.sub("X", s)

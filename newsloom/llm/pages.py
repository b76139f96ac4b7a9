"""Page operators over feeds: main body (problem 1), languages (2) and template residue (5).

Each operator is one narrow pass of Arrow batches over the text column; nothing but the small results is
shuffled. Null, empty and blank texts give an empty result row, never an error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boilerplate, ecoc
from .common import batch_of, bounded_sample, once_per_id
from .pagemodel import BLANK, FURNITURE, HEADING, PROSE, TITLE, Page, headline_form, outlet_key

#: Bounds of the labelled sample of the language classifiers: rows of feeds, and the longest text taken.
SAMPLE_ROWS, SAMPLE_CHARS = 1200, 20_000
MIN_LINE = 40

_TARGET = re.compile(r"\]\([^)\s]*\)")


def _read(text: str | None, title: str | None, domain: str | None) -> Page | None:
    if text is None or not text.strip():
        return None
    page = Page(text, title, outlet_key(domain))
    boilerplate.settle_short(page)
    return page


def main_body(feeds: DataFrame, id_col: str = "id", text: str = "raw_text", title: str = "title", domain: str = "domain") -> DataFrame:
    """One row for each distinct id: ``boiler_lines`` (numbers of the non-blank lines outside the article), ``body`` (the article's lines joined) and ``residue``.

    Null, empty or blank text: empty list, body null. A page with template residue in place of content:
    ``residue`` says which kind, its list is empty and its body null. Repeated ids count once; other columns
    of the input are ignored, so they cannot clash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for i, t, ti, d in zip(*(b.column(k).to_pylist() for k in range(4))):
                page = _read(t, ti, d)
                lines, body, why = [], None, None
                if page is not None:
                    why = boilerplate.residue_verdict(page)
                    if why is None:
                        keep = boilerplate.kept_lines(page)
                        lines = [n for n, (k, kind) in enumerate(zip(keep, page.kind), 1) if not k and kind != BLANK]
                        body = "\n".join(x for x, k in zip(page.raw, keep) if k)
                for col, v in zip(out, (i, lines, body, why)):
                    col.append(v)
            yield batch_of({"id": (out[0], pa.string()), "boiler_lines": (out[1], pa.list_(pa.int32())), "body": (out[2], pa.string()), "residue": (out[3], pa.string())})

    return feeds.select(F.col(id_col).cast("string").alias("id"), text, title, domain).mapInArrow(run, "id string, boiler_lines array<int>, body string, residue string")


def boilerplate_lines(feeds: DataFrame, **columns: str) -> DataFrame:
    """(id, line_no) of every line outside the article, each id once."""
    rows = main_body(feeds, **columns).select("id", "boiler_lines").where(F.size("boiler_lines") > 0)
    return once_per_id(rows, "id", "boiler_lines").select("id", F.explode("boiler_lines").alias("line_no"))


def residue(feeds: DataFrame, id_col: str = "id", text: str = "raw_text", title: str = "title", domain: str = "domain") -> DataFrame:
    """(id, kind) of every page with template residue in place of content, each id once; kind is field, fields, filler or message."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, kinds = [], []
            for i, t, ti, d in zip(*(b.column(k).to_pylist() for k in range(4))):
                if t is None or not t.strip():
                    continue
                why = boilerplate.residue_verdict(Page(t, ti, outlet_key(d)))
                if why is not None:
                    ids.append(i)
                    kinds.append(why)
            yield batch_of({"id": (ids, pa.string()), "kind": (kinds, pa.string())})

    rows = feeds.select(F.col(id_col).cast("string").alias("id"), text, title, domain).mapInArrow(run, "id string, kind string")
    return once_per_id(rows, "id", "kind")


# languages


def named_language(label: str | None, names: dict[str, str]) -> str | None:
    """Code of a label: code, three-letter code or English name, whatever its case, spaces and region."""
    s = (label or "").strip().lower()
    return names.get(s) or names.get(re.split(r"[-_\s]", s)[0]) if s else None


def language_names(names: DataFrame) -> dict[str, str]:
    """Every accepted spelling to its code; a fixed table of a few rows."""
    out: dict[str, str] = {}
    for r in names.collect():
        for x in (r.code, r.code3, r.name_en):
            if x:
                out[x.strip().lower()] = r.code
    return out


def _group_of(line: str) -> str:
    """Form of a line; a line that is nearly all names, such as a menu, stands for itself."""
    form = headline_form(line) if len(line) < 400 else line
    return form if sum(c.isalpha() and c != "X" for c in form) >= 10 else line.lower()


def fit_languages(feeds: DataFrame, names: dict[str, str], label: str = "language", text: str = "raw_text", id_col: str = "id", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> ecoc.Model:
    """Classifiers from a bounded sample of about ``rows`` labelled texts of up to ``chars`` characters, taken by hash of the id.

    Lines of one form (names and figures masked) are taken together under the label most of them carry, at
    most three of each, so neither wrong labels nor furniture repeated on every page sways the fit.
    """
    languages = sorted(set(names.values()))
    codes = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    s = F.lower(F.trim(F.col(label)))
    known = F.coalesce(codes[s], codes[F.split(s, r"[-_\s]")[0]])
    labelled = (
        feeds.select(F.col(id_col).alias("id"), F.col(text).alias("text"), known.alias("label"))
        .where(F.col("label").isNotNull() & (F.length("text") > 0) & (F.length("text") <= chars))
    )
    sample = sorted(bounded_sample(labelled, "id", rows).collect(), key=lambda r: (str(r.id), r.text))
    groups: dict[str, tuple[list[str], Counter]] = {}
    for r in sample:
        for x in r.text.splitlines():
            x = _TARGET.sub(" ", x.strip())
            if len(x) >= 15:
                own, votes = groups.setdefault(_group_of(x), ([], Counter()))
                if len(own) < 3 and x not in own:
                    own.append(x)
                votes[r.label] += 1
    texts, labels, agreed = [], [], []
    for own, votes in groups.values():
        top = max(sorted(votes), key=votes.__getitem__)
        texts += own
        labels += [top] * len(own)
        agreed += [votes[top]] * len(own)
    return ecoc.fit(texts, labels, languages, agreed)


def page_languages(feeds: DataFrame, model: ecoc.Model, names: dict[str, str], id_col: str = "id", text: str = "raw_text", title: str = "title", domain: str = "domain", label: str = "language", min_line: int = MIN_LINE) -> DataFrame:
    """One row for each id with an article or text: ``language`` (main code), ``confidence``, ``label_ok`` and ``segments``.

    ``segments``: for each line of at least ``min_line`` characters in another language than the main one
    (line_no, language, confidence, ambiguous). The main language is that of most characters of the article;
    a page without article lines is judged by all its lines. Blank texts and pages of template residue give
    no row. Repeated ids count once.
    """
    spark = feeds.sparkSession
    held = spark.sparkContext.broadcast((model, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, names = held.value
        seen: dict[str, tuple[int, float]] = {}
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(5)]
            for at in range(0, len(cols[0]), 256):
                yield _languages_of(list(zip(*(c[at : at + 256] for c in cols))), model, names, seen, min_line)

    schema = "id string, language string, confidence float, label_ok boolean, segments array<struct<line_no:int,language:string,confidence:float,ambiguous:boolean>>"
    rows = feeds.select(F.col(id_col).cast("string").alias("id"), text, title, domain, label).mapInArrow(run, schema)
    return rows.dropDuplicates(["id"])


_SEGMENTS = pa.list_(pa.struct([("line_no", pa.int32()), ("language", pa.string()), ("confidence", pa.float32()), ("ambiguous", pa.bool_())]))
#: Lines whose language a Python worker remembers; the store is emptied when full.
SEEN = 50_000


def _languages_of(rows: list[tuple], model: ecoc.Model, names: dict[str, str], seen: dict, min_line: int) -> pa.RecordBatch:
    pages, wanted = [], {}
    for i, t, ti, d, lab in rows:
        page = _read(t, ti, d)
        if page is None or boilerplate.residue_verdict(page) is not None:
            continue
        keep = boilerplate.kept_lines(page)
        lines = []
        for n, (raw, kind) in enumerate(zip(page.raw, page.kind)):
            if kind == BLANK:
                continue
            s = raw.strip()
            if len(s) >= min_line or keep[n]:
                x = _TARGET.sub(" ", s) if "](" in s else s
                lines.append((n, s, x, keep[n]))
                if x not in seen:
                    wanted[x] = None
        pages.append((i, lab, lines))
    texts = list(wanted)
    fresh = _decode(texts, model)
    out: list[list] = [[], [], [], [], []]
    for i, lab, lines in pages:
        votes: Counter = Counter()
        weight: Counter = Counter()
        got = [fresh.get(x) or seen[x] for _, _, x, _ in lines]
        for own in (True, False):
            for (_, s, _, kept), (lang, conf) in zip(lines, got):
                if lang >= 0 and kept == own:
                    votes[lang] += len(s) if conf >= 0.2 else 0.1 * len(s)
                    weight[lang] += len(s) * conf
            if votes:
                break
        if not votes:
            continue
        main = max(sorted(votes), key=votes.__getitem__)
        code = model.languages[main]
        confidence = weight[main] / max(sum(weight.values()), 1e-9)
        segs = [
            {"line_no": n + 1, "language": model.languages[lang], "confidence": conf, "ambiguous": conf < ecoc.AMBIGUOUS}
            for (n, s, _, _), (lang, conf) in zip(lines, got)
            if len(s) >= min_line and lang >= 0 and lang != main and written_as(s)
        ]
        for col, v in zip(out, (i, code, confidence, named_language(lab, names) == code, segs)):
            col.append(v)
    if len(seen) + len(fresh) > SEEN:
        seen.clear()
    seen.update((k, v) for k, v in fresh.items() if len(k) < 200)
    return batch_of({"id": (out[0], pa.string()), "language": (out[1], pa.string()), "confidence": (out[2], pa.float32()), "label_ok": (out[3], pa.bool_()), "segments": (out[4], _SEGMENTS)})


_CYRILLIC, _HAN, _LATIN = re.compile(r"[\u0400-\u04ff]"), re.compile(r"[\u3400-\u9fff]"), re.compile(r"[A-Za-z\u00c0-\u024f]")
_INNER_NAME = re.compile(r"(?<=\s)[A-ZÀ-ÖØ-ÞА-ЯЁ][\w’'-]*")
#: Below this confidence a short line is read once more without its capitalised words, which are mostly names.
SECOND_LOOK = 0.7


def _decode(texts: list[str], model: ecoc.Model) -> dict[str, tuple[int, float]]:
    """Language index and confidence of each text, checked against the script its letters are of.

    Most letters Cyrillic, or a fifth Han: the language of that script; otherwise not one of these.
    """
    best, sure = model.decode(texts)
    at = [i for i, t in enumerate(texts) if sure[i] < SECOND_LOOK and len(t) < 120]
    if at:
        bare = [_INNER_NAME.sub(" ", texts[i]) for i in at]
        b2, s2 = model.decode(bare)
        for i, t, b, c in zip(at, bare, b2, s2):
            if c > sure[i] and sum(ch.isalpha() for ch in t) >= 10:
                best[i], sure[i] = b, c
    code = {x: i for i, x in enumerate(model.languages)}
    out = {}
    for t, b, c in zip(texts, best.tolist(), sure.tolist()):
        cyrillic, han = len(_CYRILLIC.findall(t)), len(_HAN.findall(t))
        if cyrillic or han or model.languages[b] in ("ru", "zh"):
            latin = len(_LATIN.findall(t))
            n = cyrillic + han + latin
            want = "zh" if han * 5 >= n > 0 else "ru" if cyrillic * 2 >= n > 0 else None
            if want in code and code[want] != b:
                b, c = code[want], max(c, 0.9)
            elif want is None and model.languages[b] in ("ru", "zh"):
                b, c = -1, 0.0
        out[t] = (b, c)
    return out


def written_as(line: str) -> bool:
    """Exact check after decoding: words rather than one long code."""
    return line.count(" ") * 25 >= len(line) or bool(_HAN.search(line))


def language_findings(found: DataFrame, floor: float = 0.1) -> DataFrame:
    """(id, line_no, language): line 0 for a missing or wrong label, else each line in another language whose confidence is at least ``floor``."""
    zero = F.when(~F.col("label_ok"), F.array(F.struct(F.lit(0).alias("line_no"), F.col("language").alias("language")))).otherwise(F.expr("cast(array() as array<struct<line_no:int,language:string>>)"))
    segs = F.transform(F.filter("segments", lambda x: x["confidence"] >= floor), lambda x: F.struct(x["line_no"].alias("line_no"), x["language"].alias("language")))
    return found.select("id", F.explode(F.concat(zero, segs)).alias("s")).select("id", "s.line_no", "s.language")

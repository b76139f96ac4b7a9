"""Sentence scoring and extractive compression of documents by TF-IDF.

``terms`` and ``weights`` give the term weights as rows; scoring and compression work on the arrays of a document.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

_WORD, _DATES, _DIGIT = regex.compile(X.WORD), regex.compile(X.DATES), re.compile("[0-9]")


def sentence_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, i, sentence, n): the sentences of each document from 0; documents without one give no row."""
    s = docs.select(key, X.sentences(F.col(text)).alias("s")).select(key, F.size("s").alias("n"), F.posexplode("s").alias("i", "sentence"))
    return s.select(key, "i", "sentence", "n")


def terms(sentences: DataFrame, key: str = "doc_id", bigrams: bool = True) -> DataFrame:
    """(key, i, n, term, tf) with one row for each distinct term of a sentence.

    Pairs of words count as terms too with ``bigrams``. Sentences are dealt by document before they are
    exploded: every later group and window is by document or finer, so the many term rows never move.
    """
    # a fixed number: adaptive merging would judge by the small sentences, not by the terms that come of them
    sentences = sentences.repartition(int(sentences.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    found = X.let(X.words(F.col("sentence")), lambda w: F.concat(w, X.bigrams(w)) if bigrams else w)
    return sentences.select(key, "i", "n", F.explode(found).alias("term")).groupBy(key, "i", "n", "term").agg(F.count("*").alias("tf"))


def weights(t: DataFrame, key: str = "doc_id", max_share: float = 1.0) -> DataFrame:
    """Terms with ``v``: sublinear tf times smooth idf, rows of unit length. Terms in more than ``max_share`` of the sentences are left out."""
    doc_term, row = Window.partitionBy(key, "term"), Window.partitionBy(key, "i")
    t = t.withColumn("df", F.count("*").over(doc_term)).where(F.col("df") <= max_share * F.col("n"))
    raw = (1 + F.log("tf")) * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)
    t = t.withColumn("raw", raw)
    return t.withColumn("v", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(row))).drop("raw", "df", "tf")


def sentence_terms(sentence: str) -> list[str]:
    """Lower-case words of two characters or more, and the pairs of neighbours among them."""
    w = [x for x in _WORD.findall(sentence.lower()) if len(x) >= 2]
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def analyse(sentences: list[str], max_share: float = 0.9) -> tuple[float | None, list[float], list[float]]:
    """(redundancy, top, total) of a document's sentences from one count of their terms.

    Weights are sublinear tf times smooth idf on rows of unit length. ``total`` is the sum of a row's weights;
    ``top`` the largest where terms in more than ``max_share`` of the sentences are left out. The redundancy, mean
    similarity of two sentences, needs no pair: the sum over all is the squared norm of the sum of the rows less
    their number. It is 0 below three sentences and null for a document without terms.
    """
    n = len(sentences)
    counts = [Counter(sentence_terms(s)) for s in sentences]
    df: Counter = Counter()
    for c in counts:
        df.update(c.keys())
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items()}
    most = max_share * n
    sums: dict[str, float] = {}
    top, total, rows = [], [], 0
    for c in counts:
        raw = {t: (1 + math.log(k)) * idf[t] for t, k in c.items()}
        length = math.sqrt(sum(x * x for x in raw.values()))
        rows += bool(raw)
        total.append(sum(raw.values()) / length if raw else 0.0)
        for t, x in raw.items():
            sums[t] = sums.get(t, 0.0) + x / length
        held = [x for t, x in raw.items() if df[t] <= most]
        top.append(max(held) / math.sqrt(sum(x * x for x in held)) if held else 0.0)
    if not rows:
        return None, top, total
    return (max(0.0, (sum(x * x for x in sums.values()) - rows) / (n * (n - 1))) if n >= 3 else 0.0), top, total


def analysed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, s, redundancy, top, total) with the sentences of each document and arrays by sentence; texts without sentences are left out.

    The terms of a document, ten times its size, are counted in its Arrow batch and never become rows. Documents
    are dealt by key once, since a scan of few row groups would leave most cores idle; how many parts that gives
    is left to adaptive execution.
    """

    @F.pandas_udf("redundancy double, top array<double>, total array<double>")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([analyse(list(x)) for x in s], columns=["redundancy", "top", "total"]).astype({"redundancy": "float64"})

    run = run.asNondeterministic()  # else a filter on its result would run it twice
    found = docs.select(key, text).repartition(key).select(key, X.sentences(F.col(text)).alias("s")).where(F.size("s") > 0)
    return found.withColumn("_a", run("s")).select(key, "s", F.nanvl("_a.redundancy", F.lit(None).cast("double")).alias("redundancy"), "_a.top", "_a.total")


def redundancy(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, redundancy) of the documents that have terms."""
    return analysed(docs, key, text).where("redundancy is not null").select(key, "redundancy")


def place(i: Column, n: Column) -> Column:
    """Weight of a position: from 1 at the beginning to .85 at the end."""
    return F.when(n > 1, 1 - 0.15 * i / (n - 1)).otherwise(1.0)


def forced(s: Column, must: Column | None = None) -> Column:
    """For each sentence whether it holds a date, or one of the lower-case strings ``must``."""
    def one(x: Column) -> Column:
        dated = x.rlike(X.DATES)
        return dated if must is None else dated | F.exists(must, lambda m: F.contains(F.lower(x), m))

    return F.transform(s, one)


def scores(s: Column, top: Column, force: Column) -> Column:
    """Score of each sentence: .75 largest weight + .10/root of words + .10 digit + .05 position, + .25 where it is forced."""
    def of(r: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            n_words = F.greatest(F.size(F.split(x, " ")), F.lit(1))
            return (
                0.75 * F.element_at(r["t"], i + 1) + 0.10 / F.sqrt(n_words) + 0.10 * x.rlike("[0-9]").cast("int") + 0.05 * place(i, F.size(r["s"]))
                + 0.25 * F.element_at(r["f"], i + 1).cast("int")
            )

        return F.transform(r["s"], one)

    # held in one value, else the optimiser may compute an array anew for each sentence
    return X.let(F.struct(s.alias("s"), top.alias("t"), force.alias("f")), of)


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text", must: Column | None = None) -> DataFrame:
    """``analysed`` with ``forced`` and ``score`` by sentence."""
    a = analysed(docs, key, text).withColumn("forced", forced(F.col("s"), must))
    return a.withColumn("score", scores(F.col("s"), F.col("top"), F.col("forced")))


def min_max(values: Column) -> Column:
    """Values of an array scaled to 0..1; all 0 where they are equal."""
    ends = lambda v: F.struct(v.alias("v"), F.array_min(v).alias("low"), F.array_max(v).alias("high"))
    return X.let(X.let(values, ends), lambda e: F.transform(e["v"], lambda x: (x - e["low"]) / (e["high"] - e["low"] + 1e-9)))


def above(values: Column, share: float) -> Column:
    """Numbers of the values of an array that reach a share of the largest."""
    ends = lambda v: F.struct(v.alias("v"), F.array_max(v).alias("best"))
    return X.let(X.let(values, ends), lambda e: F.filter(F.transform(e["v"], lambda x, i: F.when(F.round(x, 9) >= F.round(share * e["best"], 9), i)), lambda i: i.isNotNull()))


def keep_fraction(red: Column, tokens: Column, most: int, low: float = 0.2, high: float = 0.4) -> Column:
    f = low + (high - low) * (0.3 + 0.7 * (0.4 - F.least(F.lit(0.4), red)))
    return F.greatest(F.lit(low), F.least(F.lit(high), F.when(tokens < int(1.5 * most), high).otherwise(f)))


def top_k(score: Column, force: Column, fraction: Column) -> Column:
    """Numbers, in order, of the sentences among the best max(1, floor(n * fraction)) or forced; equal scores prefer the later sentence."""
    def of(r: Column) -> Column:
        k = F.greatest(F.lit(1), F.floor(F.size(r["s"]) * fraction)).cast("int")
        ranked = F.array_sort(F.transform(r["s"], lambda x, i: F.struct((-F.round(x, 9)).alias("s"), (-i).alias("i"))))
        best = F.transform(F.slice(ranked, F.lit(1), k), lambda x: -x["i"])
        return X.let(best, lambda b: F.filter(F.transform(r["s"], lambda x, i: i), lambda i: F.array_contains(b, i) | F.element_at(r["f"], i + 1)))

    return X.let(F.struct(score.alias("s"), force.alias("f")), of)


def within_budget(cost: Column, budget: Column) -> Column:
    """How many leading items of an array of costs fit: up to the first that overflows the budget."""
    start = F.struct(F.lit(0).cast("long").alias("spent"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def step(acc: Column, c: Column) -> Column:
        fits = acc["open"] & (acc["spent"] + c <= budget)
        return F.struct((acc["spent"] + F.when(fits, c.cast("long")).otherwise(0)).alias("spent"), (acc["n"] + fits.cast("int")).alias("n"), fits.alias("open"))

    return F.aggregate(cost, start, step, lambda acc: acc["n"])


def fraction_of(red: float, tokens: int, most: int, low: float = 0.2, high: float = 0.4) -> float:
    """``keep_fraction`` of one document."""
    f = high if tokens < int(1.5 * most) else low + (high - low) * (0.3 + 0.7 * (0.4 - min(0.4, red)))
    return max(low, min(high, f))


def kept_sentences(sentences: list[str], costs: list[int], tokens: int, must: list[str], most: int, n_prefix: int) -> list[int]:
    """Numbers, in order, of the sentences that a document is compressed to."""
    n = len(sentences)
    red, top, _ = analyse(sentences)
    force, score = [], []
    for i, x in enumerate(sentences):
        low = x.lower()
        forced = bool(_DATES.search(x)) or any(m in low for m in must)
        force.append(forced)
        place = 1 - 0.15 * i / (n - 1) if n > 1 else 1.0
        score.append(0.75 * top[i] + 0.10 / math.sqrt(max(1, len(x.split(" ")))) + 0.10 * bool(_DIGIT.search(x)) + 0.05 * place + 0.25 * forced)
    k = max(1, int(n * fraction_of(red or 0.0, tokens, most)))
    best = set(sorted(range(n), key=lambda i: (-round(score[i], 9), -i))[:k])
    budget = max(256, (most if tokens <= 1.5 * most else 2 * most) - n_prefix)
    out, used = [], 0
    for i in range(n):
        if i in best or force[i]:
            if used + costs[i] > budget:
                break
            out.append(i)
            used += costs[i]
    return out


def compress(docs: DataFrame, most: int = 1024, key: str = "doc_id", text: str = "text", prefix: str = "summarize: ") -> DataFrame:
    """(key, compressed, n_kept): the best and the forced sentences in document order, cut at the token budget.

    Sentences with a date or with an entity to keep are forced. The budget is ``most`` tokens for documents of up
    to one and a half times that and twice as many for longer ones, less the prefix of the model, at least 256.
    Documents without a sentence stay as they are; one whose first kept sentence overflows the budget comes out
    empty. Documents are dealt by key once, then each is scored and cut where it lies.
    """
    n_prefix = len(re.findall(r"\w+|[^\w\s]", prefix))

    @F.pandas_udf("compressed string, n_kept int")
    def run(texts: pd.Series, parts: pd.Series, costs: pd.Series, tokens: pd.Series, must: pd.Series) -> pd.DataFrame:
        out = []
        for t, s, c, n, m in zip(texts, parts, costs, tokens, must):
            if s is None or not len(s):
                out.append((t, 0))
                continue
            kept = kept_sentences(list(s), list(c), int(n), [] if m is None else list(m), most, n_prefix)
            out.append((" ".join(s[i] for i in kept), len(kept)))
        return pd.DataFrame(out, columns=["compressed", "n_kept"])

    t = F.col(text)
    d = docs.select(key, t.alias("_t")).repartition(key).select(key, "_t", X.sentences(F.col("_t")).alias("_s"), X.token_count(F.col("_t")).alias("_n"), X.must_keep(X.entities(F.col("_t"))).alias("_m"))
    d = d.withColumn("_c", F.transform("_s", lambda x: X.token_count(x)))
    return d.withColumn("_r", run("_t", "_s", "_c", "_n", "_m")).select(key, "_r.compressed", "_r.n_kept")

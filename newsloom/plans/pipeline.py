"""The daily run as one plan: feeds to cluster records. Topics are a grouping key, never a driver loop."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import language as L
from ..functions import text as X
from ..operators import aggregate, cluster, compress, packing, topics
from ..session import shared
from . import plugins


def prepare(feeds: DataFrame, least_chars: int = 0, detect_language: bool = True) -> DataFrame:
    """Feeds with a text, each id once, with language, cleaned text and ``processed_text``."""
    once = feeds.where("id is not null and length(raw_text) > 0").dropDuplicates(["id"])
    clean = once.withColumn("processed_text", X.clean(F.col("raw_text"))).where(F.length("processed_text") > least_chars)
    return clean.withColumn("language", L.detect(F.col("processed_text"))) if detect_language else clean


def compress_stage(feeds: DataFrame, most: int = 1024, compress_english: bool = False) -> DataFrame:
    """Adds ``compressed_text`` for other languages than English (or all) and takes it as ``processed_text``."""
    wanted = F.lit(True) if compress_english else topics.not_language(F.col("language"))
    done = compress.compress(feeds.where(wanted), most, "id", "processed_text", prefix="").select("id", F.col("compressed").alias("compressed_text"))
    out = feeds.drop("compressed_text").join(done, "id", "left")
    return out.withColumn("processed_text", F.coalesce("compressed_text", "processed_text"))


def translate_stage(feeds: DataFrame, plugin: str = "default", limit: int = 412, fallback: str | None = None) -> DataFrame:
    """Adds ``raw_text_en``: chunks of other languages through the translator, else the fallback, joined in order; a failed chunk is empty."""
    foreign = feeds.where(topics.not_language(F.col("language"))).select("id", F.posexplode(X.smart_split(F.col("processed_text"), limit)).alias("i", "chunk"))
    done = foreign.withColumn("chunk", plugins.translated(F.col("chunk"), plugin, fallback))
    joined = aggregate.ordered_concat(done, ["id"], ["i"], "chunk").withColumnRenamed("chunk", "raw_text_en")
    out = feeds.drop("raw_text_en").join(joined, "id", "left")
    return out.withColumn("processed_text", F.coalesce("raw_text_en", "processed_text"))


def summaries(rows: DataFrame, key: str, text: str, plugin: str = "default", merge: str = "merge", most: int = 1024, window: int = 950, overlap: int = 50) -> DataFrame:
    """(key, summary) of whole texts: each window through the summariser, the window summaries merged; a text that fits goes to the merge as it is.

    The windows of a text stay in its row; rows are dealt by key once. Null and blank texts give ''.
    """
    p, q = plugins.get("summarise", plugin), plugins.get("summarise", merge)

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        first, last = p.load(), q.load()
        for whole, parts, tokens in batches:
            out = []
            for t, s, n in zip(whole, parts, tokens):
                if t is None or s is None or not len(s):
                    out.append("")
                    continue
                one = [t] if n < most else [x for x in p.apply(first, pd.Series(packing.windows_of(list(s), window, overlap))) if x]
                joined = "\n\n".join(one)
                try:
                    out.append(q.apply(last, pd.Series([joined])).iloc[0])
                except Exception:  # without a merge the window summaries stand
                    out.append(joined)
            yield pd.Series(out)

    d = rows.select(key, F.col(text).alias("_t")).repartition(key).select(key, "_t", X.sentences(F.col("_t")).alias("_s"), X.token_count(F.col("_t")).alias("_n"))
    return d.select(key, run("_t", "_s", "_n").alias("summary"))


def summarise_stage(feeds: DataFrame, plugin: str = "default", merge: str = "merge") -> DataFrame:
    """Adds ``summary`` of the whole ``processed_text``; feeds without one are dropped."""
    done = summaries(feeds, "id", "processed_text", plugin, merge)
    return feeds.drop("summary").join(done, "id").where(F.col("summary") != "")


#: Part summaries that are merged at once.
FAN = 16
SEPARATOR, PART_SEPARATOR = "\n\n— DOC —\n\n", "\n\n### CHUNK SUMMARY ###\n\n"


def cluster_summaries(rows: DataFrame, keys: list[str], order: list[str], text: str = "summary", label: str = "domain", budget: int = 1200, capacity: int = 1020) -> DataFrame:
    """(keys, summary) of each cluster from all its members: packed into parts under a token budget, each summarised, then all of them together.

    A cluster that fits the capacity goes to the final summary at once. Token counts decide the parts, so the step
    that is sequential in a cluster sees small rows; parts are summarised as rows of their own, so a large cluster
    is spread, and their summaries are short by the number of parts. More than FAN of them are merged by FAN in
    levels, so no row gathers a whole large cluster.
    """
    order = [*order, "_member"]
    rows = rows.withColumn("_member", F.xxhash64(*[F.col(c) for c in order[:-1]], F.col(text)))
    small = rows.select(*keys, *order, packing.document_cost(F.col(label), F.col(text), budget).alias("cost"))
    dealt = shared(packing.chunked(small, keys, order, budget))
    total = dealt.groupBy(*keys).agg(F.sum("cost").alias("_tokens"), (F.max("chunk") + 1).alias("_parts"))
    dealt = dealt.join(total, keys).withColumn("chunk", F.when(F.col("_tokens") <= capacity, 0).otherwise(F.col("chunk")))
    headed = F.concat(F.lit("["), topics.or_unknown(F.col(label)), F.lit("] "), F.col(text))
    parts = aggregate.ordered_concat(rows.select(*keys, *order, headed.alias("text")).join(dealt.drop("cost"), [*keys, *order]), [*keys, "chunk", "_tokens", "_parts"], order, "text", SEPARATOR)

    @F.pandas_udf("string")
    def part(texts: pd.Series, tokens: pd.Series, n: pd.Series) -> pd.Series:
        final = plugins.final_tokens(capacity)
        return pd.Series([t if k <= capacity else plugins.Extract("part", plugins.part_tokens(int(m), final)).apply(None, pd.Series([t])).iloc[0] for t, k, m in zip(texts, tokens, n)])

    done = parts.withColumn("text", part("text", "_tokens", "_parts")).select(*keys, "chunk", "text")
    left = total.agg(F.max("_parts").alias("m")).first().m or 0
    merge = plugins.Extract("level", plugins.part_tokens(FAN, plugins.final_tokens(capacity)))
    while left > FAN:
        level = done.withColumn("_level", F.floor(F.col("chunk") / FAN).cast("int"))
        done = aggregate.ordered_concat(level, [*keys, "_level"], ["chunk"], "text", " ").withColumnRenamed("_level", "chunk")
        done = shared(done.withColumn("text", plugins.call(merge, F.col("text"), "string")))
        left = -(-left // FAN)
    joined = aggregate.ordered_concat(done, keys, ["chunk"], "text", PART_SEPARATOR)
    final = plugins.Extract("final", plugins.final_tokens(capacity))
    return joined.select(*keys, plugins.call(final, F.regexp_replace("text", "\\s*(?:— DOC —|### CHUNK SUMMARY ###)\\s*", " "), "string").alias("summary"))


def vectorise_stage(feeds: DataFrame, plugin: str = "default", keep: bool = True) -> DataFrame:
    """``embedding`` of the summary; with ``keep`` a stored 768-number vector is taken as it is."""
    made = plugins.call(plugins.get("embed", plugin), F.col("summary"), "array<float>")
    return feeds.withColumn("embedding", F.when(F.lit(keep) & (F.size("embedding") == 768), F.col("embedding")).otherwise(made)).where("embedding is not null")


def run(feeds: DataFrame, flashpoints: DataFrame, budget: int = 1024) -> DataFrame:
    """Cluster records of all topics that exist and have feeds.

    Texts are written after cleaning and after compression, so no stage computes the one before it again and a
    lost executor costs one stage at most.
    """
    known = feeds.join(flashpoints.select(F.col("id").alias("flashpoint_id")).distinct(), "flashpoint_id", "left_semi")
    narrow = known.select("id", "flashpoint_id", "url", "title", "domain", "language", "image", "raw_text", "embedding", "created_at")
    ready = shared(compress_stage(shared(prepare(narrow)), budget).drop("raw_text"))
    rows = shared(vectorise_stage(summarise_stage(translate_stage(ready))).drop("processed_text", "compressed_text", "raw_text_en"))
    labels = cluster.label_topics(rows.withColumnRenamed("flashpoint_id", "topic")).where("label >= 0")
    joined = rows.join(labels.select("id", F.col("label").alias("cluster_id")), "id")
    records = aggregate.cluster_records(joined, ["flashpoint_id", "cluster_id"], ["created_at", "id"])
    told = cluster_summaries(joined.select("flashpoint_id", "cluster_id", "created_at", "id", "summary", "domain"), ["flashpoint_id", "cluster_id"], ["created_at", "id"])
    return records.join(told, ["flashpoint_id", "cluster_id"])

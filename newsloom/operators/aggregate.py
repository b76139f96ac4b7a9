"""Aggregation of clusters into records: counts, top values, distinct sets, ordered lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .topics import or_unknown


def top_values(rows: DataFrame, keys: list[str], value: str, order: list[str], n: int = 3, name: str | None = None) -> DataFrame:
    """The ``n`` most frequent values of each group; ties by first appearance in ``order``.

    Counted on (keys, value) first, so a hot group is spread over its values before it is gathered.
    """
    counted = rows.withColumn("_v", or_unknown(F.col(value))).groupBy(*keys, "_v").agg(F.count("*").alias("_n"), F.min(F.struct(*order)).alias("_first"))
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), "_first", "_v"))), 1, n)
    return counted.groupBy(*keys).agg(F.transform(ranked, lambda x: x["_v"]).alias(name or f"top_{value}s"))


def cluster_records(rows: DataFrame, keys: list[str], order: list[str], least: int = 2) -> DataFrame:
    """One record for each cluster of at least ``least`` rows.

    Columns: article_count, top_domains, all_domains, languages, urls, images. Urls and images keep the order
    of the rows and their duplicates; unknown images and empty urls are left out. Group sizes come from a
    count that is aggregated before the lists, so single rows are dropped before any list is built.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").cast("int").alias("article_count")).where(F.col("article_count") >= least)
    top = top_values(rows, keys, "domain", order, 3, "top_domains")
    known = lambda c: F.when((F.col(c) != "") & (F.col(c) != "unknown"), F.struct(*order, F.col(c).alias("v")))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(known(c))), lambda x: x["v"])
    lists = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_set(or_unknown(F.col("domain")))).alias("all_domains"),
        F.array_sort(F.collect_set(or_unknown(F.col("language")))).alias("languages"),
        ordered("url").alias("urls"), ordered("image").alias("images"),
    )
    return sizes.join(top, keys).join(lists, keys)


def ordered_concat(rows: DataFrame, keys: list[str], order: list[str], value: str, separator: str = "\n\n") -> DataFrame:
    """Strings of each group joined in order."""
    items = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("v"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(items, lambda x: x["v"]), separator).alias(value))

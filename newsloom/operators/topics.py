"""Topics and their feeds: joins, defaults, merging of stage results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_feeds(topics: DataFrame, feeds: DataFrame) -> DataFrame:
    """Topics that have at least one feed."""
    return topics.join(feeds.select(F.col("flashpoint_id").alias("id")), "id", "left_semi")


def without_feeds(topics: DataFrame, feeds: DataFrame) -> DataFrame:
    return topics.join(feeds.select(F.col("flashpoint_id").alias("id")), "id", "left_anti")


def nested(topics: DataFrame, feeds: DataFrame, *columns: str) -> DataFrame:
    """Topics with their feeds as an array ordered by time and id; topics without feeds keep an empty array."""
    item = F.struct("created_at", "id", *columns)
    grouped = feeds.groupBy("flashpoint_id").agg(F.array_sort(F.collect_list(item)).alias("feeds"))
    empty = F.expr(f"cast(array() as {grouped.schema['feeds'].dataType.simpleString()})")
    return topics.join(grouped.withColumnRenamed("flashpoint_id", "id"), "id", "left").withColumn("feeds", F.coalesce("feeds", empty))


def merge_back(rows: DataFrame, results: DataFrame, key: str, column: str) -> DataFrame:
    """``column`` replaced by the result of the same key where there is one."""
    new = results.select(F.col(key), F.col(column).alias("_new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def or_unknown(c: Column) -> Column:
    """'unknown' for null and empty strings."""
    return F.coalesce(F.when(c != "", c), F.lit("unknown"))


def canonical_id(c: Column) -> Column:
    """Lower-case trimmed UUID text; null if it isn't one."""
    t = F.lower(F.trim(c))
    return F.when(t.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), t)


def not_language(c: Column, code: str = "en") -> Column:
    """True for another language and for none."""
    return ~c.eqNullSafe(F.lit(code))


def daily_name(base: str, day: Column) -> Column:
    return F.concat(F.lit(base + "_"), F.date_format(day, "yyyyMMdd"))


def merged_map(left: Column, right: Column) -> Column:
    """Both maps in one; where a key is in both, the right one's value stands."""
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)


def zipped(left: Column, right: Column) -> Column:
    """Structs of the elements of two arrays by position; the shorter one is filled with nulls."""
    return F.arrays_zip(left.alias("left"), right.alias("right"))


def chosen(values: Column, key: Column, seed: int = 42) -> Column:
    """One element of an array, the same for a key and seed in every run; null for an empty array."""
    return F.when(F.size(values) > 0, F.element_at(values, (F.pmod(F.xxhash64(key, F.lit(seed)), F.size(values)) + 1).cast("int")))

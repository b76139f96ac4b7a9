"""Lines repeated across the pages of one site (problem 7).

Pages of equal text are collapsed first; each line is then counted over the distinct clusters of equal pages
of its domain and over their days, so a republished article is one witness however often it comes. Counting
is on (domain, line hash): a hot domain spreads over its lines, and partial sums run before the shuffle.

Two rules read the counts. ``repeated`` takes the lines of many clusters and more than one day and is what
texts are cleaned by. ``standing`` takes the lines of many pages, copies included, whatever their clusters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared

#: A line is repeated if it stands in at least so many pages, and in this share of the pages of its domain.
LEAST_PAGES, LEAST_SHARE = 4, 0.05
#: For cleaning it must stand in so many clusters of equal pages, that share of the clusters, and on so many days.
LEAST_CLUSTERS, LEAST_DAYS = 4, 2
#: Rows up to which the found lines are broadcast; beyond, a shuffle join takes over.
BROADCAST_ROWS = 200_000


def domain_key(c: Column) -> Column:
    """Trimmed, lower case, without ``www.``; blank becomes null."""
    d = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    d = F.regexp_replace(d, r"^www\.", "")
    return F.when(d != "", d)


def line_keys(text: Column) -> Column:
    """Array of the keys of all lines: trimmed, lower case, blanks and digit runs as one; null for lines without a letter.

    The key is a 64-bit hash and is only ever compared within one domain against the few found lines, so
    even 10^11 lines meet a false key about once in a million runs.
    """
    t = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", "0"), " +", " ")
    plain = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    return F.transform(F.transform(F.split(t, "\n"), plain), lambda x: F.when(x.rlike(r"\p{L}"), F.xxhash64(x)))


def pages(feeds: DataFrame, id_col: str = "id", text: str = "raw_text", domain: str = "domain", seen: str = "created_at") -> DataFrame:
    """(id, domain, day, keys, page) of every distinct page that counts, written to the shared folder.

    Pages with a blank domain or text are left out. ``page`` is a hash of the whole text and ``keys`` one hash
    for each line, so texts stay in the scan; repeated ids count once.
    """
    d = domain_key(F.col(domain))
    rows = feeds.where(F.col(text).rlike(r"\S") & d.isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), d.alias("domain"), F.to_date(seen).alias("day"),
        line_keys(F.col(text)).alias("keys"), F.xxhash64(text).alias("page"),
    )
    return shared(rows.dropDuplicates(["id"]))


def counted(keyed: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """(domain, key, n_pages, n_clusters, n_days, pages, clusters, days) of the lines of at least ``least`` pages; the last three are those of the whole domain.

    Equal pages of a domain are one cluster: its lines are counted once, on the cluster's first day, weighted
    with its pages in ``n_pages`` and as one in ``n_clusters``. Days are counted exactly; clusters without a
    day count for no day.
    """
    clusters = keyed.groupBy("domain", "page").agg(F.count("*").alias("w"), F.min("day").alias("day"), F.min("keys").alias("keys"))
    lines = clusters.select("domain", "w", "day", F.explode(F.array_distinct(F.filter("keys", lambda x: x.isNotNull()))).alias("key"))
    sums = lambda *keys: (F.sum("w").alias("w"), F.sum("c").alias("c"), F.count("day").alias("d"))
    daily = lines.groupBy("domain", "key", "day").agg(F.sum("w").alias("w"), F.count("*").alias("c"))
    found = daily.groupBy("domain", "key").agg(*sums()).where(F.col("w") >= least).select("domain", "key", F.col("w").alias("n_pages"), F.col("c").alias("n_clusters"), F.col("d").alias("n_days"))
    of_days = clusters.groupBy("domain", "day").agg(F.sum("w").alias("w"), F.count("*").alias("c"))
    totals = of_days.groupBy("domain").agg(*sums()).select("domain", F.col("w").alias("pages"), F.col("c").alias("clusters"), F.col("d").alias("days"))
    return found.join(totals, "domain")


def repeated(counts: DataFrame, least_clusters: int = LEAST_CLUSTERS, least_share: float = LEAST_SHARE, least_days: int = LEAST_DAYS) -> DataFrame:
    """The counted lines repeated excessively in a domain: in enough of its clusters of equal pages and on enough days.

    A domain known on fewer days than that is judged by its clusters alone. At most (lines of a page) /
    least_share lines of a domain can be found.
    """
    return counts.where((F.col("n_clusters") >= least_clusters) & (F.col("n_clusters") >= least_share * F.col("clusters")) & (F.col("n_days") >= F.least(F.lit(least_days), F.col("days"))))


def standing(counts: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """The counted lines that stand in enough pages of a domain, copies of a page included."""
    return counts.where((F.col("n_pages") >= least_pages) & (F.col("n_pages") >= least_share * F.col("pages")))


def marked(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """(id, line_no, domain, key, n_pages, n_clusters, n_days) of every occurrence of a found line.

    The found lines are broadcast while they are at most BROADCAST_ROWS rows; beyond, the join shuffles both
    sides on (domain, key).
    """
    found = shared(found.select("domain", "key", "n_pages", "n_clusters", "n_days"))
    small = found.count() <= BROADCAST_ROWS
    lines = keyed.select("id", "domain", F.posexplode("keys").alias("pos", "key")).where(F.col("key").isNotNull())
    return lines.join(F.broadcast(found) if small else found, ["domain", "key"]).select(
        "id", (F.col("pos") + 1).alias("line_no"), "domain", "key", "n_pages", "n_clusters", "n_days",
    )


def cleaned(feeds: DataFrame, marks: DataFrame, id_col: str = "id", text: str = "raw_text") -> DataFrame:
    """(id, text, n_removed) of each distinct id with the marked lines taken out; texts without such lines and null texts stay as they are."""
    drop = marks.groupBy("id").agg(F.collect_set("line_no").alias("drop"))
    texts = feeds.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text")).dropDuplicates(["id"])
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("drop", i + 1))
    return texts.join(drop, "id", "left").select(
        "id", F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.size("drop")).alias("n_removed"),
    )

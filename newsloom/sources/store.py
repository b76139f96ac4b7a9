"""Readers and writers: daily partitions, JSON checkpoints, cluster rows, vector collections."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import page as H
from ..functions import text as X
from ..operators.cluster import cosine
from ..operators.topics import canonical_id, or_unknown


def daily_table_name(base: str, day: str | dt.date | None = None) -> str:
    """``base_YYYYMMDD``; a string must be an ISO date, None is today in UTC, other types raise TypeError."""
    if day is None:
        day = dt.datetime.now(dt.timezone.utc).date()
    elif isinstance(day, str):
        day = dt.date.fromisoformat(day)
    elif not isinstance(day, dt.date):
        raise TypeError(f"day must be a date or an ISO date, not {type(day).__name__}")
    return f"{base}_{day:%Y%m%d}"


def valid(rows: DataFrame, kind: str) -> DataFrame:
    """Rows that have every required field of their record type."""
    for c in schema.REQUIRED[kind]:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def by_ids(rows: DataFrame, ids: Sequence[str] | DataFrame, key: str = "id", inline: int = 1000) -> DataFrame:
    """Rows of the given ids after canonicalising: a filter for short lists, a semi join for frames and long lists.

    An id in a list that is no UUID raises ValueError; in a frame it matches nothing.
    """
    if not isinstance(ids, DataFrame):
        ids = [str(uuid.UUID(i.strip())) for i in ids]
        if len(ids) <= inline:
            return rows.where(canonical_id(F.col(key)).isin(ids))
        ids = rows.sparkSession.createDataFrame([(i,) for i in ids], "id string")
    wanted = ids.select(canonical_id(F.col("id")).alias("_id")).where("_id is not null")
    return rows.join(wanted, canonical_id(F.col(key)) == F.col("_id"), "left_semi")


def read_day(spark: SparkSession, path: str, day: str | dt.date) -> DataFrame:
    """One day of a table partitioned by ``dt``; only that partition's files are listed and read."""
    return spark.read.parquet(path).where(F.col("dt") == F.lit(str(day)).cast("date"))


def write_day(rows: DataFrame, path: str, day: str | dt.date, files: int | None = None) -> None:
    """Replace one day's partition and leave the others alone, atomically per partition."""
    rows = rows.withColumn("dt", F.lit(str(day)).cast("date"))
    rows = rows.repartition(files) if files else rows
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)


def _files(spark: SparkSession, path: str):
    """(file system, path) of a folder, by the cluster's own file system classes."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def drop_day(spark: SparkSession, path: str, day: str | dt.date) -> bool:
    """Remove one day's partition; False if there was none."""
    fs, at = _files(spark, f"{path}/dt={day}")
    return bool(fs.delete(at, True))


def create_day(spark: SparkSession, path: str, day: str | dt.date) -> None:
    """Make an empty partition of cluster rows for a day; rows that are there stay."""
    fs, at = _files(spark, f"{path}/dt={day}")
    if not fs.exists(at):
        spark.createDataFrame([], _STORED).write.parquet(f"{path}/dt={day}")


def init_day(spark: SparkSession, path: str, day: str | dt.date) -> None:
    """An empty partition for a day, whatever was there."""
    drop_day(spark, path, day)
    create_day(spark, path, day)


_STORED = schema.T.StructType([
    schema.T.StructField(n, schema.T.IntegerType() if n in ("cluster_id", "article_count") else schema.T.TimestampType() if n == "created_at" else schema.T.StringType())
    for n in ("flashpoint_id", "cluster_id", "summary", "article_count", "top_domains", "languages", "urls", "images", "created_at")
])


def write_together(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Write several frames, all or none, each to its path, and return their row counts.

    Each is written beside its path first; only when all are there do renames put them in place. A failed write
    removes what was written and leaves the old data of every path alone.
    """
    if not frames:
        return {}
    tag, spark = uuid.uuid4().hex, next(iter(frames.values())).sparkSession
    beside = {path: f"{path.rstrip('/')}-{tag}" for path in frames}
    try:
        for path, df in frames.items():
            df.write.parquet(beside[path])
        counts = {path: spark.read.parquet(at).count() for path, at in beside.items()}
    except Exception:
        for at in beside.values():
            fs, p = _files(spark, at)
            fs.delete(p, True)
        raise
    for path, at in beside.items():
        fs, old = _files(spark, path)
        fs.delete(old, True)
        fs.rename(_files(spark, at)[1], old)
    return counts


def store_clusters(clusters: DataFrame, path: str, day: str | dt.date, mode: str = "append") -> None:
    """Cluster rows with their lists as JSON; ``all_domains`` isn't stored."""
    lists = ("top_domains", "languages", "urls", "images")
    out = clusters.select("flashpoint_id", "cluster_id", "summary", "article_count", *[F.to_json(c).alias(c) for c in lists])
    out = out.withColumn("created_at", F.current_timestamp())
    if mode == "append":
        out.withColumn("dt", F.lit(str(day)).cast("date")).write.mode("append").partitionBy("dt").parquet(path)
    else:
        write_day(out, path, day)


def load_clusters(spark: SparkSession, path: str, day: str | dt.date) -> DataFrame:
    """Stored cluster rows with their lists parsed; malformed lists come out empty."""
    rows = read_day(spark, path, day)
    for c in ("top_domains", "languages", "urls", "images"):
        rows = rows.withColumn(c, X.json_list(F.col(c)))
    return rows


def write_checkpoint(feeds: DataFrame, path: str, day: str | dt.date) -> None:
    """Feeds as JSON lines, strings squeezed, one folder for each topic and day."""
    strings = [f.name for f in feeds.schema if f.dataType.simpleString() == "string" and f.name != "flashpoint_id"]
    out = feeds.withColumns({c: X.squeeze(F.col(c)) for c in strings}).withColumn("dt", F.lit(str(day)))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy("flashpoint_id", "dt").json(path)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Checkpointed feeds; a missing folder gives no rows, bad times give null."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        return spark.createDataFrame([], schema.FEED)
    times = {"created_at", "updated_at"}
    read = schema.T.StructType([schema.T.StructField(f.name, schema.T.StringType() if f.name in times else f.dataType) for f in schema.FEED])
    rows = spark.read.schema(read).json(path)
    return rows.withColumns({c: F.try_to_timestamp(F.col(c)).cast("timestamp_ntz") for c in times})


def api_articles(raw: DataFrame) -> DataFrame:
    """API rows in the article shape: required url and title, country default 'unknown', time parsed, each url once by its latest sighting."""
    rows = raw.where(F.col("url").isNotNull() & F.col("title").isNotNull()).select(
        "url", "title", X.parse_time(F.col("seendate")).alias("seen_at"), F.col("socialimage").alias("image"), "domain", "language",
        or_unknown(F.col("sourcecountry")).alias("sourcecountry"),
    )
    return rows.groupBy("url").agg(F.max(F.struct("seen_at", "title", "image", "domain", "language", "sourcecountry")).alias("r")).select("url", "r.*")


def collection_rows(feeds: DataFrame) -> DataFrame:
    """Vector-store rows of the feeds that have a vector and a text: summary, else raw text; ids default to content ids."""
    text = F.coalesce(F.when(F.trim("summary") != "", F.col("summary")), F.when(F.trim("raw_text") != "", F.col("raw_text")))
    meta = F.struct("url", or_unknown(F.col("image")).alias("image"), "domain", "sourcecountry", or_unknown(F.col("language")).alias("language"))
    return feeds.where(F.size("embedding") > 0).select("flashpoint_id", F.coalesce("id", X.content_id(text)).alias("id"), text.alias("document"), meta.alias("metadata"), "embedding").where("document is not null")


def insert_collection(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("flashpoint_id").parquet(path)


def scan_collection(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """All rows of a collection, or of every one; one topic's rows are read from its own partition only."""
    rows = spark.read.parquet(path)
    return rows if topic is None else rows.where(F.col("flashpoint_id") == topic)


def list_collections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("flashpoint_id").distinct()


def require_collection(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The rows of a collection; KeyError if there is none of that name."""
    fs, at = _files(spark, f"{path}/flashpoint_id={topic}")
    if not fs.exists(at):
        raise KeyError(f"no collection named {topic}")
    return scan_collection(spark, path, topic)


def delete_collection(spark: SparkSession, path: str, topic: str) -> None:
    """Remove a collection; KeyError if there is none of that name."""
    fs, at = _files(spark, f"{path}/flashpoint_id={topic}")
    if not fs.delete(at, True):
        raise KeyError(f"no collection named {topic}")


def wipe_collections(spark: SparkSession, path: str) -> None:
    """Remove all collections."""
    fs, at = _files(spark, path)
    fs.delete(at, True)


def query_similar(rows: DataFrame, query: Sequence[float], k: int = 5, key: str = "id", embedding: str = "embedding") -> DataFrame:
    """The k rows most similar to a vector, ties by key: one scan, a bounded heap in each task, k rows to the driver."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return rows.withColumn("similarity", cosine(F.col(embedding), q)).where("similarity is not null").orderBy(F.desc("similarity"), key).limit(k)


def jdbc_options(url: str, table: str, key: str, low: int, high: int, partitions: int = 64, fetch: int = 10_000) -> dict[str, str]:
    """Options of a partitioned JDBC scan, instead of LIMIT/OFFSET pages."""
    return {"url": url, "dbtable": table, "partitionColumn": key, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions), "fetchsize": str(fetch), "pushDownPredicate": "true"}


def read_jdbc(spark: SparkSession, options: dict[str, str], **more: str) -> DataFrame:
    """A database table as partitioned scans; ``more`` adds options such as user, password and driver."""
    return spark.read.format("jdbc").options(**options, **more).load()


def addresses(pages: DataFrame, page: str = "html") -> DataFrame:
    """(host, port) of the first two cells of table rows that look like them, each once: a list of servers kept as a web page."""
    r = pages.select(F.explode(H.table_rows(F.col(page))).alias("r")).where(F.size("r") >= 2)
    r = r.select(F.col("r")[0].alias("host"), F.col("r")[1].alias("port"))
    good = F.col("host").rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") & F.col("port").rlike("^[0-9]{1,5}$")
    return r.where(good).select("host", F.col("port").cast("int").alias("port")).distinct()


def addresses_json(spark: SparkSession, path: str) -> DataFrame:
    """(host, port) of a list of servers kept as JSON, each once."""
    return spark.read.schema("ip string, port int").option("multiLine", "true").json(path).where("ip is not null").select(F.col("ip").alias("host"), "port").distinct()


#: A few articles in the shape of the news API, keys missing here and there, for trying things out.
SAMPLE = (
    {"url": "https://one.example/a", "title": "Bridge opens", "seendate": "20250701T101500Z", "domain": "one.example", "language": "English", "sourcecountry": "Norway"},
    {"url": "https://two.example/b", "url_mobile": "https://m.two.example/b", "title": "Le pont rouvre", "seendate": "2025-07-01", "socialimage": "https://two.example/b.png", "domain": "two.example", "language": "French", "sourcecountry": ""},
    {"url": "https://one.example/a", "title": "Bridge opens", "seendate": "2025-07-02T08:00:00", "domain": "one.example", "language": "English", "sourcecountry": "Norway"},
    {"url": None, "title": "No address", "seendate": "soon", "domain": "three.example", "language": "Chinese", "sourcecountry": "China"},
)


def sample_articles(spark: SparkSession) -> DataFrame:
    names = [f.name for f in schema.API_ARTICLE]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in SAMPLE], schema.API_ARTICLE)


def column_or_null(rows: DataFrame, name: str) -> Column:
    return F.col(name) if name in rows.columns else F.lit(None).cast("string").alias(name)

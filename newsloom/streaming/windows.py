"""Streaming counterparts: the same transformations run on a batch and on a stream of events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _late(events: DataFrame, late: str | None) -> DataFrame:
    """With ``late``, events under a watermark; that needs times with a zone, so times without one are read in the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if late else events


def tumbling(events: DataFrame, size: str = "1 hour", late: str | None = None) -> DataFrame:
    """Count and mean value of each event type in windows of one size; ``late`` sets the watermark of a stream."""
    e = _late(events, late)
    g = e.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean_value"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "mean_value")


def sliding(events: DataFrame, size: str = "1 hour", step: str = "15 minutes", late: str | None = None) -> DataFrame:
    e = _late(events, late)
    return e.groupBy(F.window("ts", size, step).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """Sessions of each user: events less than ``gap`` apart."""
    e = _late(events, late)
    g = e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), "n")


def distinct_events(events: DataFrame, late: str | None = None) -> DataFrame:
    """Each event id once; on a stream, within the watermark."""
    return _late(events, late).dropDuplicatesWithinWatermark(["event_id"]) if late else events.dropDuplicates(["event_id"])


def refreshes(events: DataFrame, key: str, ttl_seconds: int = 300, late: str = "1 hour") -> DataFrame:
    """(key, ts, event_id) of the events at which a cache whose entries live ``ttl_seconds`` is filled anew: the first of a key and each one as long after the last filling.

    The rule depends on the last filling, so a key's times are read in order, in small rows; on a stream the time
    of the last filling is the state of the key; it goes once the watermark, ``late`` behind, has passed its life.
    """
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    schema = f"{key} {kinds[key]}, ts timestamp, event_id {kinds['event_id']}"
    e = events.select(key, F.col("ts").cast("timestamp").alias("ts"), "event_id")
    life = pd.Timedelta(seconds=ttl_seconds)

    def filled(pdf: pd.DataFrame, last: pd.Timestamp | None) -> tuple[pd.DataFrame, pd.Timestamp | None]:
        pdf = pdf.sort_values(["ts", "event_id"], kind="stable")
        at = []
        for n, t in enumerate(pdf["ts"]):
            if last is None or t - last >= life:
                at.append(n)
                last = t
        return pdf.iloc[at], last

    if not events.isStreaming:
        return e.groupBy(key).applyInPandas(lambda pdf: filled(pdf, None)[0], schema)

    def stateful(k, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        rows = pd.concat(list(parts))
        out, last = filled(rows, last)
        state.update((last.value // 1000,))
        state.setTimeoutTimestamp(max(last.value // 1_000_000 + ttl_seconds * 1000, state.getCurrentWatermarkMs() + 1))
        yield out

    return e.withWatermark("ts", late).groupBy(key).applyInPandasWithState(stateful, schema, "last long", "append", "EventTimeTimeout")


def read_events(spark: SparkSession, folder: str, schema, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def daily_sink(stream: DataFrame, path: str, checkpoint: str, day: str = "ts"):
    """Write each day's rows into its partition, everything available now, then stop.

    Batches are keyed by their number, so a batch that is retried replaces itself and never doubles rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        out = batch.withColumn("dt", F.to_date(day)).withColumn("batch", F.lit(number))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "batch").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

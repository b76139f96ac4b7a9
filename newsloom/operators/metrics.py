"""Service metrics over event rows: rates, health score, recommendations, rolling and trend windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rates(events: DataFrame, *keys: str, batch: str = "user_id") -> DataFrame:
    """Requests, errors, batches and their rates for each group; the requests of one ``batch`` value are a batch.

    Per second over the time between first and last event (a second at least); ``batch_efficiency`` is requests per
    second over ten times the batches, at most 1.
    """
    g = events.groupBy(*keys, batch).agg(
        F.count("*").alias("n"), F.sum((F.col("event_type") == "error").cast("long")).alias("e"), F.sum("value").alias("v"), F.min("ts").alias("a"), F.max("ts").alias("b"),
    ).groupBy(*keys).agg(
        F.sum("n").alias("requests"), F.sum("e").alias("errors"), F.count("*").alias("batches"), F.sum("v").alias("_v"), F.min("a").alias("_a"), F.max("b").alias("_b"),
    )
    seconds = F.greatest(F.expr("timestampdiff(SECOND, _a, _b)"), F.lit(1))
    return g.select(
        *keys, "requests", "errors", "batches", F.round(F.col("errors") / F.col("requests"), 6).alias("error_rate"), F.round(F.col("_v") / F.col("requests"), 6).alias("mean_value"),
        F.round(F.col("_v") / F.col("batches"), 6).alias("mean_batch"), F.round(F.col("requests") / seconds, 6).alias("per_second"), F.round(F.col("batches") / seconds, 6).alias("batches_per_second"),
        F.round(F.least(F.lit(1.0), F.col("requests") / seconds / (F.col("batches") * 10)), 6).alias("batch_efficiency"),
    )


def health(gpu: Column, cpu: Column, errors: Column, efficiency: Column) -> Column:
    """0 to 100: points off for an idle GPU, a busy CPU, errors and half-empty batches."""
    s = (
        F.lit(100.0) - F.when(gpu < 0.7, (0.7 - gpu) * 50).otherwise(0.0) - F.when(cpu > 80, (cpu - 80) * 0.5).otherwise(0.0)
        - F.when(errors > 0.05, errors * 200).otherwise(0.0) - F.when(efficiency < 0.8, (0.8 - efficiency) * 25).otherwise(0.0)
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), s))


def recommendations(gpu: Column, cpu: Column, errors: Column, efficiency: Column, queue: Column) -> Column:
    """Array of (category, priority) of the rules that fire; nulls fire none."""
    rule = lambda test, category, priority: F.when(test, F.struct(F.lit(category).alias("category"), F.lit(priority).alias("priority")))
    rules = F.array(
        rule(gpu < 0.7, "gpu", "high"), rule(cpu > 80, "cpu", "medium"), rule(efficiency < 0.8, "batching", "medium"),
        rule(errors > 0.05, "errors", "high"), rule(queue > 100, "queue", "medium"),
    )
    return F.filter(rules, lambda x: x.isNotNull())


def rolling(events: DataFrame, key: str, size: int = 1000) -> DataFrame:
    """Mean over the last ``size`` rows of each key, the row itself included."""
    w = Window.partitionBy(key).orderBy("ts", "event_id").rowsBetween(1 - size, 0)
    return events.withColumn("rolling_mean", F.avg("value").over(w)).withColumn("rolling_n", F.count("*").over(w))


#: Least denominators of a relative trend: of rates, and of shares and errors (fixed values).
RATE_FLOOR, SHARE_FLOOR = 1.0, 0.001


def trend(events: DataFrame, key: str, size: int = 10, floor: float | None = RATE_FLOOR, value: str = "value", name: str = "trend") -> DataFrame:
    """(last - first) / max(first, floor) over the last ``size`` rows, the plain difference without ``floor``; null while there are fewer.

    The plain form is 0 where one of the two values is zero or missing, as of a device that is not there.
    """
    w = Window.partitionBy(key).orderBy("ts", "event_id")
    first, last = F.lag(value, size - 1).over(w), F.col(value)
    if floor is None:
        change = F.when((F.coalesce(first, F.lit(0.0)) != 0) & (F.coalesce(last, F.lit(0.0)) != 0), last - first).otherwise(0.0)
    else:
        change = (last - first) / F.greatest(first, F.lit(floor))
    return events.withColumn(name, F.when(F.row_number().over(w) >= size, change))


def pool_size(free_bytes: int | None, estimate_bytes: int, most: int) -> int:
    """Instances of a model on one device: as many as fit into the free memory, at least 1 and at most ``most``; ``most`` without a device."""
    return most if free_bytes is None or estimate_bytes <= 0 else min(max(1, free_bytes // estimate_bytes), most)


def device(available: bool, force_cpu: bool = False, force_gpu: bool = False) -> str:
    """'cpu' or 'gpu': forcing the CPU wins over forcing the GPU, which fails where there is none; else the GPU if there is one."""
    if force_cpu:
        return "cpu"
    if force_gpu and not available:
        raise RuntimeError("a GPU is demanded but none is available")
    return "gpu" if available else "cpu"


def task_resources(free_bytes: int | None, estimate_bytes: int, most: int, cores: int) -> dict[str, str]:
    """Spark settings under which as many tasks share an executor as model instances fit: a share of a GPU for each task, or whole cores."""
    n = pool_size(free_bytes, estimate_bytes, most)
    if free_bytes is None:
        return {"spark.task.cpus": str(max(1, cores // n))}
    return {"spark.executor.resource.gpu.amount": "1", "spark.task.resource.gpu.amount": f"{1 / n:.4f}"}

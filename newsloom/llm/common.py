"""Shared helpers of the training-data operators: table access, shared folder, Arrow column maps."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared  # noqa: F401 - used by the operators


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def limits(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """The fixed table of four size limits as a dict."""
    return {r.limit_name: int(r.amount) for r in table(spark, sf_dir, "size_limits").collect()}


def batch_of(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def once_per_id(df: DataFrame, key: str, *values: str) -> DataFrame:
    """One row for each key. Rows of one key carry equal values (see TESTDATA); the smallest is taken, so the result is the same in any order."""
    return df.groupBy(key).agg(*[F.min(v).alias(v) if not isinstance(df.schema[v].dataType, (T.MapType,)) else F.first(v).alias(v) for v in values])


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, the same in every run: those whose hash of the key is below the share that gives so many.

    The rows are picked in the scan, so what reaches the driver doesn't grow with the input or its partitions.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int((1 << 40) * rows / total)).limit(rows + rows // 4)

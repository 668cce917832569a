"""Writing statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rtdw.operators.stats import to_sink_order
from rtdw.sinks.topics import write_batch


def write_parquet(df: DataFrame, schema: T.StructType, path: str, batch_id: int) -> None:
    """One batch of statistics in sink order; a repeated batch replaces its own rows."""
    write_batch(to_sink_order(df, schema), path, batch_id, "parquet")


def write_by_day(df: DataFrame, path: str, batch_id: int) -> None:
    """One batch of sums by ``day`` (yyyyMMdd); a repeated batch replaces its own rows.

    The table is partitioned by day and batch, so a day is read by itself. A day's total is
    the sum over its batches, as each finished window comes in one batch only.
    """
    writer = df.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)


def read_by_day(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """The rows of such a table, with ``day`` and ``batch``."""
    return spark.read.schema(f"{columns}, day int, batch bigint").parquet(path)


def write_jdbc(
    df: DataFrame,
    schema: T.StructType,
    url: str,
    table: str,
    rows_per_batch: int = 1000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Append statistics to a database table in sink order. Delivery is at least once."""
    (
        to_sink_order(df, schema)
        .write.mode("append")
        .format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", rows_per_batch)
        .options(**(properties or {}))
        .save()
    )

"""Topics: streams of text records.

A topic lives in a folder of text files, one record per line, or in Kafka where
that package is on the class path. Both give a column ``value``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rtdw.schemas import TEXT_MAP


def _files(spark: SparkSession, rate: int | None):
    """A stream reader that takes at most ``rate`` files at a time."""
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", rate) if rate else reader


def read_folder(spark: SparkSession, path: str, rate: int | None = None) -> DataFrame:
    """A folder of finished text files as a stream.

    A file must not change after it is there; ``growing.read_growing`` reads logs that are
    appended to and rolled.
    """
    return _files(spark, rate).text(path)


def read_topic(
    spark: SparkSession, path: str, topic: str, rate: int | None = None
) -> DataFrame:
    """One topic of a folder that a split or routing job writes, partitioned by topic."""
    rows = _files(spark, rate).schema("value string, topic string").text(path)
    return rows.where(F.col("topic") == topic).select("value")


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    options: Mapping[str, str] | None = None,
    rate: int | None = None,
) -> DataFrame:
    """A Kafka topic as a stream of text. ``starting`` counts for a first run only."""
    if rate:
        options = {"maxOffsetsPerTrigger": str(rate), **(options or {})}
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**(options or {}))
        .load()
        .selectExpr("cast(value as string) as value")
    )


def records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Text records as typed columns, whether the JSON holds numbers or text.

    A malformed record fails the job.
    """
    fields = F.from_json(F.col("value"), TEXT_MAP, {"mode": "FAILFAST"})
    return lines.select(F.explode(F.array(fields)).alias("r")).selectExpr(
        *[f"cast(r['{f.name}'] as {f.dataType.simpleString()}) as {f.name}" for f in schema]
    )

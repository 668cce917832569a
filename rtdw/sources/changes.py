"""Change records of a database, as a capture tool writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rtdw.operators import cdc
from rtdw.operators.parse import parse_strict
from rtdw.schemas import CHANGE, RAW_CHANGE
from rtdw.session import fresh_dir


def parse_changes(lines: DataFrame) -> DataFrame:
    """Envelope text to change records."""
    return parse_strict(lines, CHANGE)


def parse_raw_changes(lines: DataFrame) -> DataFrame:
    """Captured text (topic, op, before, after, seq) to change records."""
    return cdc.normalise(parse_strict(lines, RAW_CHANGE))


def with_raw(lines: DataFrame) -> DataFrame:
    """Captured text kept beside its record, for a look at what was delivered."""
    record = F.from_json(F.col("value"), RAW_CHANGE)
    return lines.select("value", F.explode(F.array(record)).alias("record"))


def stored_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes of a folder as of now."""
    return parse_changes(spark.read.text(path))


def snapshot_then_changes(
    spark: SparkSession, snapshot: DataFrame, path: str, database: str, table: str
) -> DataFrame:
    """A table's stored rows as ``read`` changes, and the changes logged since, as one stored frame.

    ``stream_snapshot_then_changes`` is the streaming form.
    """
    columns = CHANGE.fieldNames()
    first = cdc.snapshot_as_changes(snapshot, database, table).select(*columns)
    later = stored_changes(spark, path).where(F.col("tableName") == table).select(*columns)
    return first.unionByName(later)


def stream_snapshot_then_changes(
    spark: SparkSession, snapshot: DataFrame, path: str, database: str, table: str
) -> DataFrame:
    """The same as a stream: the stored rows first, then each change that is logged.

    The snapshot is written to a table of its own when the stream is built, so a
    restarted query does not see rows that came later. Changes carry a higher
    ``seq`` than the snapshot, so their order of arrival does not matter to
    whoever keeps the newest.
    """
    columns = CHANGE.fieldNames()
    stored = fresh_dir(spark, "snapshot")
    first = cdc.snapshot_as_changes(snapshot, database, table).select(*columns)
    first.write.parquet(stored)
    later = parse_changes(spark.readStream.text(path)).where(F.col("tableName") == table)
    return spark.readStream.schema(first.schema).parquet(stored).unionByName(later.select(*columns))

"""Writing topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtdw.streaming.run import start, start_table


def as_text(df: DataFrame) -> DataFrame:
    """Every row as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def start_folder(rows: DataFrame, path: str, checkpoint: str, every: str | None = "5 seconds"):
    """Append a stream of ``value`` (and ``topic``) to a text folder, each record once."""
    partition_by = ("topic",) if "topic" in rows.columns else ()
    return start_table(rows, path, checkpoint, partition_by, "text", every)


def write_batch(rows: DataFrame, path: str, batch_id: int, file_format: str = "text") -> None:
    """Write one micro-batch to ``batch=N``; a repeated batch replaces its own rows."""
    writer = rows.write.mode("overwrite").format(file_format)
    if "topic" in rows.columns:
        writer = writer.partitionBy("topic")
    writer.save(f"{path}/batch={batch_id}")


def start_kafka(
    rows: DataFrame, servers: str, checkpoint: str, topic: str | None = None,
    every: str | None = "5 seconds",
):
    """Send a stream to Kafka: to ``topic``, or each row to the topic in its column.

    Delivery is at least once.
    """
    writer = (
        rows.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )
    if topic:
        writer = writer.option("topic", topic)
    return start(rows.sparkSession, writer, every)


def send_batch(rows: DataFrame, servers: str, topic: str | None = None) -> None:
    """Send one micro-batch to Kafka."""
    writer = rows.write.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    writer.save()


def start_console(rows: DataFrame, label: str):
    """Show a stream while developing."""
    return rows.writeStream.format("console").queryName(label).option("truncate", False).start()

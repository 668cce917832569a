"""Running a streaming frame to the end of its input."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rtdw.session import fresh_dir, listed_files, remove_dir, session_settings
from rtdw.streaming.keyed import STATE_SETTINGS


# A run that ends has nobody who watches its state, and counting the rows of the
# state takes a read for each write. A store would reserve 4 MB of disk ahead, as much as a partition
# of the state has input, and a join has four. Shuffles are not read again, so their files go at once.
RUN_SETTINGS = {
    **STATE_SETTINGS,
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

#: All state stores of an executor share one memory limit, whatever the number of partitions.
BOUNDED_MEMORY = {"spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true"}

#: For a run of inner joins, which return their rows at once: no further micro-batch, which would
#: only take rows from the state.
INNER_JOINS = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}

#: Bytes of stored input for each partition of the state.
PARTITION_BYTES = 4 << 20

#: Bytes of stored input for each run over a share of the keys. State and shuffles of a run take
#: many times its input on disk, and all but its result goes before the next.
RUN_BYTES = 256 << 20


def _size(spark: SparkSession, *paths: str) -> int:
    return sum(length for path in paths for _, length in listed_files(spark, path))


def state_partitions(spark: SparkSession, *paths: str) -> int:
    """Partitions of the state for the input in these files and folders: as many as the session
    shuffles into, more if the input is large, so that none grows with the input."""
    size = _size(spark, *paths)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))


def run_shares(spark: SparkSession, *paths: str) -> int:
    """Shares of the keys to run one after another for the input in these files and folders."""
    return max(1, -(-_size(spark, *paths) // RUN_BYTES))


def in_share(rows: DataFrame, key: str, share: int, shares: int) -> DataFrame:
    """The rows whose key, also a null one, falls into a share.

    Keys that are to meet must have one type. The hash is not that of the shuffles, which
    would leave most of their partitions empty.
    """
    if shares == 1:
        return rows
    return rows.where(F.pmod(F.xxhash64(key), F.lit(shares)) == share)


def run_to_table(
    spark: SparkSession, stream: DataFrame, purpose: str, partitions: int | None = None
) -> DataFrame:
    """Process all input there is now, append to a new Parquet table and read it back.

    Rows still held by open windows or timers stay in the query's state, as they
    would in a running job. The state has ``partitions``, or as many as the session
    shuffles into; the checkpoint is removed at the end.
    """
    folder = run_to_folder(spark, stream, purpose, partitions)
    return spark.read.schema(stream.schema).parquet(folder)


def read_folders(spark: SparkSession, schema: T.StructType, folders: list[str], as_stream: bool = False) -> DataFrame:
    """The tables of several finished runs as one; each is read by its own list of files."""
    reader = (spark.readStream if as_stream else spark.read).schema(schema)
    return reduce(DataFrame.unionByName, [reader.parquet(folder) for folder in folders])


def run_to_folder(spark: SparkSession, stream: DataFrame, purpose: str, partitions: int | None = None) -> str:
    """``run_to_table``, whose folder is returned."""
    table, checkpoint = fresh_dir(spark, purpose), fresh_dir(spark, f"{purpose}-checkpoint")
    dealt = {"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}
    with session_settings(spark, {**RUN_SETTINGS, **dealt}):
        (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", table)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    remove_dir(spark, checkpoint)
    return table


def start_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    file_format: str = "parquet",
    every: str | None = "5 seconds",
):
    """Start appending a stream to a table; ``every=None`` stops at the end of the input."""
    writer = (
        stream.writeStream.format(file_format)
        .outputMode("append")
        .partitionBy(*partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return start(stream.sparkSession, writer, every)


def start_batches(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "5 seconds",
):
    """Start calling ``process(rows, batch_id)`` per micro-batch.

    A batch may be repeated after a failure with the same id, so ``process`` must
    overwrite what it wrote for that id.
    """
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return start(stream.sparkSession, writer, every)


def start(spark: SparkSession, writer, every: str | None):
    """Start a stream writer every so often, or once over the input there is."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    with session_settings(spark, STATE_SETTINGS):
        return writer.trigger(**trigger).start()

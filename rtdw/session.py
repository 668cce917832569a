"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession

# AQE sizes the shuffles at run time: start wide and let it coalesce. Skewed
# join partitions are split by AQE; no job relies on a forced broadcast.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.minPartitionNum": "8",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app_name: str = "rtdw",
    master: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; ``settings`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where that is unset, a local session uses a folder below its warehouse; on a
    cluster it is an error, as the warehouse may be local to one machine there.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.shared"
    context.setCheckpointDir(base)
    return base


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/rtdw/{purpose}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark reads, and all below it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def listed_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern, in any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(pattern)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(found.getPath().toString() for found in store.globStatus(place) or [])


def listed_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and size of all files below a folder, hidden ones left out."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return []
    files, out = store.listFiles(place, True), []
    while files.hasNext():
        found = files.next()
        if not found.getPath().getName().startswith(("_", ".")):
            out.append((found.getPath().toString(), found.getLen()))
    return sorted(out)


def path_exists(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return store.exists(place)


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is either there as a whole or not at all."""
    place, store = _place(spark, path)
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}"
    )
    out = store.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not store.rename(hidden, place):
        store.delete(hidden, False)
        if not store.exists(place):
            raise OSError(f"cannot write {path}")


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@contextlib.contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set run-time settings for a block and put the old values back."""
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)

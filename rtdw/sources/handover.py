"""Topics handed over batch by batch: each record once, also when a batch is repeated.

A writer writes an attempt of a batch into a folder of its own and then publishes a manifest,
one small file that lists the attempt's files. The first manifest of a batch stands: an
attempt that failed before is never listed, and one that is repeated afterwards is not
written. Readers stream the manifests, which appear as a whole and never change, and read
the files that they list.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rtdw.session import listed_files, path_exists, publish_text, remove_dir
from rtdw.sources.lines import opened_store, read_lines, slices

MANIFESTS = "_manifest"
#: Bytes of a file that one task reads.
SLICE_BYTES = 64 << 20
ENTRY = "topic string, file string, begin long, end long, size long"


def manifest_path(path: str, batch_id: int) -> str:
    return f"{path}/{MANIFESTS}/batch={batch_id}.json"


def deliver_batch(rows: DataFrame, path: str, batch_id: int) -> bool:
    """Write and publish one micro-batch of ``value`` (and ``topic``); false if it is there already."""
    spark = rows.sparkSession
    manifest = manifest_path(path, batch_id)
    if path_exists(spark, manifest):
        return False
    batch = f"{path}/batch={batch_id}"
    remove_dir(spark, batch)  # attempts that failed; no reader knows them
    attempt = f"attempt={uuid.uuid4().hex}"
    writer = rows.write.format("text")
    if "topic" in rows.columns:
        writer = writer.partitionBy("topic")
    writer.save(f"{batch}/{attempt}")
    entries = []
    for file, size in listed_files(spark, f"{batch}/{attempt}"):
        name = file[file.index(f"batch={batch_id}/{attempt}") :]
        topic = re.search(r"/topic=([^/]*)/", name)
        entries += [
            {"topic": topic and topic[1], "file": name, "begin": begin, "end": end, "size": size}
            for begin, end in slices(0, size, SLICE_BYTES)
        ]
    publish_text(spark, manifest, "".join(json.dumps(entry) + "\n" for entry in entries))
    return True


def _lines(manifest: DataFrame, path: str, topic: str | None) -> DataFrame:
    """The lines of the files that manifest rows list."""
    entry = manifest.select(F.from_json("value", ENTRY).alias("e")).select("e.*")
    if topic is not None:
        entry = entry.where(F.col("topic") == topic)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened_store(path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base.rstrip('/')}/{row['file']}") as file:
                    yield from read_lines(file, row["begin"], row["end"], 0, row["size"])

    # A task for each part of a file, as far as the session shuffles into so many.
    return entry.repartition("file", "begin").mapInArrow(read, "value string")


def read_delivered(spark: SparkSession, path: str, topic: str | None = None, rate: int | None = None) -> DataFrame:
    """A delivered folder as a stream of lines, at most ``rate`` batches at a time."""
    publish_folder(spark, path)
    reader = spark.readStream.option("maxFilesPerTrigger", rate) if rate else spark.readStream
    return _lines(reader.text(f"{path}/{MANIFESTS}"), path, topic)


def delivered(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """The lines delivered so far, as a stored frame."""
    publish_folder(spark, path)
    return _lines(spark.read.schema("value string").text(f"{path}/{MANIFESTS}"), path, topic)


def publish_folder(spark: SparkSession, path: str) -> None:
    """Make the folder of the manifests, so that a reader may start before the writer."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}")
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)

"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rtdw.session import listed_files

#: Bytes of stored rows for each part that rows are dealt to.
DEALT_BYTES = 8 << 20


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table of known columns, so no file is opened to find them."""
    return spark.read.schema(schema).parquet(path)


def dealt_table(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """A table whose rows are dealt by a key, to parts by the size of its files.

    What is made of the rows and grouped by the key, or by the key and more, needs no further
    shuffle: the stored rows are shuffled instead, which may be far fewer bytes.
    """
    size = sum(length for _, length in listed_files(spark, path))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // DEALT_BYTES))
    return read_table(spark, path, schema).repartition(parts, key)

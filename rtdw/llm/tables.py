"""Reading the sample tables and cutting lineage with written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rtdw.session import fresh_dir


#: Texts differ in length, so what a Python worker gets at once is bounded by bytes.
BATCH_BYTES = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches; the plans made from now on keep to it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table by name."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to a new table in the shared folder and read back.

    The rows do not depend on any executor afterwards, and are computed once.
    """
    bound_batches(df.sparkSession)
    path = fresh_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame, rows: int, per_partition: int) -> int:
    """At least the session's shuffle partitions, more if one would hold too many rows."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, -(-rows // per_partition))


def text_key(text: str = "text") -> F.Column:
    """Eight bytes that equal texts share; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def extended(schema: T.StructType, ddl: str) -> T.StructType:
    """A schema followed by the columns of a schema string."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])

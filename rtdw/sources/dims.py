"""Dimension tables: stored as text, read as typed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def typed(dim: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns a job uses, cast; column names match in any case."""
    stored = {c.lower(): c for c in dim.columns}
    return dim.selectExpr(
        *[
            f"cast(`{stored[f.name.lower()]}` as {f.dataType.simpleString()}) as {f.name}"
            for f in schema
        ]
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return typed(spark.read.parquet(path), schema)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    schema: T.StructType,
    partition: Mapping[str, str | int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A dimension from a database.

    ``partition`` (column, lowerBound, upperBound, numPartitions) splits the read
    over several connections; without it one task reads the table.
    """
    split = {
        "partitionColumn" if key == "column" else key: str(value)
        for key, value in (partition or {}).items()
    }
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return typed(reader.options(**split, **(properties or {})).load(), schema)

"""Config-driven routing of change records to fact topics and dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rtdw.operators.cdc import newest
from rtdw.schemas import TABLE_PROCESS

# Sink types in the routing config.
FACT_SINK = "kafka"
DIM_SINK = "hbase"


def config_rows(changes: DataFrame) -> DataFrame:
    """Config changes as typed rows with ``seq``; a delete has no row to offer."""
    return changes.where("size(after) > 0").selectExpr(
        *[f"after['{f.name}'] as {f.name}" for f in TABLE_PROCESS], "seq"
    )


def latest_config(rows: DataFrame, order: str = "seq", keep_order: bool = False) -> DataFrame:
    """One config row per source table and operation, the newest. Deletes never remove one."""
    return newest(rows, ["source_table", "operate_type"], [order]).select(
        *TABLE_PROCESS.fieldNames(), *[order] * keep_order
    )


def keep_columns(payload: Column | str, columns: Column | str) -> Column:
    """The payload entries named in a comma list, by exact name."""
    names = F.split(F.col(columns) if isinstance(columns, str) else columns, ",")
    return F.map_filter(payload, lambda k, v: F.array_contains(names, k))


def route(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Changes that have a config row, with sink and pruned payload.

    The config has one row per table and operation; Spark broadcasts it by its
    size. Unmatched changes are left out, and so are other sink types.
    """
    wanted = config.where(F.col("sink_type").isin(FACT_SINK, DIM_SINK)).select(
        "source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk"
    )
    matched = (F.col("tableName") == F.col("source_table")) & (
        F.col("type") == F.col("operate_type")
    )
    return changes.join(wanted, matched, "inner").select(
        "database",
        "tableName",
        "type",
        "seq",
        "sink_type",
        "sink_table",
        "sink_pk",
        keep_columns("after", "sink_columns").alias("after"),
    )


def facts(routed: DataFrame) -> DataFrame:
    """Rows (topic, value) for the fact topics."""
    return routed.where(F.col("sink_type") == FACT_SINK).select(
        F.col("sink_table").alias("topic"), F.to_json("after").alias("value")
    )


def dimensions(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == DIM_SINK)

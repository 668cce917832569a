"""Column naming."""

from __future__ import annotations

from pyspark.sql import DataFrame


def camel(name: str) -> str:
    """``order_id`` -> ``orderId``."""
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    """The same rows under lower-camel column names."""
    return df.toDF(*[camel(name) for name in df.columns])

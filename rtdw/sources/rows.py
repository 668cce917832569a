"""Small fixed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rtdw.schemas import struct


def literal_table(spark: SparkSession, columns: str, rows: Sequence[Sequence[str]]) -> DataFrame:
    """A table of text literals inside the plan, so its size is known to the optimizer.

    ``createDataFrame`` on a Python list has no size estimate, and a join with
    it would shuffle both sides.
    """

    def quoted(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    names = ", ".join(struct(columns).fieldNames())
    values = ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS literal_rows({names})")

"""The dimension store: upserts as change batches, folded when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from rtdw.operators.cdc import upsert
from rtdw.operators.routing import DIM_SINK
from rtdw.session import listed_paths, remove_dir

DEFAULT_PK = "id"


def create_table_sql(config: Row, database: str) -> str:
    """DDL for the dimension table of a config row: every column text."""
    pk = config["sink_pk"] or DEFAULT_PK
    extend = config["sink_extend"] or ""
    columns = ", ".join(
        f"`{c}` STRING" + (" COMMENT 'primary key'" if c == pk else "")
        for c in config["sink_columns"].split(",")
    )
    return (
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{config['sink_table']}` ({columns}) "
        f"USING parquet {extend}"
    ).strip()


def table_columns(config: DataFrame) -> DataFrame:
    """Per dimension table of the config: all columns that its rows name, and its key.

    The config has one row per source table and operation, which may name
    different columns of one sink table. Columns stand in the order in which the rows,
    by ``seq``, first name them; by name if the config has no ``seq``.
    """
    named = F.split("sink_columns", ",")
    if "seq" in config.columns:
        rows = F.array_sort(F.collect_list(F.struct("seq", "operate_type", named.alias("columns"))))
        columns = F.array_distinct(F.flatten(F.transform(rows, lambda row: row["columns"])))
    else:
        columns = F.array_sort(F.array_distinct(F.flatten(F.collect_list(named))))
    return (
        config.where(F.col("sink_type") == DIM_SINK)
        .groupBy("sink_table")
        .agg(
            columns.alias("columns"),
            F.coalesce(F.max("sink_pk"), F.lit(DEFAULT_PK)).alias("sink_pk"),
            F.max("sink_extend").alias("sink_extend"),
        )
        .withColumn("sink_columns", F.array_join("columns", ","))
    )


def create_tables(spark: SparkSession, config: DataFrame, database: str) -> list[str]:
    """Create the dimension tables the config names, with the columns of all their rows."""
    statements = [create_table_sql(row, database) for row in table_columns(config).collect()]
    for statement in statements:
        spark.sql(statement)
    return statements


class DimensionStore:
    """Dimension tables in a folder.

    A micro-batch only appends its changes (``changes/batch=N``, replaced if the
    batch is repeated), so writing never costs more than the batch. Reading folds
    the last compacted state with the changes since; ``compact`` moves that state
    forward and ``vacuum`` removes what no reader needs. A state or batch counts
    once its mark of success is there, which Spark writes last.
    """

    CHANGES = "after map<string,string>, type string, seq bigint, batch bigint, sink_table string"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, routed: DataFrame, batch_id: int) -> None:
        """Add the routed dimension changes of one batch, all tables in one write."""
        routed.select("sink_table", "after", "type", "seq").write.mode("overwrite").partitionBy(
            "sink_table"
        ).parquet(f"{self.root}/changes/batch={batch_id}")

    def _finished(self, folder: str, name: str) -> dict[int, str]:
        """Number and path of the finished folders ``name=N``."""
        marks = listed_paths(self.spark, f"{self.root}/{folder}/{name}=*/_SUCCESS")
        paths = [mark.removesuffix("/_SUCCESS") for mark in marks]
        return {int(path.rpartition("=")[2]): path for path in paths}

    def read(self, table: str, columns: list[str], pk: str = DEFAULT_PK) -> DataFrame:
        """The current rows of a table, as text columns."""
        fields = ", ".join(f"`{c}` string" for c in columns)
        bases = self._finished(f"base/{table}", "upto")
        last = max(bases, default=-1)
        reader = self.spark.read
        current = (
            reader.schema(fields).parquet(bases[last])
            if bases
            else self.spark.createDataFrame([], fields)
        )
        later = [p for n, p in sorted(self._finished("changes", "batch").items()) if n > last]
        if not later:
            return current
        changes = (
            self.spark.read.schema(self.CHANGES)
            .option("basePath", f"{self.root}/changes")
            .parquet(*later)
            .where(F.col("sink_table") == table)
        )
        return upsert(current, changes, pk)

    def compact(self, table: str, columns: list[str], upto: int, pk: str = DEFAULT_PK) -> None:
        """Write the state after batch ``upto`` as the new starting point of readers.

        ``upto`` must be the last batch written.
        """
        self.read(table, columns, pk).write.mode("overwrite").parquet(
            f"{self.root}/base/{table}/upto={upto}"
        )

    def vacuum(self, tables: list[str]) -> None:
        """Remove all but the last two states of each table, and the changes that the older
        of the two has taken in for every table. So a reader may be one state behind."""
        floors = []
        for table in tables:
            bases = self._finished(f"base/{table}", "upto")
            kept = sorted(bases)[-2:]
            floors.append(kept[0] if len(kept) == 2 else -1)
            for number in set(bases) - set(kept):
                remove_dir(self.spark, bases[number])
        floor = min(floors, default=-1)
        for number, path in self._finished("changes", "batch").items():
            if number <= floor:
                remove_dir(self.spark, path)

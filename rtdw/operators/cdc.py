"""Change records: normalising, filtering and folding to current tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from rtdw.schemas import CHANGE

# Operation codes of change records and their names.
OPERATIONS = {"c": "insert", "create": "insert", "u": "update", "d": "delete", "r": "read"}


def normalise(raw: DataFrame) -> DataFrame:
    """Raw records (topic, op, before, after, seq) to the common envelope.

    The topic is ``server.database.table``. An absent row image becomes an empty
    map, ``create`` becomes ``insert``, a snapshot row stays ``read``.
    """
    parts = F.split("topic", r"\.")
    op = F.lower("op")
    kind = F.coalesce(
        *[F.when(op == code, name) for code, name in OPERATIONS.items()], op
    )
    empty = F.expr("cast(map() as map<string,string>)")
    return raw.select(
        parts[1].alias("database"),
        parts[2].alias("tableName"),
        F.coalesce("before", empty).alias("before"),
        F.coalesce("after", empty).alias("after"),
        kind.alias("type"),
        F.col("seq"),
    )


def drop_deletes(changes: DataFrame) -> DataFrame:
    """All changes but deletes; a missing type passes."""
    return changes.where(~F.col("type").eqNullSafe("delete"))


def row_key(pk: str = "id") -> Column:
    """The primary key of a change; a delete carries it in ``before`` only."""
    return F.coalesce(F.col("after")[pk], F.col("before")[pk])


def newest(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The last row per key. The rank filter also runs before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def fold(changes: DataFrame, pk: str = "id", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Current rows of a changed table: the newest change per key unless it is a delete."""
    keyed = changes.withColumn("__key", row_key(pk))
    last = newest(keyed, ["tableName", "__key"], list(order))
    return last.where(~F.col("type").eqNullSafe("delete")).drop("__key")


def typed_rows(changes: DataFrame, schema: T.StructType) -> DataFrame:
    """The ``after`` image as typed columns."""
    return changes.select(
        *[
            F.expr(f"cast(after['{f.name}'] as {f.dataType.simpleString()}) as {f.name}")
            for f in schema
        ]
    )


def snapshot_as_changes(
    snapshot: DataFrame, database: str, table: str, seq: int = -1
) -> DataFrame:
    """Stored rows as ``read`` changes that precede every logged change."""
    image = F.create_map(
        *[x for c in snapshot.columns for x in (F.lit(c), F.col(c).cast("string"))]
    )
    empty = F.expr("cast(map() as map<string,string>)")
    return snapshot.select(
        F.lit(database).alias("database"),
        F.lit(table).alias("tableName"),
        empty.alias("before"),
        image.alias("after"),
        F.lit("read").alias("type"),
        F.lit(seq).cast("bigint").alias("seq"),
    )


def snapshot_plus_changes(
    snapshot: DataFrame, changes: DataFrame, database: str, table: str, pk: str = "id"
) -> DataFrame:
    """Initial snapshot and the changes after it, folded to the current table."""
    columns = CHANGE.fieldNames()
    both = snapshot_as_changes(snapshot, database, table).select(*columns).unionByName(
        changes.where(F.col("tableName") == table).select(*columns)
    )
    return fold(both, pk)


def upsert(current: DataFrame, changes: DataFrame, pk: str = "id", order: str = "seq") -> DataFrame:
    """Stored text rows overwritten, column by column, by the newest non-delete change.

    A change only touches the columns its ``after`` image names, so an update
    that carries fewer columns than the insert before it leaves the rest alone.
    """
    columns = [c for c in current.columns if c != pk]
    after = F.col("after")
    images = drop_deletes(changes).withColumn(pk, after[pk]).where(F.col(pk).isNotNull())
    latest = images.groupBy(pk).agg(
        *[
            F.struct(
                F.max(F.map_contains_key(after, c)).alias("named"),
                F.max_by(
                    after[c], F.when(F.map_contains_key(after, c), F.col(order))
                ).alias("value"),
            ).alias(c)
            for c in columns
        ]
    )
    a, b = current.alias("a"), latest.alias("b")
    merged = [
        F.when(F.col(f"b.{c}.named"), F.col(f"b.{c}.value")).otherwise(F.col(f"a.{c}")).alias(c)
        for c in columns
    ]
    key = F.coalesce(F.col(f"a.{pk}"), F.col(f"b.{pk}")).alias(pk)
    return (
        a.join(b, F.col(f"a.{pk}") == F.col(f"b.{pk}"), "full_outer")
        .select(key, *merged)
        .select(*current.columns)
    )

"""A changed table as a stream of retracted and added rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rtdw.operators.cdc import row_key
from rtdw.schemas import TEXT_MAP

# Kinds of changelog rows.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


class LastRow(StatefulProcessor):
    """Keeps the newest change of a row and reports how the row changes.

    A change whose ``seq`` is not above the newest one's is repeated or late and changes
    nothing. A deleted row keeps its ``seq``, so that late changes do not bring it back.
    """

    COLUMNS = ("kind", "tableName", "key", "row", "seq")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "row string, seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        row, seq = self.last.get() if self.last.exists() else (None, None)
        changes = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        out = []
        for new, gone, at in zip(changes["row"], changes["gone"], changes["seq"], strict=True):
            if seq is not None and at <= seq:
                continue
            new = None if gone or pd.isna(new) else new
            if row is not None:
                out.append((UPDATE_BEFORE if new is not None else DELETE, row, at))
            if new is not None:
                out.append((UPDATE_AFTER if row is not None else INSERT, new, at))
            row, seq = new, int(at)
        if seq is not None:
            self.last.update((row, seq))
        if out:
            kinds, images, seqs = zip(*out, strict=True)
            yield pd.DataFrame({
                "kind": kinds, "tableName": key[0], "key": key[1], "row": images, "seq": seqs
            })[list(self.COLUMNS)]

    def close(self) -> None:
        pass


def changelog(changes: DataFrame, pk: str = "id") -> DataFrame:
    """A stream of changes as rows (kind, tableName, key, after, seq) to add or to retract.

    ``+I`` adds a new row, ``-U`` and ``+U`` replace one, ``-D`` takes one away; a retracted row
    is the one that was added. Repeated changes give nothing, and so do changes that come
    after a newer one of their row. State is one row per key; changes without a key are left out.
    """
    keyed = changes.select(
        "tableName", row_key(pk).alias("key"), F.to_json("after").alias("row"),
        F.col("type").eqNullSafe("delete").alias("gone"), "seq",
    ).where("key is not null and seq is not null")
    out = keyed.groupBy("tableName", "key").transformWithStateInPandas(
        statefulProcessor=LastRow(),
        outputStructType="kind string, tableName string, key string, row string, seq bigint",
        outputMode="append",
        timeMode="none",
    )
    return out.withColumn("after", F.from_json("row", TEXT_MAP)).drop("row")


def fold_changelog(log: DataFrame) -> DataFrame:
    """The rows (tableName, key, after) that are added more often than they are retracted.

    It does not depend on the order of the changelog.
    """
    sign = F.when(F.col("kind").isin(INSERT, UPDATE_AFTER), 1).otherwise(-1)
    image = F.to_json("after").alias("row")
    counted = log.select("tableName", "key", image, sign.alias("sign")).groupBy("tableName", "key", "row")
    live = counted.agg(F.sum("sign").alias("times")).where("times > 0")
    return live.select("tableName", "key", F.from_json("row", TEXT_MAP).alias("after"))

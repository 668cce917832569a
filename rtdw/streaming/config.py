"""The routing config as state of a stream: records wait for the config that they need."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rtdw.functions.times import duration_ms
from rtdw.operators.routing import DIM_SINK, FACT_SINK, config_rows, keep_columns
from rtdw.schemas import TEXT_MAP

#: Parts that the records of one table and operation are spread over.
PARTS = 16

#: Records of a part that are held in memory; more wait in the state.
HELD = 20_000


class Routing(StatefulProcessor):
    """Keeps the newest config row of a table and operation, and the records before the first.

    Within a micro-batch config rows count before records.
    """

    CONFIG = ("sink_type", "sink_table", "sink_columns", "sink_pk")
    RECORD = ("database", "seq", "after")
    OUT = ("database", "tableName", "type", "seq", *CONFIG, "after")

    def __init__(self, wait_ms: int | None) -> None:
        self.wait = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.config = handle.getValueState("config", "seq bigint, sink_type string, sink_table string, "
                                           "sink_columns string, sink_pk string")
        self.waiting = handle.getListState(
            "waiting", "database string, seq bigint, after string", ttlDurationMs=self.wait
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, held, size = self.config.get() if self.config.exists() else None, [], 0
        for batch in rows:
            changes = batch[batch["is_config"]].sort_values("seq", kind="stable").tail(1)
            if len(changes):
                new = changes.iloc[0]
                if known is None or int(new["seq"]) >= known[0]:
                    known = (int(new["seq"]), *(new[c] for c in self.CONFIG))
                    self.config.update(known)
            records = batch.loc[~batch["is_config"], list(self.RECORD)]
            if len(records):
                held.append(records)
                size += len(records)
            if size >= HELD:  # the newest config may still come
                self._wait(held)
                held, size = [], 0
        if known is None:
            self._wait(held)
            return
        early = self._early() if self.waiting.exists() else iter(())
        for records in itertools.chain(early, held):
            if known[1] in (FACT_SINK, DIM_SINK):
                own = {"tableName": key[0], "type": key[1], **dict(zip(self.CONFIG, known[1:], strict=True))}
                yield records.assign(**own)[list(self.OUT)]
        if self.waiting.exists():
            self.waiting.clear()

    def _wait(self, held: list[pd.DataFrame]) -> None:
        for records in held:
            rows = records.astype(object).where(records.notna(), None)
            self.waiting.appendList(list(rows.itertuples(index=False, name=None)))

    def _early(self) -> Iterator[pd.DataFrame]:
        """The waiting records, some thousands at a time."""
        waiting = self.waiting.get()
        while some := list(itertools.islice(waiting, HELD)):
            yield pd.DataFrame(some, columns=list(self.RECORD))

    def close(self) -> None:
        pass


def route_with_state(
    changes: DataFrame, config_changes: DataFrame, parts: int = PARTS, wait: str | None = None
) -> DataFrame:
    """Streams of changes and of config changes to routed changes, as ``routing.route`` gives them.

    A record goes by the newest config row (highest ``seq``) that has arrived. Records that
    come before the first config row of their table and operation wait for it, ``wait`` at most
    (default: for good), and leave once it is there. A deleted config row stays in force. The
    records of a table are spread over ``parts``, each with the config of its own.
    """
    empty = "cast(null as string)"
    # Names say how a row of either stream fills the common columns.
    config = config_rows(config_changes).selectExpr(
        "source_table as tableName", "operate_type as type", f"explode(sequence(0, {parts - 1})) as part",
        "true as is_config", "seq", f"{empty} as database", f"{empty} as after", *Routing.CONFIG,
    )
    records = changes.selectExpr(
        "tableName", "type", f"cast(pmod(xxhash64(seq, to_json(after)), {parts}) as int) as part",
        "false as is_config", "seq", "database", "to_json(after) as after",
        *[f"{empty} as {c}" for c in Routing.CONFIG],
    ).where("tableName is not null and type is not null")
    routed = records.unionByName(config).groupBy("tableName", "type", "part").transformWithStateInPandas(
        statefulProcessor=Routing(duration_ms(wait) if wait else None),
        outputStructType="database string, tableName string, type string, seq bigint, sink_type string, "
        "sink_table string, sink_columns string, sink_pk string, after string",
        outputMode="append",
        timeMode="processingTime" if wait else "none",
    )
    return routed.withColumn("after", F.from_json("after", TEXT_MAP)).withColumn(
        "after", keep_columns("after", "sink_columns")
    ).drop("sink_columns")

"""Daily unique visits on a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rtdw.functions.times import duration_ms
from rtdw.operators.visits import LAST_PAGE, MID, visit_condition
from rtdw.streaming.keyed import DEVICE_PARTS


def unique_visits(
    pages: DataFrame,
    mid: str = MID,
    ts: str = "ts",
    visits: str = "non_entry",
    last_page: str = LAST_PAGE,
    lateness: str = "2 seconds",
    parts: int = 16,
) -> DataFrame:
    """The first counted row to arrive per device and day of the session's time zone.

    The watermark runs on the days, one day behind plus ``lateness``, so a day's
    state goes when it can get no more rows. Rows are first reduced within
    ``parts`` parts of a device and day, so a busy device is spread over tasks.
    """
    time = F.timestamp_millis(F.col(ts))
    dated = (
        pages.where(visit_condition(visits, last_page))
        .withColumn("__day", F.date_trunc("DAY", time))
        .withWatermark("__day", f"1 day {lateness}")
        .withColumn("__mid", F.col(mid))
        .withColumn("__part", F.pmod(F.xxhash64(F.col(ts), F.col(mid)), F.lit(parts)))
    )
    once = dated.dropDuplicates(["__mid", "__day", "__part"])
    return once.dropDuplicates(["__mid", "__day"]).drop("__mid", "__day", "__part")


class DailyVisit(StatefulProcessor):
    """Keeps a device's last counted day for some time after it was written.

    A key of the state is a part of the devices, with an entry per device that expires by
    itself: handing over the rows of a key takes as long as many rows.
    """

    def __init__(self, ttl_ms: int) -> None:
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "mid string", "day string", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = pd.DataFrame()
        for batch in rows:  # no more than a row a device and day is held
            both = pd.concat([first, batch], ignore_index=True)
            first = both.sort_values(["at", "tie"]).drop_duplicates(["mid", "day"])
        if not len(first):
            return
        newest = first.groupby("mid")["day"].max()
        last = {}
        if self.last.exists():
            found = ((mid, self.last.getValue((mid,))) for mid in newest.index)
            last = {mid: value[0] for mid, value in found if value is not None}
        new = first[first["day"] > first["mid"].map(last).fillna("")].sort_values(["mid", "day"])
        for mid, day in newest.items():
            if day > last.get(mid, ""):
                self.last.updateValue((mid,), (day,))
        if len(new):
            yield new[["mid", "day", "value"]]

    def close(self) -> None:
        pass


def unique_visits_with_expiry(
    pages: DataFrame,
    ttl: str = "1 day",
    mid: str = MID,
    ts: str = "ts",
    value: str = "value",
    visits: str = "non_entry",
    last_page: str = LAST_PAGE,
    parts: int = DEVICE_PARTS,
) -> DataFrame:
    """(mid, day, value) of the first counted row per device and day, days of a device ascending.

    State is one day per device, dealt by hash to ``parts``, and goes ``ttl`` (processing time)
    after it was last written, with or without new input of the device; no watermark is needed.
    A device that comes back later is counted anew. Within a micro-batch "first" follows event
    time.
    """
    rows = pages.where(visit_condition(visits, last_page)).select(
        F.col(mid).cast("string").alias("mid"), F.col(ts).alias("at"), F.xxhash64(F.col(value)).alias("tie"),
        F.date_format(F.timestamp_millis(F.col(ts)), "yyyy-MM-dd").alias("day"), F.col(value).alias("value"),
    )
    dealt = rows.where("mid is not null and day is not null").withColumn("part", F.pmod(F.xxhash64("mid"), F.lit(parts)))
    return dealt.groupBy("part").transformWithStateInPandas(
        statefulProcessor=DailyVisit(duration_ms(ttl)),
        outputStructType="mid string, day string, value string",
        outputMode="append",
        timeMode="processingTime",
    )


def stored_state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """What a stopped query holds in a state variable: its keys and values."""
    reader = spark.read.format("statestore").option("stateVarName", variable)
    return reader.load(checkpoint)

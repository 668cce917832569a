"""The two per-device rules and the word counts that need state of their own on a stream.

All hand a group's rows over in Arrow batches and hold no more of a group in
memory than the rule needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rtdw.functions.times import duration_ms

# Settings of the state. The keyed rules need this store; it keeps
# large state out of the heap and with a changelog uploads only what changed.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: Parts that all devices are dealt to where a device needs one entry of the state.
DEVICE_PARTS = 1024


class FirstFlag(StatefulProcessor):
    """Sets the flag of every row to '0' but the first of its device, ever.

    A key of the state is a part of the devices, with an entry per device seen: handing over
    the rows of a key takes as long as many rows, so those of a part come together. Of the
    rows of a micro-batch one per device is held.
    """

    def __init__(self, mid: str, kind: str, flag: str, order: list[str], columns: list[str]) -> None:
        self.mid, self.kind, self.flag, self.order, self.columns = mid, kind, flag, order, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", f"mid {self.kind}", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            batch = batch[self.columns]
            if first is not None:
                batch = pd.concat([first, batch])
            batch = batch.sort_values(
                self.order, kind="stable", ignore_index=True, na_position="first"
            )
            later = batch.duplicated(self.mid)
            first = batch[~later]
            if later.any():
                yield batch[later].assign(**{self.flag: "0"})
        if first is None:
            return
        devices = [(None if pd.isna(mid) else mid,) for mid in first[self.mid].tolist()]
        any_seen = self.seen.exists()
        known = [any_seen and self.seen.containsKey(device) for device in devices]
        for device, is_known in zip(devices, known, strict=True):
            if not is_known:
                self.seen.updateValue(device, (True,))
        yield first.assign(**{self.flag: first[self.flag].mask(known, "0")})

    def close(self) -> None:
        pass


def first_flags(
    flagged: DataFrame,
    mid: str = "mid",
    is_new: str = "is_new",
    order: tuple[str, ...] = ("ts", "value"),
    parts: int = DEVICE_PARTS,
) -> DataFrame:
    """Rows flagged as new visitors with the flag kept on the first of each device only.

    "First" is by ``order`` within a micro-batch and by arrival between them. The
    state is one entry per device, dealt by hash to ``parts``, and never expires, as the
    rule demands.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flagged.schema)
    rule = FirstFlag(mid, flagged.schema[mid].dataType.simpleString(), is_new, list(order), flagged.columns)
    dealt = flagged.withColumn("__part", F.pmod(F.xxhash64(mid), F.lit(parts)))
    return dealt.groupBy("__part").transformWithStateInPandas(
        statefulProcessor=rule,
        outputStructType=columns,
        outputMode="append",
        timeMode="none",
    )


def fix_new_visitor(
    log: DataFrame,
    mid: str = "mid",
    is_new: str = "is_new",
    order: tuple[str, ...] = ("ts", "value"),
) -> DataFrame:
    """Streaming form of the new-visitor correction.

    Only flagged rows are shuffled and touch state; all others pass by.
    """
    fixed = first_flags(log.where(f"{is_new} = '1'"), mid, is_new, order)
    return fixed.unionByName(log.where(f"{is_new} is distinct from '1'"))


#: Parts that the devices of a time slice are dealt to; a part is one key of the state.
PARTS = 256


class EntryTimeout(StatefulProcessor):
    """Reports entry rows whose next row is an entry or does not come in time.

    Rows wait until the watermark has passed their timeout, then their order is
    final and they go, whatever their kind: a timer is set for the oldest row
    held. So state holds the rows of one time slice and a part of the devices, of one timeout
    plus the lateness, and the text of entry rows only. Rows that belong to the slice after
    this one (``own`` is false) only tell what follows. A call of the state takes as long as
    many rows, so all devices of a part are looked at together.
    """

    COLUMNS = ("ts", "tie", "entry", "value", "own", "mid")

    def __init__(self, timeout_ms: int) -> None:
        self.timeout = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState(
            "waiting", "ts bigint, tie string, entry boolean, value string, own boolean, mid string"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        oldest = None
        for batch in rows:
            if "own" not in batch:  # a device that is not cut into slices
                batch = batch.assign(own=True, mid=key[0])
            held = batch[list(self.COLUMNS)].astype({"ts": "int64", "entry": "bool", "own": "bool"})
            held["value"] = held["value"].where(held["entry"] & held["own"], None)
            self.waiting.appendList(self._state_rows(held))
            low = int(held["ts"].min())
            oldest = low if oldest is None else min(oldest, low)
        if oldest is not None:
            self.handle.registerTimer(oldest + self.timeout)
        return iter([])

    def _state_rows(self, rows: pd.DataFrame) -> list[tuple]:
        rows = rows[list(self.COLUMNS)].astype(object)
        return list(rows.where(rows.notna(), None).itertuples(index=False, name=None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        rows = pd.DataFrame(list(self.waiting.get()), columns=list(self.COLUMNS))
        rows["device"] = pd.factorize(rows["mid"])[0]
        rows = rows.sort_values(["device", "ts", "tie"], kind="stable", ignore_index=True)
        following = rows.shift(-1)
        last = following["device"] != rows["device"]
        alone = last | (following["ts"] - rows["ts"] >= self.timeout) | following["entry"].eq(True)
        done = rows["ts"] + self.timeout <= watermark
        kept = rows[~done]
        if len(kept):
            self.waiting.put(self._state_rows(kept))
            self.handle.registerTimer(int(kept["ts"].min()) + self.timeout)
        elif len(rows):
            self.waiting.clear()
        reported = rows[done & rows["entry"].astype(bool) & rows["own"].astype(bool) & alone]
        if len(reported):
            yield reported[["mid", "ts", "value"]]

    def close(self) -> None:
        pass


def bounces(
    pages: DataFrame,
    timeout: str = "10 seconds",
    lateness: str = "2 seconds",
    slice_length: str | None = None,
    parts: int = PARTS,
) -> DataFrame:
    """Streaming form of the bounce rule.

    ``pages`` has mid, ts (millis), entry, tie (orders rows of equal ``ts``) and
    value; the result has mid, ts and value of the bounced entries. Rows without ``ts`` have
    no place in the order and are left out, as in the stored form.

    State is kept by time slice (default 30 timeouts) and part of the devices, dealt by hash to
    ``parts``, so a device with very many rows is spread over tasks. The rows of the first ``timeout`` of a slice also go to the
    slice before it, which is all that its last rows can need; each row is reported by
    the slice that it lies in.
    """
    gap = duration_ms(timeout)
    length = duration_ms(slice_length) if slice_length else 30 * gap
    if length < gap:
        raise ValueError("a time slice must not be shorter than the timeout")
    own = F.floor(F.col("ts") / length)
    seen_by = F.when(F.col("ts") - own * length < gap, F.array(own, own - 1)).otherwise(F.array(own))
    return (
        pages.where("ts is not null")
        .selectExpr(
            "mid", "ts", "cast(tie as string) as tie", "entry", "value",
            "timestamp_millis(ts) as rt",
        )
        .withWatermark("rt", lateness)
        .withColumns({"own": own, "slice": F.explode(seen_by)})
        .withColumn("own", F.expr("own = slice"))
        .withColumn("part", F.pmod(F.xxhash64("mid"), F.lit(parts)))
        .groupBy("slice", "part")
        .transformWithStateInPandas(
            statefulProcessor=EntryTimeout(gap),
            outputStructType="mid string, ts bigint, value string",
            outputMode="append",
            timeMode="eventTime",
        )
    )


#: Parts that the words of a window are dealt to; a part is one key of the state.
WORD_PARTS = 8
#: Words counted together before they are shuffled, or those of one text if it has more.
COUNTED_WORDS = 1 << 19


def _packed(words: list[str], counts: np.ndarray) -> tuple[bytes, bytes]:
    """Words and how often each came, as bytes; words hold letters and digits only."""
    return "\n".join(words).encode(), counts.astype(np.int64).tobytes()


def _unpacked(words: bytes, counts: bytes) -> tuple[list[str], np.ndarray]:
    return bytes(words).decode().split("\n"), np.frombuffer(counts, np.int64)


def _added(packed: Iterator[tuple[bytes, bytes]]) -> tuple[list[str], np.ndarray]:
    """The sums of several packed counts; only one of them is held beside the sums."""
    total: dict[str, int] = {}
    for words, counts in packed:
        for word, count in zip(*_unpacked(words, counts), strict=True):
            total[word] = total.get(word, 0) + count
    return list(total), np.fromiter(total.values(), np.int64, len(total))


class WordCounts(StatefulProcessor):
    """Adds up the counts of a window's words, and reports them once the watermark has passed its end.

    Nearly each word of a window may be a new one, and an entry of the state takes as long as
    many rows, so the words of a part are kept together: a micro-batch adds one entry with its
    words and how often each came. The entries are added up when the window closes.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counted = handle.getListState("counted", "words binary, counts binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        packed = (pair for batch in rows for pair in zip(batch["words"], batch["counts"], strict=True))
        words, counts = _added(packed)
        if words:
            self.counted.appendValue(_packed(words, counts))
            self.handle.registerTimer(-(-int(key[1]) // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        entries = self.counted.get()
        words, counts = next(entries)
        more = next(entries, None)
        if more is not None:
            words, counts = _packed(*_added(chain([(words, counts), more], entries)))
        self.counted.clear()
        yield pd.DataFrame({
            "opens": [key[0]], "closes": [key[1]], "words": [bytes(words).decode()], "counts": [np.frombuffer(counts, np.int64)],
        })

    def close(self) -> None:
        pass


def _counted_batch(batch: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """A row for each window and part of its words: opens, closes, part, at, words, counts."""
    own = pc.list_parent_indices(batch.column("words"))
    rows = pa.table({
        **{c: batch.column(c).take(own) for c in ("opens", "closes", "at")}, "word": pc.list_flatten(batch.column("words")),
    })
    rows = rows.group_by(["opens", "closes", "word"]).aggregate([([], "count_all"), ("at", "max")])
    word = rows["word"].to_numpy()
    opens, closes, at, count = (rows[c].to_numpy() for c in ("opens", "closes", "at_max", "count_all"))
    part = (pd.util.hash_array(word, categorize=False) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((part, opens))
    word, opens, closes, at, count, part = (x[order] for x in (word, opens, closes, at, count, part))
    first = np.flatnonzero(np.append(True, (opens[1:] != opens[:-1]) | (part[1:] != part[:-1])) if len(opens) else [])
    ends = np.append(first[1:], len(opens)).tolist() if len(first) else []
    packed = [_packed(word[a:b].tolist(), count[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
    latest = np.maximum.reduceat(at, first) if len(first) else at
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array(x, pa.int64()) for x in (opens[first], closes[first], part[first], latest)),
            *(pa.array([pair[k] for pair in packed], pa.binary()) for k in (0, 1)),
        ],
        ["opens", "closes", "part", "at", "words", "counts"],
    )


def word_counts(
    texts: DataFrame, time: str, words: str, width: str, lateness: str, parts: int = WORD_PARTS
) -> DataFrame:
    """Streaming form of counting by window and word: ``opens`` and ``closes`` (timestamps) of a
    window, and ``counted``, an array of (word, ct) for each part of its words.

    ``texts`` has a time and an array of words. Those of a batch of rows are counted before they
    are shuffled. State is kept by window and part of its words, dealt by hash to ``parts``, so
    a busy window is spread over tasks; rows that come after their window has closed are dropped.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, first = batch.column("words").offsets.to_numpy(), 0
            while first < len(batch):
                last = int(np.searchsorted(offsets, offsets[first] + COUNTED_WORDS, "right")) - 1
                last = min(max(last, first + 1), len(batch))
                yield _counted_batch(batch.slice(first, last - first), parts)
                first = last

    window = F.window(time, width, width)
    counted = (
        texts.where(F.col(time).isNotNull())
        .select(
            F.unix_micros(window["start"]).alias("opens"), F.unix_micros(window["end"]).alias("closes"),
            F.unix_micros(time).alias("at"), F.col(words).alias("words"),
        )
        .mapInArrow(count, "opens bigint, closes bigint, part bigint, at bigint, words binary, counts binary")
        .withColumn("at", F.timestamp_micros("at"))
        .withWatermark("at", lateness)
        # The end of the window carries the watermark, by which late rows are known.
        .withColumn("window", F.window("at", width, width))
        .select("opens", "closes", "part", "words", "counts", F.window_time("window").alias("until"))
    )
    added = counted.groupBy("opens", "closes", "part").transformWithStateInPandas(
        statefulProcessor=WordCounts(),
        outputStructType="opens bigint, closes bigint, words string, counts array<bigint>",
        outputMode="append",
        timeMode="eventTime",
    )
    return added.select(
        F.timestamp_micros("opens").alias("opens"), F.timestamp_micros("closes").alias("closes"),
        F.arrays_zip(F.split("words", "\n").alias("word"), F.col("counts").alias("ct")).alias("counted"),
    )

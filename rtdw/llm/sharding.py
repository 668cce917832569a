"""Sharding by sampled splitters: near-equal sizes, equal keys together, any number of rows.

A sample of keys is drawn, each row with a chance in proportion to its size, and its
quantiles split the order of the keys into ranges. A key that several quantiles fall into
makes an overfull range; that is subdivided by the rows' own hashes. So no range holds much
more than its share, whatever one key holds, and each range is summed and numbered by itself.

The exact sizes of the ranges then tell where each row begins in the order of all keys, and
the order is cut into shards where their equal share is reached. Keys of a noticeable part
of a shard are dealt first, the largest to the emptiest shard; the others fill all shards
up to one level. Keys of more than ``WHOLE`` of a shard are cut between rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.tables import extended, stored, table

SHARDS = 24
#: Ranges for each shard at least, the rows that a range should hold, and the samples of a range.
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 1_000_000
SAMPLES_PER_RANGE = 20
#: Keys of more than this part of a shard are dealt by themselves, or are subdivided.
PART = 0.01
WHOLE = 0.25
DRAWS = 1 << 30


def splitters(sample: pa.Table, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Where ranges begin, but for the first: keys and tie values, ascending.

    ``sample``: key, tie and how often they are drawn. A range begins with a key as a whole,
    unless the key has several quantiles, and is subdivided at the ties of the later ones.
    """
    key, tie, drawn = (sample.column(c).to_numpy() for c in ("key", "tie", "drawn"))
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.lexsort((tie, key))
    ends = np.cumsum(drawn[order])
    at = order[np.unique(np.searchsorted(ends, np.arange(1, ranges) * ends[-1] // ranges, "right"))]
    keys, ties = key[at], tie[at]
    ties[np.append(True, keys[1:] != keys[:-1])] = np.iinfo(np.int64).min
    own = np.unique(np.column_stack([keys, ties]), axis=0)
    return own[:, 0], own[:, 1]


def in_ranges(rows: DataFrame, keys: np.ndarray, ties: np.ndarray) -> DataFrame:
    """The rows (with key and tie) and the number of their range, ``range``."""
    schema = extended(rows.schema, "range int")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tie = (batch.column(c).to_numpy() for c in ("key", "tie"))
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            out = high.astype(np.int32)
            inside = np.flatnonzero(low < high)
            for first in np.unique(low[inside]).tolist():
                rows_ = inside[low[inside] == first]
                last = int(high[rows_[0]])
                out[rows_] = first + np.searchsorted(ties[first:last], tie[rows_], "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], schema.names)

    return rows.mapInArrow(find, schema)


def levels(heavy: list[tuple], light: int, shards: int) -> tuple[list[int], list[int]]:
    """The shard of each heavy unit, and how much of the light rows lies before each shard.

    ``heavy``: (name, size). The largest goes to the emptiest shard, and light rows fill the
    shards up to one level as far as heavy ones do not stand above it.
    """
    full = [(0, shard) for shard in range(shards)]
    dealt, held = [0] * len(heavy), [0] * shards
    for at in sorted(range(len(heavy)), key=lambda i: (-heavy[i][1], heavy[i][0])):
        size = heavy[at][1]
        now, shard = heapq.heappop(full)
        dealt[at] = shard
        held[shard] = now + size
        heapq.heappush(full, (held[shard], shard))
    order, level = sorted(held), 0.0
    for n in range(1, shards + 1):  # the n least full ones are filled up
        level = (light + sum(order[:n])) / n
        if n == shards or level <= order[n]:
            break
    room = np.maximum(level - np.array(held, float), 0)
    before = np.floor(np.concatenate([[0], np.cumsum(room)[:-1]]) + 0.5)
    return dealt, [int(x) for x in before]


def shard_rows(rows: DataFrame, key: Column, size: Column, tie: Column, shards: int = SHARDS) -> DataFrame:
    """The rows with ``shard`` (from 0) and ``slot`` (gapless from 0 within the shard).

    Shards are near equal in the sum of ``size`` (not negative). Rows of one ``key`` (long,
    not null) stay in one shard unless they make more than ``WHOLE`` of it or more rows than
    a range. ``tie`` (long, not null) orders rows of one key; what is left equal is told apart by where
    it stands in the input. An empty frame gives no rows.
    """
    own = F.struct(*(rows[c] for c in rows.columns))
    slim = stored(rows.select(
        own.alias("row"), key.cast("long").alias("key"), size.cast("long").alias("size"), tie.cast("long").alias("tie"),
        F.monotonically_increasing_id().alias("id"),
    ), "shard-rows")
    count, total = slim.agg(F.count("*"), F.sum("size")).first()
    total = total or 0
    limit = max(int(total / shards * PART), 1)
    ranges = max(shards * RANGES_PER_SHARD, count // ROWS_PER_RANGE)
    # Sizes and rows count alike, so that a range has neither too many bytes nor too many rows.
    weight = (F.col("size") / F.lit(float(max(total, 1))) + F.lit(1.0 / max(count, 1))) / 2
    chance = weight * F.lit(float(ranges * SAMPLES_PER_RANGE))
    drawn = F.floor(chance + F.pmod(F.xxhash64(F.lit("splitter"), "key", "tie", "id"), F.lit(DRAWS)) / F.lit(float(DRAWS)))
    spread = F.xxhash64("tie", "id")  # where a key is subdivided
    placed = slim.withColumns({"first": F.col("tie"), "tie": spread, "drawn": drawn})
    drawn_rows = placed.filter("drawn > 0").select("key", "tie", "drawn")
    ranged = in_ranges(placed.drop("drawn"), *splitters(drawn_rows.toArrow(), ranges))
    # At most shards / PART keys, as each holds that part of a shard, and as many rows of them.
    keys = slim.groupBy("key").agg(F.sum("size").alias("held")).filter(F.col("held") > limit).collect()
    split = {row["key"] for row in keys if row["held"] > total / shards * WHOLE}
    whole = [(row["key"], row["held"]) for row in keys if row["key"] not in split]
    parted = F.broadcast(slim.sparkSession.createDataFrame([(key,) for key in sorted(split)], "key long"))
    single = slim.filter(F.col("size") > limit).join(parted, "key").select("tie", "id", "size").collect()
    single = [((row["tie"], row["id"]), row["size"]) for row in single]
    heavy = [((key,), held) for key, held in whole] + single
    dealt, before = levels(heavy, total - sum(held for _, held in heavy), shards)
    own_keys = [(key, shard, False) for (key, _), shard in zip(whole, dealt, strict=False)]
    own_keys += [(key, None, True) for key in sorted(split)]
    own_rows = [(id_, shard) for ((_, id_), _), shard in zip(single, dealt[len(whole) :], strict=True)]
    session = rows.sparkSession
    own_keys = F.broadcast(session.createDataFrame(own_keys, "key long, of_key int, split boolean"))
    own_rows = F.broadcast(session.createDataFrame(own_rows, "id long, of_row int"))
    ranged = ranged.join(own_keys, "key", "left").join(own_rows, "id", "left")
    ranged = ranged.withColumn("own", F.coalesce("of_row", "of_key")).drop("of_row", "of_key")
    light = F.when(F.col("own").isNull(), F.col("size")).otherwise(F.lit(0))
    ranged = stored(ranged.withColumn("light", light), "shard-ranges")

    # Sums before each range: one row a range.
    sums = ranged.groupBy("range").agg(F.sum("light").alias("sum"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    order = ["key", "first", "id"]
    so_far = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    together = Window.partitionBy("range", "key")
    running = ranged.withColumn("begin", F.coalesce(F.sum("light").over(so_far), F.lit(0)))
    running = running.withColumn("key_begin", F.min("begin").over(together)).join(sums, "range")
    begin = F.col("base") + F.when(F.col("split"), F.col("begin")).otherwise(F.col("key_begin"))
    bounds = F.array(*(F.lit(x).cast("long") for x in before[1:]))
    cut = F.size(F.filter(bounds, lambda x: x <= begin)) if shards > 1 else F.lit(0)
    assigned = running.withColumn("shard", F.coalesce("own", cut).cast("int"))
    assigned = stored(assigned.select("row", "range", *order, "shard"), "shard-assigned")

    counts = assigned.groupBy("shard", "range").count()
    ahead = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "range", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("ahead"))
    nth = F.row_number().over(Window.partitionBy("range", "shard").orderBy(*order))
    numbered = assigned.withColumn("nth", nth).join(counts, ["range", "shard"])
    return numbered.select("row.*", "shard", (F.col("ahead") + F.col("nth") - 1).alias("slot"))


def document_shards(docs: DataFrame, keep: list[str], text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Kept columns, size (UTF-8 bytes and 8), text_crc32, shard and slot; a null text is empty.

    Documents of equal texts stay together unless they make more than ``WHOLE`` of a shard.
    """
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*(docs[c] for c in keep)).alias("kept"),
        (F.octet_length(own) + 8).cast("long").alias("size"), F.crc32(own.cast("binary")).alias("text_crc32"),
        F.xxhash64(own).alias("text_key"), F.xxhash64(*(docs[c] for c in keep), own).alias("text_tie"),
    )
    out = shard_rows(rows, F.col("text_key"), F.col("size"), F.col("text_tie"), shards)
    return out.select("kept.*", "size", "text_crc32", "shard", "slot")


def write_shards(sharded: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write rows with shard and slot to one folder a shard, files in the order of the slots.

    A shard is written in parts of about ``ROWS_PER_RANGE`` slots, each by one task.
    """
    part = F.floor(F.col("slot") / F.lit(ROWS_PER_RANGE))
    parts = sharded.withColumn("__part", part).repartition("shard", "__part")
    parts.sortWithinPartitions("shard", "__part", "slot").drop("__part").write.partitionBy("shard").format(
        file_format
    ).save(path)


def op12_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal sizes.

    Equal texts make groups. Null texts count as empty; repeated rows are sharded each by
    itself, as are rows without an id; an empty table gives no rows.
    """
    out = document_shards(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

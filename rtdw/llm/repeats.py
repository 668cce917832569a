"""Suffix-array dedup: bytes covered by a long string that begins anywhere else go.

Every window of ``least`` bytes has an anchor, the substring of ``GRAM`` bytes in it with
the least hash (the leftmost of equal ones). Equal windows have equal anchors at equal
places, so only windows of one anchor can be equal. The consecutive windows of an anchor
make a context, the bytes that they cover together.

Contexts that occur twice as a whole repeat all their windows. Of anchors with several
different contexts one copy of each context is fetched, and anchors are dealt to shards of
bounded size. In a shard, interval expansion on the Burrows-Wheeler transform of the
contexts tells which windows begin with a common prefix of at least ``least`` bytes.

An anchor with too many contexts for one shard is made longer. Its windows are parted by the
anchor's place in them, into ranges of ``width`` places; all windows of a range share the
``least - width + 1`` bytes around the anchor, and equal windows agree in their range and in
these bytes, which are the new anchor. ``width`` is halved until no anchor is too large; at
width 1 the anchor is the whole window, and an anchor has one context only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.suffixes import long_repeats
from rtdw.llm.tables import extended, stored, table
from rtdw.llm.words import Texts, lean, mixed, pieces, prefix_sums, union_of_runs

LEAST = 400
GRAM = 64
#: For passages of more than 50 words, as the pipeline's stage removes them. Of all runs of 51
#: words of the sample documents 99.5 % have so many bytes.
PASSAGE_BYTES = 200
PASSAGE_GRAM = 40
#: Bytes of contexts in a shard, and of one anchor's before it is made longer.
SHARD_BYTES = 1 << 20
ANCHOR_BYTES = 4 << 20
#: Windows looked at together; longer texts are taken in overlapping parts.
PART = 4 << 20
PLACE_BITS = 24


def window_anchors(data: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor's place of each window of the bytes, and the anchors' hashes by place."""
    sums, inverse = prefix_sums(data)
    grams = len(data) - gram + 1
    hashes = mixed((sums[gram:] - sums[:-gram]) * inverse[:grams])
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (hashes & ~low) | np.arange(grams, dtype=np.uint64)
    width, size = least - gram + 1, 1
    while size * 2 <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    rest = width - size
    if rest:
        key = np.minimum(key[:-rest], key[rest:])
    return (key & low).astype(np.int64), hashes


def contexts(texts: Texts, least: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first window, windows, anchor, context) of all contexts, in parts.

    ``anchor`` is a hash of the anchor, ``context`` of the context and the anchor's place in it.
    """
    for first in range(0, max(len(texts.data) - least + 1, 0), PART):
        data = texts.data[first : first + PART + least - 1]
        anchors, hashes = window_anchors(data, least, gram)
        starts = np.arange(len(anchors))
        text = np.searchsorted(texts.offsets, starts + first, "right") - 1
        inside = starts + first + least <= texts.offsets[text + 1]
        starts, text, anchors = starts[inside], text[inside], anchors[inside]
        if not len(starts):
            continue
        new = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])])
        heads = np.flatnonzero(new)
        lows, counts = starts[heads], np.diff(np.append(heads, len(starts)))
        ends = lows + counts - 1 + least
        sums, inverse = prefix_sums(data)
        whole = mixed((sums[ends] - sums[lows]) * inverse[lows])
        shape = (anchors[heads] - lows).astype(np.uint64) << np.uint64(32) | counts.astype(np.uint64)
        yield (
            text[heads], lows + first - texts.offsets[text[heads]], counts,
            hashes[anchors[heads]].view(np.int64), mixed(whole ^ mixed(shape)).view(np.int64),
        )


def context_table(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(anchor, context, k1, k2, starts, windows): each different context of each document
    and the first windows of its occurrences there. ``docs``: k1, k2, text."""
    schema = "anchor long, context long, k1 long, k2 long, starts array<long>, windows int"
    names = ["anchor", "context", "k1", "k2", "starts", "windows"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in pieces(batch, "text"):
                for text, low, counts, anchor, context in contexts(texts, least, gram):
                    order = np.lexsort((low, context, anchor, text))
                    text, low, counts, anchor, context = (
                        x[order] for x in (text, low, counts, anchor, context)
                    )
                    new = np.concatenate([[True], (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])])
                    heads = np.flatnonzero(new)
                    own = pa.array(text[heads])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(anchor[heads]), pa.array(context[heads]),
                        rows.column("k1").take(own), rows.column("k2").take(own),
                        pa.ListArray.from_arrays(pa.array(np.append(heads, len(low)).astype(np.int32)), pa.array(low)),
                        pa.array(counts[heads].astype(np.int32)),
                    ], names)

    return docs.select("k1", "k2", "text").mapInArrow(lean(find), schema)


def fetch_contexts(docs: DataFrame, asked: DataFrame, least: int) -> DataFrame:
    """The asked contexts (anchor, context, k1, k2, start, windows, n) with their ``bytes``."""
    wanted = asked.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("anchor", "context", "start", "windows", "n")).alias("list")
    )
    # The bytes of a text are cut here: a string function would count characters.
    raw = F.encode("text", "UTF-8")
    found = docs.join(wanted, ["k1", "k2"]).select("k1", "k2", raw.alias("raw"), F.explode("list").alias("one"))
    part = F.substring("raw", (F.col("one.start") + 1).cast("int"), F.col("one.windows") + (least - 1))
    return found.select("one.*", "k1", "k2", part.alias("bytes")).dropDuplicates(["anchor", "context"])


def shard_repeats(shards: DataFrame, least: int) -> DataFrame:
    """Spans (k1, k2, low, high) of windows that repeat within their shard.

    ``shards``: shard, k1, k2, start, n, bytes. Contexts known to repeat as a whole
    (n > 1) only serve for comparison.
    """

    def spans(group: list[tuple]) -> Iterator[tuple]:
        sizes = np.array([len(x[4]) for x in group])
        offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
        text = np.zeros(offsets[-1], np.int64)
        for (_, _, _, _, own), at in zip(group, offsets, strict=False):
            text[at : at + len(own)] = np.frombuffer(own, np.uint8).astype(np.int64) + 1
        again = long_repeats(text, least)
        for (k1, k2, start, n, own), at in zip(group, offsets, strict=False):
            if n > 1:
                continue
            hits = np.flatnonzero(again[at : at + len(own) - least + 1])
            for low, high in zip(*union_of_runs(hits, hits + 1), strict=True):
                yield k1, k2, start + int(low), start + int(high) - 1 + least

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "k1", "k2", "start", "n", "bytes")]
            for shard, *row in zip(*columns, strict=True):
                if shard != now:
                    if len(group) > 1:
                        yield _span_batch(list(spans(group)))
                    now, group = shard, []
                group.append(tuple(row))
        if len(group) > 1:
            yield _span_batch(list(spans(group)))

    dealt = shards.repartition("shard").sortWithinPartitions("shard")
    return dealt.select("shard", "k1", "k2", "start", "n", "bytes").mapInArrow(
        lean(compare), "k1 long, k2 long, low long, high long"
    )


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k1", "k2", "low", "high"])


def longer_anchors(found: DataFrame, least: int, gram: int, width: int) -> DataFrame:
    """The contexts cut into parts whose windows have the anchor in one range of ``width`` places.

    ``found``: anchor, context, k1, k2, start, windows, n, bytes; the same columns come out.
    ``anchor`` becomes a hash of the range, of the bytes that all its windows share and of the
    old anchor.
    """
    names = ["anchor", "context", "k1", "k2", "start", "windows", "n", "bytes"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_longer(row, least, gram, width) for row in batch.to_pylist()]
            rows, heads = np.arange(len(out)), [len(part[0]) for part in out]
            own = pa.array(np.repeat(rows, heads))
            anchor, context, start, windows = (
                np.concatenate([part[k] for part in out]) if out else np.zeros(0, np.int64) for k in range(4)
            )
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor), pa.array(context), batch.column("k1").take(own), batch.column("k2").take(own),
                pa.array(start), pa.array(windows.astype(np.int32)), batch.column("n").take(own),
                pa.array([x for part in out for x in part[4]], pa.binary()),
            ], names)

    schema = "anchor long, context long, k1 long, k2 long, start long, windows int, n long, bytes binary"
    return found.select(*names).mapInArrow(lean(cut), schema)


def _longer(row: dict, least: int, gram: int, width: int) -> tuple:
    """Anchors, contexts, starts, numbers of windows and bytes of a context's parts."""
    data = np.frombuffer(row["bytes"], np.uint8)
    place = int(window_anchors(data[:least], least, gram)[0][0])
    ranges = (place - np.arange(row["windows"])) // width
    lows = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
    counts = np.diff(np.append(lows, len(ranges)))
    sums, inverse = prefix_sums(data)

    def hashes(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mixed((sums[high] - sums[low]) * inverse[low])

    each = ranges[lows]
    shared = hashes(place - each * width, place - (each + 1) * width + 1 + least)
    old = np.full(len(each), row["anchor"]).view(np.uint64)
    anchor = mixed(shared ^ mixed(old ^ mixed(each.astype(np.uint64))))
    ends = lows + counts - 1 + least
    shape = (place - lows).astype(np.uint64) << np.uint64(32) | counts.astype(np.uint64)
    context = mixed(hashes(lows, ends) ^ mixed(shape))
    parts = [data[a:b].tobytes() for a, b in zip(lows, ends, strict=True)]
    return anchor.view(np.int64), context.view(np.int64), row["start"] + lows, counts, parts


def compared_contexts(found: DataFrame, least: int, gram: int) -> DataFrame:
    """Spans (k1, k2, low, high) of the windows of contexts that repeat within their anchor.

    ``found``: anchor, context, k1, k2, start, windows, n, bytes, each context once.
    """
    bytes_of = F.sum(F.octet_length("bytes").cast("long"))
    width, done, spans = least - gram + 1, None, None
    while width > 1:
        large = found.groupBy("anchor").agg(bytes_of.alias("size")).filter(F.col("size") > ANCHOR_BYTES)
        large = stored(large.select("anchor"), "large-anchors")
        if not large.limit(1).count():
            break
        width = (width + 1) // 2
        small = found.join(large, "anchor", "left_anti")
        done = small if done is None else done.unionByName(small)
        parts = stored(
            longer_anchors(found.join(large, "anchor", "left_semi"), least, gram, width), "context-parts"
        )
        counted = stored(
            parts.groupBy("anchor", "context").agg(
                F.sum("n").alias("total"), F.first(F.struct("k1", "k2", "start", "windows", "bytes")).alias("one")
            ).select("anchor", "context", F.col("total").alias("n"), "one.*"),
            "part-counts",
        )
        # Parts that come twice as a whole; those of contexts with n > 1 are known already.
        again = parts.filter("n = 1").join(
            counted.filter("n > 1").select("anchor", "context"), ["anchor", "context"]
        ).select("k1", "k2", F.col("start").alias("low"), (F.col("start") + F.col("windows") - 1 + least).alias("high"))
        spans = again if spans is None else spans.unionByName(again)
        several = counted.groupBy("anchor").agg(F.count("*").alias("contexts")).filter("contexts > 1")
        found = stored(counted.join(several.select("anchor"), "anchor", "left_semi"), "context-bytes")
    rest = found if done is None else done.unionByName(found)
    shards = -(-(rest.agg(bytes_of).first()[0] or 1) // SHARD_BYTES)
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    compared = shard_repeats(rest.select("*", shard), least)
    return compared if spans is None else compared.unionByName(spans)


def repeated_spans(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(k1, k2, spans): arrays of byte spans (low, high) that together cover all windows of a
    row that begin anywhere else too.

    ``docs``: k1, k2 (equal for equal rows only) and text without nulls.
    """
    every = stored(context_table(docs, least, gram), "contexts")
    times = F.sum(F.size("starts").cast("long"))
    anchors = every.groupBy("anchor").agg(
        times.alias("times"), (F.min("context") != F.max("context")).alias("several"),
    ).filter("times > 1").drop("times")
    anchors = stored(anchors, "shared-anchors")  # a table, so that large anchors' joins can be split
    shared = stored(every.join(anchors, "anchor"), "shared-contexts")
    grouped = shared.groupBy("anchor", "context", "several").agg(
        times.alias("n"), F.min(F.struct("k1", "k2", F.element_at("starts", 1).alias("start"), "windows")).alias("one")
    )
    grouped = stored(grouped.select("anchor", "context", "several", "n", "one.*"), "context-counts")
    high = F.col("windows") - 1 + least
    copied = shared.join(grouped.filter("n > 1").select("anchor", "context"), ["anchor", "context"]).select(
        "k1", "k2",
        F.transform("starts", lambda low: F.struct(low.alias("low"), (low + high).alias("high"))).alias("spans"),
    )
    asked = grouped.filter("several").drop("several")
    if not asked.limit(1).count():
        return copied
    found = stored(fetch_contexts(docs, asked, least), "context-bytes")
    spans = compared_contexts(found, least, gram)
    return copied.unionByName(spans.select("k1", "k2", F.array(F.struct("low", "high")).alias("spans")))


def without_repeats(docs: DataFrame, keep: list[str], text: str = "text", least: int = LEAST,
                    gram: int = GRAM, characters: bool = False) -> DataFrame:
    """The kept columns with ``n_bytes``, ``spans`` (maximal removed runs) and ``kept`` (bytes).

    Texts are looked at as UTF-8 bytes, each by itself; a null text is an empty one. All
    occurrences of a repeated string go, also in copies of a row. Other columns play no part.
    With ``characters`` what is kept is a text, without the bytes of characters that were cut.
    """
    rows = docs.select(
        *(F.col(c).alias(f"keep_{c}") for c in keep), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumns({
        "k1": F.xxhash64("text"),
        "k2": F.xxhash64(F.lit("row"), *(f"keep_{c}" for c in keep), "text"),
    })
    spans = repeated_spans(rows.select("k1", "k2", "text"), least, gram)
    of_row = spans.groupBy("k1", "k2").agg(F.flatten(F.collect_set("spans")).alias("cut"))
    joined = rows.join(of_row, ["k1", "k2"], "left")
    names = [f"keep_{c}" for c in keep]
    kind_kept = "string" if characters else "binary"
    schema = extended(
        joined.select(*names).schema, f"n_bytes long, spans array<struct<low:long,high:long>>, kept {kind_kept}"
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                spans, kept = [], []
                for row, cut in enumerate(part.column("cut")):
                    data = texts.data[texts.offsets[row] : texts.offsets[row + 1]]
                    if cut.is_valid:
                        fields = cut.values
                        low, high = union_of_runs(fields.field("low").to_numpy(), fields.field("high").to_numpy())
                        gone = np.zeros(len(data), bool)
                        for a, b in zip(low, high, strict=True):
                            gone[a:b] = True
                        kept.append(data[~gone].tobytes())
                        spans.append([{"low": int(a), "high": int(b)} for a, b in zip(low, high, strict=True)])
                    else:
                        kept.append(data.tobytes())
                        spans.append([])
                if characters:
                    kept = [x.decode("utf-8", "ignore") for x in kept]
                kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in names), pa.array(np.diff(texts.offsets)),
                    pa.array(spans, kind), pa.array(kept, pa.string() if characters else pa.binary()),
                ], schema.names)

    out = joined.select(*names, "text", "cut").mapInArrow(lean(remove), schema)
    return out.select(*(F.col(f"keep_{c}").alias(c) for c in keep), "n_bytes", "spans", "kept")


def op8_repeats(spark, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that begin elsewhere too."""
    out = without_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["high"] - x["low"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def trimmed_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of ``PASSAGE_BYTES`` that begin anywhere else too.

    That takes passages of more than 50 words, all their occurrences. n_chars is counted
    anew. A character that loses some of its bytes goes as a whole. No document goes, even if
    nothing is left of its text.
    """
    rest = F.struct(*(docs[c] for c in docs.columns if c != "text"))
    # Decoded where it is cut: a second Python step would hold a second worker for each task.
    out = without_repeats(
        docs.select(rest.alias("rest"), "text"), ["rest"], least=PASSAGE_BYTES, gram=PASSAGE_GRAM, characters=True,
    )
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*(new.get(c, F.col("rest")[c]).alias(c) for c in docs.columns))

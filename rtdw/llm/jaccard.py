"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets verify them.

Documents with the same set of five-word shingles are one set with several copies. Each
set's MinHash values are cut into bands; sets that agree in a whole band share a bucket.
Buckets with the same members are looked at once. A bucket's sets are compared by their
full shingle sets; a large bucket is cut into blocks, and each pair of blocks is a task of
bounded size. A pair that shares several buckets is counted in the first one only.

A task gives back one row for each set with a link: how many documents it is linked with
there, and a set of its group to which links lead. Pairs are never written out, so what is
moved grows with the documents, not with the square of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.components import components
from rtdw.llm.tables import extended, stored, table
from rtdw.llm.words import lean, mixed, pieces, shingles, split_words

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
MOST_HASHES = 128
BLOCK = 256
COLUMNS = 4096


def choose_bands(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows for which a pair at the threshold shares a band with that probability.

    Of the choices with at most so many hashes, the one with the fewest false candidates.
    """
    choices = []
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            wrong = 1 - (1 - (threshold / 2) ** rows) ** bands
            choices.append((wrong, bands, rows))
    return min(choices)[1:]


def _gram_sets(rows: pa.RecordBatch, texts, size: int) -> Iterator[np.ndarray]:
    """The sorted different shingles of each text."""
    hashes, offsets = shingles(split_words(texts), size)
    for i in range(len(rows)):
        yield np.unique(hashes[offsets[i] : offsets[i + 1]])


def sketches(docs: DataFrame, keep: list[str], text: str = "text", size: int = SHINGLE,
             threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Kept columns, ``set`` (16 bytes that equal shingle sets share, null without words),
    ``grams`` (the set's size) and ``bands`` (one hash for each band)."""
    n_bands, n_rows = choose_bands(threshold, recall)
    schema = extended(docs.select(*keep).schema, "set binary, grams int, bands array<long>")
    seeds = mixed(np.arange(1, n_bands * n_rows + 1, dtype=np.uint64))
    second = np.uint64(0xC2B2AE3D27D4EB4F)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in pieces(batch, "__text"):
                sets = list(_gram_sets(rows, texts, size))
                counts = np.array([len(x) for x in sets])
                some = np.flatnonzero(counts)
                names: list[bytes | None] = [None] * len(rows)
                bands: list[np.ndarray | None] = [None] * len(rows)
                if len(some):
                    every = np.concatenate(sets)
                    begins = np.concatenate([[0], np.cumsum(counts[some])])[:-1]
                    low = mixed(np.add.reduceat(every, begins))
                    high = np.add.reduceat(mixed(every ^ second), begins)
                    least = np.empty((len(some), len(seeds)), np.uint64)
                    for k, seed in enumerate(seeds):
                        value = (every ^ seed) * second
                        value ^= value >> np.uint64(29)
                        least[:, k] = np.minimum.reduceat(value, begins)
                    cut = mixed(least).reshape(len(some), n_bands, n_rows)
                    weights = mixed(np.arange(1, n_rows + 1, dtype=np.uint64)) | np.uint64(1)
                    total = (cut * weights).sum(2, dtype=np.uint64)
                    total = mixed(total + seeds[:n_bands]).view(np.int64)
                    for i, a, b, own in zip(some, low, high, total, strict=True):
                        names[i], bands[i] = a.tobytes() + b.tobytes(), own
                values = [
                    pa.array(names, pa.binary()), pa.array(counts.astype(np.int32)),
                    pa.array(bands, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), *values], schema.names)

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(lean(sketch), schema)


def gram_sets(docs: DataFrame, keep: list[str], text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Kept columns and ``hashes``: the sorted shingle hashes of each text, as bytes."""
    schema = extended(docs.select(*keep).schema, "hashes binary")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in pieces(batch, "__text"):
                out = pa.array([x.tobytes() for x in _gram_sets(rows, texts, size)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), out], schema.names)

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(lean(sets), schema)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets share."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    inside = shared[place]
    at, owner = column[place[inside]], owner[inside]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for first in range(0, int(shared.sum()), COLUMNS):
        low, high = np.searchsorted(at, [first, first + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[low:high], at[low:high] - first] = 1
        out += part @ part.T
    return out


def group_links(bucket: int, names: list[bytes], sides: np.ndarray, copies: np.ndarray,
                sets: list[np.ndarray], buckets: list[np.ndarray], threshold: float) -> list[tuple]:
    """(set, a set linked with it directly or through others, linked documents) of a group.

    Sides are 0 and 1 where two blocks meet, whose sets are only compared across, and 2
    where all sets of one block are compared.
    """
    sizes = np.array([len(x) for x in sets], np.float64)
    both = _common(sets).astype(np.float64)
    linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-6
    linked &= np.where(sides[:, None] == 2, True, sides[:, None] != sides[None, :])
    np.fill_diagonal(linked, False)
    earlier = [x[x < bucket] for x in buckets]
    if any(len(x) for x in earlier):
        linked &= _common(earlier) == 0
    counts = linked @ copies
    root = np.arange(len(sets))
    while True:  # the least index that links lead to
        least = np.where(linked, root[None, :], len(sets)).min(1)
        new = np.minimum(root, least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    return [(names[i], names[root[i]], int(counts[i])) for i in np.flatnonzero(counts)]


def links(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, links) of the sets of each group, as ``group_links`` gives them.

    ``members``: bucket, low, high (its blocks), side, set, copies, hashes, buckets.
    """
    keys = ["bucket", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, out = None, [], []

        def close() -> None:
            if len(group) > 1:
                names, sides, copies, sets, buckets = zip(*group, strict=True)
                out.extend(group_links(
                    now[0], list(names), np.array(sides), np.array(copies), list(sets), list(buckets), threshold
                ))
            group.clear()

        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            places = list(zip(*(columns[k].to_pylist() for k in keys), strict=True))
            for row, place in enumerate(places):
                if place != now:
                    close()
                    now = place
                group.append((
                    columns["set"][row].as_py(), columns["side"][row].as_py(), columns["copies"][row].as_py(),
                    np.frombuffer(columns["hashes"][row].as_py(), np.uint64),
                    np.array(columns["buckets"][row].as_py(), np.int64),
                ))
            if len(out) > 10_000:
                yield _links_batch(out)
                out = []
        close()
        yield _links_batch(out)

    dealt = members.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "side", "set", "copies", "hashes", "buckets").mapInArrow(
        lean(compare), "a binary, b binary, links long"
    )


def _links_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = [pa.binary(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "links"]
    )


def near_classes(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD,
                 recall: float = RECALL) -> DataFrame:
    """Per document (doc_id, text): key, doc_id, root, class_id, n_links, class_size, alone.

    Documents are linked if their shingle sets have at least the threshold's Jaccard
    similarity; ``n_links`` counts the other documents linked with one, copies included.
    A class is what links connect: ``root`` is one of its shingle sets, ``class_id`` its
    least doc_id (null if none has one); ``key`` tells rows of different id or text apart. Texts of fewer words than a shingle are one
    shingle. Texts without words (null ones too) are linked with none: ``alone`` is true.
    A link at the threshold is found with the recall as probability, closer ones more surely.
    """
    plain = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    plain = plain.withColumn("key", row_key())
    sketch = stored(sketches(plain, ["key", "doc_id"], "text", size, threshold, recall), "sketches")
    sets = stored(
        sketch.filter("set is not null").groupBy("set").agg(
            F.count("*").alias("copies"), F.min("key").alias("key"), F.any_value("bands").alias("bands")
        ),
        "gram-sets",
    )
    shared = sets.select("set", F.explode("bands").alias("bucket"))
    mark = F.xxhash64("set")
    buckets = (
        shared.groupBy("bucket").agg(
            F.count("*").alias("size"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 20)).alias("s")
        )
        .filter("size > 1")
        .groupBy("size", "x", "s").agg(F.min("bucket").alias("bucket"))
        .select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )
    members = stored(shared.join(buckets, "bucket"), "bucket-members")
    of_set = members.groupBy("set").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    asked = sets.join(of_set, "set").select("set", "copies", "key", "buckets")
    texts = plain.select(F.col("key").alias("of"), "text")
    # Rows of one key are equal; any of them will do.
    found = texts.join(asked, texts["of"] == asked["key"]).dropDuplicates(["key"])
    known = stored(gram_sets(found, ["set", "copies", "buckets"], "text", size), "candidate-sets")
    block = F.pmod(F.xxhash64("set", F.lit("block")), "blocks").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = members.select("set", "bucket", block.alias("own"), other.alias("other")).select(
        "set", "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    found = stored(links(spread.join(known, "set"), threshold), "links")
    roots = components(found.select("a", "b"))
    counts = found.groupBy(F.col("a").alias("set")).agg(F.sum("links").alias("links"))
    of_sets = (
        sets.select("set", "copies").join(counts, "set", "left")
        .join(roots.withColumnRenamed("node", "set"), "set", "left")
        .select(
            "set", F.coalesce("root", "set").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    # Written tables on both sides of the last joins: large classes can then be split.
    classed = stored(sketch.select("key", "doc_id", "set").join(stored(of_sets, "set-classes"), "set"), "classed")
    named = classed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    named = stored(named, "class-names")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    return classed.join(named, "root").select(
        "key", "doc_id", "root", "class_id", "n_links", "class_size", F.lit(False).alias("alone")
    ).unionByName(
        sketch.filter("set is null").select(
            "key", "doc_id", F.col("set").alias("root"), F.col("doc_id").alias("class_id"), zero.alias("n_links"),
            one.alias("class_size"), F.lit(True).alias("alone"),
        )
    )


def row_key() -> F.Column:
    """A string that rows of the same doc_id and text share, and no others."""
    return F.concat_ws(
        "-", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
        F.hex(F.xxhash64(F.coalesce(F.col("text"), F.lit("")))),
    )


def op4_jaccard(spark, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class and number of links."""
    return near_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "class_size"
    )


def near_unique(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: that of the least id, and of repeated rows one."""
    judged = stored(near_classes(docs), "near-classes")
    least = judged.filter("not alone").groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("kept"))
    kept = least.select("kept.key", F.lit(False).alias("alone")).unionByName(
        judged.filter("alone").select("key", "alone").distinct()
    )
    rows = docs.withColumn("__key", row_key())
    joined = rows.join(kept.select(F.col("key").alias("__key"), F.col("alone").alias("__alone")), "__key")
    nth = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    return joined.withColumn("__nth", nth).filter("__alone or __nth = 1").select(*docs.columns)

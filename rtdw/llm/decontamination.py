"""Benchmark decontamination with a distributed positional inverted index.

The index has one row per segment, about two megabytes of text. A segment stores, for
each term, the sorted positions of the term among the segment's words. Each document
begins one position later than the last one's words end, so that no run of positions
crosses documents. A search orders the terms of a phrase by their frequency in the whole
corpus, takes the rarest term's list, moves it by the term's offset in the phrase and
intersects it with the other lists, moved likewise. ``slop`` turns that into a proximity
search: each term may lie so many words from its place.

Segments are bounded by construction and searched one by one, so a phrase that a third of
all documents share makes no task larger than another. Test items are sent to the tasks in
blocks of at most ``BLOCK_BYTES`` of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rtdw.llm.tables import stored, table, text_key
from rtdw.llm.words import lean, pieces, split_words, texts_of, union_of_runs

WINDOW = 10
BLOCK_BYTES = 8 << 20


@dataclass
class Phrases:
    """Phrases of test items: terms and their offsets, rarest first; unused places are -1."""

    items: list[str | None]
    item: np.ndarray
    terms: np.ndarray
    offsets: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, items: list[str | None], texts: list[str | None], window: int) -> Phrases:
        """All windows of the items; an item with fewer words is one window."""
        words = split_words(texts_of(pa.array(texts, pa.string())))
        counts = np.diff(words.offsets)
        runs = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
        item = np.repeat(np.arange(len(items)), runs)
        first = np.concatenate([[0], np.cumsum(runs)])[:-1]
        at = words.offsets[:-1][item] + np.arange(len(item)) - first[item]
        sizes = np.minimum(counts[item], window)
        offsets = np.tile(np.arange(window), (len(item), 1))
        places = np.minimum(at[:, None] + offsets, max(len(words.hashes) - 1, 0))
        terms = words.hashes[places] if len(item) else np.empty((0, window), np.uint64)
        offsets[offsets >= sizes[:, None]] = -1
        return cls(items, item, terms, offsets, sizes)

    def vocabulary(self) -> np.ndarray:
        return np.unique(self.terms[self.offsets >= 0])

    def rarest_first(self, terms: np.ndarray, counts: np.ndarray) -> Phrases:
        """The same phrases, each with its rarest terms in front."""
        place = np.minimum(np.searchsorted(terms, self.terms), max(len(terms) - 1, 0))
        known = terms[place] == self.terms if len(terms) else np.zeros(self.terms.shape, bool)
        seen = np.where(known, counts[place] if len(terms) else 0, 0)
        order = np.argsort(np.where(self.offsets < 0, np.iinfo(np.int64).max, seen), 1, kind="stable")
        pick = lambda values: np.take_along_axis(values, order, 1)
        return Phrases(self.items, self.item, pick(self.terms), pick(self.offsets), self.sizes)


def build_index(docs: DataFrame, key: str = "key", text: str = "text") -> DataFrame:
    """The positional index of whole texts, all their terms: one row per segment.

    ``docs`` holds the segment's documents with their numbers of words, ``starts`` their
    first positions.
    """
    each = F.struct(F.col(key), F.lit(0).cast("long").alias("n_words"))
    packed = "segment long, starts binary, terms binary, ends binary, deltas binary"
    schema = T.StructType.fromDDL(packed).add(docs.select(F.array(each).alias("docs")).schema[0])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, texts in pieces(batch, text):
                words = split_words(texts)
                starts = words.offsets + np.arange(len(words.offsets))
                at = np.arange(len(words.hashes)) + np.repeat(
                    np.arange(len(rows)), np.diff(words.offsets)
                )
                hashes = words.hashes
                order = np.argsort(hashes, kind="stable")
                own, counts = np.unique(hashes[order], return_counts=True)
                deltas = np.diff(at[order].astype(np.int32), prepend=np.int32(0))
                each = pa.StructArray.from_arrays(
                    [rows.column(key), pa.array(np.diff(words.offsets))], [key, "n_words"]
                )
                values = [
                    pa.array([number], pa.int64()),
                    *(
                        pa.array([part.tobytes()], pa.binary())
                        for part in (starts.astype(np.int64), own, np.cumsum(counts), deltas)
                    ),
                    pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), each),
                ]
                yield pa.RecordBatch.from_arrays(values, schema.names)
                number += 1

    return docs.select(key, F.col(text).cast("string").alias(text)).mapInArrow(lean(build), schema)


def term_counts(index: DataFrame, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each of the asked terms (sorted) occurs in the corpus; absent ones are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, ends in zip(batch["terms"], batch["ends"], strict=True):
                found = np.frombuffer(terms.as_py(), np.uint64)
                counts = np.diff(np.frombuffer(ends.as_py(), np.int64), prepend=0)
                mine = np.isin(found, asked, assume_unique=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[mine].view(np.int64)), pa.array(counts[mine])], ["term", "n"]
                )

    counted = index.select("terms", "ends").mapInArrow(lean(count), "term long, n long")
    got = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    terms = got["term"].to_numpy().view(np.uint64)
    order = np.argsort(terms)
    return terms[order], got["n"].to_numpy()[order]


def search_segment(phrases: Phrases, starts: np.ndarray, terms: np.ndarray, ends: np.ndarray,
                   positions: np.ndarray, slop: int) -> Iterator[tuple]:
    """(document, item, first word, word after the last) of each run of matches."""
    if not len(terms) or not len(phrases.item):
        return
    place = np.minimum(np.searchsorted(terms, phrases.terms), len(terms) - 1)
    present = (terms[place] == phrases.terms) | (phrases.offsets < 0)
    begins = np.concatenate([[0], ends[:-1]])
    found: dict[int, list] = {}
    for p in np.flatnonzero(present.all(1)):
        size = phrases.sizes[p]
        lists = [positions[begins[t] : ends[t]] for t in place[p, :size]]
        offsets = phrases.offsets[p, :size]
        at = lists[0] - offsets[0]
        lowest, highest = lists[0], lists[0] + 1
        doc = np.searchsorted(starts, lists[0], "right") - 1
        for moved, offset in zip(lists[1:], offsets[1:], strict=True):
            wanted = at + offset
            # The nearest on each side within the document; other documents' are not looked at.
            first, last = starts[doc], starts[doc + 1] - 1
            after = moved[np.minimum(np.searchsorted(moved, np.maximum(wanted, first)), len(moved) - 1)]
            before = moved[np.maximum(np.searchsorted(moved, np.minimum(wanted, last), "right") - 1, 0)]
            good_after, good_before = (
                (abs(x - wanted) <= slop) & (x >= first) & (x <= last) for x in (after, before)
            )
            nearer = good_before & (~good_after | (abs(before - wanted) <= abs(after - wanted)))
            hit, good = np.where(nearer, before, after), good_before | good_after
            at, doc, hit = at[good], doc[good], hit[good]
            lowest = np.minimum(lowest[good], hit)
            highest = np.maximum(highest[good], hit + 1)
            if not len(at):
                break
        if len(at):
            found.setdefault(int(phrases.item[p]), []).append((lowest, highest))
    for item, parts in found.items():
        low, high = union_of_runs(*(np.concatenate(side) for side in zip(*parts, strict=True)))
        doc = np.searchsorted(starts, low, "right") - 1
        yield doc, item, low - starts[doc], high - starts[doc]


def search(index: DataFrame, phrases: Phrases, slop: int = 0) -> DataFrame:
    """Where the phrases occur: rows (segment, doc, item_id, start, end), runs merged.

    ``slop`` 0 asks for exact phrases, more for terms within so many words of their places.
    ``doc`` is the document's place in its segment; ``start`` and ``end`` count its words.
    """
    schema = "segment long, doc int, item_id string, start long, end long"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                starts, terms, ends, deltas = (
                    np.frombuffer(batch[name][row].as_py(), kind)
                    for name, kind in (
                        ("starts", np.int64), ("terms", np.uint64),
                        ("ends", np.int64), ("deltas", np.int32),
                    )
                )
                positions = np.cumsum(deltas, dtype=np.int32).astype(np.int64)
                for doc, item, low, high in search_segment(
                    phrases, starts, terms, ends, positions, slop
                ):
                    values = [
                        pa.array(np.full(len(doc), batch["segment"][row].as_py())),
                        pa.array(doc.astype(np.int32)),
                        pa.array([phrases.items[item]] * len(doc), pa.string()),
                        pa.array(low), pa.array(high),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        values, ["segment", "doc", "item_id", "start", "end"]
                    )

    return index.select("segment", "starts", "terms", "ends", "deltas").mapInArrow(lean(find), schema)


def item_blocks(items: DataFrame) -> Iterator[tuple[list, list]]:
    """Ids and texts of the different items, in blocks small enough to be sent to every task."""
    items = items.distinct()  # equal rows have one hash, so no number of blocks would part them
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        yield [row["item"] for row in rows], [row["text"] for row in rows]


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "key", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document: key, n_words, n_hit, items (sorted ids), contaminated.

    A document word inside an occurrence of an item's window is hit. A null text has no
    words; a repeated document is looked at by itself; an item without words hits nothing,
    a repeated item counts once, and a null item id hits words but is in no list. Other
    columns of either table are not looked at.
    """
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("text")
    ).filter("text is not null")
    index = stored(build_index(docs, key, text), "index")
    found = None
    for names, texts in item_blocks(items):
        phrases = Phrases.of(names, texts, window)
        ordered = phrases.rarest_first(*term_counts(index, phrases.vocabulary()))
        more = search(index, ordered, slop)
        found = more if found is None else found.unionByName(more)
    if found is None:
        found = search(index, Phrases.of([], [], window), slop)
    every = index.select("segment", F.posexplode("docs").alias("doc", "entry")).select(
        "segment", "doc", F.col(f"entry.{key}").alias(key), "entry.n_words"
    )
    by_doc = found.groupBy("segment", "doc").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"),
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"),
    )
    covered = F.aggregate(
        "runs",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach")),
        lambda done, run: F.struct(
            (done["n"] + F.greatest(F.lit(0), run["end"] - F.greatest(run["start"], done["reach"]))).alias("n"),
            F.greatest(run["end"], done["reach"]).alias("reach"),
        ),
        lambda done: done["n"],
    )
    hits = by_doc.select("segment", "doc", "items", covered.alias("n_hit"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return every.join(hits, ["segment", "doc"], "left").select(
        key, "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` against the windows of ``benchmark``."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def clean_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of a benchmark item."""
    keyed = docs.select(
        F.struct("doc_id", text_key().alias("text_key")).alias("key"), "text"
    )
    found = decontaminate(keyed, table(spark, sf_dir, "benchmark"))
    dirty = found.filter("contaminated").select("key.*").distinct()
    same = [docs["doc_id"].eqNullSafe(dirty["doc_id"]), text_key() == dirty["text_key"]]
    return docs.join(dirty, same, "left_anti")

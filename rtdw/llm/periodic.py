"""Periodic runs of words: the same few words again and again.

A run is a stretch of words with a period of at most half its length that no neighbour
extends. The longest Lyndon words that begin at each word, by the order of words and by its
reversal, contain a root of every run (the runs theorem). Each such word is a candidate: the
place where it begins is compared with the place where it ends, forwards in the suffix tree
of the document and backwards in the tree of its reversal, by lowest common ancestors.

A run of ``least`` words or more with two periods repeats a piece of half that many words at
the distance of its period. So only stretches of a document that have such pieces twice are
put into its trees, one after another with separators between; runs never reach beyond a
stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.suffix_tree import SuffixTree
from rtdw.llm.tables import extended, table
from rtdw.llm.words import Texts, mixed, pieces, powers, prefix_sums, ranges

LEAST = 12


def blank_words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of the words between ASCII white space, and each text's first word.

    The pattern is ``[^\\x20\\x09-\\x0D]+``.
    """
    data, offsets = texts
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    first, last = inside & ~before, before & ~inside
    joined = offsets[1:-1]  # where one text ends in a word and the next begins with one
    joined = joined[inside[joined] & before[joined]]
    first[joined] = last[joined] = True
    begins, ends = np.flatnonzero(first), np.flatnonzero(last)
    sums, inverse = prefix_sums(data)
    hashes = mixed((sums[ends] - sums[begins]) * inverse[begins])
    return begins, ends, hashes, np.searchsorted(begins, offsets)


def stretches(hashes: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The words [low, high) that can hold runs, ascending; none reaches beyond a text.

    Within a run of ``least`` words, pieces of half that many that come again in the text
    begin at most so many words apart.
    """
    size = least // 2
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    text = np.searchsorted(offsets, np.arange(len(hashes)), "right") - 1
    up, _ = powers(size + 1)
    total = mixed(text[:count].astype(np.uint64) + np.uint64(1))
    for j in range(size):
        total = total + hashes[j : j + count] * up[j + 1]
    at = np.flatnonzero(text[:count] == text[size - 1 :])
    order = at[np.argsort(total[at], kind="stable")]
    same = total[order[1:]] == total[order[:-1]]
    again = np.zeros(len(hashes), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    begins = np.flatnonzero(again)
    if not len(begins):
        return begins, begins
    new = np.append(True, (np.diff(begins) > size) | (text[begins[1:]] != text[begins[:-1]]))
    heads = np.flatnonzero(new)
    low, high = begins[heads], begins[np.append(heads[1:] - 1, len(begins) - 1)] + size
    long_ = high - low >= least
    return low[long_], high[long_]


def lyndon_ends(ranks: np.ndarray) -> np.ndarray:
    """Where the longest Lyndon word from each place ends: the next smaller suffix."""
    ranks = ranks.tolist()
    ends = [0] * (len(ranks) - 1)
    for i in range(len(ends) - 1, -1, -1):
        own, j = ranks[i], i + 1
        while ranks[j] > own:
            j = ends[j]
        ends[i] = j
    return np.array(ends, np.int64)


def runs_of(symbols: list[int], least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and then period."""
    n = len(symbols)
    if n < max(least, 2):
        return np.empty((0, 3), np.int64)
    ahead, back = SuffixTree(symbols, turned=True), SuffixTree(symbols[::-1])
    i = np.tile(np.arange(n), 2)
    j = np.concatenate([lyndon_ends(ahead.ranks), lyndon_ends(ahead.turned_ranks)])
    period, right = j - i, ahead.common(i, j)
    left = np.zeros(2 * n, np.int64)
    inner = np.flatnonzero(i)
    left[inner] = back.common(n - i[inner], n - j[inner])
    length = left + period + right
    found = (left + right >= period) & (length >= least)
    return np.unique(np.column_stack([i - left, period, length])[found], axis=0)[:, [0, 2, 1]]


def runs_of_texts(texts: Texts, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """All runs of several texts: text, start (word of the text), length, period; and the words
    (begin and end by byte, and each text's first word)."""
    begins, ends, hashes, offsets = blank_words(texts)
    low, high = stretches(hashes, offsets, least)
    owner = np.searchsorted(offsets, low, "right") - 1
    whole = texts.data.tobytes() if len(low) else b""
    out = [np.empty((0, 4), np.int64)]
    for text in np.unique(owner).tolist():
        own = np.flatnonzero(owner == text) if len(low) < 64 else np.arange(
            *np.searchsorted(owner, [text, text + 1])
        )
        known: dict[bytes, int] = {}
        symbols, places = [], []
        for a, b in zip(low[own].tolist(), high[own].tolist(), strict=True):
            for x, y in zip(begins[a:b].tolist(), ends[a:b].tolist(), strict=True):
                symbols.append(known.setdefault(whole[x:y], len(known)))
            symbols.append(-1)
            places += range(a, b + 1)
        separators = iter(range(len(known) + 1, len(known) + len(own) + 1))
        found = runs_of([x + 1 if x >= 0 else next(separators) for x in symbols], least)
        start = np.array(places, np.int64)[found[:, 0]] - offsets[text]
        out.append(np.column_stack([np.full(len(found), text), start, found[:, 1:]]))
    rows = np.concatenate(out)
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], begins, ends, offsets


def collapsed_texts(texts: Texts, keep: np.ndarray, begins: np.ndarray, ends: np.ndarray,
                    offsets: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[keep]
    sizes = (ends - begins)[keep] + 1
    data = np.append(texts.data, np.uint8(0x20))
    index = ranges(begins[keep], sizes)
    if len(sizes):
        index[np.cumsum(sizes) - 1] = len(texts.data)  # a blank after each word
    of_text = np.bincount(text, sizes, len(offsets) - 1).astype(np.int64)
    last = np.cumsum(of_text)
    index = np.delete(index, last[of_text > 0] - 1)  # but none after the last
    bounds = np.concatenate([[0], np.cumsum(np.maximum(of_text - 1, 0))])
    return pa.LargeStringArray.from_buffers(
        len(of_text), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[index])
    ).cast(pa.string())


def periodic_runs(docs: DataFrame, keep: list[str], text: str = "text", least: int = LEAST) -> DataFrame:
    """Kept columns, ``n_words``, ``runs`` (by start, then period) and ``collapsed``.

    Words are what stands between ASCII white space, numbered from 0; a null text has none.
    ``runs`` are all of at least ``least`` words and two periods; the period is the smallest.
    ``collapsed`` is the text of all words but those that a run has after its first period.
    Rows are looked at each by itself. A worker holds the trees of one document, some
    hundred bytes a word of its repeated stretches.
    """
    names = [f"keep_{c}" for c in keep]
    rows = docs.select(
        *(docs[c].alias(name) for c, name in zip(keep, names, strict=True)),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
    )
    run = "struct<start:long,length:long,period:long>"
    schema = extended(rows.select(*names).schema, f"n_words long, runs array<{run}>, collapsed string")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                owner, start, length, period, begins, ends, offsets = runs_of_texts(texts, least)
                marks = np.zeros(len(begins) + 1, np.int64)
                first = offsets[owner] + start
                np.add.at(marks, first + period, 1)
                np.add.at(marks, first + length, -1)
                dropped = np.cumsum(marks[:-1]) > 0
                bounds = np.searchsorted(owner, np.arange(len(part) + 1)).astype(np.int32)
                found = pa.StructArray.from_arrays([start, length, period], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in names), pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(pa.array(bounds), found),
                    collapsed_texts(texts, ~dropped, begins, ends, offsets),
                ], schema.names)

    out = rows.mapInArrow(find, schema)
    return out.select(
        *(F.col(name).alias(c) for c, name in zip(keep, names, strict=True)), "n_words", "runs", "collapsed"
    )


def longest_run(runs: str = "runs") -> F.Column:
    """The run of the greatest length; of equal ones that of the smallest start, then period."""
    by_length = F.array_max(F.transform(runs, lambda x: F.struct(
        x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period")
    )))
    return F.struct(
        (-by_length["start"]).alias("start"), by_length["length"].alias("length"), (-by_length["period"]).alias("period")
    )


def repeating_texts(docs: DataFrame) -> DataFrame:
    """The documents with the words of every tenth one replaced by a period, in ``edited``.

    h is the CRC-32 of the id; where h % 10 is 0 and the text has n > 0 words, the words from
    a = (h / 10) % n on repeat the p words there, p being 1 and (n - a) / (3 + h / 10 % 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    marked = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    # Only the texts that are edited are split.
    marked = marked.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n = F.size("words").cast("long")
    a = F.when(n > 0, F.col("g") % F.greatest(n, F.lit(1)))
    marked = marked.withColumns({"n": n, "a": a})
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    marked = marked.withColumn("p", p)
    index = F.transform(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - 1, F.lit(0))),
        lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")),
    )
    own = F.array_join(F.transform(index, lambda i: F.get("words", i.cast("int"))), " ")
    edited = F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), own).otherwise(F.col("text"))
    return marked.select("doc_id", edited.alias("edited"))


def op13_periodic(spark, sf_dir: str) -> DataFrame:
    """Every document's periodic runs, the longest of them, and its text without repetitions.

    Null and blank texts have no runs; documents without an id are not edited; repeated rows
    give a row each; an empty table gives no rows.
    """
    found = periodic_runs(repeating_texts(table(spark, sf_dir, "documents")), ["doc_id"], "edited")
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    found = found.withColumn("longest", F.when(F.size("runs") > 0, longest_run()))
    length, period = F.col("longest.length"), F.col("longest.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.tables import extended, stored, table
from rtdw.llm.words import Texts, mixed, pieces

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
CHUNK_BYTES = 1 << 20
MODEL_BYTES = 64 << 20


@cache
def _letters() -> np.ndarray:
    """By code point: its lower case if it is a letter, else a blank."""
    out = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def letters_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of the texts, and where each text begins among them."""
    data, offsets = texts
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return _letters()[codes], begins[offsets]


def grams(codes: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each code point; ``BUCKETS`` where it would cross texts."""
    total = np.full(len(codes), order, np.uint64)
    for j in range(order):
        total[: len(codes) - j] = total[: len(codes) - j] * np.uint64(0x100000001B3) + codes[j:]
    buckets = (mixed(total) >> np.uint64(49)).astype(np.int64)
    for j in range(1, order):
        at = offsets[1:] - j
        buckets[at[at >= offsets[:-1]]] = BUCKETS
    return buckets


def gram_counts(docs: DataFrame, text: str, label: str) -> DataFrame:
    """(label, bucket, n): how often each n-gram bucket occurs in the texts of a label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for rows, texts in pieces(batch, text, CHUNK_BYTES):
                codes, offsets = letters_of(texts)
                codes_of = rows.column(label).dictionary_encode()
                of_row = codes_of.indices.to_numpy()
                of_code = np.repeat(of_row, np.diff(offsets))
                names = codes_of.dictionary.to_pylist()
                for order in ORDERS:
                    buckets = grams(codes, offsets, order)
                    both = np.bincount(of_code * (BUCKETS + 1) + buckets, minlength=len(names) * (BUCKETS + 1))
                    for i, name in enumerate(names):
                        own = both[i * (BUCKETS + 1) : (i + 1) * (BUCKETS + 1) - 1]
                        seen[name] = seen.get(name, 0) + own
        for name, own in seen.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])],
                ["label", "bucket", "n"],
            )

    rows = docs.select(F.col(text).cast("string").alias(text), F.col(label).cast("string").alias(label))
    counted = rows.mapInArrow(count, "label string, bucket int, n long")
    return counted.groupBy("label", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", label: str = "lang",
        smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Labels and their log-probabilities by bucket (the last row is for no bucket, all 0).

    The matrix has one column per label; it is refused if it would pass ``MODEL_BYTES``.
    Rows without a label are not learned from.
    """
    docs = docs.filter(F.col(label).isNotNull())
    counts = stored(gram_counts(docs, text, label), "gram-counts")
    labels = counts.agg(F.count_distinct("label")).first()[0]
    if labels * (BUCKETS + 1) * 8 > MODEL_BYTES:
        raise ValueError(f"{labels} labels are too many for a matrix that is sent to every task")
    got = counts.toArrow()
    names = sorted(set(got["label"].to_pylist()))
    column = np.array([names.index(x) for x in got["label"].to_pylist()], np.int64)
    matrix = np.zeros((BUCKETS + 1, len(names)))
    matrix[got["bucket"].to_numpy(), column] = got["n"].to_numpy()
    matrix[:-1] = np.log(matrix[:-1] + smoothing) - np.log(matrix[:-1].sum(0) + smoothing * BUCKETS)
    matrix[-1] = 0
    return names, matrix


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str],
            text: str = "text") -> DataFrame:
    """The kept columns with ``lang_pred`` and ``score``, the posterior of that label.

    Labels are equally likely beforehand; of equal ones the first by name wins. A null
    text, one without any letter, and every text when nothing was learned, is ``und``
    with score 0.
    """
    names, matrix = model
    sent = docs.sparkSession.sparkContext.broadcast(matrix)
    schema = extended(docs.select(*keep).schema, "lang_pred string, score double")
    choices = pa.array([*names, "und"], pa.string())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = sent.value
        for batch in batches:
            for rows, texts in pieces(batch, "__text", CHUNK_BYTES):
                codes, offsets = letters_of(texts)
                some = np.flatnonzero(np.diff(offsets) > 0)
                best, sure = np.full(len(rows), len(names)), np.zeros(len(rows))
                if len(some) and names:
                    total = np.zeros((len(some), len(names)))
                    for order in ORDERS:
                        total += np.add.reduceat(table_[grams(codes, offsets, order)], offsets[some], axis=0)
                    letters = np.add.reduceat((codes != 32).astype(np.int64), offsets[some])
                    total -= total.max(1, keepdims=True)
                    odds = np.exp(total)
                    first = odds.argmax(1)
                    known = letters > 0
                    best[some[known]] = first[known]
                    sure[some[known]] = (odds.max(1) / odds.sum(1))[known]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), choices.take(pa.array(best)), pa.array(sure)],
                    schema.names,
                )

    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    return rows.mapInArrow(score, schema)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document; fitted on those whose id's checksum mod 4 is not 2.

    A null doc_id counts as an empty one.
    """
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold == 2).alias("held_out"))
    model = fit(docs.filter(~F.col("held_out")))
    return predict(docs, model, ["doc_id", "held_out"])

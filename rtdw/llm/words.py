"""Bytes, words and hashes of whole Arrow text columns, without a Python object per row."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import cache
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CHUNK_BYTES = 2 << 20


_kept: dict[str, Any] = {}


def kept(owner: str, make: Callable[[], Any]) -> Any:
    """What an operator's tasks keep in a worker; it is made once."""
    if owner not in _kept:
        _kept[owner] = make()
    return _kept[owner]


def forget_others(owner: str | None) -> None:
    """Drop what other operators' tasks have kept in this worker."""
    others = _kept.keys() - {owner}
    for other in others:
        del _kept[other]
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()


def release() -> None:
    """Give memory that is free in this worker back to the system: others run while it waits."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc keeps free memory and has this
        ctypes.CDLL(None).malloc_trim(0)


Batches = Iterator[pa.RecordBatch]


def lean(work: Callable[[Batches], Batches], owner: str | None = None) -> Callable[[Batches], Batches]:
    """The work of a task, before which goes what other operators than ``owner`` have kept in the
    worker, and after which the worker holds no more than what is kept."""

    def run(batches: Batches) -> Batches:
        forget_others(owner)
        try:
            yield from work(batches)
        finally:
            release()

    return run


class Texts(NamedTuple):
    """UTF-8 bytes of several texts and where each begins (one more entry than texts)."""

    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """The words of several texts: hash and byte range of each, and each text's first word."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The texts of a string column; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return Texts(np.empty(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def pieces(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES,
           owner: str | None = None) -> Iterator[tuple]:
    """Slices of a batch, each with its texts, of about ``limit`` bytes.

    A longer text makes a slice of its own: texts are never cut. What operators other
    than ``owner`` have kept in this worker is dropped.
    """
    forget_others(owner)
    whole = texts_of(batch.column(text))
    first, count = 0, len(batch)
    while first < count:
        last = int(np.searchsorted(whole.offsets, whole.offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), count)
        lo, hi = whole.offsets[first], whole.offsets[last]
        yield (
            batch.slice(first, last - first),
            Texts(whole.data[lo:hi], whole.offsets[first : last + 1] - lo),
        )
        first = last


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    ones = np.ones(size, np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:], down[1:] = BASE, INVERSE
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse; tables for usual sizes are kept."""
    if size <= CHUNK_BYTES + 1:
        up, down = _powers(CHUNK_BYTES + 1)
    else:
        up, down = _powers.__wrapped__(size)
    return up[:size], down[:size]


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``S`` and inverse powers: bytes [a, b) hash to ``(S[b] - S[a]) * inverse[a]``."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums, down


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower, word = np.arange(256, dtype=np.uint8), np.zeros(256, bool)
    lower[ord("A") : ord("Z") + 1] += 32
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        word[low : high + 1] = True
    return lower, word


LOWER, IS_WORD = _tables()


def split_words(texts: Texts) -> Words:
    """Words are runs of ASCII letters and digits and of all characters beyond ASCII.

    A-Z count as a-z. The pattern is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
    """
    data, offsets = texts
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = IS_WORD[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    first, last = inside & ~before, before & ~inside
    # Where one text ends in a word and the next begins with one.
    joined = offsets[1:-1]
    joined = joined[inside[joined] & before[joined]]
    first[joined] = last[joined] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    sums, inverse = prefix_sums(LOWER[data])
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and each text's first run.

    A text of fewer words, but not none, has one run: all of them.
    """
    counts = np.diff(words.offsets)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(runs)])
    text = np.repeat(np.arange(len(counts)), runs)
    at = words.offsets[:-1][text] + np.arange(offsets[-1]) - offsets[:-1][text]
    end = words.offsets[1:][text]
    up, _ = powers(size + 1)
    total = np.zeros(len(at), np.uint64)
    padded = np.append(words.hashes, np.zeros(size, np.uint64))
    for j in range(size):
        total += np.where(at + j < end, padded[at + j], np.uint64(0)) * up[j + 1]
    return mixed(total), offsets


def counts_by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags each text has."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def union_of_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that intervals [start, end) cover together; touching ones merge."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The whole numbers of all ranges that begin at ``first``, one range after another."""
    ends = np.cumsum(count, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - count), count)

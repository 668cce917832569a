"""Lines of parts of text files, in any store that pyarrow opens."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs

CHUNK = 4 << 20


def opened_store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path or URI (also in Hadoop's form, ``file:/x``), and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^(\w+):/(?!/)", r"\1:///", path))


def slices(begin: int, stop: int, size: int) -> list[tuple[int, int]]:
    """The byte range [begin, stop) in parts of at most ``size`` bytes."""
    return [(at, min(at + size, stop)) for at in range(begin, stop, size)]


def read_lines(file: pa.NativeFile, begin: int, end: int, first: int, stop: int) -> Iterator[pa.RecordBatch]:
    """The lines that begin in [begin, end), as batches of ``value``.

    ``first`` is where a line begins for sure, at or before ``begin``; ``stop`` is where the last line ends,
    with or without a line end.
    """
    at, rest = begin, b""
    if begin > first:  # the line across ``begin`` belongs to the part before
        at = begin - 1
        file.seek(at)
        while at < stop:
            data = file.read(min(CHUNK, stop - at))
            if not data:
                return
            cut = data.find(b"\n") + 1
            if cut:
                at += cut
                break
            at += len(data)
        else:
            return
    file.seek(at)
    place = at  # of what is in ``rest``
    while place < end:
        data = file.read(min(CHUNK, stop - at))
        at += len(data)
        own = rest + data
        lines = own.split(b"\n")
        rest = lines.pop()
        if not data and rest:  # the last line has no end
            lines, rest = [rest], b""
        taken = []
        for line in lines:
            if place >= end:
                break
            taken.append(line)
            place += len(line) + 1
        if taken:
            values = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in taken]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])
        if not data:
            return

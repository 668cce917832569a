"""Log files that are appended to and rolled: a streaming source of their lines.

Spark's file source reads each file once, so it misses what is appended later and reads a
renamed file again. This source remembers how many bytes of each file it has read. A file
is known by its first line, not by its name, so a rolled file goes on where it was left.
Only whole lines are read; a line without its end waits, unless the file's name says
that nothing more will come.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from rtdw.sources.lines import opened_store, read_lines, slices

NAME = "growing_log"
#: Bytes of a file that one task reads.
SLICE_BYTES = 64 << 20
#: Bytes looked at together in search of a line end.
STEP = 1 << 16
#: Names of rolled files, to which nothing is appended.
CLOSED = r"\d{4}-\d\d-\d\d"


@dataclass
class Part(InputPartition):
    """Lines that begin in [begin, end) of the file ``name``, of which [first, stop) is read."""

    name: str
    file: str
    begin: int
    end: int
    first: int
    stop: int

    def __post_init__(self) -> None:
        super().__init__(self.file)


class GrowingLog(DataSource):
    """``spark.readStream.format("growing_log")`` with one column, ``value``.

    Options: ``path`` (a folder, with those below it), ``headlines`` (how many first lines tell
    files apart; default 1), ``closed`` (pattern found in the names of rolled files).
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(
            self.options["path"], int(self.options.get("headlines", 1)), self.options.get("closed", CLOSED)
        )


class GrowingReader(DataSourceStreamReader):
    """Offsets are read bytes by file. Files that vanish keep theirs as long as the query runs."""

    def __init__(self, path: str, headlines: int, closed: str) -> None:
        self.path, self.headlines, self.closed = path, headlines, closed
        self.seen: dict[str, tuple] = {}  # by name: size, time of change, file, whole lines' end
        self.known: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        found = {file: end for file, (_, end) in self.files().items()}
        self.known = {**self.known, **found}
        return dict(self.known)

    def partitions(self, start: dict, end: dict) -> list[Part]:
        self.known = {**end, **self.known}
        wanted = {file: (start.get(file, 0), stop) for file, stop in end.items() if stop > start.get(file, 0)}
        names = {file: name for file, (name, _) in self.files().items()} if wanted else {}
        return [
            Part(names.get(file, ""), file, a, b, begin, stop)
            for file, (begin, stop) in wanted.items()
            for a, b in slices(begin, stop, SLICE_BYTES)
        ]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        store, _ = opened_store(self.path)
        with self.opened(store, partition) as file:
            yield from read_lines(file, partition.begin, partition.end, partition.first, partition.stop)

    def opened(self, store: pyarrow.fs.FileSystem, part: Part):
        """The partition's file, under the name it has by now."""
        for name in (part.name, None):
            name = self.files().get(part.file, ("",))[0] if name is None else name
            if name:
                try:
                    file = store.open_input_file(name)
                except FileNotFoundError:
                    continue
                if self.file_of(file) == part.file:
                    return file
                file.close()
        raise FileNotFoundError(f"a log file that has lines still to be read is gone from {self.path}")

    def files(self) -> dict[str, tuple[str, int]]:
        """Name of each file, and the end of its last whole line.

        The folder is listed twice: a file that is renamed meanwhile may be missed once.
        """
        store, base = opened_store(self.path)
        out: dict[str, tuple[str, int]] = {}
        for _ in range(2):
            listed = store.get_file_info(pyarrow.fs.FileSelector(base, recursive=True, allow_not_found=True))
            for info in listed:
                hidden = info.base_name.startswith((".", "_"))
                if info.type != pyarrow.fs.FileType.File or hidden or not info.size:
                    continue
                found = self.looked_at(store, info)
                if not found:
                    continue
                file, end = found
                other = out.get(file)
                if other and other[0] != info.path and self.exists(store, other[0], file):
                    raise ValueError(
                        f"{other[0]} and {info.path} begin with the same line; set headlines above {self.headlines}"
                    )
                out[file] = (info.path, end)
        return out

    def exists(self, store: pyarrow.fs.FileSystem, name: str, file: str) -> bool:
        try:
            with store.open_input_file(name) as own:
                return self.file_of(own) == file
        except FileNotFoundError:
            return False

    def looked_at(self, store: pyarrow.fs.FileSystem, info: pyarrow.fs.FileInfo) -> tuple[str, int] | None:
        """The file's identity and the end of its last whole line, unless it has none yet."""
        state = (info.size, info.mtime_ns)
        known = self.seen.get(info.path)
        if known and known[0] == state:
            return known[1]
        try:
            with store.open_input_file(info.path) as file:
                name = self.file_of(file)
                closed = re.search(self.closed, info.base_name)
                end = info.size if closed else self.whole_lines(file, info.size)
        except FileNotFoundError:  # renamed meanwhile
            return None
        found = (name, end) if name else None
        self.seen[info.path] = (state, found)
        return found

    def file_of(self, file: pa.NativeFile) -> str | None:
        """A hash of the first lines, if they are whole."""
        head, at, left = hashlib.sha1(), 0, self.headlines
        file.seek(0)
        while data := file.read(STEP):
            at = 0
            while left and (cut := data.find(b"\n", at)) >= 0:
                at, left = cut + 1, left - 1
            head.update(data if left else data[:at])
            if not left:
                return head.hexdigest()
        return None

    @staticmethod
    def whole_lines(file: pa.NativeFile, size: int) -> int:
        at = size
        while at > 0:
            begin = max(0, at - STEP)
            file.seek(begin)
            cut = file.read(at - begin).rfind(b"\n")
            if cut >= 0:
                return begin + cut + 1
            at = begin
        return 0


def read_growing(spark: SparkSession, path: str, headlines: int = 1, closed: str = CLOSED) -> DataFrame:
    """The lines of a folder of growing and rolled log files, each once."""
    spark.dataSource.register(GrowingLog)
    return (
        spark.readStream.format(NAME)
        .option("path", path).option("headlines", headlines).option("closed", closed)
        .load()
    )

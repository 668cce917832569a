"""Web archives: a Spark data source that reads and writes WARC files.

Reading. The files are listed once and grouped into partitions by size. Conditions on the
record type, the record id and the page id are pushed into the reader. It parses a record's
headers first; the block of a record that they rule out, or of which no column is wanted,
is skipped by its length. Compressed files hold one gzip member per record, whose extra
field tells the compressed and the plain length, so that a skipped record is not
decompressed beyond its headers. Members of other writers, without that field, are
decompressed to find their end, but not decoded.

Writing. Each task writes files of bounded size under names of its own, and the driver
publishes a list of the files of committed tasks at the end. Readers go by that list, so
files of lost or repeated attempts are not seen.

Paths are those of any store that pyarrow can open.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from rtdw.llm.tables import stored, table
from rtdw.session import fresh_dir

SCHEMA = (
    "page_id long, url string, record_type string, record_id string, refers_to long, "
    "payload_digest string, payload_bytes long, headers map<string,string>, payload binary"
)
NAMES = [column.split()[0] for column in SCHEMA.split(", ")]
#: Smallest payload that a later equal one may refer to.
MIN_REVISIT_BYTES = 0
FILE_BYTES = 64 << 20
PARTITION_BYTES = 32 << 20
BATCH_BYTES = 8 << 20
MANIFEST = "_files.json"
PUSHED = ("record_type", "record_id", "page_id")


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id_of(page_id: int | None, url: str | None) -> str:
    """The same id for the same page on every attempt."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def one_line(value: str) -> str:
    """A header value: line ends would begin another header, so they become blanks."""
    return " ".join(value.split("\r")).replace("\n", " ")


def member(record: bytes) -> bytes:
    """A gzip member whose extra field 'sl' has its compressed and plain lengths."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    end = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = 24 + len(body) + len(end)
    head = struct.pack("<BBBBIBBH2sHII", 31, 139, 8, 4, 0, 0, 255, 12, b"sl", 8, size, len(record) & 0xFFFFFFFF)
    return head + body + end


def record(page_id: int | None, url: str | None, record_type: str, refers_to: int | None,
           digest: str, payload: bytes) -> bytes:
    """A response with its payload, or a revisit with the headers of its payload only."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if record_type == "response" else http
    fields = [
        ("WARC-Type", record_type), ("WARC-Record-ID", record_id_of(page_id, url)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", one_line(url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if record_type == "revisit":
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("X-Refers-To-Page-Id", str(refers_to)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


class Source:
    """A file read forward in pieces, with skipping; ``left`` is what was read but not used."""

    PIECE = 1 << 20

    def __init__(self, file: pa.NativeFile):
        self.file, self.left = file, b""

    def fill(self, size: int) -> bool:
        while len(self.left) < size:
            more = self.file.read(max(self.PIECE, size - len(self.left)))
            if not more:
                return False
            self.left += more
        return True

    def take(self, size: int) -> bytes:
        if not self.fill(size):
            raise ValueError("the archive ends within a record")
        out, self.left = self.left[:size], self.left[size:]
        return out

    def skip(self, size: int) -> None:
        if size <= len(self.left):
            self.left = self.left[size:]
        else:
            self.file.seek(self.file.tell() + size - len(self.left))
            self.left = b""

    def until(self, mark: bytes) -> bytes:
        """All up to a mark, and the mark."""
        at = self.left.find(mark)
        while at < 0:
            seen = len(self.left)
            if not self.fill(seen + 1):
                raise ValueError("the archive ends within headers")
            at = self.left.find(mark, max(0, seen - len(mark) + 1))
        return self.take(at + len(mark))


def parse_headers(head: bytes) -> dict[str, str]:
    """The named fields of a record or of HTTP headers, by lower-case name."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def plain_records(source: Source, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers of each record and, where ``wanted(headers)`` is "block", its block.

    ``wanted`` returns None for a record to leave out.
    """
    while source.fill(1):
        if source.left[:2] == b"\r\n":
            source.take(2)
            continue
        headers = parse_headers(source.until(b"\r\n\r\n"))
        size = int(headers.get("content-length", 0))
        want = wanted(headers)
        if want == "block":
            yield headers, source.take(size)
        else:
            source.skip(size)
            if want:
                yield headers, None
        if source.fill(4) and source.left[:4] == b"\r\n\r\n":
            source.take(4)


def packed_records(source: Source, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """The same from gzip members of one record each."""
    while source.fill(18):
        flags = source.left[3]
        size = None
        if flags & 4 and source.fill(24) and source.left[12:14] == b"sl":
            size = struct.unpack_from("<I", source.left, 16)[0]
        if size is not None:
            # The headers are decompressed alone, at first from few of the member's bytes.
            unpack, head, used = zlib.decompressobj(31), b"", 0
            while b"\r\n\r\n" not in head and used < size:
                more = min(1024, size - used)
                source.fill(used + more)
                head += unpack.decompress(source.left[used : used + more])
                used += more
            top, mark, block = head.partition(b"\r\n\r\n")
            if not mark:
                raise ValueError("a record without end of headers")
            headers = parse_headers(top)
            want = wanted(headers)
            if want == "block":
                body = source.take(size)
                block += unpack.decompress(body[used:]) + unpack.flush()
                yield headers, block[: int(headers.get("content-length", 0))]
            else:
                source.skip(size)
                if want:
                    yield headers, None
            continue
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not source.fill(1):
                raise ValueError("the archive ends within a member")
            parts.append(unpack.decompress(source.left))
            source.left = unpack.unused_data
        whole = b"".join(parts)
        top, _, block = whole.partition(b"\r\n\r\n")
        headers = parse_headers(top)
        want = wanted(headers)
        if want:
            yield headers, block[: int(headers.get("content-length", 0))] if want == "block" else None


@dataclass
class Files(InputPartition):
    """Files that one task reads."""

    paths: list[str]


def listed(path: str) -> tuple[pyarrow.fs.FileSystem, list[tuple[str, int]]]:
    """The archives below a path, by its list of committed files where there is one."""
    store, base = pyarrow.fs.FileSystem.from_uri(path)
    info = store.get_file_info(base)
    if info.is_file:
        return store, [(base, info.size)]
    manifest = store.get_file_info(f"{base}/{MANIFEST}")
    if manifest.is_file:
        with store.open_input_stream(manifest.path) as file:
            return store, [(f"{base}/{name}", size) for name, size in json.loads(file.read())]
    found = store.get_file_info(pyarrow.fs.FileSelector(base, recursive=True))
    return store, sorted(
        (x.path, x.size) for x in found if x.is_file and x.path.endswith((".warc", ".warc.gz"))
    )


class WarcReader(DataSourceReader):
    """Options: ``path``; ``payload`` = "false" leaves all blocks unread; ``verify`` = "true"
    compares response payloads with their digests."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true") != "false"
        self.verify = options.get("verify", "false") == "true"
        self.allowed: dict[str, list] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            name = one.attribute[0] if getattr(one, "attribute", None) else None
            if isinstance(one, EqualTo) and len(one.attribute) == 1 and name in PUSHED:
                self._allow(name, [one.value])
            elif isinstance(one, In) and len(one.attribute) == 1 and name in PUSHED:
                self._allow(name, list(one.value))
            else:
                yield one

    def _allow(self, name: str, values: list) -> None:
        old = self.allowed.get(name)
        self.allowed[name] = values if old is None else [v for v in old if v in values]

    def partitions(self) -> list[InputPartition]:
        _, files = listed(self.path)
        out, held = [], 0
        for path, size in files:
            if not out or held + size > PARTITION_BYTES:
                out.append(Files([]))
                held = 0
            out[-1].paths.append(path)
            held += size
        return out or [Files([])]

    def wanted(self, headers: dict[str, str]) -> str | None:
        page = headers.get("x-page-id")
        values = {
            "record_type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"),
            "page_id": None if page is None else int(page),
        }
        if any(values[name] not in allowed for name, allowed in self.allowed.items()):
            return None
        return "block" if self.payload else "headers"

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                source = Source(file)
                packed = source.fill(2) and source.left[:2] == b"\x1f\x8b"
                for headers, block in (packed_records if packed else plain_records)(source, self.wanted):
                    rows.append(self.row(headers, block))
                    size += len(block or b"") + 1024
                    if size >= BATCH_BYTES:
                        yield self.batch(rows)
                        rows, size = [], 0
        yield self.batch(rows)

    def row(self, headers: dict[str, str], block: bytes | None) -> tuple:
        kind = headers.get("warc-type")
        digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
        payload, length = None, None
        if block is not None:
            if headers.get("content-type", "").startswith("application/http"):
                top, _, payload = block.partition(b"\r\n\r\n")
                stated = parse_headers(top).get("content-length")
            else:
                payload, stated = block, None
            if kind == "revisit":
                payload, length = None, None if stated is None else int(stated)
            else:
                length = len(payload)
                if self.verify and kind == "response" and digest not in (None, digest_of(payload)):
                    raise ValueError(f"the payload of {headers.get('warc-record-id')} has changed")
        page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
        return (
            None if page is None else int(page), headers.get("warc-target-uri"), kind,
            headers.get("warc-record-id"), None if refers is None else int(refers),
            digest, length, list(headers.items()), payload,
        )

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [
            pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(),
            pa.map_(pa.string(), pa.string()), pa.binary(),
        ]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES
        )


@dataclass
class Written(WriterCommitMessage):
    """Names and sizes of a task's files."""

    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    """Takes page_id, url, record_type, refers_to and payload. Option ``compress`` = "false"
    writes plain files."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.compress = options.get("compress", "true") != "false"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = pyarrow.fs.FileSystem.from_uri(self.path)
        store.create_dir(base, recursive=True)
        attempt, files, out, size = uuid.uuid4().hex, [], None, 0
        for batch in iterator:
            for row in range(len(batch)):
                page_id, url, kind, refers_to, payload = (
                    batch[name][row].as_py()
                    for name in ("page_id", "url", "record_type", "refers_to", "payload")
                )
                payload = payload or b""
                data = record(page_id, url, kind, refers_to, digest_of(payload), payload)
                data = member(data) if self.compress else data
                if out is None:
                    name = f"pages-{attempt}-{len(files):05d}.warc" + ".gz" * self.compress
                    out, size = store.open_output_stream(f"{base}/{name}", compression=None), 0
                    files.append((name, 0))
                out.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    out.close()
                    files[-1], out = (name, size), None
        if out is not None:
            out.close()
            files[-1] = (name, size)
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = pyarrow.fs.FileSystem.from_uri(self.path)
        store.create_dir(base, recursive=True)
        files = sorted(file for one in messages if one for file in one.files)
        with store.open_output_stream(f"{base}/{MANIFEST}.new") as out:
            out.write(json.dumps(files).encode())
        store.move(f"{base}/{MANIFEST}.new", f"{base}/{MANIFEST}")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc")``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def as_uri(path: str) -> str:
    """A path that pyarrow opens: a local one with the full scheme, others as they are."""
    local = path.removeprefix("file://").removeprefix("file:")
    return f"file://{local}" if local.startswith("/") else path


def with_revisits(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages (page_id, url, payload) with ``record_type`` and ``refers_to``.

    Of equal payloads of at least so many bytes, the smallest page_id is the response; rows
    that repeat it are responses too. Rows without an id revisit one that has an id, and are
    responses if none has. Only digests and ids are grouped, and partly before they move. The
    digests that come again are written first: the join with the payloads then has two tables,
    and a payload that very many pages share is split.
    """
    keyed = pages.withColumn("__sha", F.sha1("payload"))
    first = keyed.filter(F.octet_length("payload") >= least).groupBy("__sha").agg(
        F.min("page_id").alias("__first"), F.count("*").alias("__n")
    ).filter("__n > 1").drop("__n")
    first = stored(first, "shared-payloads")
    joined = keyed.join(first, "__sha", "left")
    again = F.col("__first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first"))
    again = again & (F.octet_length("payload") >= least)
    return joined.select(
        "page_id", "url", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("__first")).alias("refers_to"), "payload",
    )


def write_archive(pages: DataFrame, path: str) -> None:
    """Write pages as an archive of responses and revisits."""
    pages.sparkSession.dataSource.register(WarcSource)
    with_revisits(pages).write.format("warc").mode("append").option("path", path).save()


def read_archive(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The records of an archive; conditions on a record's type and ids reach the reader.

    Use one load per set of conditions: those pushed into a load hold for all uses of it.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(path)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back.

    A null html is an empty payload; every row gives a record.
    """
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    )
    path = as_uri(fresh_dir(spark, "warc"))
    write_archive(pages, path)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    # Two loads: the conditions pushed into one load hold for all uses of it.
    both = [
        read_archive(spark, path, verify="true").filter(F.col("record_type") == kind).select(*columns)
        for kind in ("response", "revisit")
    ]
    return stored(both[0].unionByName(both[1]), "warc-records")

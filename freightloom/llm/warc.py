"""WARC archives as a Spark data source: ``format("warc")`` writes and reads them.

Writing: each task writes its rows as records into files of at most
``rollBytes`` bytes, first under ``_attempts``; the driver's commit moves the
files of the successful attempts into place, so that a task run twice (a lost
executor) leaves no second copy. Whether a page is a ``response`` or a
``revisit`` of an earlier page with the same payload is decided before
writing, by Spark (see :func:`write_pages`).

Reading plans one partition per file. Each record's header is parsed first;
pushed-down filters on the record type, page id and target URI are judged
on it, and the block of a record that fails them, or whose payload no column
asks for, is skipped by seeking past it, never read or decoded. Only the
columns of the schema the reader is given are produced.

Files are ``.warc.gz``: each record is a gzip member of its own, as is
usual, and its gzip header carries the member's length in an extra field
(``WL``), which other gzip readers pass over. The reader inflates the first
bytes of a member up to the end of the WARC header and skips the rest of a
member it does not need by that length. Uncompressed ``.warc`` files are read
too.

Records (WARC/1.1): a ``response`` holds the HTTP response with the payload;
a ``revisit`` (profile identical-payload-digest) holds the HTTP header only,
with ``Content-Length`` of the payload, and refers to the response's record
id. Extension fields ``WARC-Page-ID`` and ``WARC-Refers-To-Page-ID`` carry
the page ids. Digests are SHA-1 in upper-case base32, as the format has it.

Edge cases: a null html is an empty payload (0 bytes, still a record); a null
URL writes no ``WARC-Target-URI``; an empty table writes no file and reads
as an empty table; pages with equal ids are written as they come, each its
own record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "warc"
#: Bytes of a file after which a task starts the next one.
ROLL_BYTES = 128 << 20
#: Records of a batch the reader yields.
BATCH = 1024
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6c0f2bde-6a51-4b55-9d7a-6d1d6ad2f1a3")

#: Columns the reader can give; a schema passed to it may hold any of them.
SCHEMA = (
    "record_id string, record_type string, page_id long, target_uri string, payload_digest string, "
    "payload_bytes long, refers_to long, refers_to_record string, file string, offset long, payload binary"
)
#: Columns the writer takes; ``refers_to`` is null for responses.
WRITE_SCHEMA = "page_id long, target_uri string, record_type string, refers_to long, payload binary, sha1 string, size long"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, str(page_id))}>"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; plain paths are local ones."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def record(page_id, target_uri, record_type, refers_to, payload: bytes, sha1_hex: str | None = None, size: int | None = None) -> bytes:
    """One WARC record as bytes; a revisit takes the digest and size of the payload it does not hold."""
    if record_type == "response" or sha1_hex is None:
        digest, size = base32_sha1(payload), len(payload)
    else:
        digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode("ascii")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if record_type == "response" else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if target_uri is not None:
        head.append("WARC-Target-URI: " + target_uri.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if record_type == "revisit":
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


class WarcCommit(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, roll: int):
        self.path, self.overwrite, self.roll = path.rstrip("/"), overwrite, roll
        self.job = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> WarcCommit:
        fs, root = filesystem(self.path)
        attempt = f"{root}/_attempts/{self.job}"
        fs.create_dir(attempt, recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in batches:
                rows = batch.to_pydict()
                for page_id, uri, kind, refers, payload, sha1, bytes_ in zip(
                    rows["page_id"], rows["target_uri"], rows["record_type"], rows["refers_to"], rows["payload"], rows["sha1"], rows["size"]
                ):
                    if out is None or size >= self.roll:
                        if out is not None:
                            out.close()
                        name = f"{attempt}/part-{uuid.uuid4().hex}.warc.gz"
                        out, size = fs.open_output_stream(name, compression=None), 0
                        files.append(name)
                    data = member(record(page_id, uri, kind, refers, payload or b"", sha1, bytes_))
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return WarcCommit(files)

    def commit(self, messages: list[WarcCommit]) -> None:
        fs, root = filesystem(self.path)
        if self.overwrite:
            for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if info.base_name.endswith((".warc", ".warc.gz")):
                    fs.delete_file(info.path)
        for message in messages:
            for name in message.files if message is not None else []:
                fs.move(name, f"{root}/{name.rsplit('/', 1)[1]}")
        fs.delete_dir_contents(f"{root}/_attempts", missing_dir_ok=True)

    def abort(self, messages: list[WarcCommit]) -> None:
        fs, root = filesystem(self.path)
        fs.delete_dir_contents(f"{root}/_attempts/{self.job}", missing_dir_ok=True)


class WarcFile(InputPartition):
    def __init__(self, name: str):
        self.name = name


#: Columns whose pushed filters are judged on the header.
HEADER_COLUMNS = ("record_type", "page_id", "target_uri")


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path.rstrip("/"), schema
        self.pushed: list = []

    def partitions(self):
        fs, root = filesystem(self.path)
        infos = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        names = sorted(i.path for i in infos if i.type == pafs.FileType.File and i.base_name.endswith((".warc", ".warc.gz")))
        scheme = self.path.split("://", 1)[0] + "://" if "://" in self.path else ""
        files = [WarcFile(scheme + n if scheme and not n.startswith(scheme) else n) for n in names]
        return files or [WarcFile(None)]

    def _passes(self, values: dict) -> bool:
        for f in self.pushed:
            v = values.get(f.attribute[0])
            if isinstance(f, EqualTo) and v != f.value:
                return False
            if isinstance(f, In) and v not in f.value:
                return False
            if isinstance(f, StringStartsWith) and (v is None or not v.startswith(f.value)):
                return False
        return True

    def read(self, partition: WarcFile):
        names = self.schema.names
        if partition.name is None:
            return
        wanted = set(names)
        needs_block = bool(wanted & {"payload", "payload_bytes", "payload_digest"})
        types = pa.schema([pa.field(f.name, _arrow(f.dataType.simpleString())) for f in self.schema.fields])
        fs, name = filesystem(partition.name)
        columns: dict[str, list] = {n: [] for n in names}

        def header_values(head: dict) -> dict:
            page = head.get("warc-page-id")
            return {"record_type": head.get("warc-type"), "page_id": int(page) if page else None, "target_uri": head.get("warc-target-uri")}

        def decide(head: dict) -> tuple[bool, bool]:
            return self._passes(header_values(head)), needs_block

        with fs.open_input_file(name) as raw:
            records = gzip_records if name.endswith(".gz") else plain_records
            for offset, head, block in records(Buffered(raw), decide):
                values = header_values(head)
                kind = values["record_type"]
                digest = (head.get("warc-payload-digest") or "").removeprefix("sha1:")
                payload, size = None, None
                if block is not None:
                    http, _, body = block.partition(b"\r\n\r\n")
                    if kind == "revisit":
                        size = _http_length(http)
                    else:
                        payload, size = body, len(body)
                        if "payload_digest" in wanted:
                            digest = base32_sha1(body)  # of the bytes read, not of the header
                refers = head.get("warc-refers-to-page-id")
                values |= {
                    "record_id": head.get("warc-record-id"),
                    "payload_digest": digest or None,
                    "payload_bytes": size,
                    "refers_to": int(refers) if refers and refers != "None" else None,
                    "refers_to_record": head.get("warc-refers-to"),
                    "file": partition.name,
                    "offset": offset,
                    "payload": payload,
                }
                for n in names:
                    columns[n].append(values[n])
                if len(columns[names[0]]) >= BATCH:
                    yield pa.RecordBatch.from_pydict(columns, schema=types)
                    columns = {n: [] for n in names}
        if names and columns[names[0]]:
            yield pa.RecordBatch.from_pydict(columns, schema=types)


def plain_records(stream: "Buffered", decide):
    """``(offset, header, block or None)`` of the records of an uncompressed file that ``decide`` keeps."""
    while True:
        offset = stream.tell()
        head = _head(stream)
        if head is None:
            return
        length = int(head.get("content-length", "0"))
        keep, block = decide(head)
        if keep and block:
            yield offset, head, stream.read(length)
            stream.skip(4)
        else:
            stream.skip(length + 4)
            if keep:
                yield offset, head, None


#: Subfield of the gzip header that holds the length of its member, so that a member can be skipped unread.
LENGTH_FIELD = b"WL"


def member(data: bytes) -> bytes:
    """One gzip member of a record, its whole length in an extra field of the header."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    extra = LENGTH_FIELD + struct.pack("<H", 8)
    total = 12 + len(extra) + 8 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra) + 8) + extra + struct.pack("<Q", total)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def gzip_records(stream: "Buffered", decide):
    """Records of a file of gzip members: the header is inflated first, a record not kept is skipped by its length."""
    while True:
        offset = stream.tell()
        fixed = stream.read(12)
        if len(fixed) < 12:
            return
        if fixed[:3] != b"\x1f\x8b\x08" or not fixed[3] & 4:
            raise ValueError(f"not a record member at {offset}")
        extra = stream.read(struct.unpack("<H", fixed[10:12])[0])
        total, at = None, 0
        while at + 4 <= len(extra):
            size = struct.unpack("<H", extra[at + 2 : at + 4])[0]
            if extra[at : at + 2] == LENGTH_FIELD:
                total = struct.unpack("<Q", extra[at + 4 : at + 12])[0]
            at += 4 + size
        if total is None:
            raise ValueError(f"member at {offset} does not give its length")
        left = total - 12 - len(extra) - 8
        inflater, out = zlib.decompressobj(-15), b""
        while b"\r\n\r\n" not in out and left > 0:
            chunk = stream.read(min(left, 4096))
            left -= len(chunk)
            out += inflater.decompress(chunk)
        head = _head(Buffered(io.BytesIO(out)))
        keep, block = decide(head)
        if not keep or not block:
            stream.skip(left + 8)
            if keep:
                yield offset, head, None
            continue
        out += inflater.decompress(stream.read(left)) + inflater.flush()
        crc, size = struct.unpack("<II", stream.read(8))
        if zlib.crc32(out) != crc or len(out) & 0xFFFFFFFF != size:
            raise ValueError(f"member at {offset} is damaged")
        data = out[out.index(b"\r\n\r\n") + 4 :]
        length = int(head.get("content-length", "0"))
        yield offset, head, data[:length]


class FilteringWarcReader(WarcReader):
    """The reader with filters on header fields pushed down (when the session allows it)."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in HEADER_COLUMNS:
                self.pushed.append(f)
            else:
                yield f


def _arrow(kind: str) -> pa.DataType:
    return {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[kind]


class Buffered:
    """Lines and blocks of a seekable stream, read in chunks; skipping seeks past what is not buffered."""

    CHUNK = 1 << 16

    def __init__(self, raw):
        self.raw, self.buffer, self.at, self.base = raw, b"", 0, raw.tell()

    def tell(self) -> int:
        return self.base + self.at

    def _fill(self) -> bool:
        more = self.raw.read(self.CHUNK)
        if not more:
            return False
        self.base += self.at
        self.buffer, self.at = self.buffer[self.at :] + more, 0
        return True

    def readline(self) -> bytes:
        while True:
            end = self.buffer.find(b"\n", self.at)
            if end >= 0:
                line, self.at = self.buffer[self.at : end + 1], end + 1
                return line
            if not self._fill():
                line, self.at = self.buffer[self.at :], len(self.buffer)
                return line

    def read(self, size: int) -> bytes:
        while len(self.buffer) - self.at < size and self._fill():
            pass
        out = self.buffer[self.at : self.at + size]
        self.at += len(out)
        return out

    def skip(self, size: int) -> None:
        left = len(self.buffer) - self.at
        if size <= left:
            self.at += size
            return
        target = self.tell() + size
        self.raw.seek(target)
        self.buffer, self.at, self.base = b"", 0, target


def _head(stream: Buffered) -> dict | None:
    """Fields of the next record's header, names in lower case; None at the end of the file."""
    line = stream.readline()
    while line == b"\r\n":
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record at {stream.tell() - len(line)}")
    fields = {}
    while True:
        line = stream.readline()
        if line in (b"\r\n", b""):
            return fields
        key, _, value = line.decode("utf-8").partition(":")
        fields[key.strip().lower()] = value.strip()


def _http_length(http: bytes) -> int | None:
    for line in http.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == b"content-length":
            return int(value.strip())
    return None


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        kind = FilteringWarcReader if self.options.get("pushFilters", "false") == "true" else WarcReader
        return kind(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite, int(self.options.get("rollBytes", ROLL_BYTES)))


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session, with filter pushdown where the session lets it be set."""
    spark.dataSource.register(WarcSource)
    try:
        spark.conf.set(PUSHDOWN, "true")
    except Exception:  # noqa: BLE001 - a session that fixes the setting reads without pushdown
        pass


def payload_of(html: str = "html"):
    """The html in UTF-8; null is empty."""
    return F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")


def write_pages(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> None:
    """A record per page: of pages with equal payloads the smallest id is the response, the others revisit it.

    Equal payloads are found by SHA-1 and SHA-256 together. The smallest id of
    each digest is combined before the shuffle, so a payload shared by a third
    of all pages costs one row a task; the pages then meet it in one join,
    which Spark may broadcast when the digests turn out small and otherwise
    splits where a digest is hot. Pages with a null id are responses of
    their own.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("target_uri"),
        payload_of(html_column).alias("payload"),
    ).withColumn("__digest", F.concat(F.unhex(F.sha1("payload")), F.unhex(F.sha2("payload", 256))))
    first = rows.where(F.col("page_id").isNotNull()).groupBy("__digest").agg(F.min("page_id").alias("__first"))
    decided = rows.join(first, "__digest", "left").select(
        "page_id",
        "target_uri",
        F.when(F.col("page_id").isNull() | (F.col("page_id") == F.col("__first")), F.lit("response")).otherwise(F.lit("revisit")).alias("record_type"),
        F.when(F.col("page_id") > F.col("__first"), F.col("__first")).alias("refers_to"),
        F.when(F.col("page_id").isNull() | (F.col("page_id") == F.col("__first")), F.col("payload")).alias("payload"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("size"),
    )
    register(pages.sparkSession)
    decided.write.format(FORMAT).mode("overwrite").save(path)


def read_archive(spark: SparkSession, path: str, columns: str | None = None) -> DataFrame:
    """The records of the archives in a folder; ``columns`` (DDL) picks fields of :data:`SCHEMA`."""
    register(spark)
    reader = spark.read.format(FORMAT).option("pushFilters", spark.conf.get(PUSHDOWN, "false"))
    if columns is not None:
        reader = reader.schema(columns)
    return reader.load(path)

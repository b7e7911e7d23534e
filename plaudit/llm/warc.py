"""WARC archives as a PySpark Python data source.

``register(spark)`` makes ``format("warc")`` known.

*Writing.* One or more gzip archives a task, one gzip member a record. The
members carry their compressed length in an ``sl`` extra field, so that a
reader can go from one record to the next without inflating it. Tasks write
under hidden names; the driver renames the files of the attempts that count
when the job commits, so a lost or repeated task leaves nothing to be read.

*Reading.* Partitions are files, or ranges of ``splitBytes`` bytes of large
files whose members carry lengths; a range starts at the first member in it.
Only the head of a member is inflated to parse its headers; predicates on the
record type and the header columns are applied there, and a record that fails,
or whose payload nobody wants, is skipped by its length. Length and digest of
the payload may be missing in the headers of other writers and are then taken
from the payload, so predicates on them are left to Spark. The payload of a
response is its HTTP body, of a revisit null, of any other record its block. A
damaged or cut off record is an error.

Options: ``path``; ``payload`` (``true``: return payloads, ``verify``: check
them against their digest without returning them, ``false``: leave them
alone); ``splitBytes``; ``fileBytes`` for the writer.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull,
    WriterCommitMessage)

from .common import cut, scratch_path

SCHEMA = ("record_id string, record_type string, target_uri string, page_id long, refers_to long, "
          "payload_bytes long, payload_digest string, payload binary")
_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                    ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("payload", pa.binary())])
# Columns that headers may not hold; predicates on them are left to Spark.
_FROM_PAYLOAD = ("payload_bytes", "payload_digest", "payload")
# Fixed values of the formats.
_VERSION = b"WARC/1.1\r\n"
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MEMBER = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + b"\x0c\x00sl\x08\x00"  # gzip header up to the lengths
_DATE = "2024-01-01T00:00:00Z"  # the tables hold no fetch time
_ID = "<urn:page:%d>"


def _member(data: bytes, level: int = 1) -> bytes:
    """One gzip member; its extra field holds the compressed and full length."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    size = len(_MEMBER) + 8 + len(body) + 8
    return (_MEMBER + struct.pack("<II", size, len(data) & 0xFFFFFFFF) + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def _one_line(value: str) -> str:
    return " ".join(value.split())


def record_bytes(row: dict) -> bytes:
    """A response record with the payload, or a revisit record without it."""
    kind, size = row["record_type"], row["payload_bytes"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + ((row["payload"] or b"") if kind == "response" else b"")
    page = row["page_id"]
    record = _ID % page if page is not None else "<urn:uuid:%s>" % uuid.uuid5(
        uuid.NAMESPACE_URL, f"{row['target_uri']} {row['payload_digest']}")
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    head = [("WARC-Type", kind), ("WARC-Record-ID", record), ("WARC-Date", _DATE)]
    if row["target_uri"]:
        head.append(("WARC-Target-URI", _one_line(row["target_uri"])))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        head += [("WARC-Profile", _SAME), ("WARC-Refers-To", _ID % row["refers_to"]),
                 ("WARC-Refers-To-Date", _DATE)]
    head += [("X-Payload-Length", str(size)), ("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return _VERSION + lines + b"\r\n" + block + b"\r\n\r\n"


# --------------------------------------------------------------------------
# Writer
# --------------------------------------------------------------------------

@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.limit = int(options.get("filebytes", 1 << 30))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                if out is None:
                    files.append(f".{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                data = _member(record_bytes({n: batch.column(n)[i].as_py() for n in batch.schema.names}))
                out.write(data)
                size += len(data)
                if size >= self.limit:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for name in (f for m in messages if m for f in m.files):
            fs.move(f"{root}/{name}", f"{root}/part-{name[1:]}")

    def abort(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for name in (f for m in messages if m for f in m.files):
            fs.delete_file(f"{root}/{name}")


# --------------------------------------------------------------------------
# Reader
# --------------------------------------------------------------------------

@dataclass
class _Range(InputPartition):
    file: str
    start: int
    end: int


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _page(urn: str | None) -> int | None:
    tail = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(tail) if tail.lstrip("-").isdigit() else None


def _row(h: dict[str, str]) -> dict:
    """Columns of a record from its headers; a digest in another form than
    SHA-1 in base 32 is passed through."""
    digest = h.get("warc-payload-digest")
    if digest and digest.startswith("sha1:") and len(digest) == 37:
        digest = base64.b32decode(digest[5:]).hex()
    size = h.get("x-payload-length")
    return {"record_id": h.get("warc-record-id"), "record_type": h.get("warc-type"),
            "target_uri": h.get("warc-target-uri"), "page_id": _page(h.get("warc-record-id")),
            "refers_to": _page(h.get("warc-refers-to")), "payload_bytes": int(size) if size else None,
            "payload_digest": digest, "payload": None}


class _Inflater:
    """A gzip member read in steps: the headers of a record, its block, the
    next record, without inflating more than is asked for."""

    def __init__(self, f, at: int, known: int | None):
        self.f, self.at, self.known = f, at, known
        self.z, self.out, self.read = zlib.decompressobj(31), bytearray(), 0
        f.seek(at)

    def _more(self) -> bool:
        if self.z.eof:
            return False
        want = 1 << 12 if not self.read else 1 << 18
        if self.known is not None:
            want = min(want, self.known - self.read)
        raw = self.f.read(want) if want > 0 else b""
        self.read += len(raw)
        self.out += self.z.decompress(raw)
        return bool(raw)

    def begins_record(self) -> bool:
        """Whether this is a member at all and starts with a record."""
        try:
            while len(self.out) < 5 and self._more():
                pass
        except zlib.error:
            return False
        return self.out[:5] == b"WARC/"

    def headers(self) -> bytes | None:
        """The headers of the next record; None at the member's end, also
        where some writers append an empty one."""
        seen = 0
        while True:
            if not seen and self.out[:1] in (b"\r", b"\n"):  # the two line ends after a block
                self.out = self.out.lstrip(b"\r\n")
            at = self.out.find(b"\r\n\r\n", max(0, seen - 3))
            if at >= 0:
                head, self.out = bytes(self.out[:at]), self.out[at + 4:]
                return head
            seen = len(self.out)
            if not self._more():
                if self.z.eof and not self.out.strip():
                    return None
                raise ValueError(f"the member at byte {self.at} has no end of its headers")

    def block(self, size: int) -> bytes:
        while len(self.out) < size and self._more():
            pass
        if len(self.out) < size:
            raise ValueError(f"the record at byte {self.at} ends after {len(self.out)} of {size} bytes")
        body, self.out = bytes(self.out[:size]), self.out[size:]
        return body

    def skip(self, size: int) -> None:
        while size > len(self.out):
            size -= len(self.out)
            self.out = bytearray()
            if not self._more():
                raise ValueError(f"the record at byte {self.at} lacks {size} bytes")
        self.out = self.out[size:]

    def end(self) -> int:
        """Where the next member starts, inflating on only if no length is known."""
        if self.known is not None:
            if self.at + self.known > self.f.size():
                raise ValueError(f"the member at byte {self.at} is cut off")
            return self.at + self.known
        while self._more():
            self.out = bytearray()
        if not self.z.eof:
            raise ValueError(f"the member at byte {self.at} is cut off")
        return self.at + self.read - len(self.z.unused_data)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true")
        self.split = int(options.get("splitbytes", 128 << 20))
        self.tests: list[tuple[str, set]] = []
        if self.payload not in ("true", "verify", "false"):
            raise ValueError("payload must be true, verify or false")

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name is None or name in _FROM_PAYLOAD:
                yield f
            elif isinstance(f, IsNotNull):
                self.tests.append((name, None))
            elif isinstance(f, EqualTo):
                self.tests.append((name, {f.value}))
            elif isinstance(f, In):
                self.tests.append((name, set(f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        files = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        plan = []
        for f in sorted(files, key=lambda x: x.path):
            if not f.is_file or f.base_name[0] in "._" or ".warc" not in f.base_name or not f.size:
                continue
            step = f.size
            if f.base_name.endswith(".gz") and f.size > self.split:
                with fs.open_input_file(f.path) as s:
                    step = self.split if s.read(len(_MEMBER)) == _MEMBER else f.size
            plan += [_Range(f.path, a, min(a + step, f.size)) for a in range(0, f.size, step)]
        return plan or [_Range("", 0, 0)]

    def _passes(self, row: dict) -> bool:
        return all(row[n] is not None and (want is None or row[n] in want) for n, want in self.tests)

    def _fill(self, row: dict, block: bytes) -> None:
        body = block
        if row["record_type"] == "response" and block[:5] == b"HTTP/":
            body = block.partition(b"\r\n\r\n")[2]
        if row["payload_bytes"] is None:
            row["payload_bytes"] = len(body)
        sha = hashlib.sha1(body).hexdigest()
        if row["payload_digest"] is None:
            row["payload_digest"] = sha
        elif row["record_type"] == "request":
            pass  # the header's digest is that of the HTTP body alone
        elif len(row["payload_digest"]) == 40 and (sha, len(body)) != (row["payload_digest"], row["payload_bytes"]):
            raise ValueError(f"payload of {row['record_id']} does not match its digest")
        if self.payload == "true":
            row["payload"] = body

    def _wants(self, row: dict) -> bool:
        return self.payload != "false" and row["record_type"] != "revisit"

    def _gzip(self, f, start: int, end: int) -> Iterator[dict]:
        at = start
        if start:  # the first member that begins in the range
            tail = b""
            while True:
                f.seek(at)
                chunk = f.read(1 << 20)
                found = (tail + chunk).find(_MEMBER)
                if found >= 0:
                    at += found - len(tail)
                    tail = b""
                    if _Inflater(f, at, None).begins_record():  # else compressed data that looks like a member
                        break
                    at += 1
                    continue
                if not chunk:
                    return
                at += len(chunk)
                tail = (tail + chunk)[-len(_MEMBER) + 1:]
        while at < end:
            f.seek(at)
            head = f.read(len(_MEMBER) + 4)
            known = struct.unpack("<I", head[-4:])[0] if head[:len(_MEMBER)] == _MEMBER else None
            member = _Inflater(f, at, known)
            while (block := member.headers()) is not None:
                headers = _headers(block)
                row, size = _row(headers), int(headers.get("content-length", 0))
                if passes := self._passes(row):
                    if wants := self._wants(row):
                        self._fill(row, member.block(size))
                    yield row
                if known is not None:  # this writer's members hold one record
                    break
                if not (passes and wants):
                    member.skip(size)
            at = member.end()

    def _plain(self, f, end: int) -> Iterator[dict]:
        at, buffer = 0, b""
        while at < end:
            f.seek(at)
            buffer = f.read(1 << 13)
            while b"\r\n\r\n" not in buffer and (more := f.read(1 << 16)):
                buffer += more
            head, mark, _ = buffer.partition(b"\r\n\r\n")
            if not mark:
                if head.strip():
                    raise ValueError(f"the record at byte {at} has no end of its headers")
                return
            headers = _headers(head)
            size, body = int(headers.get("content-length", 0)), at + len(head) + 4
            if body + size > end:
                raise ValueError(f"the record at byte {at} ends after {end - body} of {size} bytes")
            row = _row(headers)
            if self._passes(row):
                if self._wants(row):
                    f.seek(body)
                    self._fill(row, f.read(size))
                yield row
            at = body + size + 4

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, _ = pafs.FileSystem.from_uri(self.path)
        with fs.open_input_file(partition.file) as f:
            rows = (self._gzip(f, partition.start, partition.end) if partition.file.endswith(".gz")
                    else self._plain(f, partition.end))
            held, size = [], 0
            for row in rows:
                held.append(row)
                size += len(row["payload"] or b"") + 200
                if size >= 8 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                    held, size = [], 0
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options))


# --------------------------------------------------------------------------
# Pages to archives
# --------------------------------------------------------------------------

def records(pages: DataFrame, min_revisit: int = 1000, id_col: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """Rows for the writer. Of records with equal payloads of at least
    ``min_revisit`` bytes that with the largest id is a response and the others
    revisit it; the rest are responses. Null html: empty payload. Rows that
    repeat the largest id are responses too, rows without an id revisit a group
    that has one and are responses otherwise."""
    payload: Column = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("target_uri"),
                        payload.alias("payload"))
    rows = rows.select("*", F.length("payload").cast("long").alias("payload_bytes"),
                       F.sha1("payload").alias("payload_digest"))
    # Decided on the keys alone: groups of one need no partner, equal payloads
    # fold before the shuffle, and the written sides let AQE split a hot digest.
    same = ["payload_digest", "payload_bytes"]
    keys = cut(rows.where(F.col("payload_bytes") >= min_revisit).select("page_id", *same), "payload-keys")
    keep = cut(keys.groupBy(*same).agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
               .where("n > 1 and keep is not null").select(*same, "keep"), "payload-first")
    again = cut(keys.join(keep, same).where(~F.col("page_id").eqNullSafe(F.col("keep"))).distinct(), "payload-again")
    # then payloads meet the revisits by page, so that equal payloads spread
    again = again.select(F.col("page_id").alias("_page"), *[F.col(c).alias(f"_{c}") for c in same], "keep")
    on = F.col("page_id").eqNullSafe(F.col("_page"))
    for c in same:
        on &= F.col(c) == F.col(f"_{c}")
    revisit = F.col("keep").isNotNull()
    return (rows.join(again, on, "left")
            .select(F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri", "page_id",
                    F.col("keep").alias("refers_to"), "payload_bytes", "payload_digest",
                    F.when(~revisit, F.col("payload")).alias("payload")))


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known; its predicates need Spark's switch for
    push-down into Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def write_archives(pages: DataFrame, path: str | None = None, **options: int) -> str:
    """Write the pages as archives under ``path`` (default: a fresh shared
    folder) and return it."""
    spark = pages.sparkSession
    register(spark)
    path = path or scratch_path(spark, "warc")
    records(pages, **options).write.format("warc").mode("append").save(path)
    return path


def read_archives(spark: SparkSession, path: str, payload: str = "true") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)

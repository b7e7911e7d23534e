"""Quoted multi-line CSV read by byte ranges, many tasks to a file (A1).

Spark reads a ``multiLine`` file in one task, because a line break may lie
inside quotes. Here the quotes of every byte range are counted first; their
prefix parity along the file tells each range whether it starts inside quotes,
so it finds the next true record start on its own and reads on past its end to
finish its last record. The records go to Spark's ``from_csv``.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")
QUOTE, NEWLINE = 0x22, 0x0A


def _open(path: str):
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path[len("file:"):].lstrip("/"))
    if "://" not in path:
        return pafs.LocalFileSystem().open_input_file(path)
    fs, inner = pafs.FileSystem.from_uri(quote(path, safe=":/@?=&"))
    return fs.open_input_file(inner)


def _quotes_in_range(path: str, start: int, end: int) -> int:
    n = 0
    with _open(path) as f:
        f.seek(start)
        while start < end:
            block = f.read(min(BLOCK_BYTES, end - start))
            if not block:
                break
            n += block.count(b'"')
            start += len(block)
    return n


def _records(path: str, start: int, end: int, inside: bool, sep: int,
             block_bytes: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The records that begin in [start, end), a list per block read.

    ``inside`` tells whether ``start`` lies within quotes. Reading begins one
    byte earlier, so that a record starting exactly at ``start`` is seen."""
    opens_after = np.array([sep, NEWLINE, QUOTE], np.uint8)
    with _open(path) as f:
        pos = max(start - 1, 0)
        f.seek(pos)
        skipping, odd, pending, last = start > 0, int(inside), [], None
        first = True
        while block := f.read(block_bytes):
            a = np.frombuffer(block, np.uint8)
            if first and start > 0 and a[0] == QUOTE:
                odd ^= 1
            quotes, lines = np.flatnonzero(a == QUOTE), np.flatnonzero(a == NEWLINE)
            opening = quotes[(odd + np.arange(len(quotes))) % 2 == 0]
            before = a[np.maximum(opening - 1, 0)]
            bad = ~np.isin(before, opens_after)
            if len(opening) and opening[0] == 0:
                # a file's first byte, or the byte before this range, which the range before has checked
                bad[0] = last is not None and last not in opens_after
            if bad.any() and not _after_mark(a, pos, opening[bad]):
                raise ValueError(f"{path}: a quote inside an unquoted field near byte {pos + int(opening[bad][0])}; "
                                 "read this file with multiline=True, split=False")
            ends = lines[(odd + np.searchsorted(quotes, lines)) % 2 == 0]
            found, cut = [], 0
            for e in ends.tolist():
                if skipping:
                    skipping = False
                else:
                    pending.append(block[cut:e])
                    found.append(b"".join(pending))
                    pending = []
                cut = e + 1
                if pos + cut >= end:
                    yield found
                    return
            if not skipping:
                pending.append(block[cut:])
            yield found
            odd = (odd + len(quotes)) % 2
            pos, last, first = pos + len(block), a[-1], False
        if odd:
            raise ValueError(f"{path}: the file ends inside quotes; read it with multiline=True, split=False")
        if not skipping and any(pending):
            yield [b"".join(pending)]


def _after_mark(a: np.ndarray, pos: int, bad: np.ndarray) -> bool:
    """Whether the only odd opening quote is the first one after a UTF-8 byte order mark."""
    return pos == 0 and len(bad) == 1 and bad[0] == 3 and a[:3].tobytes() == b"\xef\xbb\xbf"


def _header(path: str, sep: str) -> str:
    for found in _records(path, 0, 1, False, ord(sep), 1 << 16):
        if found:
            return found[0].decode("utf-8-sig", "replace").rstrip("\r")
    raise ValueError(f"{path}: no header")


def _column_names(spark: SparkSession, header: str, options: dict[str, str]) -> list[str]:
    """The header's fields, parsed by Spark's CSV reader; empty and repeated
    names get their position, as that reader does."""
    n = sum(part.count(options.get("sep", ",")) for part in header.split('"')[::2]) + 1
    wide = ", ".join(f"c{i} STRING" for i in range(n))
    width = spark.range(1).select(F.from_csv(F.lit(header), wide, options).alias("h")).select("h.*").first()
    names = list(width)
    lower = [(x or "").lower() for x in names]
    return [f"_c{i}" if not x else f"{x}{i}" if lower.count(x.lower()) > 1 else x for i, x in enumerate(names)]


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   range_bytes: int = RANGE_BYTES, options: dict[str, str] | None = None) -> DataFrame:
    """CSV with a header and quoted newlines, one task per ``range_bytes``.

    UTF-8 files as RFC 4180 has them: a quote opens a field or is doubled
    inside one. Anything else (a bare quote in an unquoted field, an escape
    sign, a file that ends inside quotes) raises an error instead of moving a
    record boundary. Blank lines are skipped, ``\\r\\n`` ends a record too, an
    empty file gives no rows and every file's header line is dropped. All files
    have the columns of the first one, strings unless ``schema`` is given.
    Compressed files cannot be read from the middle and raise.

    The files' paths and lengths come to the driver, one row a file. Two passes
    over the bytes, nothing but one count per range is shuffled.
    """
    options = {"escape": '"', "multiLine": "true", **(options or {})}
    sep = options.get("sep", ",")
    if len(sep) != 1 or ord(sep) > 127:
        raise ValueError("the separator must be one ASCII character")
    files = [tuple(r) for r in spark.read.format("binaryFile").load(path)
             .select("path", "length").orderBy("path").collect() if r.length]
    packed = [p for p, _ in files if p.lower().endswith(COMPRESSED)]
    if packed:
        raise ValueError(f"compressed CSV cannot be split: {packed[0]}")
    if schema is None:
        if not files:
            raise ValueError(f"{path}: no header, pass a schema")
        schema = T.StructType([T.StructField(n, T.StringType())
                               for n in _column_names(spark, _header(files[0][0], sep), options)])
    ranges = (spark.createDataFrame(files, "path string, length long")
              .select("path", "length", F.explode(F.expr(f"sequence(0L, length - 1, {int(range_bytes)}L)")).alias("start"))
              .select("path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("end")))
    tasks = max(1, sum(-(-n // range_bytes) for _, n in files))

    def count(batches):
        for b in batches:
            rows = b.to_pylist()
            yield pa.RecordBatch.from_pylist(
                [{**r, "quotes": _quotes_in_range(r["path"], r["start"], r["end"])} for r in rows],
                schema=pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("quotes", pa.int64())]))

    def read(batches):
        for b in batches:
            for r in b.to_pylist():
                header = r["start"] == 0
                for found in _records(r["path"], r["start"], r["end"], r["inside"], ord(sep)):
                    if header and found:
                        found, header = found[1:], False
                    texts = [x[:-1] if x.endswith(b"\r") else x for x in found]
                    texts = [x.decode("utf-8", "replace") for x in texts if x]
                    if texts:
                        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["record"])

    counted = ranges.repartition(tasks).mapInArrow(count, "path string, start long, end long, quotes long")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    dealt = counted.select("path", "start", "end",
                           (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    records = dealt.repartition(tasks).mapInArrow(read, "record string")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
